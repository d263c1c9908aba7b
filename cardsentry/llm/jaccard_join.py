"""N-gram Jaccard join by chosen paths.

Texts with the same words form one exact class; the join works on one
representative of each.  A representative is its set of five-word shingles,
embedded as a min-hash signature.  Each run starts one search tree: a node
samples coordinates (1 / similarity of them on average, one at least) and sends
a set to the child named by the coordinate and the set's value there, so sets
meet in a child only if they share the sampled token.  Buckets of at most
``LIMIT`` sets are compared by brute force on sketches; larger ones are split
again (Christiani and Pagh, 2017; Christiani, Pagh and Sivertsen, 2018).
``RUNS`` trees bring the chance to miss a pair at the threshold below 1/1000.
Candidates are verified exactly on the shingle sets of their whole texts.

Hot groups stay linear: in an oversize bucket every set is first compared with
a leader that is not yet linked, and a bucket whose sets all belong to one
verified component is finished, since its links are already implied.  Sets
that stay together in an oversize bucket through ``DEPTH`` splits are compared
block by block, each pair of blocks in a bucket of its own and each pair of sets in one
of them; of oversize buckets with equal members one is compared.

In a bucket with many candidates, the strongest links of each set and a maximum
spanning forest are verified first; a second pass over these buckets verifies every
remaining candidate between different components, so that no component is left split
by a rejected link.  All candidates of the other buckets are verified at once.

These links only name the components.  A link never leaves its component, so
``link_counts`` counts the links of a text on all pairs of its component,
exactly and by blocks of bounded size, each two blocks in a task of their own.

Defined results: null texts and texts without words are never linked and are
their own class; a shorter text than five words is one shingle; repeated rows
are members of one class; where ids repeat or are null, classes are named by a
hash of id and text instead of the smallest id; a pair at the similarity exactly is linked; texts of any
length are compared whole; an empty table gives an empty
result; only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, fitting, fresh, materialize, prepare, with_row_key, without
from .components import components
from .shingles import BINS, COORDS, jaccard, mix, shingle_set, signature, sketch, word_hashes

SIMILARITY = 0.8
RUNS = 8
LIMIT = 2000
DEPTH = 4
#: Sketches that agree this many standard deviations less than the threshold are not verified
#: (one pair in 30,000 at the threshold itself, fewer above).
DEVIATIONS = 4
#: Links of each set that a bucket sends to verification in the first pass, beside the forest.
STRONGEST = 2
#: A set in a bucket that is compared by brute force: the bucket, its group (itself, or the oversize bucket of which
#: it is two blocks), the set's block there, and whether pairs within one block are compared too.
MEMBER = ("bucket", "id", "grp", "side", "whole")
#: Texts and characters of a block when the links inside a component are counted.
BLOCK, BLOCK_CHARS = 1000, 1 << 23
#: Rows of a partition that hold a sketch, and pairs of texts (or texts of a cell) of one.
SKETCHES, TEXTS = 2000, 500
#: Shingles in at most this many texts of a cell are counted pair by pair, others by a product.
RARE, COLUMNS = 16, 4096


def features(rows: DataFrame) -> DataFrame:
    """Rows ``row, text, doc_id`` -> ``row, key, sig, sketch, doc_id``: the key is a 128-bit hash of the word sequence (null without words)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, sigs, sketches = [], [], []
            for t in batch.column(1):
                w = word_hashes(t.as_py())
                found = shingle_set(w)
                keys.append(hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None)
                sigs.append(signature(found).tobytes() if len(w) else None)
                sketches.append(sketch(found).tobytes() + len(found).to_bytes(4, "little") if len(w) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.binary()) for x in (keys, sigs, sketches)], batch.column(2)],
                names=["row", "key", "sig", "sketch", "doc_id"],
            )

    return rows.mapInArrow(run, "row long, key binary, sig binary, sketch binary, doc_id long")


def children(paths: np.ndarray, sigs: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child bucket) for every coordinate that a row's node samples."""
    with np.errstate(over="ignore"):
        draw = mix(paths[:, None] + np.arange(1, COORDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        chosen = draw < np.uint64(int(2**64 / (similarity * COORDS)) - 1)
        chosen[np.arange(len(paths)), draw.argmin(axis=1)] = True
        row, coord = np.nonzero(chosen)
        value = (coord.astype(np.uint64) << np.uint64(32)) | sigs[row, coord].astype(np.uint64)
        return row, mix(paths[row] ^ mix(value))


def few(rows: DataFrame, broadcast_rows: int) -> DataFrame:
    """Narrow, written ``rows``, broadcast while measured few."""
    return F.broadcast(rows) if rows.limit(broadcast_rows + 1).count() <= broadcast_rows else rows


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def roots(sets: DataFrame, runs: int, similarity: float) -> DataFrame:
    """``bucket, id``: the children of each run's root."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, sigs = np.array(batch.column(0), np.int64), _signatures(batch.column(1))
            out = [children(np.full(len(ids), mix(np.array([r + 1], np.uint64))[0]), sigs, similarity) for r in range(runs)]
            row, bucket = (np.concatenate([o[k] for o in out]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(ids[row])], names=["bucket", "id"])

    return sets.select("id", "sig").mapInArrow(run, "bucket long, id long")


def split(rows: DataFrame, similarity: float) -> DataFrame:
    """Rows ``bucket, id, sig`` of oversize buckets -> ``bucket, id`` of their children."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            paths, ids = np.array(batch.column(0), np.int64).view(np.uint64), np.array(batch.column(1), np.int64)
            row, bucket = children(paths, _signatures(batch.column(2)), similarity)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(ids[row])], names=["bucket", "id"])

    return rows.select("bucket", "id", "sig").mapInArrow(run, "bucket long, id long")


def _sketches(column) -> tuple[np.ndarray, np.ndarray]:
    """Sketches and set sizes (the last four bytes)."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS + 4)
    return raw[:, :BINS], np.ascontiguousarray(raw[:, BINS:]).view("<u4")[:, 0].astype(np.int64)


def close(agree: np.ndarray, filled: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sketches that agree in so many of so many filled bins can reach the similarity.

    The filled bins are a sample without replacement of the two sets' union
    (``sizes`` is the sum of their sizes), which bounds the deviation.
    """
    union = np.maximum(sizes / (1 + similarity), filled)
    slack = DEVIATIONS * np.sqrt(similarity * (1 - similarity) * filled * (1 - filled / np.maximum(union, 1))) + 1.5
    return agree >= similarity * filled - slack


def agreement(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every pair of rows, the bins that agree and the bins that are filled in one at least."""
    n, m = len(x), len(y)
    # bins that are empty in both say nothing
    empty = ((x == 0).astype(np.float32) @ (y == 0).astype(np.float32).T).astype(np.int16)
    same = np.zeros((n, m), np.int16)
    if n * m <= 4096:
        bits = np.packbits(x[:, None, :] == y[None, :, :], axis=2).view(np.uint64)
        same += np.bitwise_count(bits).sum(axis=2, dtype=np.int16)
        return same - empty, BINS - empty
    left, right = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    step = max(1, (1 << 18) // m)  # blocks that stay in the cache, summed in bytes
    for at in range(0, n, step):
        rows = slice(at, at + step)
        hit = np.empty((len(x[rows]), m), bool)
        for first in range(0, BINS, 64):
            part = np.zeros(hit.shape, np.int8)
            for k in range(first, first + 64):
                np.equal(left[k, rows, None], right[k, None, :], out=hit)
                part += hit.view(np.int8)
            same[rows] += part
    return same - empty, BINS - empty


def bucket_pairs(
    ids: np.ndarray, labels: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, similarity: float, everything: bool,
    group: int = 0, meets: list[set] | None = None, sides: np.ndarray | None = None,
) -> tuple[list[tuple[int, int]], bool]:
    """Candidate pairs of one bucket between different components, and whether some are left to the second pass.

    Few candidates are sent all at once, of many the strongest and a forest, or ``everything``.
    ``meets`` has the groups of each set: in the second pass a pair is left to the first
    group in which it meets.  ``sides`` are the blocks of two blocks of an oversize bucket:
    then only pairs between them count here.
    """
    n = len(ids)
    names, count = np.unique(labels, return_counts=True)
    # links inside the largest component are implied: only the other sets are compared
    rows = np.flatnonzero(labels != names[count.argmax()])
    agree, filled = agreement(sketches[rows], sketches)
    found = close(agree, filled, sizes[rows, None] + sizes[None, :], similarity) & (labels[rows, None] != labels[None, :])
    if sides is not None:
        found &= sides[rows, None] != sides[None, :]
    x, b = np.nonzero(found)
    a = rows[x]
    once = (a < b) | ~np.isin(b, rows)
    x, a, b = x[once], a[once], b[once]
    total = len(a)
    if everything and meets is not None:
        keep = np.array([min(meets[i] & meets[j]) == group for i, j in zip(a.tolist(), b.tolist(), strict=True)], bool)
    elif everything or len(a) <= (STRONGEST + 1) * n:
        keep = np.arange(len(a))
    else:
        order = np.lexsort((b, a, -agree[x, b] / filled[x, b]))
        parent = {x: x for x in labels.tolist()}
        used, keep = np.zeros(n, int), []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for k in order.tolist():
            i, j = int(a[k]), int(b[k])
            u, v = root(int(labels[i])), root(int(labels[j]))
            if u != v:
                parent[u] = v
            if u != v or min(used[i], used[j]) < STRONGEST:
                keep.append(k)
                used[[i, j]] += 1
        keep = np.array(keep, int)
    pairs = list(zip(ids[a[keep]].tolist(), ids[b[keep]].tolist(), strict=True))
    return pairs, not everything and len(pairs) < total


def brute_force(rows: DataFrame, similarity: float, everything: bool) -> DataFrame:
    """Distinct candidate pairs ``a, b`` of bounded buckets; rows are ``MEMBER`` columns with ``label, sketch, meets``.

    A row with ``cut`` instead of a pair names a bucket of which candidates are left to the second pass.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(part) -> pa.RecordBatch:
            bucket = np.array(part.column("bucket"), np.int64)
            ids, labels = (np.array(part.column(c), np.int64) for c in ("id", "label"))
            sketches, sizes = _sketches(part.column("sketch"))
            groups, sides = (np.array(part.column(c), np.int64) for c in ("grp", "side"))
            whole = np.array(part.column("whole"))
            meets = [set(x) for x in part.column("meets").to_pylist()] if everything else None
            cut = np.flatnonzero(np.diff(bucket)) + 1
            found, part_cut = set(), []
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True):
                if j - i > 1:
                    pairs, left = bucket_pairs(
                        ids[i:j], labels[i:j], sketches[i:j], sizes[i:j], similarity, everything,
                        int(groups[i]), meets[i:j] if everything else None, None if whole[i] else sides[i:j],
                    )
                    found.update((min(p), max(p)) for p in pairs)
                    part_cut += [int(bucket[i])] if left else []
            out = [(a, b, None) for a, b in sorted(found)] + [(None, None, c) for c in part_cut]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["a", "b", "cut"])

        rest = None
        for batch in batches:  # sorted by bucket; the last bucket may go on in the next batch
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            bucket = np.array(now.column("bucket"), np.int64)
            if not len(bucket):
                continue
            at = int(np.searchsorted(bucket, bucket[-1], side="left"))
            if at:
                yield emit(now.slice(0, at).combine_chunks())
            rest = now.slice(at).combine_chunks()
        if rest is not None and len(rest):
            yield emit(rest)

    dealt = rows.select(*MEMBER, "label", "sketch", "meets").repartition("bucket").sortWithinPartitions("bucket", "id")
    return dealt.mapInArrow(run, "a long, b long, cut long").distinct()


def verify(
    spark: SparkSession, pairs: DataFrame, texts: DataFrame, similarity: float, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``a, b, similarity`` for the (written) pairs whose exact similarity reaches the threshold.

    ``texts`` has ``row, text``, a row once.  Only the texts that occur in a
    pair move: pairs and rows are broadcast while measured few, else they meet the
    texts in a shuffle join.
    """
    ids, n = pairs.select(F.col("a").alias("row")).union(pairs.select("b")), pairs.count()
    if 2 * n <= broadcast_rows:
        ids, pairs = F.broadcast(ids), F.broadcast(pairs)
    else:
        ids = few(materialize(spark, ids.distinct(), "candidate-ids"), broadcast_rows)
    texts = texts.join(ids, "row", "left_semi")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last: dict[str, np.ndarray] = {}

        def shingles(t: str) -> np.ndarray:
            if t not in last:
                if len(last) > 64:
                    last.clear()
                last[t] = shingle_set(word_hashes(t))
            return last[t]

        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            s = np.array([jaccard(shingles(x[k].as_py()), shingles(y[k].as_py())) for k in range(batch.num_rows)], float)
            ok = pa.array(s >= similarity)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], names=["a", "b", "similarity"])
            yield out.filter(ok)

    both = texts.select(F.col("row").alias("a"), F.col("text").alias("ta")).join(pairs, "a")
    both = both.join(texts.select(F.col("row").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return materialize(spark, fitting(both, n, TEXTS).mapInArrow(run, "a long, b long, similarity double"), "links")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    runs: int = RUNS, limit: int = LIMIT, depth: int = DEPTH, broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``.

    ``members``: ``doc_id, row, text_class, class_id`` for every row; ``row``
    is its id (a hash of id and text where ids repeat), ``text_class`` the
    smallest row with the same words and ``class_id`` the smallest row of the
    linked component.  ``links``: verified pairs ``a, b, similarity`` of text
    classes (links that verified ones already imply inside a component are not
    all listed; ``link_counts`` counts them all).
    """
    members, links, _, _ = _joined(spark, docs, doc_id, text, similarity, runs, limit, depth, broadcast_rows)
    return members, links


def counted(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    broadcast_rows: int = BROADCAST_ROWS, block: int = BLOCK, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The ``members`` of ``near_duplicates`` with ``n_links``: the other texts that reach the similarity."""
    members, _, texts, labels = _joined(spark, docs, doc_id, text, similarity, RUNS, LIMIT, DEPTH, broadcast_rows)
    degree = link_counts(spark, texts, labels, similarity, broadcast_rows, block, block_chars)
    out = members.join(degree.withColumnRenamed("id", "text_class"), "text_class", "left")
    return out.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))


def link_counts(
    spark: SparkSession, texts: DataFrame, labels: DataFrame, similarity: float,
    broadcast_rows: int = BROADCAST_ROWS, block: int = BLOCK, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``id, n_links`` for every text class of a component (``labels`` has ``id, component``).

    A component is one cell, or meets in cells of two blocks each when it is
    large; a cell sends one number for each text, not its pairs.
    """
    near = texts.select(F.col("row").alias("id"), "text").join(few(labels, broadcast_rows), "id")
    # written before the join, else the counts' own shuffle keeps Spark from splitting a hot component
    sizes = near.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    sizes = sizes.select("component", "n", F.ceil(F.greatest(F.col("n") / block, F.col("chars") / block_chars)).cast("long").alias("blocks"))
    sizes = materialize(spark, fitting(sizes, labels.count()), "component-sizes")
    n = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    dealt = near.join(few(sizes.drop("n"), broadcast_rows), "component").withColumn("side", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = dealt.select(
        F.xxhash64("component", F.least("side", "other"), F.greatest("side", "other")).alias("cell"),
        "component", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "id", "text",
    )
    order = ("cell", "component", "lo", "hi", "side", "id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(ids: list[int], sets: list[np.ndarray], sides: list[int], apart: bool) -> pa.RecordBatch:
            n = cell_links(sets, np.array(sides), apart, similarity)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["id", "n_links"])

        now, ids, sets, sides = None, [], [], []
        for batch in batches:  # sorted by cell; a cell may go on in the next batch
            keys = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
            for key, side, i, t in zip(keys, batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6), strict=True):
                if key != now and ids:
                    yield emit(ids, sets, sides, now[2] != now[3])
                    ids, sets, sides = [], [], []
                now = key
                ids.append(i)
                sides.append(side)
                sets.append(shingle_set(word_hashes(t.as_py())))
        if ids:
            yield emit(ids, sets, sides, now[2] != now[3])

    parts = fitting(cells.repartition("cell"), n, TEXTS).sortWithinPartitions(*order).mapInArrow(run, "id long, n_links long")
    return materialize(spark, fitting(parts.groupBy("id").agg(F.sum("n_links").alias("n_links")), labels.count()), "link-counts")


def cell_links(sets: list[np.ndarray], sides: np.ndarray, apart: bool, similarity: float) -> np.ndarray:
    """Each set's number of links in a cell: to every other set, or (``apart``) to those of the other side."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n < 2 or apart and sides.min() == sides.max():
        return np.zeros(n, np.int64)
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    held = np.diff(np.concatenate([first, [len(flat)]]))
    both = np.zeros((n, n), np.int64)
    few = np.repeat((held > 1) & (held <= RARE), held)
    f, r = flat[few], row[few]
    for d in range(1, RARE):  # rows of one shingle stand in ascending order
        same = np.flatnonzero(f[d:] == f[:-d])
        if not len(same):
            break
        both += np.bincount(r[same] * n + r[same + d], minlength=n * n).reshape(n, n)
    both += both.T
    many = held > RARE
    column = np.repeat(np.cumsum(many) - 1, held)[np.repeat(many, held)]
    r = row[np.repeat(many, held)]
    for at in range(0, int(many.sum()), COLUMNS):
        a, z = np.searchsorted(column, [at, at + COLUMNS])
        x = np.zeros((n, int(column[z - 1]) - at + 1), np.float32)
        x[r[a:z], column[a:z] - at] = 1
        both += (x @ x.T).astype(np.int64)
    linked = both / np.maximum(sizes[:, None] + sizes[None, :] - both, 1) >= similarity
    np.fill_diagonal(linked, False)
    if apart:
        linked &= sides[:, None] != sides[None, :]
    return linked.sum(axis=1)


def _joined(
    spark: SparkSession, docs: DataFrame, doc_id: str, text: str, similarity: float, runs: int, limit: int, depth: int,
    broadcast_rows: int,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Members, links, ``row, text`` of every row and ``id, component`` of the linked text classes."""
    prepare(spark)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, unique = with_row_key(own, "row")
    texts = rows.select("row", "text") if unique else rows.select("row", "text").dropDuplicates(["row"])
    feats = materialize(spark, features(rows.select("row", "text", "doc_id")), "shingle-features")
    classes = feats.where("key is not null").groupBy("key").agg(
        F.min("row").alias("id"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")
    )
    classes = materialize(spark, fitting(classes, feats.count(), SKETCHES), "text-classes")
    sets, sketches = classes.select("id", "sig"), classes.select("id", "sketch")

    def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Adds ``label``: the verified component so far, else the id itself (then it is ``open``)."""
        if labels is None:
            return rows.withColumn("label", F.col("id")).withColumn("open", F.lit(True))
        rows = rows.join(few(labels, broadcast_rows), "id", "left").withColumn("open", F.col("component").isNull())
        return rows.withColumn("label", F.coalesce("component", "id")).drop("component")

    def sized(rows: DataFrame) -> DataFrame:
        """Buckets in which at least two components meet; the leader is a set that is not linked yet."""
        return rows.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"),
            F.coalesce(F.min(F.when(F.col("open"), F.col("id"))), F.min("id")).alias("leader"),
        ).where("n > 1 and lo <> hi").select("bucket", "n", "leader")

    links, labels, small, n_small = None, None, None, 0
    found = materialize(spark, roots(sets, runs, similarity), "buckets-0")
    for level in range(depth + 1):
        # written before the join, else the counts' own shuffle keeps Spark from splitting a hot bucket
        n_found = found.count()
        buckets = materialize(spark, fitting(sized(labelled(found, labels)), n_found), f"bucket-sizes-{level}")
        kept = materialize(spark, fitting(found.join(buckets, "bucket"), n_found), f"bucket-members-{level}")
        within = kept.where(F.col("n") <= limit).select(
            "bucket", "id", F.col("bucket").alias("grp"), F.lit(0).cast("long").alias("side"), F.lit(True).alias("whole"))
        small = within if small is None else small.unionByName(within)
        hot = kept.where(F.col("n") > limit)
        over = F.when(F.col("n") > limit, F.col("n"))
        n_hot, held, n_within = buckets.agg(F.count(over), F.coalesce(F.sum(over), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_small += n_within - held
        if not n_hot:
            break
        if level == depth:
            # blocks of an oversize bucket meet pairwise, each two in a bucket of their own
            hot = hot.join(distinct_buckets(hot), "bucket", "left_semi")
            blocks = F.ceil(F.col("n") / F.lit(max(1, limit // 2))).cast("long")
            dealt = hot.withColumn("x", F.pmod(F.xxhash64("id"), blocks)).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            met = dealt.select(
                F.xxhash64("bucket", F.least("x", "y"), F.greatest("x", "y")).alias("bucket"), "id",
                F.col("bucket").alias("grp"), F.col("x").alias("side"), (F.col("x") == F.col("y")).alias("whole"))
            small = small.unionByName(met)
            n_small += hot.agg(F.sum(blocks)).first()[0]
            break
        # every member of an oversize bucket against its leader, once for all buckets that the two share
        leaders = buckets.where(F.col("n") > limit).select("leader").distinct()
        lead = sketches.select(F.col("id").alias("leader"), F.col("sketch").alias("lead_sketch")).join(leaders, "leader", "left_semi")
        star = hot.where("id <> leader").select("id", "leader").distinct()
        star = sketches.join(F.broadcast(star) if held <= broadcast_rows else star, "id")
        # a sketch is as wide as 32 pairs of ids
        star = star.join(F.broadcast(lead) if 32 * n_hot <= broadcast_rows else lead, "leader")
        star = materialize(spark, agreeing(fitting(star, held, SKETCHES), similarity), "leader-pairs")
        star = verify(spark, star, texts, similarity, broadcast_rows)
        links = star if links is None else links.unionByName(star)
        labels = materialize(spark, components(spark, links, broadcast_rows=broadcast_rows), "components")
        alive = materialize(spark, fitting(unfinished(labelled(hot.select("bucket", "id"), labels)), n_hot), f"open-buckets-{level}")
        if not alive.limit(1).count():
            break
        hot = hot.select("bucket", "id").join(few(alive, broadcast_rows), "bucket", "left_semi")
        found = fitting(sets.join(F.broadcast(hot) if held <= broadcast_rows else hot, "id"), held, SKETCHES)
        found = split(found, similarity)
        found = materialize(spark, found, f"buckets-{level + 1}")

    # a few groups of each run: their number depends neither on the corpus nor on the blocks
    meets = small.groupBy("id").agg(F.collect_set("grp").alias("meets"))
    # a set's label is looked up once, not in each of its buckets
    small = small.join(labelled(sketches, labels).drop("open").join(meets, "id"), "id")
    small = materialize(spark, fitting(small, n_small, SKETCHES), "small-buckets")
    tried, meeting = links, small
    for everything in (False, True):
        pairs = brute_force(meeting, similarity, everything)
        pairs = materialize(spark, pairs, "bucket-pairs")
        cut, pairs = pairs.where("cut is not null").select(F.col("cut").alias("bucket")), pairs.where("cut is null").select("a", "b")
        if everything:
            pairs = materialize(spark, pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "untried-pairs")
        true = verify(spark, pairs, texts, similarity, broadcast_rows)
        links = true if links is None else links.unionByName(true)
        if everything and not true.limit(1).count():
            break
        tried = pairs if tried is None else tried.select("a", "b").unionByName(pairs)
        # a later pass only adds its links to the components so far
        edges = links.select("a", "b") if labels is None else (
            labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(true.select("a", "b")))
        labels = materialize(spark, components(spark, edges, broadcast_rows=broadcast_rows), "components")
        # the candidates of a bucket that is not cut are all tried
        if not cut.limit(1).count():
            break
        meeting = labelled(small.drop("label").join(few(cut, broadcast_rows), "bucket", "left_semi"), labels)

    members = feats.select("doc_id", "row", "key").join(classes.select("key", F.col("id").alias("text_class")), "key", "left")
    members = members.join(labels.select(F.col("id").alias("text_class"), "component"), "text_class", "left")
    alone = F.coalesce("text_class", "row")
    return members.select("doc_id", "row", alone.alias("text_class"), F.coalesce("component", alone).alias("class_id")), links, texts, labels


def unfinished(rows: DataFrame) -> DataFrame:
    """``bucket`` of the buckets in which two components meet (rows have ``bucket, label``)."""
    return rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")


def distinct_buckets(rows: DataFrame) -> DataFrame:
    """``bucket``: one of each group of buckets that hold the same sets.

    Texts that share a template stay together on many paths; comparing them once is enough.
    """
    held = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
    )
    return held.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")


def agreeing(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (id, leader) whose sketches are close enough to be verified."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            (x, n), (y, m) = _sketches(batch.column(2)), _sketches(batch.column(3))
            filled = ((x != 0) | (y != 0)).sum(axis=1)
            ok = close(((x == y) & (x != 0)).sum(axis=1), filled, n + m, similarity)
            ids, leads = (np.array(batch.column(k), np.int64)[ok] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids, leads)), pa.array(np.maximum(ids, leads))], names=["a", "b"])

    return rows.select("id", "leader", "sketch", "lead_sketch").mapInArrow(run, "a long, b long")


def one_of_each(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with one document (the smallest row key) of each class of near duplicates."""
    key = fresh("key")
    rows, unique = with_row_key(docs, key, doc_id, text)
    members, _ = near_duplicates(spark, docs, doc_id, text, similarity)
    gone = members.where("row <> class_id").select("row")
    kept = without(spark, rows, key, gone, "near-duplicates")
    return (kept if unique else kept.dropDuplicates([key])).drop(key)
