"""Exact substring dedup by longest-previous-factor arrays, distributed.

A byte is removed if a ``LENGTH``-byte string that covers it also starts
elsewhere.  The strings are brought together as follows.

1. Anchors.  Every ``LENGTH``-byte string has one anchor: the smallest hash
   among its ``GRAM``-byte substrings.  Equal strings have equal anchors, so a
   string can only repeat among the occurrences of its anchor.  An occurrence
   owns the run of string starts that chose it; the bytes of these strings are
   its context.
2. Anchors that occur once are dropped by a count.  Contexts that occur twice
   in full are settled by a count as well: all their strings repeat.
3. One copy of each other context whose anchor has several contexts goes, by
   anchor, to a task that sorts the suffixes of its contexts and derives the
   longest-previous-factor array: the previous and the next smaller position
   in suffix order are where the longest earlier match starts.  The mirrored
   array (larger positions) gives later matches.

An anchor with more than ``GROUP`` contexts is split: its contexts are cut into
``BLOCK``-wide ranges of string starts, keyed by the bytes that all strings of
the range share; what is still too large then holds (nearly) equal strings and
is settled by counting the strings themselves.  No group grows with the data.

``keep="none"`` removes every copy; ``keep="first"`` keeps the copy with the
smallest (id, position).

Defined results: null text is empty; texts shorter than ``LENGTH`` lose
nothing; matches never cross documents; repeated rows are copies of each
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, prepare, with_row_key
from .shingles import mix

LENGTH, GRAM = 200, 64
REACH = LENGTH - GRAM + 1  # grams of a string
GROUP, BLOCK = 2000, 17
#: Bytes handled at once when anchors are chosen.
STRETCH = 1 << 18
_POS = np.uint64((1 << 20) - 1)
_BYTE = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.random.default_rng(78).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def power_hashes(raw: np.ndarray, upto: int) -> dict[int, np.ndarray]:
    """Hashes of all substrings of 1, 2, 4, ... ``upto`` bytes, by doubling."""
    out, h, size = {}, _BYTE[raw], 1
    with np.errstate(over="ignore"):
        for step in _STEP:
            out[size] = h
            if size >= upto or len(h) <= size:
                break
            h = h[:-size] * step + h[size:]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            size *= 2
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Occurrences in documents laid end to end (``bounds``: starts and the end).

    Returns (document, first start, last start, anchor position, anchor hash,
    context hash); positions are in ``raw``.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(raw) < LENGTH:
        return none
    hashes = power_hashes(raw, 128)
    gram, wide = hashes[GRAM], hashes[128]
    at = np.arange(len(gram), dtype=np.uint64)
    chosen = (sliding_min((gram & ~_POS) | at, REACH) & _POS).astype(np.int64)  # leftmost smallest gram of each string
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n)), np.maximum(n - LENGTH + 1, 0))
    if not len(doc):
        return none
    start = np.concatenate([np.arange(a, a + m - LENGTH + 1) for a, m in zip(bounds[:-1].tolist(), n.tolist(), strict=True) if m >= LENGTH])
    own = chosen[start]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.concatenate([first[1:], [len(own)]]) - 1
    s0, s1, a = start[first], start[last], own[first]
    with np.errstate(over="ignore"):
        # 128-byte hashes at the start, the middle and the end cover the context
        c = mix(wide[s0] * _STEP[10] + wide[(s0 + s1 + LENGTH - 128) // 2] * _STEP[11] + wide[s1 + LENGTH - 128] * _STEP[12]
                + (s1 - s0).astype(np.uint64) * _STEP[13] + (a - s0).astype(np.uint64) * _STEP[14])
    return doc[first], s0, s1, a, gram[a], c


OCCURRENCE = ["h", "c", "row", "place", "n"]
_ROOM = (1 << 40) - 1


def occurrences(docs: DataFrame) -> DataFrame:
    """``h, c, row, place, n`` for every anchor of every text; rows are ``row, text``.

    ``place`` packs the first start, the number of further starts and the
    anchor's distance from the first start.  A context that a text repeats is
    sent once, with its count ``n``; its later copies repeat for certain and
    are sent as ranges ``c`` to ``place`` with ``n`` = 0 (and any ``h``), so a
    periodic text is a few rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(rows: list, offsets: list, parts: list) -> pa.RecordBatch:
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            doc, s0, s1, a, h, c = anchors(np.frombuffer(b"".join(parts), np.uint8), bounds)
            if not len(doc):
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 5, names=OCCURRENCE)
            row, begin = np.array(rows, np.int64)[doc], s0 - bounds[doc] + np.array(offsets, np.int64)[doc]
            place = (begin << 16) | ((s1 - s0) << 8) | (a - s0)
            order = np.lexsort((begin, c, h, doc))
            same = np.zeros(len(order), bool)
            same[1:] = (doc[order[1:]] == doc[order[:-1]]) & (h[order[1:]] == h[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
            lead = np.flatnonzero(~same)
            n = np.diff(np.concatenate([lead, [len(order)]]))
            first, later = order[lead], order[same]
            cols = [h[first].view(np.int64), c[first].view(np.int64), row[first], place[first], n]
            if len(later):
                # ranges of later copies, merged text by text (a text's positions stay below 2**40)
                at = doc[later].astype(np.int64) << 40
                r = merge(np.stack([at + begin[later], at + begin[later] + (s1 - s0)[later] + LENGTH], axis=1))
                of, b, e = r[:, 0] >> 40, r[:, 0] & _ROOM, r[:, 1] & _ROOM
                own = np.array(rows, np.int64)[of]
                more = [mix(own.view(np.uint64) ^ b.astype(np.uint64)).view(np.int64), b, own, e, np.zeros(len(b), np.int64)]
                cols = [np.concatenate(x) for x in zip(cols, more, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=OCCURRENCE)

        rows, offsets, parts, size = [], [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(len(raw) - LENGTH + 1, 0), STRETCH):
                    part = raw[at : at + STRETCH + LENGTH - 1]  # strings that start in the stretch
                    if size and size + len(part) > 3 * STRETCH:
                        yield emit(rows, offsets, parts)
                        rows, offsets, parts, size = [], [], [], 0
                    rows.append(i)
                    offsets.append(at)
                    parts.append(part)
                    size += len(part)
                    if size >= STRETCH:
                        yield emit(rows, offsets, parts)
                        rows, offsets, parts, size = [], [], [], 0
        if parts:
            yield emit(rows, offsets, parts)

    return docs.select("row", "text").mapInArrow(run, ", ".join(f"{x} long" for x in OCCURRENCE))


# -- suffix order ------------------------------------------------------------


def ranks(raw: np.ndarray) -> dict[int, np.ndarray]:
    """Dense ranks of the substrings of 8, 16, ... 128 and ``LENGTH`` bytes at every position that has them."""
    out: dict[int, np.ndarray] = {}
    if len(raw) < LENGTH:
        return out
    word = np.zeros(len(raw) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | raw[k : len(raw) - 7 + k]
    size, rank = 8, np.unique(word, return_inverse=True)[1]
    while True:
        out[size] = rank
        step = size if size < 128 else LENGTH - 128  # the last two substrings overlap
        if size == LENGTH:
            return out
        width = int(rank.max()) + 1
        rank = np.unique(rank[:-step].astype(np.int64) * width + rank[step:], return_inverse=True)[1]
        size = 2 * size if size < 128 else LENGTH


def lcp(raw: np.ndarray, rank: dict[int, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes at i and j, up to ``LENGTH`` (both have that many bytes)."""
    out = np.where(rank[LENGTH][i] == rank[LENGTH][j], LENGTH, 0)
    part = np.flatnonzero(out == 0)
    at = np.zeros(len(part), np.int64)
    for size in (128, 64, 32, 16, 8):
        r = rank[size]
        x, y = i[part] + at, j[part] + at
        ok = (x < len(r)) & (y < len(r))
        same = np.zeros(len(part), bool)
        same[ok] = r[x[ok]] == r[y[ok]]
        at[same] += size
    going = np.ones(len(part), bool)
    for _ in range(8):
        x, y = i[part] + at, j[part] + at
        going &= (x < len(raw)) & (y < len(raw))
        going[going] = raw[x[going]] == raw[y[going]]
        at[going] += 1
    out[part] = np.minimum(at, LENGTH - 1)
    return out


def smaller(sa: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous smaller value of every entry of ``sa`` (index, -1 if none) and the minimum of
    ``near`` (common prefix with the entry before) on the way, by pointer jumping."""
    link, low = np.arange(len(sa)) - 1, near.copy()
    todo = np.flatnonzero(link >= 0)
    todo = todo[sa[link[todo]] > sa[todo]]
    while len(todo):
        via = link[todo]
        low[todo] = np.minimum(low[todo], low[via])
        link[todo] = link[via]
        todo = todo[link[todo] >= 0]
        todo = todo[sa[link[todo]] > sa[todo]]
    low[link < 0] = 0
    return link, low


def factors(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor (up to ``LENGTH``) of the suffixes at ``starts``.

    Every start has ``LENGTH`` bytes before its context ends; suffix order,
    neighbours' common prefixes and the nearest smaller positions on both
    sides give the longest match that starts earlier, larger positions the
    longest that starts later.
    """
    if not len(starts):
        return starts, starts
    rank = ranks(raw)
    sa = starts[np.lexsort((starts, rank[LENGTH][starts]))]
    near = np.zeros(len(sa), np.int64)
    near[1:] = lcp(raw, rank, sa[:-1], sa[1:])
    after = np.concatenate([near[1:], [0]])[::-1]
    out = []
    for order in (sa, -sa):
        before = smaller(order, near)[1]
        behind = smaller(order[::-1], after.copy())[1][::-1]
        full = np.zeros(int(starts.max()) + 1, np.int64)
        full[sa] = np.maximum(before, behind)
        out.append(full[starts])
    return out[0], out[1]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


# -- jobs --------------------------------------------------------------------

UNITS = "key long, row long, first long, bytes binary"


def units(requests: DataFrame) -> DataFrame:
    """Contexts with their bytes; rows are ``row, text, asked`` (array of ``place, h, hot``).

    A context of a split anchor is cut into ranges of starts by their distance
    to the anchor, keyed by the bytes that all strings of the range share.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, rows, firsts, parts = [], [], [], []
            for i, t, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                for q in asked:
                    s0, more, far = q["place"] >> 16, (q["place"] >> 8) & 255, q["place"] & 255
                    a, s1 = s0 + far, s0 + more
                    if not q["hot"]:
                        cuts = [(q["h"], s0, s1)]
                    else:
                        cuts = []
                        for b in range((a - s1) // BLOCK, (a - s0) // BLOCK + 1):
                            lo, hi = b * BLOCK, b * BLOCK + BLOCK - 1  # distances of the range
                            shared = raw[a - lo : a - hi + LENGTH] + f"{q['h']}/{b}".encode()
                            key = int.from_bytes(hashlib.blake2b(shared, digest_size=8).digest(), "little", signed=True)
                            cuts.append((key, max(s0, a - hi), min(s1, a - lo)))
                    for key, u0, u1 in cuts:
                        keys.append(key)
                        rows.append(i)
                        firsts.append(u0)
                        parts.append(raw[u0 : u1 + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(rows, pa.int64()), pa.array(firsts, pa.int64()), pa.array(parts, pa.binary())],
                names=["key", "row", "first", "bytes"])

    return requests.select("row", "text", "asked").mapInArrow(run, UNITS)


def matched(contexts: DataFrame, later_only: bool, batch_bytes: int = 1 << 20) -> DataFrame:
    """``row, b, e``: byte ranges covered by repeated strings, from the factor arrays of each group."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def solve(table) -> pa.RecordBatch:
            parts = table.column("bytes").to_pylist()
            n = np.array([len(p) for p in parts], np.int64)
            at = np.concatenate([[0], np.cumsum(n)])[:-1]
            raw = np.frombuffer(b"".join(parts), np.uint8)
            starts = np.concatenate([np.arange(a, a + m - LENGTH + 1) for a, m in zip(at.tolist(), n.tolist(), strict=True)])
            previous, following = factors(raw, starts)
            hit = (previous >= LENGTH) | (False if later_only else following >= LENGTH)
            flags = np.zeros(len(raw), bool)
            flags[starts] = hit
            rows, firsts = table.column("row").to_pylist(), table.column("first").to_pylist()
            out = [(rows[k], firsts[k] + x, firsts[k] + y + LENGTH)
                   for k in np.unique(np.searchsorted(at, starts[hit], side="right") - 1).tolist()
                   for x, y in _runs(flags[at[k] : at[k] + n[k]])]
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row", "b", "e"])

        held, size = [], 0
        for batch in batches:  # sorted by key: a flush must end with a whole group
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size >= batch_bytes:
                now = pa.concat_tables(held).combine_chunks()
                key = np.array(now.column("key"), np.int64)
                cut = int(np.searchsorted(key, key[-1], side="left"))
                if cut:
                    yield solve(now.slice(0, cut))
                rest = now.slice(cut)
                held, size = [rest], rest.nbytes
        if held and sum(len(t) for t in held):
            yield solve(pa.concat_tables(held).combine_chunks())

    dealt = contexts.repartition("key").sortWithinPartitions("key", "row", "first")
    return dealt.mapInArrow(run, "row long, b long, e long")


def counted(contexts: DataFrame, later_only: bool) -> DataFrame:
    """The same for ranges of nearly equal strings, by counting each string (combined on the map side)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keys, rows, starts = [], [], []
            for i, first, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                for k in range(len(raw) - LENGTH + 1):
                    keys.append(hashlib.blake2b(raw[k : k + LENGTH], digest_size=16).digest())
                    rows.append(i)
                    starts.append(first + k)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(rows, pa.int64()), pa.array(starts, pa.int64())], names=["s", "row", "b"])

    strings = contexts.mapInArrow(run, "s binary, row long, b long")
    again = strings.groupBy("s").agg(F.count("*").alias("n"), F.min(F.struct("row", "b")).alias("first")).where("n > 1")
    # written before the join, else the counts' own shuffle keeps Spark from splitting a hot string
    again = materialize(contexts.sparkSession, again, "counted-strings")
    hit = strings.join(again, "s")
    if later_only:
        hit = hit.where((F.col("row") != F.col("first.row")) | (F.col("b") != F.col("first.b")))
    return hit.select("row", "b", (F.col("b") + LENGTH).alias("e"))


def repeated_ranges(spark: SparkSession, docs: DataFrame, keep: str = "none", group: int = GROUP,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``row, b, e``: byte ranges (overlaps allowed) of ``row, text`` to remove."""
    prepare(spark)
    later_only = keep == "first"
    # pass 1 counts anchors, pass 2 finds them again: cheaper than keeping every occurrence on disk
    shared = occurrences(docs).where("n > 0").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    shared = materialize(spark, shared.select(F.col("h").alias("of")), "shared-anchors")
    found = occurrences(docs)
    found = found.join(shared, (found.h == shared.of) & (found.n > 0), "left").where("n = 0 or of is not null")
    found = materialize(spark, found.drop("of"), "shared-occurrences")
    occ = found.where("n > 0")

    contexts = occ.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min(F.struct("row", "place")).alias("rep"))
    contexts = materialize(spark, contexts, "contexts")
    # whole contexts that occur again
    twice = contexts.where("n > 1").select("h", "c", "rep")
    settled = occ.join(twice, ["h", "c"])
    if later_only:
        settled = settled.where((F.col("row") != F.col("rep.row")) | (F.col("place") != F.col("rep.place")))
    begin = F.shiftright("place", 16)
    more = F.shiftright("place", 8).bitwiseAND(F.lit(255))
    spans = settled.select("row", begin.alias("b"), (begin + more + LENGTH).alias("e"))
    spans = spans.unionByName(found.where("n = 0").select("row", F.col("c").alias("b"), F.col("place").alias("e")))

    # one copy of every context of an anchor that has several
    several = contexts.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    several = materialize(spark, several, "several-contexts")  # so that the join can split a hot anchor
    asked = contexts.join(several, "h").select(
        F.col("rep.row").alias("row"), F.struct(F.col("rep.place").alias("place"), "h", (F.col("k") > group).alias("hot")).alias("q")
    ).groupBy("row").agg(F.collect_list("q").alias("asked"))  # at most the anchors of one text
    asked = materialize(spark, asked, "asked-contexts")
    ids = asked.select("row")
    if ids.limit(broadcast_rows + 1).count() <= broadcast_rows:
        ids = F.broadcast(ids)
    texts = docs.select("row", "text").join(ids, "row", "left_semi").dropDuplicates(["row"])
    own = materialize(spark, units(texts.join(asked, "row")), "context-bytes")
    sizes = own.groupBy("key").agg(F.count("*").alias("k"))
    large = materialize(spark, sizes.where(F.col("k") > 2 * group).select("key"), "large-groups")
    spans = spans.unionByName(matched(own.join(large, "key", "left_anti"), later_only))
    if large.limit(1).count():
        spans = spans.unionByName(counted(own.join(large, "key", "left_semi"), later_only))
    return spans


def merge(ranges: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or touching ranges."""
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    end = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate([[True], ranges[1:, 0] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ranges) - 1]])
    return np.stack([ranges[new, 0], end[last]], axis=1)


def remove_repeats(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "none",
    with_kept: bool = False, group: int = GROUP, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document
    (and ``kept``, the remaining bytes, if ``with_kept``)."""
    prepare(spark)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, _ = with_row_key(own, "row")  # equal rows have equal ranges
    spans = repeated_ranges(spark, rows, keep, group, broadcast_rows)
    ranges = spans.groupBy(F.col("row").alias("of")).agg(F.collect_list(F.struct("b", "e")).alias("ranges"))
    # one list of a text's own ranges meets the text in a shuffle join, at every size
    joined = rows.join(ranges, rows.row == ranges.of, "left").select("doc_id", "text", "ranges")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            size, removed, n_spans, digest, kept = [], [], [], [], []
            for t, found in zip(batch.column(1), batch.column(2), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                if found.is_valid and len(found):
                    flat = found.values.flatten()
                    r = merge(np.stack([np.array(x, np.int64) for x in flat], axis=1))
                else:
                    r = np.zeros((0, 2), np.int64)
                edges = [0, *r.ravel().tolist(), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                size.append(len(raw))
                removed.append(len(raw) - len(rest))
                n_spans.append(len(r))
                digest.append(hashlib.sha256(rest).hexdigest())
                if with_kept:
                    kept.append(rest)
            cols = [batch.column(0), *[pa.array(x, pa.int64()) for x in (size, removed, n_spans)], pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * with_kept, names=names)

    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    )
