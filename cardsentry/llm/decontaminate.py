"""Benchmark decontamination by latent semantic retrieval.

1. Texts become word hashes, written once to the shared folder; document
   frequencies of hashed terms over all passages give the inverse weights, and
   the most frequent terms (stop words) get none: passages and windows are runs
   of the remaining content words.
2. A randomised SVD of the TF-IDF passage matrix A: every task adds up its part
   of (A'A) @ Omega for a fixed Gaussian Omega, the parts are summed by term
   blocks, and a Nystroem step (Tropp et al., 2017) turns the small sum into
   right singular vectors and singular values.  Its size is terms x rank,
   whatever the corpus.
3. Windows of documents and of benchmark items are folded in (V'x / sigma).  A
   running sum of folded words gives every window of a document; windows whose
   cosine to an item's window reaches the limit, and which share enough of its
   content words, are candidates.  So is, whatever its cosine, every place that
   holds ``GRAM`` words of an item in a row, found by an exact index.
4. A candidate is checked on its words: the longest common subsequence of the
   item and the document's region.  A long one is a leak; a medium one
   (a paraphrase) is a leak if the item's answer, its last sentence, is there
   as well.

Benchmark items are a query set: they go to every task in blocks of at most
``ITEM_BLOCK`` items and about ``ITEM_WORDS`` words, with one search for each block; products
are formed by blocks of ``PRODUCT`` windows on both sides, however long texts and items are.

Defined results: null and empty texts have no windows and are clean; documents
of any length are searched whole, in overlapping stretches; an item of fewer
than ``SHORT`` words must occur in full (found by an index of runs of its own length); one with few content words (a widely
leaked one turns its own words into stop words) is a candidate wherever two of
its words stand in a row;
items without words match nothing; repeated documents are each reported, a
repeated row once; an empty table or benchmark gives no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialize, prepare, with_row_key, without
from .shingles import byte_word_hashes, mix

TERMS = 1 << 14
RANK, EXTRA = 44, 4
#: Content words of a window and steps between windows.
WINDOW, STRIDE = 16, 6
#: Items' windows lie closer, so that some pair of windows is at most two words out of step.
ITEM_STRIDE = 3
#: Words of a passage in the document frequencies.
PASSAGE = 32
#: Terms in more than this share of the passages are stop words, up to that share of all words.
STOP_TERMS, STOP_WORDS = 0.01, 0.45
COSINE = 0.4
#: Share of an item window's content words that a document's window must hold.
SHARED = 0.4
#: Bins of the table that tells an item's words.
WORD_BINS = 1 << 12
#: Share of the item's words that the common subsequence must hold: alone, or with the answer.
STRONG, WEAK = 0.7, 0.45
#: Share of the answer's words, in order, that count as the answer being there.
ANSWER = 0.75
#: Shorter items must occur in full; items with fewer content words have no windows.
SHORT, FEW = 8, 4
#: Words by which a region exceeds the item on each side.
MARGIN = 10
#: Words between the regions that are tried around a candidate, and their share of a long item.
SLIDE, SLIDE_SHARE = 5, 8
#: Words in a row that make a place a candidate by themselves.
GRAM = 3
#: The same for items that have no windows.
FEW_GRAM = 2
ITEM_BLOCK, ITEM_WORDS = 5000, 1 << 18
#: Words searched at once, and the least overlap; it is longer where an item's region is.
STRETCH, OVERLAP = 1 << 16, 1024
#: Words of the documents searched together.
TOGETHER = 1 << 14
#: Windows of a product on each side, also inside one document or one item.
PRODUCT = 1 << 12
#: Parts into which the sums over terms are dealt.
BLOCKS = 64

LEAKS = "doc_id long, item_id long, word long, cosine double, lcs_words int, lcs_ratio double, answer_found boolean"


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    answer: np.ndarray


@dataclass
class Query:
    """A block of items, ready to be searched for."""

    items: list[Item]
    content: list[np.ndarray]  # places of each item's content words
    of: np.ndarray  # item of each window
    at: np.ndarray  # its first word in the item
    need: np.ndarray  # content words that a document's window must share
    vec: np.ndarray  # its unit vector
    known: np.ndarray  # (items x WORD_BINS): bins of the items' content words, laid flat
    exact: list[Grams]  # items that must occur in full, by their length
    union: np.ndarray  # content words of all items, by their first 20 bits
    groups: list[np.ndarray]  # windows that need the same number of words
    grams: list[Grams]


@dataclass
class Grams:
    """Exact index of the items' runs of ``size`` words, sorted by key."""

    size: int
    key: np.ndarray
    of: np.ndarray  # item of each run
    at: np.ndarray  # its place in the item
    table: np.ndarray  # whether some key has these first 20 bits


#: ASCII punctuation separates words.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def hashes(text: str | None) -> np.ndarray:
    """32-bit word hashes (case and ASCII punctuation do not matter)."""
    plain = (text or "").lower().encode("utf-8", "replace").translate(_PLAIN)
    return (byte_word_hashes(plain) >> np.uint64(32)).astype(np.uint32)


def answer_of(text: str) -> str:
    """The last sentence with at least two words, else the whole text."""
    parts = [p for p in text.replace("\n", " ").replace("?", ".").replace("!", ".").split(".") if len(p.split()) > 1]
    return parts[-1] if parts else text


def term(words: np.ndarray) -> np.ndarray:
    return (words & np.uint32(TERMS - 1)).astype(np.int64)


def hashed_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            words = [hashes(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["doc_id", "words"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, words binary")


def word_arrays(batch) -> list[np.ndarray]:
    found = (np.frombuffer(w.as_buffer(), np.uint32) for w in batch.column("words"))
    return [w for w in found if len(w)]


def content_of(words: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Places of the words that are not stop words."""
    return np.flatnonzero(idf[term(words)] > 0)


def passage_terms(docs: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms of documents laid end to end and the start of each passage among them."""
    docs = [d for d in docs if len(d)]
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum([len(d) for d in docs])
    starts = [np.arange(e - len(d), e, size) for d, e in zip(docs, ends, strict=True)]
    return term(np.concatenate(docs)), np.concatenate(starts)


def _summed(spark: SparkSession, parts: DataFrame, width: int) -> np.ndarray:
    """Sum of per-task matrices (TERMS x width), sent as rows ``block, salt, part``.

    Summed in two steps, so that a block's parts never meet in one task in
    numbers that grow with the corpus.
    """

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                x = np.frombuffer(p.as_buffer(), np.float64)
                total[b] = total[b] + x if b in total else x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([0] * len(total), pa.int32()),
             pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "salt", "part"])

    schema = "block int, salt int, part binary"
    tasks = min(BLOCKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    once = parts.repartition("block", "salt").mapInArrow(add, schema)
    rows = once.repartition(tasks, "block").mapInArrow(add, schema).collect()
    out = np.zeros((BLOCKS, TERMS // BLOCKS * width))
    for r in rows:
        out[r["block"]] += np.frombuffer(r["part"], np.float64)
    return out.reshape(TERMS, width)


def _parts(total: np.ndarray, salt: int):
    import pyarrow as pa

    blocks = total.astype(np.float64).reshape(BLOCKS, -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(BLOCKS), pa.int32()), pa.array([salt % 16] * BLOCKS, pa.int32()),
         pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "salt", "part"])


def frequencies(docs: list[np.ndarray], into: np.ndarray) -> int:
    """Add each term's number of passages; returns the passages."""
    t, starts = passage_terms(docs, PASSAGE)
    if len(starts):
        sizes = np.diff(np.concatenate([starts, [len(t)]]))
        rows = np.full((len(starts), PASSAGE), -1, np.int16)
        rows[np.repeat(np.arange(len(starts)), sizes), np.arange(len(t)) - np.repeat(starts, sizes)] = t
        rows.sort(axis=1)
        new = rows >= 0
        new[:, 1:] &= rows[:, 1:] != rows[:, :-1]
        into += np.bincount(rows[new], minlength=TERMS)
    return len(starts)


def inverse_frequencies(spark: SparkSession, words: DataFrame) -> np.ndarray:
    """Weight of each hashed term, from counts over all passages; 0 for stop words."""

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        total, n = np.zeros((TERMS, 2)), 0
        for batch in batches:
            n += frequencies(word_arrays(batch), total[:, 0])
        if n:
            total[0, 1] = n
            yield _parts(total, TaskContext.get().partitionId())

    total = _summed(spark, words.mapInArrow(run, "block int, salt int, part binary"), 2)
    return weights(total[:, 0], float(total[0, 1]))


def weights(df: np.ndarray, n: float) -> np.ndarray:
    idf = np.log((n + 1) / (df + 1)) + 0.05
    order = np.argsort(-df, kind="stable")
    so_far = np.cumsum(df[order])
    stop = (df[order] > STOP_TERMS * n) & (so_far <= STOP_WORDS * max(so_far[-1], 1))
    idf[order[stop]] = 0
    return idf


def gaussian() -> np.ndarray:
    return np.random.default_rng(4711).standard_normal((TERMS, RANK + EXTRA)).astype(np.float32)


def gram_sketch(t: np.ndarray, starts: np.ndarray, idf: np.ndarray, omega: np.ndarray, into: np.ndarray) -> None:
    """Add (A'A) @ omega of these passages, but for the terms' own weights.

    A row of A holds its words' weights, scaled to unit length.  ``omega``
    comes multiplied by the terms' weights, and a caller multiplies the sum by
    them once, so no product is formed for single words.
    """
    step = 256  # passages at once
    bounds = np.concatenate([starts, [len(t)]])
    for at in range(0, len(starts), step):
        a, z = bounds[at], bounds[min(at + step, len(starts))]
        d, s = t[a:z], bounds[at : min(at + step, len(starts))] - a
        sizes = np.diff(np.concatenate([s, [z - a]]))
        image = np.add.reduceat(omega[d], s, axis=0) / np.add.reduceat(idf[d] ** 2, s)[:, None]
        order = np.argsort(d, kind="stable")
        ds = d[order]
        first = np.flatnonzero(np.concatenate([[True], ds[1:] != ds[:-1]]))
        row = np.repeat(np.arange(len(s)), sizes)[order]
        into[ds[first]] += np.add.reduceat(image[row], first, axis=0)


def latent_terms(spark: SparkSession, words: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Folded-in vector of each term: idf * V / sigma (TERMS x RANK)."""
    shared = spark.sparkContext.broadcast(idf.astype(np.float32))

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        weight = shared.value
        omega = gaussian() * weight[:, None]
        total, any_rows = np.zeros((TERMS, RANK + EXTRA), np.float32), False
        for batch in batches:
            docs = [w[content_of(w, weight)] for w in word_arrays(batch)]
            t, starts = passage_terms(docs, WINDOW)
            if len(starts):
                gram_sketch(t, starts, weight, omega, total)
                any_rows = True
        if any_rows:
            yield _parts(total * weight[:, None], TaskContext.get().partitionId())

    y = _summed(spark, words.mapInArrow(run, "block int, salt int, part binary"), RANK + EXTRA)
    v, sigma = nystroem(y, gaussian().astype(np.float64))
    return (idf[:, None] * v[:, :RANK] / np.maximum(sigma[:RANK], 1e-3 * max(sigma[0], 1e-12))).astype(np.float32)


def nystroem(y: np.ndarray, omega: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors of a Gram matrix G and singular values of A from y = G @ omega."""
    if not y.any():
        return np.linalg.qr(omega)[0], np.ones(omega.shape[1])
    shift = 1e-7 * np.linalg.norm(y)
    y = y + shift * omega
    core = omega.T @ y
    chol = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * np.trace(core) / len(core) * np.eye(len(core)))
    u, s, _ = np.linalg.svd(np.linalg.solve(chol, y.T).T, full_matrices=False)
    return u, np.sqrt(np.maximum(s * s - shift, 0))


def window_starts(n: int, stride: int) -> np.ndarray:
    """Windows that cover n words (the last one ends at the end)."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.unique(np.concatenate([np.arange(0, n - WINDOW, stride), [n - WINDOW]]))


def folded_windows(words: np.ndarray, latent: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Start and unit vector of each window of content words."""
    run = np.zeros((len(words) + 1, latent.shape[1]), np.float32)
    np.cumsum(latent[term(words)], axis=0, out=run[1:])
    at = window_starts(len(words), stride)
    x = run[np.minimum(at + WINDOW, len(words))] - run[at]
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-6)[:, None]
    return at, x


def bins(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint32(20)).astype(np.int64)


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over ``a``)."""
    if not len(a) or not len(b):
        return 0
    place: dict[int, int] = {}
    for k, w in enumerate(a.tolist()):
        place[w] = place.get(w, 0) | (1 << k)
    full = (1 << len(a)) - 1
    v = full
    for w in b.tolist():
        u = v & place.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def is_leak(item: Item, region: np.ndarray) -> tuple[int, bool, bool]:
    """(common words, answer found, leak) of an item and a region of a document."""
    n = lcs(item.words, region)
    found = lcs(item.answer, region) >= ANSWER * len(item.answer)
    ratio = n / len(item.words)
    if len(item.words) < SHORT:
        return n, found, ratio == 1.0
    return n, found, ratio >= STRONG or (ratio >= WEAK and found)


def gram_keys(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit key of the run of ``size`` words that begins at each place."""
    total = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = mix(total + words[k : k + len(total)].astype(np.uint64) + np.uint64(1))
    return total


def grams_of(items: list[Item], rows: list[int], size: int) -> Grams:
    keys = [gram_keys(items[k].words, size) for k in rows]
    of = np.repeat(np.array(rows, np.int64), [len(x) for x in keys])
    at = np.concatenate([np.arange(len(x)) for x in keys] or [np.zeros(0, np.int64)])
    key = np.concatenate([*keys, np.zeros(0, np.uint64)])
    order = np.argsort(key, kind="stable")
    table = np.zeros(1 << 20, bool)
    table[key >> np.uint64(44)] = True
    return Grams(size, key[order], of[order], at[order], table)


def gram_places(words: np.ndarray, g: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, item, place in the item) of every run of words that an item has."""
    keys = gram_keys(words, g.size)
    place = np.flatnonzero(g.table[keys >> np.uint64(44)])
    low, high = (np.searchsorted(g.key, keys[place], side) for side in ("left", "right"))
    count = high - low
    entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(place, count), g.of[entry], g.at[entry]


def query_of(items: list[Item], idf: np.ndarray, latent: np.ndarray) -> Query:
    content = [content_of(i.words, idf) for i in items]
    short = [k for k, i in enumerate(items) if len(i.words) < SHORT]
    bare = [k for k, i in enumerate(items) if len(i.words) >= SHORT and len(content[k]) < FEW]
    known = np.zeros((len(items), WORD_BINS), np.int8)
    of, at, need, vecs = [], [], [], []
    for k, item in enumerate(items):
        if len(item.words) < SHORT or len(content[k]) < FEW:
            continue
        own = item.words[content[k]]
        known[k, bins(own)] = 1
        start, x = folded_windows(own, latent, ITEM_STRIDE)
        for a, v in zip(start.tolist(), x, strict=True):
            of.append(k)
            at.append(int(content[k][a]))
            need.append(max(FEW - 1, int(np.ceil(SHARED * min(WINDOW, len(own) - a)))))
            vecs.append(v)
    vec = np.array(vecs, np.float32).reshape(len(vecs), latent.shape[1])
    union, need = np.zeros(1 << 20, np.int8), np.array(need, np.int64)
    for k, item in enumerate(items):
        union[item.words[content[k]] >> np.uint32(12)] = 1
    groups = [np.flatnonzero(need == k) for k in np.unique(need)]
    rest = sorted(set(range(len(items))) - set(short) - set(bare))
    sizes = sorted({len(items[k].words) for k in short})
    exact = [grams_of(items, [k for k in short if len(items[k].words) == n], n) for n in sizes]
    grams = [grams_of(items, rows, size) for rows, size in ((rest, GRAM), (bare, FEW_GRAM)) if rows]
    return Query(items, content, np.array(of, np.int64), np.array(at, np.int64), need, vec, known.ravel(), exact, union, groups, grams)


def search(docs: list[np.ndarray], idf: np.ndarray, latent: np.ndarray, q: Query) -> dict:
    """Leaks of some documents: (document, item) -> (first word, cosine, common words, ratio, answer found).

    Documents are laid end to end, in overlapping stretches, so that every
    step is one operation for all of them.
    """
    out: dict[tuple[int, int], tuple] = {}
    overlap = max([OVERLAP, *(len(i.words) + 2 * MARGIN + slide(i) for i in q.items)])
    parts = [(n, at, w[at : at + STRETCH + overlap]) for n, w in enumerate(docs) if len(w)
             for at in range(0, max(len(w) - overlap, 1), STRETCH)]
    if not parts:
        return out
    words = np.concatenate([p for _, _, p in parts])
    ends = np.cumsum([len(p) for _, _, p in parts])
    for g in q.exact:
        in_full(out, q, g, parts, words, ends)
    by_windows(out, q, parts, words, ends, idf, latent)
    for g in q.grams:
        by_grams(out, q, g, parts, words, ends, latent)
    return out


def in_full(out: dict, q: Query, g: Grams, parts: list[tuple], words: np.ndarray, ends: np.ndarray) -> None:
    """The first place of each short item that a document holds in full."""
    place, of, _ = gram_places(words, g)
    part = np.searchsorted(ends, place, side="right")
    whole = place + g.size <= ends[part]
    for a, k, p in zip(place[whole].tolist(), of[whole].tolist(), part[whole].tolist(), strict=True):
        n, base, text = parts[p]
        if (n, k) not in out and np.array_equal(words[a : a + g.size], q.items[k].words):
            out[n, k] = (base + a - (int(ends[p]) - len(text)), 1.0, g.size, 1.0, True)


def by_windows(
    out: dict, q: Query, parts: list[tuple], words: np.ndarray, ends: np.ndarray, idf: np.ndarray, latent: np.ndarray
) -> None:
    """Check the windows whose cosine and shared words reach the limits."""
    if not len(q.vec):
        return
    place = content_of(words, idf)
    if not len(place):
        return
    own = words[place]
    bound = np.concatenate([[0], np.searchsorted(place, ends)])  # content words of each part
    sizes = np.diff(bound)
    count = np.where(sizes > WINDOW, -(-(sizes - WINDOW) // STRIDE) + 1, sizes > 0)
    part = np.repeat(np.arange(len(parts)), count)
    step = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
    start = bound[part] + np.minimum(step * STRIDE, np.maximum(sizes[part] - WINDOW, 0))
    stop = np.minimum(start + WINDOW, bound[part + 1])
    # a window must hold as many words of all items as it has to share with one of them
    seen = np.concatenate([[0], np.cumsum(q.union[own >> np.uint32(12)], dtype=np.int64)])
    seen = seen[stop] - seen[start]
    fold = np.flatnonzero(seen >= q.need.min())
    if not len(fold):
        return
    run = np.zeros((len(own) + 1, latent.shape[1]), np.float32)
    np.cumsum(latent[term(own)], axis=0, out=run[1:])
    x = run[stop[fold]] - run[start[fold]]
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-6)[:, None]
    found = []
    for g in q.groups:
        every = np.flatnonzero(seen[fold] >= q.need[g[0]])
        for first in range(0, len(every), PRODUCT):
            rows = every[first : first + PRODUCT]
            for column in range(0, len(g), PRODUCT):
                some = g[column : column + PRODUCT]
                cos = x[rows] @ q.vec[some].T
                a, b = np.nonzero(cos >= COSINE)
                found.append((fold[rows[a]], some[b], cos[a, b]))
    if not found:
        return
    hit, which, cosine = (np.concatenate([f[k] for f in found]) for k in range(3))
    # content words of the window that the item has: one flat look-up for each place in the window
    line = (q.of[which] * WORD_BINS).astype(np.int32)
    word = np.concatenate([bins(own), np.zeros(WINDOW, np.int64)]).astype(np.int32)
    first, room, shared = start[hit].astype(np.int32), (stop - start)[hit].astype(np.int8), np.zeros(len(hit), np.int8)
    for k in range(WINDOW):
        shared += q.known[line + word[first + k]] * (room > k)
    enough = shared >= q.need[which]
    tried = set()
    for h, k, c in zip(hit[enough].tolist(), which[enough].tolist(), cosine[enough].tolist(), strict=True):
        n, base, text = parts[part[h]]
        item_at = int(q.of[k])
        offset = int(ends[part[h]]) - len(text)
        # the item may begin an item's length before the window and end as far behind it
        low, high = int(place[start[h]]) - offset, int(place[stop[h] - 1]) - offset + 1
        key = (int(part[h]), item_at, low // slide(q.items[item_at]))
        best = out.get((n, item_at))
        if key not in tried and (best is None or best[2] < len(q.items[item_at].words)):
            tried.add(key)
            verdict(out, q, n, item_at, base, text, low, high, c)


def by_grams(
    out: dict, q: Query, g: Grams, parts: list[tuple], words: np.ndarray, ends: np.ndarray, latent: np.ndarray
) -> None:
    """Check every place that holds a run of an item's words, once for neighbours on one alignment."""
    place, of, at = gram_places(words, g)
    part = np.searchsorted(ends, place, side="right")
    whole = place + g.size <= ends[part]  # a run may not reach into the next document
    place, of, at, part = place[whole], of[whole], at[whole], part[whole]
    start = np.concatenate([[0], ends[:-1]])
    step = np.array([max(MARGIN, slide(i)) for i in q.items])
    line = (place - at - start[part]) // step[of]  # the item would begin here
    _, first = np.unique(((part * len(q.items) + of) << 32) + line + (1 << 31), return_index=True)
    for k in first.tolist():
        n, base, text = parts[part[k]]
        low, own, pair = int(place[k] - start[part[k]]), q.items[int(of[k])].words, (n, int(of[k]))
        was = out.get(pair)
        if was is not None and was[2] == len(own):
            continue
        verdict(out, q, *pair, base, text, low, low + g.size, 0.0)
        if out.get(pair) != was:  # its cosine is that of the words where the item would lie
            begin = max(0, low - int(at[k]))
            x, y = (latent[term(w)].sum(axis=0) for w in (text[begin : begin + len(own)], own))
            cosine = float(x @ y / max(np.linalg.norm(x) * np.linalg.norm(y), 1e-12))
            out[pair] = (out[pair][0], cosine, *out[pair][2:])


def slide(item: Item) -> int:
    return max(SLIDE, len(item.words) // SLIDE_SHARE)


def verdict(out: dict, q: Query, n: int, item_at: int, base: int, text: np.ndarray, low: int, high: int, cosine: float) -> None:
    """Record the best leak of an item whose words may lie around ``text[low:high]``."""
    item = q.items[item_at]
    step = slide(item)
    size = len(item.words) + 2 * MARGIN + step - SLIDE  # no region of a long item lies between two that are tried
    reach = len(item.words) + MARGIN + step  # candidates nearer than a step are checked once
    low, high = max(0, low - reach), min(len(text), high + reach)
    # no region inside holds more common words than the whole
    if lcs(item.words, text[low:high]) < WEAK * len(item.words):
        return
    for begin in range(low, max(high - size, low) + step, step):
        begin = min(begin, max(high - size, low))
        common, answered, leak = is_leak(item, text[begin : min(begin + size, high)])
        best = out.get((n, item_at))
        if leak and (best is None or common > best[2]):
            out[n, item_at] = (base + begin, cosine, common, common / len(item.words), answered)


def leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row for each (document, item) whose text the document holds."""
    prepare(spark)
    words = materialize(spark, hashed_words(docs, doc_id, text), "word-hashes")
    idf = inverse_frequencies(spark, words)
    latent = latent_terms(spark, words, idf)
    shared = spark.sparkContext.broadcast((idf, latent))
    found = None
    queries = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t is not null").orderBy("i", "t")
    block: list[Item] = []
    size = 0  # words of the block

    def searched(block: list[Item]) -> DataFrame:
        query = spark.sparkContext.broadcast(query_of(block, idf, latent))

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            (weight, m), q = shared.value, query.value
            for batch in batches:
                ids, words = batch.column(0).to_pylist(), [np.frombuffer(w.as_buffer(), np.uint32) for w in batch.column(1)]
                rows, at = [], 0
                while at < len(ids):  # some documents at a time, up to a bound of words
                    z, size = at + 1, len(words[at])
                    while z < len(ids) and size + len(words[z]) <= TOGETHER:
                        size += len(words[z])
                        z += 1
                    got = search(words[at:z], weight, m, q)
                    rows += [(ids[at + n], q.items[k].item_id, *v) for (n, k), v in got.items()]
                    at = z
                names = [c.split()[0] for c in LEAKS.split(", ")]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.float64(), pa.bool_()]
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        return words.mapInArrow(run, LEAKS).distinct()

    for r in queries.toLocalIterator():
        item = Item(r["i"], hashes(r["t"]), hashes(answer_of(r["t"])))
        if not len(item.words):
            continue
        if block and (len(block) == ITEM_BLOCK or size + len(item.words) > ITEM_WORDS):
            found = searched(block) if found is None else found.unionByName(searched(block))
            block, size = [], 0
        block.append(item)
        size += len(item.words)
    if block:
        found = searched(block) if found is None else found.unionByName(searched(block))
    return found if found is not None else spark.createDataFrame([], LEAKS)


def decontaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    key = fresh("key")
    rows, _ = with_row_key(docs, key, doc_id, text)
    bad = leaks(spark, rows, benchmark, key, text).select("doc_id")
    return without(spark, rows, key, bad, "leaky-documents").drop(key)
