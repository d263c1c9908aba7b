"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period ``q`` that is at least
``max(least, 2 * q)`` words long and that no neighbouring word extends.  Each of
its words occurs twice inside it, so a word that occurs once in a segment can
join no run there: such words split the segment, the parts are judged by their
own frequencies, and so on until nothing changes.  Whether a word occurs once in
a segment is read from the places of its neighbours of the same kind
(computed once a text), and parts that still change after a few passes are
searched from both ends at once, which keeps the recursion near linear.

Each surviving segment is scanned at every lag.  ``q`` matching places in a row
hold a multiple of ``q``, so a lag is tested at its multiples only (all lags
together cost n log n tests), and a match there is extended both ways.  A lag
that is a multiple of a known run's period gives the same stretch again.

Every text is handled whole in its own task; nothing is shuffled.

Defined results: null, empty and blank texts have no words, no runs and an empty
collapsed text; repeated rows give repeated results; an empty table gives an
empty result; a text of any length is searched whole (memory is a few arrays of
its words); runs are ordered by start, then period, and a word that several runs
drop is dropped once; of the input only the id and text columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

#: Words that a run has at least.
LEAST = 12
#: Passes over all segments of a batch before the rest is split one by one.
PASSES = 10
#: Tests of one block of lags.
BLOCK = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def neighbours(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the last place before and the first after it with the same key."""
    n = len(keys)
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    before[order[same + 1]] = order[same]
    after[order[same]] = order[same + 1]
    return before, after


def lonely(before: np.ndarray, after: np.ndarray, start: int, stop: int) -> int | None:
    """A place whose word occurs once in the segment, searched from both ends."""
    low, high, step = start, stop, 64
    while low < high:
        mid = min(low + step, high)
        hit = np.flatnonzero((before[low:mid] < start) & (after[low:mid] >= stop))
        if hit.size:
            return low + int(hit[0])
        low, mid = mid, max(high - step, mid)
        hit = np.flatnonzero((before[mid:high] < start) & (after[mid:high] >= stop))
        if hit.size:
            return mid + int(hit[-1])
        high, step = mid, 2 * step
    return None


def segments(before: np.ndarray, after: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """The stretches between ``bounds`` in which, at last, every word occurs at least twice."""
    start, stop = bounds[:-1], bounds[1:]
    out: list[tuple[int, int]] = []
    for _ in range(PASSES):
        long = stop - start >= least
        start, stop = start[long], stop[long]
        if not len(start):
            return out
        size = stop - start
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(start)), size)
        place = np.arange(len(of)) - first[of] + start[of]
        alone = (before[place] < start[of]) & (after[place] >= stop[of])
        changed = np.logical_or.reduceat(alone, first)
        out += zip(start[~changed].tolist(), stop[~changed].tolist(), strict=True)
        cut = alone & changed[of]
        # a part starts where its segment starts or behind a cut, and ends before the next cut
        keep = changed[of] & ~cut
        opens = keep & np.concatenate([[True], cut[:-1] | (of[1:] != of[:-1])])
        closes = keep & np.concatenate([cut[1:] | (of[1:] != of[:-1]), [True]])
        start, stop = place[opens], place[closes] + 1
    todo = list(zip(start.tolist(), stop.tolist(), strict=True))
    while todo:
        s, e = todo.pop()
        if e - s < least:
            continue
        at = lonely(before, after, s, e)
        if at is None:
            out.append((s, e))
        else:
            todo += [(s, at), (at + 1, e)]
    return out


def agree(a: np.ndarray, i: int, j: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on (``i < j``)."""
    left, done, step = len(a) - j, 0, 32
    while done < left:
        m = min(step, left - done)
        differ = a[i + done : i + done + m] != a[j + done : j + done + m]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, step = done + m, 4 * step
    return left


def agree_back(a: np.ndarray, i: int, j: int) -> int:
    """How many words before ``i`` equal those before ``j``."""
    done, step = 0, 32
    while done < i:
        m = min(step, i - done)
        differ = (a[i - done - m : i - done] != a[j - done - m : j - done])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, step = done + m, 4 * step
    return i


def lag_blocks(n: int) -> Iterator[np.ndarray]:
    """All lags up to ``n // 2``, in blocks: the next one starts at twice the last's first lag."""
    low = 1
    while low <= n // 2:
        high = n // 2 if n <= 512 else min(2 * low - 1, n // 2)
        lags, size = np.arange(low, high + 1), 0
        tests = np.cumsum((n - 1) // lags)
        while size < len(lags):
            done = tests[size - 1] if size else 0
            upto = max(size + 1, int(np.searchsorted(tests, done + BLOCK)))
            yield lags[size:upto]
            size = upto
        low = high + 1


def scan(a: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in a segment of word numbers."""
    n, found = len(a), {}
    period, end = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of the longest run known at a place
    length = np.zeros(n, np.int64)
    for lags in lag_blocks(n):
        tests = (n - 1) // lags
        q = np.repeat(lags, tests)
        i = (np.arange(len(q)) - np.repeat(np.cumsum(tests) - tests, tests)) * q
        hit = a[i] == a[i + q]
        hit &= (period[i] == 0) | (end[i] <= i + q) | (q % np.maximum(period[i], 1) != 0)
        q, i = q[hit], i[hit]
        # of the matches that a run needs around the place, half stand on one side
        more = (np.maximum(q, least - q) - 1) // 2
        ahead, behind = np.ones(len(q), bool), np.ones(len(q), bool)
        for k in range(1, 5):
            far = more < k
            ahead &= far | ((i + q + k < n) & (a[np.minimum(i + k, n - 1)] == a[np.minimum(i + q + k, n - 1)]))
            behind &= far | ((i >= k) & (a[np.maximum(i - k, 0)] == a[np.maximum(i + q - k, 0)]))
        hit = ahead | behind
        q, i = q[hit], i[hit]
        edges = np.concatenate([np.flatnonzero(np.diff(q, prepend=0)), [len(q)]])
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            lag, at, k = int(q[lo]), i[lo:hi], 0
            while k < len(at):
                x = int(at[k])
                if period[x] and lag % period[x] == 0 and end[x] > x + lag:
                    k = max(k + 1, int(np.searchsorted(at, end[x] - lag)))
                    continue
                s = x - agree_back(a, x, x + lag)
                e = x + lag + agree(a, x, x + lag)
                if e - s >= max(least, 2 * lag) and (s, e) not in found:
                    found[s, e] = lag
                    better = length[s:e] < e - s
                    for values, new in ((period, lag), (end, e), (length, e - s)):
                        values[s:e][better] = new
                k = max(k + 1, int(np.searchsorted(at, e - lag)))
    return [(s, e - s, lag) for (s, e), lag in found.items()]


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each word list, by start, then period."""
    out: list[list] = [[] for _ in texts]
    long = [k for k, words in enumerate(texts) if len(words) >= least]
    if not long:
        return out
    parts, base = [], 0
    for k in long:  # words are numbered text by text: small dictionaries stay in the cache
        number = dict.fromkeys(texts[k])
        number = dict(zip(number, range(base, base := base + len(number)), strict=True))
        parts.append(np.fromiter(map(number.__getitem__, texts[k]), np.int64, len(texts[k])))
    ids = np.concatenate(parts)
    bounds = np.cumsum([0, *(len(texts[k]) for k in long)])
    before, after = neighbours(ids)
    for s, e in segments(before, after, bounds, least):
        at = int(np.searchsorted(bounds, s, side="right")) - 1
        out[long[at]] += [(s + x - int(bounds[at]), n, q) for x, n, q in scan(ids[s:e], least)]
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside every run's repeats, joined by one space."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, n in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not n]
    return b" ".join(words)


def periodic_runs(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs and its text without their repeats."""
    prepare(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            # bytes split at the six ASCII white-space characters only
            texts = [(t or b"").split() for t in batch.column(1).to_pylist()]
            found = runs_of(texts, least)
            flat = np.array([r for x in found for r in x], np.int64).reshape(-1, 3)
            runs = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(c) for c in flat.T], names=["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), runs,
                 pa.array([collapsed(w, r) for w, r in zip(texts, found, strict=True)], pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    out = rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
