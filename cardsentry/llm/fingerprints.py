"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (see ``paragraphs``), each with a 64-bit digest that
also tells its copies within the text apart.  A sketch has three tables of cells;
each digest is added to one cell of each table: a count, the sum of digests and the
sum of check values, all modulo 2^64.  The fingerprint is the sketch with
``CELLS`` cells a table, written as text.

Two versions are compared by subtracting their cells: what both hold cancels.  A
cell that holds one digest of the difference shows it by its check value; taking that
digest out of its other cells frees more of them (peeling), until every cell is
empty and the differing digests of both sides are known.  If cells are left, the
sketches are built again, twice as large and with other hashes, until they peel.
The likeness is the share of paragraphs that both versions hold among all of both.

Defined results: null text is empty; texts without a paragraph (empty, white space)
have the same empty fingerprint and are alike to the full; a text of any length is
sketched whole; equal texts have equal fingerprints, so repeated rows give repeated
results; an empty table gives an empty result; only the named columns are read,
so others cannot clash.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, prepare

#: Cells of each table in a fingerprint (a power of two).
CELLS = 8
TABLES = 3
#: Cells of all sketches that are built at a time.
TOGETHER = 1 << 20
#: A sentence of more characters is first cut behind words that a hash picks, one in ``PICK``.
LONG, PICK = 400, 8
#: Characters of a paragraph at most.
SHORT = 48
#: Buckets of neighbouring ids for each shuffle partition.
BUCKETS = 8
#: Sizes that are tried before a comparison counts as broken (it then holds equal digests of unequal texts).
TRIES = 40

U64 = np.uint64


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer (Stafford's variant 13) over ``x`` plus a salt."""
    x = x + U64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def paragraphs(text: str) -> list[tuple[str, bool]]:
    """The text's paragraphs, and whether each ends a line.

    A paragraph is a sentence of a line, up to a full stop and a space, or each
    ``SHORT`` characters of it from its start, so that an edit changes what stands
    near it only, also in short texts.  A stretch of more than ``LONG`` characters without
    such an end is first cut behind words that their own hash picks.
    """
    out: list[tuple[str, bool]] = []
    for line in text.split("\n"):
        parts = line.split(". ")
        for part in parts[:-1]:
            if len(part) > SHORT:
                out += [(x, False) for x in cut(part)]
            elif part:
                out.append((part, False))
        if parts[-1].strip():
            *most, last = cut(parts[-1])
            out += [(x, False) for x in most]
            out.append((last, True))
    return out


def cut(part: str) -> list[str]:
    if len(part) <= LONG:
        return [part[k : k + SHORT] for k in range(0, len(part), SHORT)]
    out, now = [], []
    for word in part.split(" "):
        now.append(word)
        if zlib.crc32(word.encode("utf-8", "surrogatepass")) % PICK == 0:
            out.append(" ".join(now))
            now = []
    if now:
        out.append(" ".join(now))
    return [x[k : k + SHORT] for x in out for k in range(0, len(x), SHORT)]


def digests(text: str | None) -> np.ndarray:
    """Digests of the text's paragraphs; the second copy of one has another digest, and so on."""
    import xxhash

    parts = paragraphs(text or "")
    plain = np.array([xxhash.xxh3_64_intdigest(p.encode()) for p, _ in parts], U64)
    # which copy it is, and whether it ends a line: not as the hash's seed, which short inputs absorb
    which = np.array([ends for _, ends in parts], U64)
    if len(set(parts)) < len(parts):
        seen: Counter = Counter()
        for k, part in enumerate(parts):
            which[k] += U64(2 * seen[part])
            seen[part] += 1
    return mixed(plain ^ mixed(which, 1), 0)


class Sketches:
    """One sketch for each row, all of one size."""

    def __init__(self, rows: int, cells: int, salt: int = 0):
        self.cells, self.salt = cells, salt
        shape = (rows, TABLES * cells)
        self.count, self.keys, self.checks = np.zeros(shape, np.int64), np.zeros(shape, U64), np.zeros(shape, U64)

    def add(self, row: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Add digests (``sign`` 1) or take them out (-1)."""
        check = self.check(keys)
        factor = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        times = factor.astype(U64)  # -1 is 2^64 - 1
        for table in range(TABLES):
            at = (mixed(keys, 2 + TABLES * self.salt + table) & U64(self.cells - 1)).astype(np.int64)
            at += row * (TABLES * self.cells) + table * self.cells
            np.add.at(self.count.reshape(-1), at, factor)
            np.add.at(self.keys.reshape(-1), at, keys * times)
            np.add.at(self.checks.reshape(-1), at, check * times)

    def check(self, keys: np.ndarray) -> np.ndarray:
        return mixed(keys, 1) & U64(0xFFFFFFFF)

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(0, self.cells, self.salt)
        out.count, out.keys, out.checks = self.count - other.count, self.keys - other.keys, self.checks - other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``row, digest, sign`` of what the sketches hold, and which rows peeled to the end."""
        width, found = TABLES * self.cells, []
        while True:
            at = np.flatnonzero(np.abs(self.count.reshape(-1)) == 1)
            sign = self.count.reshape(-1)[at]
            keys = self.keys.reshape(-1)[at] * sign.astype(U64)
            pure = self.checks.reshape(-1)[at] * sign.astype(U64) == self.check(keys)
            row, keys, sign = at[pure] // width, keys[pure], sign[pure]
            if not len(row):
                break
            order = np.lexsort((keys, row))
            row, keys, sign = row[order], keys[order], sign[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])])
            row, keys, sign = row[new], keys[new], sign[new]
            found.append((row, keys, sign))
            if len(found) > 64 + width:
                break
            self.add(row, keys, -sign)
        done = ~(self.count.any(1) | self.keys.any(1) | self.checks.any(1))
        parts = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, t) for t in (np.int64, U64, np.int64)]
        return *parts, done

    def written(self) -> list[str]:
        """Each row as text: the base64 of its cells (count, digest sum, check sum; little-endian)."""
        cells = np.zeros(self.count.shape, [("n", "<i4"), ("keys", "<u8"), ("checks", "<u4")])
        cells["n"], cells["keys"], cells["checks"] = self.count, self.keys, self.checks & U64(0xFFFFFFFF)
        return [base64.b64encode(x.tobytes()).decode() for x in cells]


def sketched(sets: list[np.ndarray], cells: int, salt: int = 0) -> Sketches:
    out = Sketches(len(sets), cells, salt)
    if sets:
        out.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets))
    return out


def differences(
    ours: list[np.ndarray], theirs: list[np.ndarray], base: tuple[Sketches, Sketches] | None = None
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each pair of digest sets: the digests on one side only, and the cells a table that it took.

    ``base`` are the sketches with ``CELLS`` cells, if they are there already.
    """
    out: list = [None] * len(ours)
    left, cells = np.arange(len(ours)), CELLS
    for salt in range(TRIES):
        again = []
        step = len(left) if salt == 0 and base else max(1, TOGETHER // (TABLES * cells))
        for k in range(0, len(left), step or 1):
            some = left[k : k + step]
            if salt == 0 and base:
                diff = base[0].minus(base[1])
            else:
                diff = sketched([ours[i] for i in some], cells, salt).minus(sketched([theirs[i] for i in some], cells, salt))
            row, keys, sign, done = diff.peel()
            order = np.argsort(row, kind="stable")
            row, keys, sign = row[order], keys[order], sign[order]
            bounds = np.searchsorted(row, np.arange(len(some) + 1))
            for j in np.flatnonzero(done).tolist():
                own, way = keys[bounds[j] : bounds[j + 1]], sign[bounds[j] : bounds[j + 1]]
                out[some[j]] = (own[way > 0], own[way < 0], cells)
            again.append(some[~done])
        left, cells = np.concatenate(again) if again else left, 2 * cells
        if not len(left):
            return out
        # beyond four cells for each digest a larger sketch is no help: only other hashes are
        cells = min(cells, 1 << int(max(4, 4 * max(len(ours[i]) + len(theirs[i]) for i in left)) - 1).bit_length())
    raise ValueError("sketches do not peel")


def likeness(n_ours: int, n_theirs: int, n_differ: int) -> float:
    both = n_ours + n_theirs
    return (both - n_differ) / (both + n_differ) if both else 1.0


def compare_versions(
    spark: SparkSession, rows: DataFrame, key: str, text: str, others: list[str], with_digests: bool = False
) -> DataFrame:
    """``key``, the fingerprint of ``text``, and of each other version ``v``: ``fingerprint_v, near_v, cells_v``.

    With ``with_digests`` also ``gone_v`` and ``new_v``: the recovered digests of
    paragraphs that only ``text``, or only ``v``, holds.
    """
    prepare(spark, rows=256, mb=8)
    names = [key, text, *others]
    own = rows.select(*[F.col(n) for n in names])
    schema = [f"`{key}` {own.schema[key].dataType.simpleString()}", "fingerprint string"]
    for v in others:
        schema += [f"`fingerprint_{v}` string", f"`near_{v}` double", f"`cells_{v}` int"]
        schema += [f"`{side}_{v}` array<bigint>" for side in ("gone", "new") if with_digests]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sets = [[digests(t) for t in batch.column(k).to_pylist()] for k in range(1, len(names))]
            step = max(1, TOGETHER // (TABLES * CELLS))
            sketches = [sketched(s, CELLS) for s in sets]
            columns = [batch.column(0), pa.array(sketches[0].written(), pa.string())]
            titles = [key, "fingerprint"]
            assert len(batch) <= step
            for v, theirs, sketch in zip(others, sets[1:], sketches[1:], strict=True):
                found = differences(sets[0], theirs, (sketches[0], sketch))
                near = [likeness(len(a), len(b), len(x) + len(y)) for a, b, (x, y, _) in zip(sets[0], theirs, found, strict=True)]
                columns += [pa.array(sketch.written(), pa.string()), pa.array(near, pa.float64()), pa.array([c for *_, c in found], pa.int32())]
                titles += [f"fingerprint_{v}", f"near_{v}", f"cells_{v}"]
                for side, name in ((0, "gone"), (1, "new")) if with_digests else ():
                    columns.append(pa.array([x[side].view(np.int64) for x in found], pa.list_(pa.int64())))
                    titles.append(f"{name}_{v}")
            yield pa.RecordBatch.from_arrays(columns, names=titles)

    return own.mapInArrow(run, ", ".join(schema))


def with_next(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "next") -> DataFrame:
    """``doc_id, text`` and the text of the next row by ascending id; after the last comes the first.

    Rows are dealt to buckets by quantiles of the ids, and the first rows of a bucket
    also go to the bucket before it, so every row meets its successor in one window of
    bounded size: one shuffle of the texts, no global sort.  Rows of one id go by a
    hash of their text, in one window: ids are expected to tell nearly all rows apart.
    Null ids come last.
    """
    n = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    probs = [k / n for k in range(1, n)]
    bounds = own.agg(F.percentile_approx("doc_id", probs, 20 * n).alias("q")).first()["q"] or []  # n numbers
    bounds = np.unique(np.array(bounds, np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), side="right"))

    known = F.col("doc_id").isNotNull()
    own = own.withColumn("bucket", F.when(known, bucket(F.coalesce("doc_id", F.lit(0)))).otherwise(F.lit(n + 1)))
    heads = own.groupBy("bucket").agg(F.min("doc_id").alias("head")).orderBy("bucket").collect()  # at most n + 1 rows
    before = [heads[k - 1]["bucket"] for k in range(len(heads))]
    lead = spark.createDataFrame(
        [(r["bucket"], r["head"], b) for r, b in zip(heads, before, strict=True)], "bucket int, head long, before int"
    )
    own = own.join(F.broadcast(lead), "bucket")
    also = F.col("doc_id").eqNullSafe(F.col("head"))
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    there = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    own = own.select("doc_id", "text", F.explode(F.when(also, F.array(here, there)).otherwise(F.array(here))).alias("at"))
    own = own.select("doc_id", "text", "at.bucket", "at.guest")
    order = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_last("doc_id"), F.xxhash64("text"))
    own = own.withColumn(into, F.lead("text").over(order))
    return own.where(~F.col("guest")).select("doc_id", "text", into)


def with_edit(rows: DataFrame, text: str = "text", other: str = "next", into: str = "edited") -> DataFrame:
    """Add the text whose last quarter of code points is replaced by as many (or all) first ones of ``other``."""
    size = fresh("size")
    quarter = F.floor(F.col(size) / 4).cast("int")
    rows = rows.withColumn(size, F.char_length(text))
    edited = F.concat(F.substring(text, F.lit(1), F.col(size) - quarter), F.substring(other, F.lit(1), quarter))
    return rows.withColumn(into, edited).drop(size)
