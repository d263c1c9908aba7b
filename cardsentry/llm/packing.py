"""Best-fit packing of token sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  What the packer needs
to know about them is how many pieces there are of each length: at most
``capacity`` numbers, whatever the size of the corpus.  On this histogram, the
bin of the longest remaining piece is filled by a bitset subset-sum dynamic
program over the available lengths, which finds the fullest feasible
combination (Gupta and Ho, 1999; with the longest piece fixed, Fleszar and
Hindi, 2002).  The combination is removed as often as the remaining counts
allow, which is what repeating the search would do.

The plan says, for each length, which pieces by rank go to which bins.  Ranks
come from counts of (length, hash bucket) groups and a row number inside each
group, so a length that a third of all pieces share is still dealt over many
tasks.

Defined results: null and empty text is the end id alone; a document longer
than the capacity, of any length, is cut into full pieces and a rest; repeated rows are packed
as often as they occur; pieces of equal length are ranked by id, piece and checksum, and rows equal
in these in any order; an empty table gives no sequences; only the id and text columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import encoder, materialize, prepare

PIECES = "piece int, start long, length long, ids_crc32 long"
#: Words whose ids a worker keeps (more cost memory and save no time here).
MEMO = 350_000
#: Pieces of one length that are ranked in one window, at least (more, as their root, beyond).
RANKED = 4096

Pattern = tuple[int, list[tuple[int, int]]]  # bins, [(length, copies)]


def fullest(available: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The combination of available lengths whose sum comes closest to ``room``.

    Bit ``s`` of the state says that some combination sums to ``s``; lengths
    are tried from the longest and the search stops at a perfect fit.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in available if x <= room), reverse=True):
        for _ in range(min(available[length], room // length)):
            more = (reach | (reach << length)) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    left, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> left & 1:
            taken[length] = taken.get(length, 0) + 1
            left -= length
    return sorted(taken.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins, grouped by equal combinations."""
    left, out = {k: n for k, n in histogram.items() if n}, []
    while left:
        seed = max(left)
        left[seed] -= 1
        combo = dict(fullest({k: n for k, n in left.items() if n}, capacity - seed))
        left[seed] += 1
        combo[seed] = combo.get(seed, 0) + 1
        bins = min(left[k] // n for k, n in combo.items())
        for k, n in combo.items():
            left[k] -= n * bins
            if not left[k]:
                del left[k]
        out.append((bins, sorted(combo.items(), reverse=True)))
    return out


def places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, copies in a bin, first bin, offset) by rank."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first_bin = 0
    for bins, combo in patterns:
        offset = 0
        for length, copies in combo:
            rank = ranks.get(length, 0)
            out.setdefault(length, []).append((rank, copies, first_bin, offset))
            ranks[length] = rank + copies * bins
            offset += copies * length
        first_bin += bins
    return {k: np.array(v, np.int64) for k, v in out.items()}


def buckets_of(histogram: dict[int, int]) -> dict[int, int]:
    """Groups into which the pieces of each length are dealt for ranking, from their count.

    Both the pieces of a group and the groups of a length grow with the root of the count.
    """
    return {length: -(-n // max(RANKED, 8 * math.isqrt(n))) for length, n in histogram.items()}


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each piece of each document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc, width = encoder(tokenizer_path, end_id, "<u4", MEMO), 4 * capacity
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, raw in enumerate(enc.encode_batch(batch.column(1).to_pylist())):
                for k in range(-(-len(raw) // width)):
                    part = raw[k * width : (k + 1) * width]
                    at.append(row)
                    piece.append(k)
                    start.append(k * capacity)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {PIECES}")


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    prepare(spark)
    own = materialize(spark, pieces(docs, tokenizer_path, end_id, capacity, doc_id, text), "pieces")
    histogram = {r["length"]: r["count"] for r in own.groupBy("length").count().collect()}  # <= capacity rows
    shared = spark.sparkContext.broadcast(places(plan(histogram, capacity)))

    key = ["length", "bucket"]
    dealt = spark.createDataFrame(list(buckets_of(histogram).items()), "length long, buckets long")  # <= capacity rows
    own = own.join(F.broadcast(dealt), "length")
    own = own.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("buckets"))).drop("buckets")
    counts = own.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*key).orderBy("doc_id", "piece", "ids_crc32")
    ranked = own.join(base, key).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        where = shared.value
        for batch in batches:
            length, rank = (np.array(batch.column(k), np.int64) for k in (3, 5))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                rows, t = np.flatnonzero(length == x), where[x]
                hit = t[np.searchsorted(t[:, 0], rank[rows], side="right") - 1]
                inner = rank[rows] - hit[:, 0]
                seq[rows] = hit[:, 2] + inner // hit[:, 1]
                off[rows] = hit[:, 3] + inner % hit[:, 1] * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(seq), pa.array(off)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return ranked.mapInArrow(run, f"doc_id {kind}, {PIECES}, sequence_id long, offset long")
