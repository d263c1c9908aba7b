"""Lost-offset audit: gaps and islands over the source positions of stored documents.

A source with ``failOnDataLoss`` off goes on where a topic's old messages are gone.  Each
micro-batch stores the runs of neighbouring offsets that it read (``islands``, a few rows
a batch); the audit merges the runs of all batches and writers and lists what lies
between them.

Offsets are cut into stretches of ``STRETCH``: islands are found within a stretch, then
joined over the stretches' edges, so a source partition with a third of all documents is no
task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of a stretch.
STRETCH = 1 << 20


def _merged(runs: DataFrame, *group: str) -> DataFrame:
    """Overlapping or touching ``first_offset .. last_offset`` of each group as one run."""
    order = Window.partitionBy(*group).orderBy("first_offset", "last_offset")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce((F.col("first_offset") > F.max("last_offset").over(before) + 1).cast("int"), F.lit(1))
    marked = runs.withColumn("opens", opens)
    marked = marked.withColumn("island", F.sum("opens").over(order))
    return marked.groupBy(*group, "island").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("n_documents").alias("n_documents")
    ).drop("island")


def islands(docs: DataFrame, partition: str = "partition", offset: str = "offset", stretch: int = STRETCH) -> DataFrame:
    """``partition, first_offset, last_offset, n_documents``: the runs of offsets that documents have.

    Documents without a position are left out; one that was read twice counts twice.
    """
    at = docs.where(F.col(partition).isNotNull() & F.col(offset).isNotNull()).select(
        F.col(partition).cast("long").alias("partition"), F.col(offset).cast("long").alias("first_offset")
    )
    # a repeated position is combined before the shuffle
    at = at.groupBy("partition", "first_offset").agg(F.count("*").alias("n_documents"))
    at = at.withColumn("last_offset", F.col("first_offset"))
    at = at.withColumn("stretch", F.floor(F.col("first_offset") / stretch))
    return _merged(_merged(at, "partition", "stretch").drop("stretch"), "partition")


def lost_ranges(ranges: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """``partition, first_lost, last_lost, n_lost``: what no run covers between a partition's first and last offset.

    ``ranges`` are runs as ``islands`` gives them, of any number of batches; ``first``
    (``partition, first_offset``) names where reading should have begun.
    """
    runs = ranges.select("partition", "first_offset", "last_offset", "n_documents")
    if first is not None:
        begin = first.select("partition", (F.col("first_offset") - 1).alias("first_offset"), (F.col("first_offset") - 1).alias("last_offset"))
        runs = runs.unionByName(begin.withColumn("n_documents", F.lit(0).cast("long")))
    order = Window.partitionBy("partition").orderBy("first_offset")
    runs = _merged(runs, "partition").withColumn("next", F.lead("first_offset").over(order))
    lost = runs.where(F.col("next") > F.col("last_offset") + 1)
    return lost.select(
        "partition", (F.col("last_offset") + 1).alias("first_lost"), (F.col("next") - 1).alias("last_lost"),
        (F.col("next") - F.col("last_offset") - 1).alias("n_lost"),
    )
