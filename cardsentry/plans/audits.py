"""Registered audits: source positions that were lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.offsets import islands, lost_ranges
from . import oracle
from .catalog import register


def positions(events: DataFrame) -> DataFrame:
    """``partition, offset`` of the events on a topic of three partitions, some of them lost.

    Lost: offsets 5 to 7 of each 97, and each 50th offset of partition 1.
    """
    at = events.select((F.col("event_id") % 3).alias("partition"), F.floor(F.col("event_id") / 3).alias("offset"))
    lost = (F.col("offset") % 97).between(5, 7) | ((F.col("partition") == 1) & (F.col("offset") % 50 == 0))
    return at.where(~lost)


@register("lost_offsets")
def q_lost_offsets(spark, sf_dir):
    """The gaps that the stored runs of two writers leave, each of which read every other forty offsets."""
    read = positions(spark.read.parquet(f"{sf_dir}/events.parquet"))
    other = F.floor(F.col("offset") / 40) % 2 == 0
    return lost_ranges(islands(read.where(other)).unionByName(islands(read.where(~other))))


oracle.add(
    "lost_offsets",
    """, kept AS (
  SELECT DISTINCT event_id % 3 AS p, event_id // 3 AS o FROM events
  WHERE NOT (event_id // 3) % 97 BETWEEN 5 AND 7 AND NOT (event_id % 3 = 1 AND (event_id // 3) % 50 = 0)),
following AS (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS n FROM kept)
SELECT p AS "partition", o + 1 AS first_lost, n - 1 AS last_lost, n - o - 1 AS n_lost FROM following WHERE n > o + 1""",
)
