"""Connected components of an edge table, as Spark jobs (alternating stars).

Each round points every neighbour of a vertex at the vertex's smallest
neighbour (Kiveris et al., 2014); the number of rounds grows with the
logarithm of the graph, and no vertex, component or edge list is gathered in
one place.  Rounds are written to the shared folder, which cuts the lineage;
they end as soon as the links are stars, which a further round would not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, fitting, materialize


def _settled(links: DataFrame, n: int) -> bool:
    """Whether the links (``a > b``) are stars: no vertex has two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = fitting(ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")), 2 * n)
    return not ends.where("up > 1 or up = 1 and down = 1").limit(1).count()


def components(
    spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``id, component`` (the smallest id) for every vertex of ``edges`` that has a neighbour.

    Rounds go on to the fixed point; their number grows with the logarithm of the
    longest path, so a graph that needs more than ``max_rounds`` is an error, not a result.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    links = edges.where(F.col(a) != F.col(b)).select(hi.alias("a"), lo.alias("b")).distinct()
    links = materialize(spark, fitting(links, edges.count()), "cc")  # a > b
    n = links.count()  # rounds never add links

    def smallest(links: DataFrame) -> DataFrame:
        return fitting(links.groupBy("a").agg(F.min("b").alias("m")), 2 * n)

    def near(least: DataFrame) -> DataFrame:
        """Measured few, the smallest neighbours are broadcast and the links need not move to them."""
        return F.broadcast(least) if 2 * n <= broadcast_rows else least

    for _ in range(max_rounds):
        if _settled(links, n):
            break
        # large star: larger neighbours of a vertex go to its smallest neighbour (or itself)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(near(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a vertex and its smaller neighbours go to the smallest of them
        least = smallest(large)
        moved = large.join(near(least), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        links = materialize(spark, fitting(links, n), "cc")
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(fitting(stars.select(F.col("component").alias("id"), "component").distinct(), n))
