"""Sliding windows from panes.

A pane is a stretch of time as long as the windows' slide (the greatest common
divisor of width and slide, if the slide does not divide the width); every window
is a run of neighbouring panes.  Rows are aggregated once under their pane,
and a window's state is merged from the states of its panes, at most ``width /
pane`` of them, instead of from every row once for each window it falls in.

Panes meet by a window function over the account's panes in order: a hot
account brings one narrow row a pane there, however many transactions it has.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The microseconds of each unit of a duration text.
UNITS = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
         "day": 86400 * 10**6, "week": 604800 * 10**6}
#: Panes of a window up to which they are fetched one by one, without a list.
FEW = 16


def micros(duration: str) -> int:
    """``"10 minutes"`` -> 600,000,000 (units of fixed length, as event-time windows need them)."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", duration.lower().replace("interval", ""))
    if not parts or any(unit not in UNITS for _, unit in parts):
        raise ValueError(f"not a duration of fixed length: {duration!r}")
    return sum(int(n) * UNITS[unit] for n, unit in parts)


def pane_length(width: int, slide: int) -> int:
    return math.gcd(width, slide)


def pane_of(event_time: Column, pane: int) -> Column:
    """The pane's start in microseconds (panes and windows start at multiples of their length)."""
    t = F.unix_micros(event_time.cast("timestamp"))
    return t - F.pmod(t, F.lit(pane))


def window_starts(pane_start: Column, width: int, slide: int) -> Column:
    """The starts of all windows that hold the pane, ascending."""
    pane = pane_length(width, slide)
    last = pane_start - F.pmod(pane_start, F.lit(slide))
    # the first start s (a multiple of the slide) with s + width >= the pane's end
    least = pane_start + F.lit(pane - width)
    first = least + F.pmod(-least, F.lit(slide))
    return F.sequence(first, last, F.lit(slide).cast("long"))


def pane_states(rows: DataFrame, keys: list[str], time: str, value: str, counted: str, pane: int) -> DataFrame:
    """One row for each key and pane: the distinct ``value``s and how many ``counted`` are not null."""
    return (
        rows.where(F.col(time).isNotNull())
        .withColumn("pane", pane_of(F.col(time), pane))
        .groupBy(*keys, "pane")
        .agg(F.collect_set(value).alias("found"), F.count(counted).alias("n"))
    )


def window_states(panes: DataFrame, keys: list[str], width: int, slide: int) -> DataFrame:
    """``keys, window_start, found, n`` of every window with a pane: neighbouring pane states merged.

    A window is made by its first pane; it holds that pane and those after it that
    start before the window ends.
    """
    pane = pane_length(width, slide)
    ordered = Window.partitionBy(*keys).orderBy("pane")
    state = F.struct("pane", "found", "n")
    if width // pane <= FEW:  # the panes of a window are among the next ones
        near = F.array(state, *[F.lead(state, k).over(ordered) for k in range(1, width // pane)])
    else:
        near = F.collect_list(state).over(ordered.rangeBetween(0, width - pane))  # at most width / pane states
    panes = panes.select(*keys, "pane", F.lag("pane").over(ordered).alias("before"), near.alias("near"))
    start = F.explode(
        F.filter(window_starts(F.col("pane"), width, slide), lambda s: F.col("before").isNull() | (F.col("before") < s))
    )
    windows = panes.select(*keys, start.alias("window_start"), "near")
    inside = F.filter("near", lambda p: p["pane"] < F.col("window_start") + width)
    merged = windows.withColumn("inside", inside)
    return merged.select(
        *keys, "window_start",
        F.array_distinct(F.flatten(F.transform("inside", lambda p: p["found"]))).alias("found"),
        F.aggregate("inside", F.lit(0).cast("long"), lambda total, p: total + p["n"]).alias("n"),
    )


def panes_of(window_start: Column, width: int, slide: int) -> Column:
    """The starts of a window's panes."""
    pane = pane_length(width, slide)
    return F.sequence(window_start, window_start + F.lit(width - pane).cast("long"), F.lit(pane).cast("long"))


def window_struct(window_start: Column, width: int) -> Column:
    """The window as Spark's ``window`` function gives it."""
    start = F.timestamp_micros(window_start)
    return F.struct(start.alias("start"), F.timestamp_micros(window_start + width).alias("end"))
