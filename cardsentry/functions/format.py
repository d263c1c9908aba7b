"""Report cell formatting as column expressions.

Python's ``{:<n}`` / ``{:>n}`` pad but never cut; Spark's ``rpad`` /
``lpad`` cut, so values already at least ``n`` long pass through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(c: Column) -> Column:
    # Python renders a missing value as "None".
    return F.coalesce(c.cast("string"), F.lit("None"))


def pad_right(c: Column, n: int) -> Column:
    t = _text(c)
    return F.when(F.length(t) >= n, t).otherwise(F.rpad(t, n, " "))


def pad_left(c: Column, n: int) -> Column:
    t = _text(c)
    return F.when(F.length(t) >= n, t).otherwise(F.lpad(t, n, " "))


def money(c: Column) -> Column:
    """``{:,.2f}``: thousands separators, two decimals."""
    return F.format_number(c.cast("decimal(38,2)"), 2)


def line(*parts: Column | str) -> Column:
    """A report row: two leading spaces, then the parts concatenated."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.lit("  "), *cols)
