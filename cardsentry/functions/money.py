"""Money expressions: fixed-point at rest, double only where promised."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AMOUNT_TYPE


def to_amount(c: Column, dtype: str = AMOUNT_TYPE) -> Column:
    """Storage coercion; overflow and NaN/Inf give NULL (quarantined)."""
    return c.try_cast(dtype)


def normalize_amount(c: Column) -> Column:
    """Decimal/NULL -> double; NULL and zero both become 0.0."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


def round_cents(c: Column, dtype: str = AMOUNT_TYPE) -> Column:
    """Round a raw double to cents through its printed decimal value."""
    return F.round(c.cast("decimal(38,18)"), 2).cast(dtype)


def is_finite(c: Column) -> Column:
    """True for real numbers; NaN and +/-Infinity are not money."""
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def money_sum(c: Column, dtype: str) -> Column:
    """SUM with the empty-set result 0 instead of NULL."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(dtype)
