"""Row validation: the table constraints as a split, not as failures.

A bad row never aborts its batch: ``split_valid`` routes it to a
quarantine frame with a reason, and the rest is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AMOUNT_TYPE, DEFAULT_CURRENCY
from ..functions.money import is_finite, to_amount
from ..schemas import CORRUPT_COLUMN, WIRE_COLUMNS

# ---------------------------------------------------------------------------
# Quarantine reasons, checked in this order.
#   malformed_json  the document is not JSON or no field of it can be read
#   null_key        txn_ref, account_id or event_ts is NULL
#   bad_amount      amount is NaN or +/-Infinity
#   amount_overflow amount does not fit NUMERIC(14,2)
# ---------------------------------------------------------------------------
MALFORMED_JSON = "malformed_json"
NULL_KEY = "null_key"
BAD_AMOUNT = "bad_amount"
AMOUNT_OVERFLOW = "amount_overflow"
KEY_COLUMNS = ("txn_ref", "account_id", "event_ts")


def currency_default(df: DataFrame, raw_col: str | None = None) -> DataFrame:
    """Currency defaults to USD only where it is absent, never when NULL.

    Without a ``currency`` column the whole frame gets USD.  With the raw
    JSON text at hand, a document lacking the key gets USD while an
    explicit ``"currency": null`` stays NULL.
    """
    if "currency" not in df.columns:
        return df.withColumn("currency", F.lit(DEFAULT_CURRENCY))
    if raw_col is None:
        return df
    keys = F.map_keys(F.from_json(F.col(raw_col), "map<string,string>"))
    absent = ~F.coalesce(F.array_contains(keys, F.lit("currency")), F.lit(True))
    return df.withColumn(
        "currency", F.when(absent, F.lit(DEFAULT_CURRENCY)).otherwise(F.col("currency"))
    )


def reject_reason(df: DataFrame) -> Column:
    """First failed check of a decoded row, NULL when the row is valid."""
    corrupt = F.lit(False)
    if CORRUPT_COLUMN in df.columns:
        # one mistyped field is NULL and its row stays; a row with nothing readable is malformed
        corrupt = F.col(CORRUPT_COLUMN).isNotNull() & F.coalesce(
            *[F.col(c).cast("string") for c in WIRE_COLUMNS if c in df.columns]
        ).isNull()
    null_key = F.lit(False)
    for c in KEY_COLUMNS:
        null_key = null_key | F.col(c).isNull()
    amount = F.col("amount")
    if dict(df.dtypes).get("amount", "").startswith("decimal"):
        bad = F.lit(False)
        overflow = F.lit(False)
    else:
        bad = amount.isNotNull() & ~is_finite(amount)
        overflow = amount.isNotNull() & to_amount(amount).isNull()
    return (
        F.when(corrupt, F.lit(MALFORMED_JSON))
        .when(null_key, F.lit(NULL_KEY))
        .when(bad, F.lit(BAD_AMOUNT))
        .when(overflow, F.lit(AMOUNT_OVERFLOW))
    )


def with_reject_reason(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(df))


def valid_rows(tagged: DataFrame) -> DataFrame:
    """Rows that pass every check, amount coerced to NUMERIC(14,2)."""
    return (
        tagged.where(F.col("reject_reason").isNull())
        .withColumn("amount", to_amount(F.col("amount"), AMOUNT_TYPE))
        .drop("reject_reason")
    )


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reject_reason").isNotNull()).select(
        "txn_ref",
        "account_id",
        F.col("reject_reason").alias("reason"),
        F.col("raw") if "raw" in tagged.columns else F.lit(None).cast("string").alias("raw"),
        "proc_ts",
    )


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = with_reject_reason(decoded)
    return valid_rows(tagged), rejected_rows(tagged)
