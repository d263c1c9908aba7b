"""Adapter from the generated ``events`` table to card transactions.

Every row of ``events`` becomes one transaction; the mapping is pure
column arithmetic (no join, no shuffle), so it scales with the scan.

Fault injection for the decode path: every event is encoded, and the
events whose ``props.k`` is 0-11 carry one defect each (about 1% of rows
per defect), so the decoder, the quarantine split, the rules and the
currency default meet each case on the whole table.  The defective feed
also carries fraud labels that depend on ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AMOUNT_TYPE, DEFAULT_CURRENCY
from ..functions.codec import iso_text
from ..schemas import WIRE_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values of the events -> transactions mapping.
#   country  = COUNTRIES[event_id mod 8]
#   channel  = CHANNELS[props.k mod 5]
#   amount   = value (to cents) times 50, as NUMERIC(14,2)
#   currency = USD
# ---------------------------------------------------------------------------
COUNTRIES = ["US", "UK", "DE", "SG", "AU", "IN", "NG", "BR"]
CHANNELS = ["ATM", "Online", "POS", "Mobile", "Branch"]
AMOUNT_SCALE = 50

# Defect classes of the wire fixture, keyed by props.k.
FAULT_MALFORMED = 0  # text is not JSON
FAULT_BAD_TS = 1  # event_ts is not a timestamp
FAULT_NAN = 2  # amount is NaN
FAULT_NULL_KEY = 3  # account_id is null
FAULT_NO_CURRENCY = 4  # currency key absent
FAULT_NULL_CURRENCY = 5  # currency present as null
FAULT_NULL_AMOUNT = 6  # amount is null
FAULT_MISTYPED = 7  # flagged is a text
FAULT_OVERFLOW = 8  # amount does not fit NUMERIC(14,2)
FAULT_NULL_REF = 9  # txn_ref is null
FAULT_NULL_TS = 10  # event_ts is null
FAULT_SUB_CENT = 11  # above the threshold by less than half a cent
OVERFLOW_AMOUNT, SUB_CENT_AMOUNT = 1e12, 5000.004
BAD_TS_TEXT = "not-a-timestamp"
MALFORMED_PREFIX = "corrupt:"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """``events`` (batch or stream) -> typed transaction rows."""
    event_time = F.col("ts").cast("timestamp")
    countries = F.array(*[F.lit(c) for c in COUNTRIES])
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    amount = (F.col("value").cast(AMOUNT_TYPE) * F.lit(AMOUNT_SCALE)).cast(AMOUNT_TYPE)
    return events.select(
        F.col("event_id").cast("string").alias("txn_ref"),
        F.col("user_id").cast("string").alias("account_id"),
        iso_text(event_time).alias("event_ts"),
        event_time.alias("event_time"),
        F.col("event_type").alias("merchant_category"),
        amount.alias("amount"),
        F.element_at(countries, (F.col("event_id") % 8 + 1).cast("int")).alias("country"),
        F.element_at(channels, (_k(F.col("props")) % 5 + 1).cast("int")).alias("channel"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        # raw double before rounding to cents, for the rounding operator
        (F.col("value") * F.lit(float(AMOUNT_SCALE))).alias("raw_amount"),
        _k(F.col("props")).alias("fault"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch transactions of one scale-factor directory."""
    return transactions_from_events(read_table(spark, sf_dir, "events")).drop(
        "raw_amount", "fault"
    )


def wire_from_transactions(txns: DataFrame, faults: bool = True) -> DataFrame:
    """Transactions -> ``(value BINARY)`` documents, optionally with defects."""
    fault = F.col("fault")

    def field(c: str) -> Column:
        if c == "amount":
            col = F.col("amount").cast("double")
            if faults:
                col = (
                    F.when(fault == FAULT_NAN, F.lit(float("nan")))
                    .when(fault == FAULT_NULL_AMOUNT, F.lit(None))
                    .when(fault == FAULT_OVERFLOW, F.lit(OVERFLOW_AMOUNT))
                    .when(fault == FAULT_SUB_CENT, F.lit(SUB_CENT_AMOUNT))
                    .otherwise(col)
                )
            return col.alias(c)
        if c == "flagged":
            return ((fault % 4).isin(1, 2) if faults else F.lit(False)).alias(c)
        if c == "flag_reason":
            reason = F.lit(None).cast("string")
            if faults:
                reason = F.when((fault % 4).isin(1, 3), F.lit("HIGH_VALUE")).when(
                    fault % 4 == 2, F.lit("IMPOSSIBLE_TRAVEL")
                )
            return reason.alias(c)
        col = F.col(c)
        if faults and c == "txn_ref":
            col = F.when(fault == FAULT_NULL_REF, F.lit(None)).otherwise(col)
        if faults and c == "event_ts":
            col = (
                F.when(fault == FAULT_BAD_TS, F.lit(BAD_TS_TEXT))
                .when(fault == FAULT_NULL_TS, F.lit(None))
                .otherwise(col)
            )
        if faults and c == "account_id":
            col = F.when(fault == FAULT_NULL_KEY, F.lit(None)).otherwise(col)
        if faults and c == "currency":
            col = F.when(fault == FAULT_NULL_CURRENCY, F.lit(None)).otherwise(col)
        return col.alias(c)

    opts = {"ignoreNullFields": "false"}
    full = F.to_json(F.struct(*[field(c) for c in WIRE_COLUMNS]), opts)
    if not faults:
        return txns.select(full.cast("binary").alias("value"))
    without_currency = F.to_json(
        F.struct(*[field(c) for c in WIRE_COLUMNS if c != "currency"]), opts
    )
    text = (
        F.when(fault == FAULT_NO_CURRENCY, without_currency)
        .when(fault == FAULT_MALFORMED, F.concat(F.lit(MALFORMED_PREFIX), full))
        .when(fault == FAULT_MISTYPED, F.replace(full, F.lit('"flagged":false'), F.lit('"flagged":"maybe"')))
        .otherwise(full)
    )
    return txns.select(text.cast("binary").alias("value"))


def wire_events(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Stream-value shaped fixture built from ``events``."""
    return wire_from_transactions(
        transactions_from_events(read_table(spark, sf_dir, "events")), faults
    )
