"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the generated tables of ``sf_dir`` (through the
``events`` -> transactions adapter) over the whole table.  Columns that
cannot be reproduced by another engine (detection and processing
timestamps) are left out of the returned frames.

Money is fixed-point inside every operator and table; the registered
outputs expose it as DOUBLE (the exact decimal result, converted once) so
a cross-engine comparison sees the same value type on both sides;
booleans are exposed as 'true' / 'false' text for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType

from ..config import DEFAULT, RuleConfig
from ..functions.codec import decode_events, encode_events
from ..functions.money import normalize_amount, round_cents, to_amount
from ..operators import aggregates as agg
from ..operators import joins, quality, rules
from ..schemas import TXN_VALUE_COLUMNS, WIRE_COLUMNS
from ..session import ensure_utc
from ..sources import fixture

ALERT_OUT = ["txn_ref", "account_id", "fraud_type", "details"]

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return comparable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Decimal outputs as DOUBLE, booleans as text, the rest unchanged."""

    def out(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, BooleanType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[out(f) for f in df.schema.fields])


def registry() -> dict[str, QueryFn]:
    # Importing the job modules registers their queries too.
    from . import audits, etl, reports  # noqa: F401
    from ..streaming import detector  # noqa: F401

    return dict(_REGISTRY)


# -- shared inputs ----------------------------------------------------------


def txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.transactions(spark, sf_dir)


def alerts(spark: SparkSession, sf_dir: str, cfg: RuleConfig = DEFAULT) -> DataFrame:
    return rules.all_alerts(txns(spark, sf_dir), cfg)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_events(fixture.wire_events(spark, sf_dir, faults=True))


# -- decode / normalise -----------------------------------------------------


@register("decode_events")
def q_decode_events(spark, sf_dir):
    """Wire documents (with injected defects) -> the ten wire columns."""
    return decoded(spark, sf_dir).select(*WIRE_COLUMNS)


@register("event_time_parse")
def q_event_time_parse(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        "txn_ref", "event_ts", F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


@register("encode_events")
def q_encode_events(spark, sf_dir):
    """Transactions -> JSON wire text (the Kafka value)."""
    t = txns(spark, sf_dir)
    return encode_events(t, key_col="txn_ref").select(
        F.col("key").cast("string").alias("txn_ref"),
        F.col("value").cast("string").alias("value"),
    )


@register("scan_transactions")
def q_scan_transactions(spark, sf_dir):
    return txns(spark, sf_dir).select(*TXN_VALUE_COLUMNS)


@register("project_transactions")
def q_project_transactions(spark, sf_dir):
    """Encode -> decode round trip, then the nine-column projection."""
    wire = fixture.wire_events(spark, sf_dir, faults=False)
    d = decode_events(wire)
    return d.select(*TXN_VALUE_COLUMNS).withColumn("amount", to_amount(F.col("amount")))


@register("normalize_amount")
def q_normalize_amount(spark, sf_dir):
    """Amounts as loaded: NULL, NaN and overflowing ones are 0.0."""
    amount = normalize_amount(to_amount(F.col("amount")))
    return decoded(spark, sf_dir).select("txn_ref", amount.alias("amount"))


@register("round_amount")
def q_round_amount(spark, sf_dir):
    """Raw amounts with up to five decimals, half a cent included."""
    t = fixture.transactions_from_events(fixture.read_table(spark, sf_dir, "events"))
    t = t.withColumn("raw_amount", F.col("raw_amount") / 16)
    return t.select("txn_ref", "raw_amount", round_cents(F.col("raw_amount")).alias("amount"))


@register("currency_default")
def q_currency_default(spark, sf_dir):
    d = quality.currency_default(decoded(spark, sf_dir), raw_col="raw")
    return d.select("txn_ref", "currency")


@register("amount_decimal")
def q_amount_decimal(spark, sf_dir):
    d = decoded(spark, sf_dir)
    return d.select("txn_ref", to_amount(F.col("amount")).alias("amount"))


@register("valid_events")
def q_valid_events(spark, sf_dir):
    valid, _ = quality.split_valid(decoded(spark, sf_dir))
    return valid.select(*TXN_VALUE_COLUMNS)


@register("rejected_events")
def q_rejected_events(spark, sf_dir):
    _, rejected = quality.split_valid(decoded(spark, sf_dir))
    return rejected.select("txn_ref", "account_id", "reason")


# -- rules ------------------------------------------------------------------


@register("high_value")
def q_high_value(spark, sf_dir):
    return rules.high_value(txns(spark, sf_dir)).select(
        "txn_ref", "account_id", "amount", "country", "merchant_category"
    )


@register("high_value_alerts")
def q_high_value_alerts(spark, sf_dir):
    return rules.high_value_alerts(txns(spark, sf_dir)).select(*ALERT_OUT)


def _windows_out(df: DataFrame) -> DataFrame:
    """Window bounds as UTC wall-clock (NTZ); countries as JSON array text."""
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "account_id",
        F.to_json("countries").alias("countries"),
        "txn_count",
    )


@register("travel_windows")
def q_travel_windows(spark, sf_dir):
    return _windows_out(rules.travel_windows(txns(spark, sf_dir)))


@register("travel_windows_tumbling")
def q_travel_windows_tumbling(spark, sf_dir):
    return _windows_out(rules.travel_windows(txns(spark, sf_dir), DEFAULT.tumbling()))


@register("travel_alerts")
def q_travel_alerts(spark, sf_dir):
    return rules.travel_alerts(txns(spark, sf_dir)).select(*ALERT_OUT)


@register("all_alerts")
def q_all_alerts(spark, sf_dir):
    return alerts(spark, sf_dir).select(*ALERT_OUT)


# -- joins ------------------------------------------------------------------


@register("clean_transactions")
def q_clean_transactions(spark, sf_dir):
    t = txns(spark, sf_dir)
    return joins.clean_transactions(t, rules.all_alerts(t)).select(*TXN_VALUE_COLUMNS)


@register("alert_transactions")
def q_alert_transactions(spark, sf_dir):
    t = txns(spark, sf_dir)
    return joins.alert_transactions(rules.all_alerts(t), t).select(
        "txn_ref", "account_id", "fraud_type", "merchant_category", "country", "amount"
    )


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    """Existing table = high-value rows; incoming = every row, sent twice.

    The result is the table after the insert: existing rows keep their
    origin, each other key is inserted once.
    """
    t = txns(spark, sf_dir).select(*TXN_VALUE_COLUMNS)
    existing = rules.high_value(t).withColumn("origin", F.lit("existing"))
    incoming = t.unionByName(t).withColumn("origin", F.lit("inserted"))
    added = joins.insert_if_absent(incoming, existing, "txn_ref")
    return existing.unionByName(added).select("txn_ref", "amount", "origin")


# -- aggregates -------------------------------------------------------------


@register("volume_ingested")
def q_volume_ingested(spark, sf_dir):
    return agg.volume(txns(spark, sf_dir))


@register("volume_flagged")
def q_volume_flagged(spark, sf_dir):
    t = txns(spark, sf_dir)
    return agg.volume_flagged(rules.all_alerts(t), t)


@register("alerts_by_type")
def q_alerts_by_type(spark, sf_dir):
    return agg.alerts_by_type(alerts(spark, sf_dir))


@register("alerts_by_merchant")
def q_alerts_by_merchant(spark, sf_dir):
    t = txns(spark, sf_dir)
    return agg.alerts_by_merchant(rules.all_alerts(t), t)


@register("alerts_by_country")
def q_alerts_by_country(spark, sf_dir):
    t = txns(spark, sf_dir)
    return agg.alerts_by_country(rules.all_alerts(t), t)


@register("fraud_by_merchant")
def q_fraud_by_merchant(spark, sf_dir):
    t = txns(spark, sf_dir)
    return agg.fraud_by_merchant(rules.all_alerts(t), t)


@register("top_accounts")
def q_top_accounts(spark, sf_dir):
    return agg.top_accounts(alerts(spark, sf_dir), DEFAULT.top_accounts)


def _clean(spark, sf_dir):
    t = txns(spark, sf_dir)
    return joins.clean_transactions(t, rules.all_alerts(t))


@register("clean_by_merchant")
def q_clean_by_merchant(spark, sf_dir):
    return agg.clean_by(_clean(spark, sf_dir), "merchant_category")


@register("clean_by_country")
def q_clean_by_country(spark, sf_dir):
    return agg.clean_by(_clean(spark, sf_dir), "country")


@register("clean_summary")
def q_clean_summary(spark, sf_dir):
    return agg.clean_summary(_clean(spark, sf_dir))


@register("label_mix")
def q_label_mix(spark, sf_dir):
    return agg.label_mix(decoded(spark, sf_dir))
