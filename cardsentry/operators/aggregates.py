"""Grouped and global aggregates of the reports and the ETL.

All are partial + final hash aggregates; the alert-side ones run over
pre-aggregated alert weights (see ``joins.alert_weights``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import STATUS_FAIL, STATUS_PASS, TOTAL_TYPE
from ..functions.money import money_sum
from .joins import weighted_alert_transactions

SUM_TYPE = "decimal(38,2)"


def volume(txns: DataFrame) -> DataFrame:
    """COUNT(*) and COALESCE(SUM(amount), 0) of one table."""
    return txns.agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum(F.col("amount"), SUM_TYPE).alias("total_amount"),
    )


def fraud_cube(alerts: DataFrame, txns: DataFrame) -> DataFrame:
    """Alert-weighted counts and money per (merchant, country, fraud type).

    One pre-aggregated join feeds every alert/transaction report section;
    its size is bounded by the key domains, not by the data.
    """
    w = weighted_alert_transactions(alerts, txns, keys=("fraud_type",))
    return w.groupBy("merchant_category", "country", "fraud_type").agg(
        F.sum("n").alias("alert_count"),
        F.sum(F.col("amount") * F.col("n")).cast(SUM_TYPE).alias("total_amount"),
    )


def _rollup(cube: DataFrame, keys, count_name: str, sum_name: str) -> DataFrame:
    return cube.groupBy(*keys).agg(
        F.coalesce(F.sum("alert_count"), F.lit(0)).cast("long").alias(count_name),
        money_sum(F.col("total_amount"), SUM_TYPE).alias(sum_name),
    )


def volume_flagged(alerts: DataFrame, txns: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Alert-weighted volume: one unit per (alert, matching transaction)."""
    c = cube if cube is not None else fraud_cube(alerts, txns)
    return _rollup(c, [], "txn_count", "total_amount")


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    """Counts every alert, also those without a transaction."""
    return alerts.groupBy("fraud_type").agg(F.count(F.lit(1)).alias("alert_count"))


def alerts_by_merchant(alerts: DataFrame, txns: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    c = cube if cube is not None else fraud_cube(alerts, txns)
    return _rollup(c, ["merchant_category"], "alert_count", "total_amount").orderBy(
        F.desc("alert_count"), F.asc_nulls_first("merchant_category")
    )


def alerts_by_country(alerts: DataFrame, txns: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    c = cube if cube is not None else fraud_cube(alerts, txns)
    return _rollup(c, ["country"], "alert_count", "total_amount").orderBy(
        F.desc("alert_count"), F.asc_nulls_first("country")
    )


def fraud_by_merchant(alerts: DataFrame, txns: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """Alerts by merchant category x fraud type, largest count first."""
    c = cube if cube is not None else fraud_cube(alerts, txns)
    return _rollup(
        c, ["merchant_category", "fraud_type"], "fraud_count", "total_fraud_amount"
    ).orderBy(
        F.desc("fraud_count"),
        F.asc_nulls_first("merchant_category"),
        F.asc_nulls_first("fraud_type"),
    )


def top_accounts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Accounts with most alerts; ties broken by account id (top-k)."""
    return (
        alerts.groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_count"), F.asc_nulls_first("account_id"))
        .limit(n)
    )


def clean_by(clean: DataFrame, key: str) -> DataFrame:
    """Clean totals per key; rows with a NULL key are not a group."""
    return (
        clean.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("txn_ref").alias("tx_count"),
            # exact decimal sum, converted once: no order-dependent rounding
            F.sum(F.coalesce(F.col("amount"), F.lit(0)).cast(SUM_TYPE))
            .cast("double")
            .alias("total_amount"),
        )
        .orderBy(F.desc("total_amount"), F.asc(key))
    )


def clean_summary(clean: DataFrame) -> DataFrame:
    """Grand total (float, cents) and row count; empty input -> 0.0 / 0."""
    return clean.agg(
        F.coalesce(F.sum(F.col("amount").cast(SUM_TYPE)), F.lit(0))
        .cast("double")
        .alias("total_clean_amount"),
        F.count(F.lit(1)).alias("tx_count"),
    )


def label_mix(wire: DataFrame) -> DataFrame:
    """Share of producer labels on the wire (flag_reason when flagged)."""
    reason = F.when(F.col("flagged"), F.lower(F.col("flag_reason")))
    total = F.count(F.lit(1))
    counts = {
        "normal": F.count_if(reason.isNull()),
        "high_value": F.count_if(reason == F.lit("high_value")),
        "impossible_travel": F.count_if(reason == F.lit("impossible_travel")),
    }
    agg = wire.agg(total.alias("total"), *[v.alias(k) for k, v in counts.items()])
    denom = F.greatest(F.col("total"), F.lit(1))
    return agg.select(
        "total",
        *counts.keys(),
        *[(F.col(k) / denom * F.lit(100.0)).alias(f"pct_{k}") for k in counts],
    )


def reconcile_row(
    txns: DataFrame,
    alerts: DataFrame,
    ledger: DataFrame,
    tolerance: str = "0.02",
    distinct_alerts: bool = False,
) -> DataFrame:
    """One reconciliation row from three totals, in a single aggregate.

    The three sums come from different tables; they are tagged, unioned
    and summed in one global aggregate (no join of one-row frames).
    ``distinct_alerts`` counts each flagged transaction once instead of
    once per alert.
    """
    if distinct_alerts:
        fraud = weighted_alert_transactions(alerts, txns, keys=(), txn_cols=["amount"]).select(
            F.lit("fraud").alias("part"), F.col("amount").alias("v")
        )
    else:
        fraud = weighted_alert_transactions(alerts, txns, keys=(), txn_cols=["amount"]).select(
            F.lit("fraud").alias("part"), (F.col("amount") * F.col("n")).alias("v")
        )
    parts = (
        txns.select(F.lit("total").alias("part"), F.col("amount").cast(SUM_TYPE).alias("v"))
        .unionByName(fraud.select("part", F.col("v").cast(SUM_TYPE).alias("v")))
        .unionByName(
            ledger.select(F.lit("valid").alias("part"), F.col("amount").cast(SUM_TYPE).alias("v"))
        )
    )

    def part_sum(name: str):
        return F.coalesce(F.sum(F.when(F.col("part") == name, F.col("v"))), F.lit(0)).cast(
            TOTAL_TYPE
        )

    totals = parts.agg(
        part_sum("total").alias("total_ingested"),
        part_sum("fraud").alias("fraud_amount"),
        part_sum("valid").alias("validated_amt"),
    )
    return finish_reconcile(totals, tolerance)


def finish_reconcile(totals: DataFrame, tolerance: str = "0.02") -> DataFrame:
    """Expected amount, difference and PASS/FAIL from the three totals."""
    expected = F.round(F.col("total_ingested") - F.col("fraud_amount"), 2)
    return (
        totals.withColumn("expected_valid", expected.cast(TOTAL_TYPE))
        .withColumn(
            "difference",
            F.round(F.abs(F.col("expected_valid") - F.col("validated_amt")), 2).cast(TOTAL_TYPE),
        )
        .withColumn(
            "status",
            F.when(F.col("difference") < F.lit(tolerance).cast(TOTAL_TYPE), F.lit(STATUS_PASS)).otherwise(
                F.lit(STATUS_FAIL)
            ),
        )
    )
