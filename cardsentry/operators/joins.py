"""Joins between transactions and alerts, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_transactions(txns: DataFrame, alerts: DataFrame) -> DataFrame:
    """Transactions with no alert: a true anti join.

    Written as ``left_anti`` because Catalyst keeps ``LEFT JOIN ... IS
    NULL`` as an outer join plus a filter.
    """
    keys = alerts.select("txn_ref").where(F.col("txn_ref").isNotNull())
    return txns.join(keys, "txn_ref", "left_anti")


def flagged_transactions(txns: DataFrame, alerts: DataFrame) -> DataFrame:
    """Transactions with at least one alert, each once (semi join)."""
    keys = alerts.select("txn_ref").where(F.col("txn_ref").isNotNull())
    return txns.join(keys, "txn_ref", "left_semi")


def alert_transactions(alerts: DataFrame, txns: DataFrame, txn_cols=None) -> DataFrame:
    """Alerts joined to their transaction (many-to-one, orphans drop)."""
    cols = txn_cols or ["merchant_category", "country", "amount"]
    return alerts.join(txns.select("txn_ref", *cols), "txn_ref", "inner")


def alert_weights(alerts: DataFrame, keys=("fraud_type",)) -> DataFrame:
    """Alerts pre-aggregated to (txn_ref, *keys, n) before any join.

    A transaction hit many times (or a replayed hot key) collapses to one
    row per key in the map-side partial aggregate, so the join behind it
    sees at most (#fraud types) rows per transaction.
    """
    return (
        alerts.where(F.col("txn_ref").isNotNull())
        .groupBy("txn_ref", *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weighted_alert_transactions(
    alerts: DataFrame, txns: DataFrame, keys=("fraud_type",), txn_cols=None
) -> DataFrame:
    """``alert_weights`` joined to transactions; ``n`` is the multiplicity."""
    cols = txn_cols or ["merchant_category", "country", "amount"]
    return alert_weights(alerts, keys).join(txns.select("txn_ref", *cols), "txn_ref")


def dedupe_by_key(df: DataFrame, key: str, order_cols=()) -> DataFrame:
    """One row per key, chosen deterministically.

    The winner is the smallest ``(order_cols..., remaining columns...)``
    struct, computed as a partial + final aggregate so a key repeated in a
    third of the batch is combined map-side, not gathered in one task.
    """
    rest = [c for c in df.columns if c != key and c not in order_cols]
    ordered = [*order_cols, *rest]
    best = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_best")
    return df.groupBy(key).agg(best).select(
        key, *[F.col(f"_best.{c}").alias(c) for c in ordered]
    ).select(*df.columns)


def insert_if_absent(batch: DataFrame, target: DataFrame, key: str, order_cols=()) -> DataFrame:
    """Rows of ``batch`` to append so the existing row of a key wins."""
    fresh = dedupe_by_key(batch.where(F.col(key).isNotNull()), key, order_cols)
    return fresh.join(target.select(key), key, "left_anti")
