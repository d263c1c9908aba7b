"""The two fraud rules, written once for batch and streaming DataFrames.

Input: decoded transactions with at least ``txn_ref, account_id,
event_time, merchant_category, amount, country``.  Output alert shape:
``txn_ref, account_id, fraud_type, detection_ts, details``.

Impossible travel is "aggregate, then join back", in batch and in
streaming alike:

* only the distinct countries (bounded by the country domain) and a count are kept of each
  (window, account);
* guilty windows are joined back to the rows, so no list of transactions is ever built
  per group, and each row takes part once, under its pane, not once for each window.

Batch: rows are aggregated by pane and the panes merged to windows (``panes``); the join is on
the pane.  AQE broadcasts the guilty side when it is measured small at runtime.
Streaming: a window function needs the whole input, so windows are aggregated directly
(partial aggregates, one state a window); the join is a stream-stream join in which a row waits
once, under the last window it falls in, until the watermark passes that.  A guilty
window meets only rows that came before it closed, as ``arrived`` tells.

A hot account's rows are spread over ``travel_salt_buckets`` join
partitions and each guilty window is replicated once per bucket, in batch
and in streaming: the aggregate between the join and its shuffle keeps
AQE from splitting that key on its own.

The rules take decoded rows as they came: rule 1 compares the raw amount
(before rounding to cents), and neither rule depends on whether the
transactions table would accept the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, HIGH_VALUE, IMPOSSIBLE_TRAVEL, RuleConfig
from ..functions.money import is_finite
from ..schemas import ALERT_COLUMNS
from . import panes


def _window(cfg: RuleConfig) -> Column:
    if cfg.travel_slide:
        return F.window("event_time", cfg.travel_window, cfg.travel_slide)
    return F.window("event_time", cfg.travel_window)


def high_value(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Rule 1: strictly above the threshold; NULL, NaN and infinite amounts never match."""
    hit = F.col("amount") > F.lit(cfg.high_value_threshold)
    if dict(txns.dtypes)["amount"] == "double":
        hit = hit & is_finite(F.col("amount"))
    return txns.filter(hit)


def high_value_alerts(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    details = F.to_json(
        F.struct(
            F.col("amount").cast("double").alias("amount"),
            F.col("country"),
            F.col("merchant_category"),
        )
    )
    return high_value(txns, cfg).select(
        "txn_ref",
        "account_id",
        F.lit(HIGH_VALUE).alias("fraud_type"),
        F.current_timestamp().alias("detection_ts"),
        details.alias("details"),
    )


def _with_watermark(txns: DataFrame, cfg: RuleConfig) -> DataFrame:
    # Batch plans drop the watermark node, so this is a no-op there;
    # ``watermark_delay=None`` means the caller already set the watermark.
    if txns.isStreaming and cfg.watermark_delay:
        return txns.withWatermark("event_time", cfg.watermark_delay)
    return txns


def windowed_rows(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """One row per (transaction, window it falls in); NULL times drop out."""
    return _with_watermark(txns, cfg).select(
        _window(cfg).alias("window"), "account_id", "country", "txn_ref"
    )


def _lengths(cfg: RuleConfig) -> tuple[int, int]:
    """Width and slide of the travel window in microseconds."""
    width = panes.micros(cfg.travel_window)
    return width, panes.micros(cfg.travel_slide) if cfg.travel_slide else width


def travel_windows(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Guilty (window, account) pairs with their sorted distinct countries."""
    guilty = F.size("countries") >= F.lit(cfg.min_countries)
    if txns.isStreaming:
        found = windowed_rows(txns, cfg).groupBy("window", "account_id").agg(
            F.array_sort(F.collect_set("country")).alias("countries"), F.count("txn_ref").alias("txn_count")
        )
        return found.filter(guilty)
    width, slide = _lengths(cfg)
    states = panes.pane_states(
        txns, ["account_id"], "event_time", "country", "txn_ref", panes.pane_length(width, slide)
    )
    return panes.window_states(states, ["account_id"], width, slide).select(
        panes.window_struct(F.col("window_start"), width).alias("window"),
        "account_id",
        F.array_sort("found").alias("countries"),
        F.col("n").alias("txn_count"),
    ).filter(guilty)


def _travel_details() -> Column:
    return F.to_json(F.struct("window", "countries"))


def _row_slots(txns: DataFrame, cfg: RuleConfig) -> DataFrame:
    """``slot, account_id, txn_ref`` once a row: its pane; in a stream its last window, and when it came."""
    width, slide = _lengths(cfg)
    if not txns.isStreaming:
        slot = panes.pane_of(F.col("event_time"), panes.pane_length(width, slide))
        rows = txns.where(F.col("event_time").isNotNull()).select(slot.alias("slot"), "account_id", "txn_ref")
    else:
        rows = _with_watermark(txns, cfg).select(
            _window(cfg).alias("slot"), "event_time", "account_id", "txn_ref", F.current_timestamp().alias("arrived")
        )
        into = F.unix_micros("event_time") - F.unix_micros("slot.start")
        # the window's column carries the watermark: a row leaves the state when its last window closes
        rows = rows.where(into < slide).withColumn("at", F.unix_micros("event_time")).drop("event_time")
    return rows.where(F.col("txn_ref").isNotNull())


def _window_slots(guilty: DataFrame, cfg: RuleConfig) -> DataFrame:
    """The guilty windows, once for each slot that their rows can wait under."""
    width, slide = _lengths(cfg)
    start = F.unix_micros("window.start")
    if not guilty.isStreaming:
        return guilty.withColumn("slot", F.explode(panes.panes_of(start, width, slide)))
    starts = F.sequence(start, start + F.lit(width - 1), F.lit(slide).cast("long"))
    slot = F.transform(starts, lambda s: panes.window_struct(s, width))
    return guilty.select("*", F.current_timestamp().alias("closed"), F.explode(slot).alias("slot"))


def travel_alerts(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Rule 2: one alert per transaction of every guilty window."""
    rows = _row_slots(txns, cfg)
    guilty = _window_slots(travel_windows(txns, cfg).select("window", "account_id", "countries"), cfg)
    keys = ["slot", "account_id"]
    buckets = cfg.travel_salt_buckets
    if buckets > 1:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("txn_ref"), F.lit(buckets)))
        guilty = guilty.withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")))
        )
        keys = keys + ["salt"]
    found = rows.join(guilty, keys, "inner")
    if txns.isStreaming:
        found = found.where((F.col("arrived") <= F.col("closed")) & (F.col("at") < F.unix_micros("window.end")))
    return found.select(
        "txn_ref",
        "account_id",
        F.lit(IMPOSSIBLE_TRAVEL).alias("fraud_type"),
        F.current_timestamp().alias("detection_ts"),
        _travel_details().alias("details"),
    )


def all_alerts(txns: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """UNION ALL of both rules (duplicates are data: one row per hit)."""
    return (
        high_value_alerts(txns, cfg)
        .select(*ALERT_COLUMNS)
        .unionByName(travel_alerts(txns, cfg).select(*ALERT_COLUMNS))
    )
