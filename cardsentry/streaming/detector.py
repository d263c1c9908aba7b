"""Streaming detector: wire stream -> transactions table + alerts table.

Two queries read the same source with the same explicit start position,
each with its own checkpoint under the shared checkpoint root:

* ``transactions``: decode -> quarantine split -> ``all_transactions`` and
  ``rejected_events``.  Every rejected document passes as it is.  The keys of the
  valid ones go through a stateful minimum of ``proc_ts`` per ``txn_ref``, the table's
  key index: two times a key, combined map-side, exact across all batches (the first
  arrival wins, as with an insert that ignores conflicts), O(batch) work per trigger.
  The sink keeps, of each key new in the batch, the smallest row; that minimum, too, is
  combined map-side, so a key that a third of a batch repeats is no hot task.
* ``alerts``: decode -> rule 1 (stateless, on the raw amount) UNION ALL
  rule 2 (watermarked window aggregate of countries, joined back to the
  windowed rows by a stream-stream join) -> ``flagged_transactions``.  The
  quarantine decides only what enters ``all_transactions``.

Sinks run in ``foreachBatch`` as distributed writes of partition
``writer=<checkpoint id>/batch_id=<n>`` in overwrite mode: a replayed batch
replaces what its first attempt wrote, and no checkpoint touches another's
batches.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ..config import DEFAULT, RuleConfig
from ..functions.codec import decode_events, decode_once
from ..operators import joins, offsets, quality, rules
from ..plans import oracle
from ..plans.catalog import register
from ..schemas import ALERT_COLUMNS, SOURCE_COLUMNS, TXN_COLUMNS
from ..session import STATE_PROVIDER, STATE_PROVIDER_KEY, STATE_ROWS_KEY, default_parallelism, ensure_utc, scratch_path
from ..sinks.store import TableStore, checkpoint_writer
from ..sources import fixture
from ..sources.kafka import kafka_stream, start_now
from .progress import ProgressLog

EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


# -- sources ------------------------------------------------------------------


def events_file_stream(
    spark: SparkSession, sf_dir: str, max_files: int = 1, faults: bool = False
) -> DataFrame:
    """``events`` parquet files of a directory as a stream of wire values."""
    events = (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .parquet(sf_dir)
        .repartition(default_parallelism(spark))  # a file of few row groups is read by few tasks
    )
    return fixture.wire_from_transactions(fixture.transactions_from_events(events), faults=faults)


def json_file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Text files, one JSON document per line, as a stream of wire values."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(path)
        .select(F.col("value").cast("binary").alias("value"))
    )


# -- plans ---------------------------------------------------------------------


#: What the rules read of a decoded row.
RULE_COLUMNS = ("txn_ref", "account_id", "event_time", "merchant_category", "amount", "country")


def decoded_stream(raw: DataFrame) -> DataFrame:
    """Decoded rows for the rules, which read them in two or three branches."""
    return decode_once(decode_events(raw).select(*RULE_COLUMNS), default_parallelism(raw.sparkSession))


def alert_stream(raw: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Both rules over the decoded rows of a wire stream (or batch)."""
    txns = decoded_stream(raw)
    if cfg.dedupe_within_watermark and txns.isStreaming:
        txns = txns.withWatermark("event_time", cfg.watermark_delay).dropDuplicatesWithinWatermark(
            ["txn_ref"]
        )
        cfg = replace(cfg, watermark_delay=None)  # one watermark per stream
    return rules.all_alerts(txns, cfg)


def travel_stream(raw: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    return rules.travel_alerts(decoded_stream(raw), cfg)


# -- sinks ---------------------------------------------------------------------


#: Marks a row of ``transaction_rows`` that names a new key (the others are documents).
NEW_KEY = "_new_key"


def transaction_rows(raw: DataFrame, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Every decoded row with its reject reason, and one ``NEW_KEY`` row for each key first seen now.

    The state of a key is the first and the last ``proc_ts`` it came with.  All rows of a
    micro-batch have one ``proc_ts`` (also in its replay), so a key is new where the two are
    equal.  Without a watermark the state remembers every key, which is exactly the
    primary-key contract of ``all_transactions``.  With ``txn_dedupe="watermark"`` keys are
    remembered for the watermark delay only (bounded state; a copy arriving later is
    written again).
    """
    # not shared: a batch's input rows are logged once for each branch that reads them
    tagged = quality.with_reject_reason(decode_events(raw))
    valid = tagged.where(F.col("reject_reason").isNull())
    if cfg.txn_dedupe == "global":
        seen = valid.groupBy("txn_ref").agg(F.min("proc_ts").alias("first_seen"), F.max("proc_ts").alias("last_seen"))
        keys = seen.where(F.col("first_seen") == F.col("last_seen"))
    elif cfg.txn_dedupe == "watermark":
        keys = valid.withWatermark("event_time", cfg.watermark_delay)
        keys = keys.dropDuplicatesWithinWatermark(["txn_ref"])
    else:
        raise ValueError(f"txn_dedupe must be 'global' or 'watermark', not {cfg.txn_dedupe!r}")
    keys = keys.select("txn_ref", F.lit(True).alias(NEW_KEY))
    return tagged.withColumn(NEW_KEY, F.lit(False)).unionByName(keys, allowMissingColumns=True)


def transactions_output_mode(cfg: RuleConfig = DEFAULT) -> str:
    """A new key is reported when it comes: the stateful minimum needs update mode for that."""
    return "update" if cfg.txn_dedupe == "global" else "append"


class Writer:
    """The writer id of one checkpoint, read at its first batch."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.checkpoint, self._id = spark, checkpoint, None

    def __call__(self) -> str:
        if self._id is None:
            self._id = checkpoint_writer(self.spark, self.checkpoint)
        return self._id


def transactions_sink(store: TableStore, writer: Callable[[], str]):
    """foreachBatch body for ``all_transactions`` and the quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            docs, keys = batch.where(~F.col(NEW_KEY)), batch.where(F.col(NEW_KEY)).select("txn_ref")
            valid = quality.valid_rows(docs).select(*TXN_COLUMNS)
            smallest = joins.dedupe_by_key(valid, "txn_ref", order_cols=("proc_ts",))
            store.write_partition("all_transactions", smallest.join(keys, "txn_ref", "left_semi"), batch_id, writer())
            if set(SOURCE_COLUMNS) <= set(batch.columns):
                store.write_partition("source_ranges", offsets.islands(docs, *SOURCE_COLUMNS), batch_id, writer())
            rejected = quality.rejected_rows(docs)
            if not rejected.isEmpty():  # most batches have none: no empty partitions
                store.write_partition("rejected_events", rejected, batch_id, writer())
        finally:
            batch.unpersist()

    return write


def alerts_sink(store: TableStore, writer: Callable[[], str]):
    """foreachBatch body for ``flagged_transactions`` (plain append)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        flag_id = F.concat(
            F.lit(f"{writer()}-{batch_id}-"), F.monotonically_increasing_id().cast("string")
        )
        out = batch.withColumn("flag_id", flag_id)
        store.write_partition("flagged_transactions", out, batch_id, writer())

    return write


@dataclass
class Detector:
    spark: SparkSession
    transactions: StreamingQuery
    alerts: StreamingQuery

    def await_all(self) -> None:
        self.transactions.awaitTermination()
        self.alerts.awaitTermination()

    def await_any(self) -> None:
        """Return when either query ends (the other keeps running)."""
        self.spark.streams.awaitAnyTermination()

    def stop(self) -> None:
        for q in (self.transactions, self.alerts):
            if q.isActive:
                q.stop()


def _trigger(writer, trigger: dict | None):
    """None: drain what is there (tests, backfills); {}: Spark's default
    trigger (next batch as soon as the last one ends); else the given one."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(**trigger) if trigger else writer


@contextmanager
def state_partitions(spark: SparkSession, cfg: RuleConfig = DEFAULT, count_state: bool = True):
    """Start queries with an explicit state-partition count and the RocksDB state provider.

    A stateful query keeps the shuffle-partition count and the provider of its first start
    in the checkpoint; both are set here (default: the cluster's total
    cores), whoever built the session, and the session's settings are restored afterwards.
    ``count_state``: whether progress tells the rows in state.  Counting looks each key up once
    more with every write and removal; the registered queries, which store no progress, do without.
    """
    n = cfg.state_partitions or default_parallelism(spark)
    wanted = {"spark.sql.shuffle.partitions": str(n), STATE_PROVIDER_KEY: STATE_PROVIDER, STATE_ROWS_KEY: str(count_state).lower()}
    old = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield n
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_detector(
    raw_transactions: DataFrame,
    raw_alerts: DataFrame,
    store: TableStore,
    checkpoint_dir: str,
    cfg: RuleConfig = DEFAULT,
    trigger: dict | None = None,
    log: ProgressLog | None = None,
    count_state: bool = True,
) -> Detector:
    """Start both queries; pass two reads of one source (same start).  ``log`` stores what each batch read and dropped."""
    with state_partitions(raw_transactions.sparkSession, cfg, count_state):
        found = _start_both(raw_transactions, raw_alerts, store, checkpoint_dir, cfg, trigger)
    if log:
        log.follow(found.transactions, "transactions")
        log.follow(found.alerts, "alerts")
    return found


def start_transactions(
    raw: DataFrame, store: TableStore, checkpoint: str, cfg: RuleConfig = DEFAULT, trigger: dict | None = None
) -> StreamingQuery:
    """The transactions query alone."""
    return _trigger(
        transaction_rows(raw, cfg)
        .writeStream.foreachBatch(transactions_sink(store, Writer(store.spark, checkpoint)))
        .outputMode(transactions_output_mode(cfg))
        .option("checkpointLocation", checkpoint),
        trigger,
    ).start()


def _start_both(raw_transactions, raw_alerts, store, checkpoint_dir, cfg, trigger) -> Detector:
    q1 = start_transactions(raw_transactions, store, f"{checkpoint_dir}/all_txn", cfg, trigger)
    q2 = _trigger(
        alert_stream(raw_alerts, cfg)
        .select(*ALERT_COLUMNS)
        .writeStream.foreachBatch(alerts_sink(store, Writer(store.spark, f"{checkpoint_dir}/flagged")))
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_dir}/flagged"),
        trigger,
    ).start()
    return Detector(raw_transactions.sparkSession, q1, q2)


def run_kafka_detector(spark: SparkSession, store: TableStore, cfg: RuleConfig = DEFAULT) -> Detector:
    """Production entry: Kafka source, default trigger, run until stopped."""
    ensure_utc(spark)
    ckpt = f"{store.root}/_checkpoints/detector"
    cfg = start_now(cfg)  # one position for both queries
    log = ProgressLog(spark, store).attach()
    return start_detector(
        kafka_stream(spark, cfg), kafka_stream(spark, cfg), store, ckpt, cfg, trigger={}, log=log
    )


# -- registered stream queries -----------------------------------------------


@register("stream_travel")
def q_stream_travel(spark, sf_dir):
    """Rule 2 as a stateful stream over ``events`` (availableNow), read back."""
    store = TableStore(spark, scratch_path(spark, "stream-travel"))
    with state_partitions(spark, count_state=False):
        q = (
            travel_stream(events_file_stream(spark, sf_dir))
            .writeStream.foreachBatch(alerts_sink(store, Writer(spark, f"{store.root}/_checkpoints/travel")))
            .outputMode("append")
            .option("checkpointLocation", f"{store.root}/_checkpoints/travel")
            .trigger(availableNow=True)
            .start()
        )
    q.awaitTermination()
    return store.read("flagged_transactions").select("txn_ref", "account_id", "fraud_type", "details")


@register("stream_all_alerts")
def q_stream_all_alerts(spark, sf_dir):
    """The full two-query detector over ``events``; alerts read back."""
    store = TableStore(spark, scratch_path(spark, "stream-detector"))
    det = start_detector(
        events_file_stream(spark, sf_dir),
        events_file_stream(spark, sf_dir),
        store,
        f"{store.root}/_checkpoints",
        count_state=False,
    )
    det.await_all()
    return store.read("flagged_transactions").select("txn_ref", "account_id", "fraud_type", "details")


def _run_transactions_query(spark: SparkSession, sf_dir: str, label: str, faults: bool) -> TableStore:
    """The transactions query alone over ``events`` (availableNow)."""
    store = TableStore(spark, scratch_path(spark, label))
    raw = events_file_stream(spark, sf_dir, faults=faults)
    with state_partitions(spark, count_state=False):
        q = start_transactions(raw, store, f"{store.root}/_checkpoints/all_txn")
    q.awaitTermination()
    return store


@register("stream_transactions")
def q_stream_transactions(spark, sf_dir):
    """The detector's transaction table after the stream drained."""
    store = _run_transactions_query(spark, sf_dir, "stream-transactions", faults=False)
    return store.read("all_transactions").select(*TXN_COLUMNS[:-1])


@register("stream_rejected")
def q_stream_rejected(spark, sf_dir):
    """The transactions query over wire documents with defects: quarantine."""
    store = _run_transactions_query(spark, sf_dir, "stream-rejected", faults=True)
    return store.read("rejected_events").select("txn_ref", "account_id", "reason")


@register("stream_alerts_faulty")
def q_stream_alerts_faulty(spark, sf_dir):
    """Both rules over wire documents with defects: what the table rejects is still judged."""
    store = TableStore(spark, scratch_path(spark, "stream-faulty"))
    checkpoint = f"{store.root}/_checkpoints/flagged"
    with state_partitions(spark, count_state=False):
        q = (
            alert_stream(events_file_stream(spark, sf_dir, faults=True))
            .select(*ALERT_COLUMNS)
            .writeStream.foreachBatch(alerts_sink(store, Writer(spark, checkpoint)))
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    q.awaitTermination()
    return store.read("flagged_transactions").select("txn_ref", "account_id", "fraud_type", "details")


def _two_writers(spark: SparkSession, sf_dir: str, label: str) -> TableStore:
    """A store that holds every transaction twice: from a load, then from a detector that rereads the topic."""
    from ..plans.etl import seed_store

    store = seed_store(spark, sf_dir, root=scratch_path(spark, label))
    with state_partitions(spark, count_state=False):
        q = start_transactions(events_file_stream(spark, sf_dir), store, f"{store.root}/_checkpoints/all_txn")
    q.awaitTermination()
    return store


@register("stream_two_writers")
def q_stream_two_writers(spark, sf_dir):
    """A load and a detector's transactions query on one store: one row a key, the load's (it came first)."""
    store = _two_writers(spark, sf_dir, "stream-two-writers")
    rows = store.read("all_transactions").withColumn("from_load", F.col("writer").startswith("load-").cast("string"))
    amount = F.max(F.col("amount").cast("double")).alias("amount")
    return rows.groupBy("txn_ref", "from_load").agg(F.count("*").alias("n_rows"), amount)


@register("stream_two_writers_reconcile")
def q_stream_two_writers_reconcile(spark, sf_dir):
    """The reconciliation over such a store: every transaction counts once."""
    from ..plans.etl import RECON_OUT, reconcile, run_etl

    store = _two_writers(spark, sf_dir, "two-writers-reconcile")
    res = run_etl(spark, store)
    return reconcile(spark, store, run_id=res.run_id, distinct_alerts=True).select(*RECON_OUT)


# Append mode emits a window once the final watermark (max event time
# minus the delay) has passed its end.
_CLOSED = " WHERE we <= (SELECT max(event_time) - INTERVAL 2 MINUTE FROM txn)"
oracle.add("stream_travel", "SELECT txn_ref, account_id, fraud_type, details FROM travel" + _CLOSED)
oracle.add(
    "stream_all_alerts",
    "SELECT txn_ref, account_id, fraud_type, details FROM hv UNION ALL "
    "SELECT txn_ref, account_id, fraud_type, details FROM travel" + _CLOSED,
)
oracle.add("stream_rejected", oracle.REJECTED)
oracle.add(
    "stream_two_writers",
    "SELECT txn_ref, 'true' AS from_load, 1 AS n_rows, CAST(amount AS DOUBLE) AS amount FROM txn",
)
oracle.add(
    "stream_alerts_faulty",
    r""", wslid AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS ws, * FROM wire WHERE event_time IS NOT NULL
  UNION ALL
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE AS ws, * FROM wire
  WHERE event_time IS NOT NULL),
wguilty AS (
  SELECT ws, ws + INTERVAL 10 MINUTE AS we, account_id, list_sort(list(DISTINCT country)) AS countries
  FROM wslid GROUP BY ws, account_id HAVING count(DISTINCT country) > 1)
SELECT txn_ref, account_id, 'HIGH_VALUE' AS fraud_type,
       '{"amount":' || CASE WHEN k = 8 THEN '1.0E12' ELSE CAST(amount AS VARCHAR) END || ',"country":"' || country
         || '","merchant_category":"' || merchant_category || '"}' AS details
FROM wire WHERE amount > 5000 AND NOT isnan(amount)
UNION ALL
SELECT s.txn_ref, s.account_id, 'IMPOSSIBLE_TRAVEL',
       '{"window":{"start":"' || strftime(g.ws, '%Y-%m-%dT%H:%M:%S') || '.000Z","end":"'
         || strftime(g.we, '%Y-%m-%dT%H:%M:%S') || '.000Z"},"countries":'
         || CAST(to_json(g.countries) AS VARCHAR) || '}'
FROM wslid s JOIN wguilty g ON s.ws = g.ws AND s.account_id = g.account_id
WHERE s.txn_ref IS NOT NULL AND g.we <= (SELECT max(event_time) - INTERVAL 2 MINUTE FROM wire)""",
)
oracle.add(
    "stream_transactions",
    "SELECT txn_ref, account_id, event_ts, merchant_category, amount, country, channel, currency"
    " FROM txn",
)
