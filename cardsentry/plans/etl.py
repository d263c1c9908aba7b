"""Batch ETL: clean transactions -> snapshot, ledger, summaries, reconciliation.

Order (one application, sequential): extract -> snapshot of the clean set ->
insert-if-absent into the ledger -> summaries -> one reconciliation row.  A
rerun with the same run id replaces its own partitions and nothing else.

A full run shuffles ``all_transactions`` once for the extract (no alert), the
ledger check (key not in the ledger) and the reconciliation: alert keys
and ledger keys are first reduced to one narrow row per ``txn_ref``
(alert count, ledger flag; partial + final aggregate), and the
transactions pick both up in a single join.  The joined rows are written
once to a staging folder of this attempt, which every executor can reach, and serve the
totals, the snapshot write and the ledger write.

Every run stores its marks: the partitions (writer, batch, attempt) of both tables that it
read.  The next run is incremental: it reads the partitions without a mark, and
its totals are the last run's plus what these add.

* New transactions meet the new alerts and the alerts whose transaction had not been there
  (``etl_pending``).
* New alerts without a new transaction may flag old ones.  Only if there are any, the
  old partitions are searched for these few keys; a row that was clean until
  now is retracted from the clean set (``snapshot_retractions``).
* A snapshot is a stack of layers, the full run's and what each run added;
  ``read_snapshot`` gives the clean set of a run.  Every ``cfg.snapshot_layers`` runs the
  stack is written as one layer again.

Where that would not give the full run's totals a full run is made: no marks, a marked
partition that was replaced, a run that is not the last, or a key of a new partition that
another writer stored as well.

Totals and counts come from aggregates and read-backs, not accumulators, so
a recomputed stage after an executor loss cannot count twice.

The transactions and alerts tables must exist: a wrong store root is an
error, not an empty reconciliation.  The ledger and the log start empty.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .. import schemas
from ..config import AMOUNT_TYPE, DEFAULT, RuleConfig
from ..functions.money import normalize_amount
from ..operators import aggregates as agg
from ..operators import joins, rules
from ..schemas import TXN_COLUMNS, TXN_VALUE_COLUMNS
from ..session import ensure_utc, scratch_path
from ..sinks.store import Partition, TableStore
from ..sources import fixture
from . import oracle
from .catalog import register

SNAPSHOT_COLUMNS = TXN_COLUMNS


@dataclass
class EtlResult:
    run_id: int
    #: Folder of the rows that this run wrote: the clean set of a full run, the new rows of another.
    snapshot_path: str
    rows_extracted: int
    rows_inserted: int
    by_merchant: DataFrame
    by_country: DataFrame
    summary: DataFrame
    reconciliation: DataFrame
    #: The run whose totals this one builds on; None for a full run.
    base_run: int | None = None
    #: The stored files that the extract read.
    files_read: tuple[str, ...] = ()


MONEY = "decimal(38,2)"


def _total(col: Column) -> Column:
    return F.coalesce(F.sum(col.cast(MONEY)), F.lit(0)).cast(MONEY)


def extract_clean(store: TableStore) -> DataFrame:
    return joins.clean_transactions(
        store.read("all_transactions"), store.read("flagged_transactions")
    )


def key_flags(alerts: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(txn_ref, n_alerts, in_ledger)``: one narrow row per key of either table.

    ``alerts`` counts one a row, or ``n_alerts`` where it has that column.
    """
    n = F.col("n_alerts") if "n_alerts" in alerts.columns else F.lit(1)
    a = alerts.select("txn_ref", n.cast("long").alias("n_alerts"), F.lit(0).alias("in_ledger"))
    led = ledger.select("txn_ref", F.lit(0).cast("long").alias("n_alerts"), F.lit(1).alias("in_ledger"))
    return (
        a.unionByName(led)
        .where(F.col("txn_ref").isNotNull())
        .groupBy("txn_ref")
        .agg(F.sum("n_alerts").alias("n_alerts"), F.max("in_ledger").alias("in_ledger"))
    )


def tagged_transactions(txns: DataFrame, flags: DataFrame) -> DataFrame:
    """Every transaction with its flags, and every flagged key without a transaction (``has_txn`` false)."""
    return (
        txns.select(*SNAPSHOT_COLUMNS, F.lit(True).alias("has_txn"))
        .join(flags, "txn_ref", "full")
        .fillna({"has_txn": False, "n_alerts": 0, "in_ledger": 0})
    )


@dataclass
class Base:
    """The last run, on which an incremental one builds."""

    run_id: int
    layers: int
    extracted: int
    ingested: Decimal
    fraud: Decimal
    validated: Decimal


SOURCES = ("all_transactions", "flagged_transactions")


def _fresh(now: list[Partition], marked: set[tuple]) -> list[Partition]:
    return [p for p in now if (p.writer, p.value, p.attempt) not in marked]


def marks_of(store: TableStore, run_id: int) -> dict[str, set[tuple]]:
    """The partitions that a run had read, by table (one row a stored batch)."""
    rows = store.read("etl_marks", found=[p for p in store.partitions("etl_marks") if p.value == run_id])
    out: dict[str, set[tuple]] = {name: set() for name in SOURCES}
    for r in rows.collect():
        out[r["table_name"]].add((r["writer"], r["batch_id"], r["read_attempt"]))
    return out


def find_base(store: TableStore, run_id: int, now: dict[str, list[Partition]]) -> tuple[Base, dict] | None:
    """The run before ``run_id`` and its marks, if an incremental run on it equals a full one."""
    ended = {p.value for p in store.partitions("reconciliation_log")} - {run_id}
    marked = {p.value for p in store.partitions("etl_marks")}
    if not ended or max(ended) not in marked or max(ended) > run_id:
        return None
    last = max(ended)
    marks = marks_of(store, last)
    for name in SOURCES:  # a marked partition that is gone or was replaced
        if not marks[name] <= {(p.writer, p.value, p.attempt) for p in now[name]}:
            return None
    if store.may_repeat("all_transactions", now["all_transactions"]):
        new = _fresh(now["all_transactions"], marks["all_transactions"])
        repeated = store.repeated_hashes("all_transactions", now["all_transactions"])
        if new and not store.key_hashes("all_transactions", new).join(repeated, "key_hash", "left_semi").isEmpty():
            return None
    log = store.read("reconciliation_log").where(F.col("run_id") == last).first()
    chain = _layers(store, last)
    return Base(last, len(chain), chain[-1]["rows_extracted"], log["total_ingested"], log["fraud_amount"], log["validated_amt"]), marks


def run_etl(
    spark: SparkSession, store: TableStore, cfg: RuleConfig = DEFAULT, run_id: int | None = None
) -> EtlResult:
    ensure_utc(spark)
    store.require(*SOURCES)
    run_id = store.claim_run(run_id)
    now, base, marks = {}, None, None
    if store.lists_partitions:
        now = {name: store.partitions(name) for name in SOURCES}  # what this run reads, fixed here
        found = find_base(store, run_id, now) if cfg.etl_incremental else None
        base, marks = found if found else (None, None)
    staging = []

    def staged(df: DataFrame, what: str) -> DataFrame:
        path = store.staging_path(run_id, what)
        staging.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    if base:
        new = {name: _fresh(now[name], marks[name]) for name in SOURCES}
        txns = store.read("all_transactions", found=new["all_transactions"])
        alerts = store.read("flagged_transactions", found=new["flagged_transactions"]).select("txn_ref", F.lit(1).alias("n_alerts"))
        before = store.read("etl_pending", found=[p for p in store.partitions("etl_pending") if p.value == base.run_id])
        alerts = alerts.unionByName(before.select("txn_ref", "n_alerts"))
        # a new key is in no earlier ledger: find_base has seen to that
        flags = key_flags(alerts, store.read("validated_ledger", found=[]))
    else:
        txns = store.read("all_transactions", must_exist=True, found=now.get("all_transactions"))
        alerts = store.read("flagged_transactions", must_exist=True, found=now.get("flagged_transactions"))
        # this run's own ledger partition is not "existing": a rerun rewrites it
        flags = key_flags(alerts, store.read("validated_ledger").where(F.col("run_id") != F.lit(run_id)))
    files = tuple(txns.inputFiles()) + tuple(alerts.inputFiles())
    joined = staged(tagged_transactions(txns, flags), "tagged")
    tagged = joined.where("has_txn")
    orphans = joined.where("not has_txn and n_alerts > 0").select("txn_ref", "n_alerts")
    totals = tagged.agg(
        _total(F.col("amount")).alias("ingested"),
        _total(F.col("amount") * F.col("n_alerts")).alias("fraud"),
        F.count_if(F.col("n_alerts") == 0).alias("clean"),
    ).first()
    ingested, fraud, n_extracted = totals["ingested"], totals["fraud"], int(totals["clean"])
    retracted = None
    if base:
        ingested, fraud, n_extracted = ingested + base.ingested, fraud + base.fraud, n_extracted + base.extracted
        old = [p for p in now["all_transactions"] if p not in new["all_transactions"]]
        if old and not orphans.isEmpty():
            late, retracted = late_flags(store, orphans, old, [p for p in now["flagged_transactions"] if p not in new["flagged_transactions"]])
            late, retracted = staged(late, "late"), staged(retracted, "retracted")
            fraud += late.agg(_total(F.col("amount") * F.col("n_alerts")).alias("f")).first()["f"]
            n_extracted -= retracted.count()
            orphans = orphans.join(late, "txn_ref", "left_anti")

    # the loaded rows carry the float amount, NULL -> 0.0
    clean = tagged.where(F.col("n_alerts") == 0).withColumn("amount", normalize_amount(F.col("amount")))
    if retracted is not None:
        store.write_partition("snapshot_retractions", retracted, run_id)
    snap_path = store.new_snapshot_path(run_id)
    layer = clean.drop("n_alerts", "in_ledger", "has_txn")
    folded = base is not None and base.layers >= cfg.snapshot_layers
    if folded:
        layer = read_snapshot(store, base.run_id).unionByName(layer)
        if retracted is not None:
            layer = layer.join(retracted, "txn_ref", "left_anti")
    layer.select(*SNAPSHOT_COLUMNS).write.partitionBy(*cfg.snapshot_partition_by).parquet(snap_path)
    fresh = clean.where(F.col("in_ledger") == 0).drop("n_alerts", "in_ledger", "has_txn")
    fresh = fresh.withColumn("amount", F.col("amount").cast(AMOUNT_TYPE))
    store.write_partition("validated_ledger", joins.dedupe_by_key(fresh, "txn_ref", order_cols=("proc_ts",)), run_id)

    own = F.col("run_id") == F.lit(run_id)
    ledger = store.read("validated_ledger")
    if base:
        ledger = store.read("validated_ledger", found=[p for p in store.partitions("validated_ledger") if p.value == run_id])
    led = ledger.agg(_total(F.col("amount")).alias("valid"), F.count_if(own).alias("inserted")).first()
    n_inserted, validated = int(led["inserted"]), led["valid"] + (base.validated if base else 0)
    if store.lists_partitions:
        write_marks(store, run_id, now, orphans)
    metrics = spark.createDataFrame(
        [(run_id, n_extracted, n_inserted, n_extracted, base.run_id if base and not folded else None, snap_path)],
        schemas.LOAD_METRICS_SCHEMA,
    )
    store.write_partition("load_metrics", metrics, run_id)

    three_totals = spark.createDataFrame(
        [(ingested, fraud, validated)],
        f"total_ingested {MONEY}, fraud_amount {MONEY}, validated_amt {MONEY}",
    )
    recon = agg.finish_reconcile(three_totals, cfg.reconcile_tolerance).select(
        F.lit(run_id).cast("long").alias("run_id"), F.current_timestamp().alias("run_ts"), "*"
    )
    store.write_partition("reconciliation_log", recon, run_id)  # ends the run
    for path in staging:
        store.delete_path(path)

    snapshot = read_snapshot(store, run_id)
    return EtlResult(
        run_id=run_id,
        snapshot_path=snap_path,
        rows_extracted=n_extracted,
        rows_inserted=n_inserted,
        by_merchant=agg.clean_by(snapshot, "merchant_category"),
        by_country=agg.clean_by(snapshot, "country"),
        summary=agg.clean_summary(snapshot),
        reconciliation=store.read("reconciliation_log").where(F.col("run_id") == run_id),
        base_run=base.run_id if base else None,
        files_read=files,
    )


def late_flags(
    store: TableStore, orphans: DataFrame, old: list[Partition], old_alerts: list[Partition]
) -> tuple[DataFrame, DataFrame]:
    """Old transactions that new alerts flag ``(txn_ref, amount, n_alerts)``, and the keys of those clean until now.

    The few keys are joined to narrow scans of the old partitions (AQE broadcasts them while small).
    """
    hit = store.read("all_transactions", found=old).select("txn_ref", "amount").join(orphans, "txn_ref")
    flagged = store.read("flagged_transactions", found=old_alerts).select("txn_ref")
    return hit, hit.select("txn_ref").join(flagged, "txn_ref", "left_anti")


def write_marks(store: TableStore, run_id: int, now: dict[str, list[Partition]], orphans: DataFrame) -> None:
    """Store what the run read and the alerts that wait for their transaction."""
    rows = [(run_id, name, p.writer, p.value, p.attempt) for name, found in now.items() for p in found]
    store.write_partition("etl_pending", orphans.withColumn("run_id", F.lit(run_id).cast("long")), run_id)
    store.write_partition("etl_marks", store.spark.createDataFrame(rows, schemas.ETL_MARKS_SCHEMA), run_id)


def _layers(store: TableStore, run_id: int) -> list[dict]:
    """The runs whose layers make the snapshot of ``run_id``, the full one first (one row a run)."""
    runs = {r["run_id"]: r.asDict() for r in store.read("load_metrics").where(F.col("run_id") <= run_id).collect()}
    chain = [runs[run_id]]
    while chain[-1]["base_run"] is not None:
        chain.append(runs[chain[-1]["base_run"]])
    return chain[::-1]


def read_snapshot(store: TableStore, run_id: int) -> DataFrame:
    """The clean set of a run: its layers without the rows that were flagged since."""
    chain = _layers(store, run_id)
    schema = StructType([f if f.name != "amount" else StructField("amount", DoubleType()) for f in schemas.TRANSACTIONS_SCHEMA])
    rows = None
    for r in chain:
        layer = store.spark.read.schema(schema).parquet(r["snapshot_path"]).select(*SNAPSHOT_COLUMNS)
        rows = layer if rows is None else rows.unionByName(layer)
    later = {r["run_id"] for r in chain[1:]}
    gone = [p for p in store.partitions("snapshot_retractions") if p.value in later] if later else []
    if gone:
        rows = rows.join(store.read("snapshot_retractions", found=gone).select("txn_ref"), "txn_ref", "left_anti")
    return rows.select(*SNAPSHOT_COLUMNS)


def reconcile(
    spark: SparkSession,
    store: TableStore,
    cfg: RuleConfig = DEFAULT,
    run_id: int = 1,
    distinct_alerts: bool = False,
) -> DataFrame:
    row = agg.reconcile_row(
        store.read("all_transactions"),
        store.read("flagged_transactions"),
        store.read("validated_ledger"),
        cfg.reconcile_tolerance,
        distinct_alerts=distinct_alerts,
    )
    return row.select(
        F.lit(run_id).cast("long").alias("run_id"), F.current_timestamp().alias("run_ts"), "*"
    )


def latest_reconciliation(store: TableStore) -> DataFrame:
    return store.read("reconciliation_log").orderBy(F.desc("run_id")).limit(1)


# -- fixture store ------------------------------------------------------------


def seed_store(
    spark: SparkSession, sf_dir: str, cfg: RuleConfig = DEFAULT, root: str | None = None,
    store: TableStore | None = None,
) -> TableStore:
    """A store holding the transactions and alerts of ``sf_dir``.

    Both tables are written as batch 0 of a writer named after the folder, the
    state the stream sinks leave; loading the folder again replaces it.
    """
    store = store or TableStore(spark, root or scratch_path(spark, "store"))
    writer = "load-" + hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    txns = fixture.transactions(spark, sf_dir)
    txns = joins.dedupe_by_key(txns.drop("event_time").withColumn("proc_ts", F.current_timestamp()), "txn_ref", ("proc_ts",))
    store.write_partition("all_transactions", txns, 0, writer)
    written = store.read_writer("all_transactions", writer).select(*TXN_COLUMNS)
    alerts = rules.all_alerts(
        written.withColumn("event_time", F.try_to_timestamp(F.col("event_ts"))), cfg
    ).withColumn("flag_id", F.concat(F.lit(f"{writer}-0-"), F.monotonically_increasing_id().cast("string")))
    store.write_partition("flagged_transactions", alerts, 0, writer)
    return store


RECON_OUT = [
    "run_id",
    "total_ingested",
    "fraud_amount",
    "validated_amt",
    "expected_valid",
    "difference",
    "status",
]


@register("validated_ledger")
def q_validated_ledger(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    return store.read("validated_ledger").select(*TXN_VALUE_COLUMNS)


@register("volume_validated")
def q_volume_validated(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    return agg.volume(store.read("validated_ledger"))


@register("reconcile")
def q_reconcile(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    res = run_etl(spark, store)
    return res.reconciliation.select(*RECON_OUT)


@register("reconcile_distinct")
def q_reconcile_distinct(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    res = run_etl(spark, store)
    return reconcile(spark, store, run_id=res.run_id, distinct_alerts=True).select(*RECON_OUT)


@register("latest_reconciliation")
def q_latest_reconciliation(spark, sf_dir):
    """ETL run twice; the second run is the latest and inserts nothing."""
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    run_etl(spark, store)
    return latest_reconciliation(store).select(
        "run_id", "total_ingested", "fraud_amount", "validated_amt", "status"
    )


@register("load_metrics")
def q_load_metrics(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    run_etl(spark, store)
    return store.read("load_metrics").select(
        "run_id", "rows_extracted", "rows_inserted", "rows_snapshotted"
    )


_RECON_SQL = """
tot AS (SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS t FROM txn),
fr AS (SELECT CAST(COALESCE(SUM(t.amount), 0) AS DECIMAL(38,2)) AS f
       FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref),
frd AS (SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS f
        FROM txn WHERE txn_ref IN (SELECT txn_ref FROM alerts)),
val AS (SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS v FROM clean)
SELECT CAST(1 AS BIGINT) AS run_id, tot.t AS total_ingested, {fraud}.f AS fraud_amount,
       val.v AS validated_amt,
       CAST(ROUND(tot.t - {fraud}.f, 2) AS DECIMAL(38,2)) AS expected_valid,
       CAST(ROUND(ABS(CAST(ROUND(tot.t - {fraud}.f, 2) AS DECIMAL(38,2)) - val.v), 2)
            AS DECIMAL(38,2)) AS difference,
       CASE WHEN ROUND(ABS(ROUND(tot.t - {fraud}.f, 2) - val.v), 2) < 0.02
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM tot, {fraud}, val
"""

oracle.add(
    "validated_ledger",
    "SELECT txn_ref, account_id, event_ts, merchant_category,"
    " CAST(COALESCE(amount, 0) AS DECIMAL(14,2)) AS amount, country, channel, currency FROM clean",
)
oracle.add(
    "volume_validated",
    "SELECT count(*) AS txn_count, CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS total_amount"
    " FROM clean",
)
oracle.add("reconcile", ", " + _RECON_SQL.format(fraud="fr"))
oracle.add("reconcile_distinct", ", " + _RECON_SQL.format(fraud="frd"))
oracle.add("stream_two_writers_reconcile", ", " + _RECON_SQL.format(fraud="frd"))
oracle.add(
    "latest_reconciliation",
    ", "
    + """tot AS (SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS t FROM txn),
fr AS (SELECT CAST(COALESCE(SUM(t.amount), 0) AS DECIMAL(38,2)) AS f
       FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref),
val AS (SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,2)) AS v FROM clean)
SELECT CAST(2 AS BIGINT) AS run_id, tot.t AS total_ingested, fr.f AS fraud_amount,
       val.v AS validated_amt,
       CASE WHEN ROUND(ABS(ROUND(tot.t - fr.f, 2) - val.v), 2) < 0.02
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM tot, fr, val""",
)
oracle.add(
    "load_metrics",
    """SELECT CAST(1 AS BIGINT) AS run_id, count(*) AS rows_extracted,
              count(*) AS rows_inserted, count(*) AS rows_snapshotted FROM clean
       UNION ALL
       SELECT CAST(2 AS BIGINT), count(*), CAST(0 AS BIGINT), count(*) FROM clean""",
)
