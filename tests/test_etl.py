"""ETL cases: the reference's transform cases, load, reruns, reconciliation."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import aggregates as agg
from cardsentry.operators import joins
from cardsentry.plans.etl import run_etl, seed_store
from cardsentry.sinks.store import TableStore
from cardsentry.session import scratch_path
from helpers import base, txn, txn_frame


def _rows(spark, amounts, categories=None):
    cats = categories or ["ATM Withdrawal"] * len(amounts)
    return txn_frame(
        spark, [txn(f"t{i}", f"a{i}", "2024-01-01T10:00:00", "US", a, merchant=cats[i], channel="ATM")
                for i, a in enumerate(amounts)]
    )


def test_empty_input(spark):
    empty = _rows(spark, [1.0]).limit(0)
    s = agg.clean_summary(empty).first()
    assert s["tx_count"] == 0 and s["total_clean_amount"] == 0.0
    assert agg.clean_by(empty, "merchant_category").count() == 0


def test_correct_total(spark):
    s = agg.clean_summary(_rows(spark, [100.0, 200.0, 300.0])).first()
    assert s["total_clean_amount"] == 600.0 and s["tx_count"] == 3


def test_aggregation_by_merchant(spark):
    df = _rows(spark, [500.0, 300.0, 200.0], ["Online Payment", "ATM Withdrawal", "Online Payment"])
    by_m = {r["merchant_category"]: r["total_amount"] for r in agg.clean_by(df, "merchant_category").collect()}
    assert by_m["Online Payment"] == pytest.approx(700.0)
    assert by_m["ATM Withdrawal"] == pytest.approx(300.0)
    first = agg.clean_by(df, "merchant_category").first()
    assert first["merchant_category"] == "Online Payment"  # largest total first


def test_row_count_matches_input(spark):
    assert agg.clean_summary(_rows(spark, [10.0, 20.0, 30.0, 40.0])).first()["tx_count"] == 4


def test_decimal_input_gives_float_total(spark):
    s = agg.clean_summary(_rows(spark, [123.45])).first()
    assert isinstance(s["total_clean_amount"], float) and s["total_clean_amount"] == 123.45


def test_null_keys_dropped_by_group_but_counted_in_total(spark):
    df = txn_frame(spark, [txn("t1", "a", base(), None, 5.0), txn("t2", "a", base(), "US", 7.0)])
    by_c = agg.clean_by(df, "country").collect()
    assert [(r["country"], r["tx_count"]) for r in by_c] == [("US", 1)]
    assert agg.clean_summary(df).first()["tx_count"] == 2


def test_anti_join_excludes_flagged_and_ignores_null_refs(spark):
    t = txn_frame(spark, [txn("t1", "a", base()), txn("t2", "a", base())])
    alerts = spark.createDataFrame([("t1",), (None,)], "txn_ref string")
    assert [r["txn_ref"] for r in joins.clean_transactions(t, alerts).collect()] == ["t2"]


def test_insert_if_absent_keeps_existing_and_dedupes(spark):
    target = spark.createDataFrame([("k1", "old")], "txn_ref string, v string")
    batch = spark.createDataFrame(
        [("k1", "new"), ("k2", "b"), ("k2", "a"), (None, "x")], "txn_ref string, v string"
    )
    out = sorted(tuple(r) for r in joins.insert_if_absent(batch, target, "txn_ref").collect())
    assert out == [("k2", "a")]  # k1 exists; k2 once, smallest row wins


def test_dedupe_hot_key(spark):
    """A key holding a third of the batch collapses without one-task gathering."""
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(8)
    out = joins.dedupe_by_key(df, "k", order_cols=("v",))
    assert out.count() == 6001
    assert out.where("k = 'hot'").first()["v"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial" in plan.lower() or "Partial" in plan


@pytest.fixture(scope="module")
def etl_store(spark):
    store = seed_store(spark, "/root/testdata/sf0.001")
    first = run_etl(spark, store)
    return store, first


def test_etl_first_run(spark, etl_store):
    store, first = etl_store
    assert first.rows_extracted == 843 and first.rows_inserted == 843
    assert store.read("validated_ledger").count() == 843
    rec = first.reconciliation.first()
    assert rec["status"] == "FAIL"
    assert rec["total_ingested"] == Decimal("2502509.50")
    assert rec["validated_amt"] == Decimal("1496144.50")
    assert first.summary.first()["total_clean_amount"] == 1496144.5
    snap = spark.read.parquet(first.snapshot_path)
    assert snap.count() == 843 and dict(snap.dtypes)["amount"] == "double"


def test_etl_rerun_is_idempotent(spark, etl_store):
    store, first = etl_store
    second = run_etl(spark, store)
    assert second.run_id == first.run_id + 1
    assert second.rows_extracted == 843 and second.rows_inserted == 0
    assert store.read("validated_ledger").count() == 843
    # replaying the same run id rewrites its own partitions only
    again = run_etl(spark, store, run_id=second.run_id)
    assert again.rows_inserted == 0
    assert store.read("validated_ledger").count() == 843
    assert store.read("reconciliation_log").count() == 2


def test_invariant_txns_equal_clean_plus_flagged(spark, etl_store):
    store, _ = etl_store
    t = store.read("all_transactions")
    a = store.read("flagged_transactions")
    n_clean = joins.clean_transactions(t, a).count()
    n_flagged = joins.flagged_transactions(t, a).count()
    assert n_clean + n_flagged == t.count() == 1000
    assert a.select("txn_ref").distinct().count() == 157


def test_reconcile_distinct_passes(spark, etl_store):
    from cardsentry.plans.etl import reconcile

    store, _ = etl_store
    row = reconcile(spark, store, distinct_alerts=True).first()
    assert row["status"] == "PASS" and row["difference"] == Decimal("0.00")


def test_reconcile_tolerance_boundary(spark):
    store = TableStore(spark, scratch_path(spark, "recon-edge"))
    t = txn_frame(spark, [txn("t1", "a", base(), amount=10.00)]).withColumn("proc_ts", F.current_timestamp())
    store.write_partition("all_transactions", t, 0, "w")
    for ledger_amount, status in ((9.99, "PASS"), (9.98, "FAIL")):
        led = txn_frame(spark, [txn("t1", "a", base(), amount=ledger_amount)]).withColumn(
            "proc_ts", F.current_timestamp())
        store.write_partition("validated_ledger", led, 1)
        row = agg.reconcile_row(store.read("all_transactions"), store.read("flagged_transactions"),
                                store.read("validated_ledger")).first()
        assert row["status"] == status, (ledger_amount, row)


def test_fused_totals_equal_table_totals(spark):
    """The ETL's one-pass totals equal an independent read of the tables."""
    store = seed_store(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        res = run_etl(spark, store)
        logged = res.reconciliation.first()
        direct = agg.reconcile_row(
            store.read("all_transactions"),
            store.read("flagged_transactions"),
            store.read("validated_ledger"),
        ).first()
        for col in ("total_ingested", "fraud_amount", "validated_amt", "expected_valid",
                    "difference", "status"):
            assert logged[col] == direct[col], col


def test_rerun_after_crash_between_ledger_and_log(spark):
    """A run that died after writing part of its ledger partition is redone whole."""
    store = seed_store(spark, "/root/testdata/sf0.001")
    clean = joins.clean_transactions(store.read("all_transactions"), store.read("flagged_transactions"))
    partial = clean.orderBy("txn_ref").limit(100)  # what the dead attempt left behind
    store.write_partition("validated_ledger", partial, 1)
    assert store.read("reconciliation_log").count() == 0  # the log never got its row
    res = run_etl(spark, store)
    assert res.run_id == 1 and res.rows_inserted == 843
    assert store.read("validated_ledger").count() == 843
    rec = res.reconciliation.first()
    assert rec["validated_amt"] == Decimal("1496144.50")


def test_snapshot_partitioned_by_country(spark):
    from dataclasses import replace

    from cardsentry.config import DEFAULT
    from cardsentry.session import local_path

    store = seed_store(spark, "/root/testdata/sf0.001")
    res = run_etl(spark, store, replace(DEFAULT, snapshot_partition_by=("country",)))
    parts = sorted(os.listdir(local_path(res.snapshot_path)))
    assert "country=US" in parts and "country=BR" in parts
    snap = spark.read.parquet(res.snapshot_path)
    assert snap.count() == 843 and snap.where("country = 'US'").count() > 0
