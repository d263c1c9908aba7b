"""Published attempts, keys across writers, concurrent and incremental ETL runs."""

from __future__ import annotations

import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cardsentry.config import DEFAULT
from cardsentry.operators import aggregates as agg
from cardsentry.operators import joins, rules
from cardsentry.plans.etl import extract_clean, read_snapshot, run_etl, seed_store
from cardsentry.schemas import TXN_COLUMNS
from cardsentry.session import local_path, scratch_path
from cardsentry.sinks import store as store_module
from cardsentry.sinks.store import TableStore
from cardsentry.streaming import detector
from helpers import base, txn, txn_frame, wire_docs, wire_frame

SF = "/root/testdata/sf0.001"


def new_store(spark, label):
    return TableStore(spark, scratch_path(spark, label))


def timed(spark, rows, second=0):
    """Transactions that were processed at a given second."""
    return txn_frame(spark, rows).withColumn("proc_ts", F.timestamp_seconds(F.lit(1_700_000_000 + second)))


def put(store, rows, batch, writer="w", second=0, alerts=True):
    t = timed(store.spark, rows, second)
    store.write_partition("all_transactions", t, batch, writer)
    if alerts:
        put_alerts(store, [r["txn_ref"] for r in rows if r["amount"] and r["amount"] > 5000], batch, writer)


def put_alerts(store, refs, batch, writer="w"):
    out = store.spark.createDataFrame([(f"{writer}-{batch}-{k}", r) for k, r in enumerate(refs)], "flag_id string, txn_ref string")
    out = out.selectExpr("*", "'a' AS account_id", "'HIGH_VALUE' AS fraud_type", "current_timestamp() AS detection_ts", "'{}' AS details")
    store.write_partition("flagged_transactions", out, batch, writer)


def refs(df):
    return sorted(r["txn_ref"] for r in df.select("txn_ref").collect())


# -- attempts -----------------------------------------------------------------


def test_a_reader_sees_old_or_new_rows_of_a_replay(spark):
    store = new_store(spark, "attempts")
    put(store, [txn("old1", "a", base()), txn("old2", "a", base())], 0)
    before = store.read("all_transactions")
    put(store, [txn("new", "a", base())], 0)
    assert refs(before) == ["old1", "old2"]  # began before the replay
    assert refs(store.read("all_transactions")) == ["new"]


def test_an_unpublished_attempt_is_never_read(spark):
    store = new_store(spark, "lost")
    put(store, [txn("kept", "a", base())], 0)
    folder = store.write_partition("all_transactions", timed(spark, [txn("lost", "a", base())]), 0, "w")
    os.remove(os.path.join(local_path(folder), "_SUCCESS"))  # a job that died before its commit
    assert refs(store.read("all_transactions")) == ["kept"]
    put(store, [txn("again", "a", base())], 0)
    assert refs(store.read("all_transactions")) == ["again"]


def test_superseded_attempts_are_dropped_but_the_last(spark):
    store = new_store(spark, "superseded")
    for k in range(5):
        put(store, [txn(f"t{k}", "a", base())], 0, alerts=False)
    found = store.attempts("all_transactions")
    assert len(found) == 2 and refs(store.read("all_transactions")) == ["t4"]


# -- one row a key ------------------------------------------------------------


def test_the_earliest_row_of_a_key_wins_across_writers(spark):
    store = new_store(spark, "keys")
    put(store, [txn("k1", "late", base()), txn("only-w", "a", base())], 0, "w", second=50)
    put(store, [txn("k1", "early", base()), txn("only-x", "a", base())], 0, "x", second=10)
    put(store, [txn("k1", "latest", base()), txn("only-y", "a", base())], 7, "y", second=90)
    rows = {r["txn_ref"]: r for r in store.read("all_transactions").collect()}
    assert sorted(rows) == ["k1", "only-w", "only-x", "only-y"]
    assert rows["k1"]["account_id"] == "early" and rows["k1"]["writer"] == "x"
    repeated = store.repeated_hashes("all_transactions", store.partitions("all_transactions"))
    assert repeated.count() == 1  # found from the key runs: no other row meets by key


def test_key_runs_cover_and_follow_the_rows(spark):
    store = new_store(spark, "runs")
    put(store, [txn(f"a{k}", "a", base()) for k in range(30)], 0, "w")
    put(store, [txn(f"a{k}", "a", base()) for k in range(20, 50)], 0, "x")
    found = store.partitions("all_transactions")
    hashes = store.key_hashes("all_transactions", found)
    assert all("transaction_key_runs" in f for f in hashes.inputFiles()) and hashes.count() == 60
    # a replay whose key run is not there yet: its keys are read from the rows
    fresh = store._write("all_transactions", timed(spark, [txn("b0", "a", base()), txn("a1", "a", base())]), 0, "x")
    found = store.partitions("all_transactions")
    hashes = store.key_hashes("all_transactions", found)
    assert hashes.count() == 32 and any(fresh.split("/")[-1] in f for f in hashes.inputFiles())
    assert store.read("all_transactions").count() == 31


def test_one_writer_needs_no_key_check(spark):
    store = new_store(spark, "single")
    put(store, [txn("t1", "a", base())], 0)
    put(store, [txn("t2", "a", base())], 1)
    plan = store.read("all_transactions")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_random_writers_equal_insert_if_absent(spark):
    rng = random.Random(3)
    store, want = new_store(spark, "random"), {}
    for second, (writer, batch) in enumerate([("w", 0), ("x", 0), ("w", 1), ("y", 0), ("x", 1)]):
        keys = [f"k{k}" for k in rng.sample(range(60), 25) if writer not in {v[0] for v in want.get(f"k{k}", [])}]
        for k in keys:
            want.setdefault(k, []).append((writer, second))
        put(store, [txn(k, f"{writer}{batch}", base()) for k in keys], batch, writer, second, alerts=False)
    got = {r["txn_ref"]: r["writer"] for r in store.read("all_transactions").collect()}
    assert got == {k: v[0][0] for k, v in want.items()}


def test_a_reread_topic_does_not_double_the_volume(spark):
    store = seed_store(spark, SF, root=scratch_path(spark, "reread"))
    raw = detector.events_file_stream(spark, SF)
    detector.start_transactions(raw, store, f"{store.root}/_ckpt").awaitTermination()
    rows = store.read("all_transactions")
    assert rows.count() == 1000 and float(rows.agg(F.sum("amount")).first()[0]) == 2502509.50


# -- the transactions query ---------------------------------------------------


def test_rejected_documents_are_all_kept_and_replays_replace_them(spark):
    store = new_store(spark, "rejects")
    docs = ["not json", "not json", "{}"] + wire_docs([txn(None, "a", base()), txn("ok", "a", base())])
    raw = wire_frame(spark, docs).unionByName(spark.createDataFrame([(None,), (None,)], "value binary"))
    sink = detector.transactions_sink(store, lambda: "w")
    for _ in range(2):
        sink(detector.transaction_rows(raw), 3)
    rows = store.read("rejected_events").collect()
    assert len(rows) == 6 and refs(store.read("all_transactions")) == ["ok"]
    assert sum(r["raw"] is None for r in rows) == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_winner_of_a_repeated_key_does_not_depend_on_the_order(spark, seed):
    store = new_store(spark, "winner")
    docs = wire_docs([txn(f"k{k % 5}", f"acc{k}", base(), amount=float(k)) for k in range(60)])
    random.Random(seed).shuffle(docs)
    raw = wire_frame(spark, docs).repartition(seed * 2)
    detector.transactions_sink(store, lambda: "w")(detector.transaction_rows(raw), 0)
    got = {r["txn_ref"]: r["account_id"] for r in store.read("all_transactions").collect()}
    assert got == {f"k{k}": min(f"acc{i}" for i in range(k, 60, 5)) for k in range(5)}


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """A third of a batch repeats one key: each task sends one row of it."""
    docs = wire_docs([txn("hot" if k % 3 == 0 else f"k{k}", "a", base(), amount=float(k)) for k in range(3000)])
    rows = detector.transaction_rows(wire_frame(spark, docs).repartition(6))
    valid = rows.where("reject_reason is null and not _new_key").select(*TXN_COLUMNS)
    for df in (rows.where("_new_key"), joins.dedupe_by_key(valid, "txn_ref", ("proc_ts",))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_min" in plan
    assert rows.where("_new_key and txn_ref = 'hot'").count() == 1


# -- runs ---------------------------------------------------------------------


def totals(store, run_id):
    r = store.read("reconciliation_log").where(F.col("run_id") == run_id).first()
    return r["total_ingested"], r["fraud_amount"], r["validated_amt"], r["status"]


def direct(store):
    r = agg.reconcile_row(store.read("all_transactions"), store.read("flagged_transactions"), store.read("validated_ledger")).first()
    return r["total_ingested"], r["fraud_amount"], r["validated_amt"], r["status"]


def test_runs_claim_different_ids(spark):
    store = new_store(spark, "claims")
    assert [store.claim_run() for _ in range(3)] == [1, 2, 3]
    assert store.overlapping_runs() == [2, 3]
    assert store_module.create_exclusively(spark, f"{store.root}/_runs/3") is False


def test_two_runs_at_a_time(spark, monkeypatch):
    """The second run begins and ends while the first one is about to write its ledger."""
    store = new_store(spark, "concurrent")
    put(store, [txn(f"t{k}", "a", base(), amount=100.0 + k) for k in range(10)] + [txn("big", "a", base(), amount=9000.0)], 0)
    real, seen = store.new_snapshot_path, []

    def meanwhile(run_id):
        if not seen:
            seen.append(run_id)
            seen.append(run_etl(spark, store).run_id)
        return real(run_id)

    monkeypatch.setattr(store, "new_snapshot_path", meanwhile)
    first = run_etl(spark, store)
    assert seen == [first.run_id, first.run_id + 1]
    assert store.read_partitions("validated_ledger", store.partitions("validated_ledger")).count() == 20
    ledger = store.read("validated_ledger")
    assert ledger.count() == 10 and refs(ledger) == sorted(f"t{k}" for k in range(10))
    assert totals(store, 1) == totals(store, 2) == direct(store)
    monkeypatch.undo()
    put(store, [txn("t99", "a", base(), amount=1.0)], 1)
    third = run_etl(spark, store)
    assert third.rows_inserted == 1 and totals(store, third.run_id) == direct(store)


def test_the_second_run_reads_only_new_partitions(spark):
    store = new_store(spark, "incremental")
    put(store, [txn(f"t{k}", "a", base(), amount=1000.0 * k) for k in range(10)], 0)
    first = run_etl(spark, store)
    assert first.base_run is None and first.rows_extracted == 6
    put(store, [txn(f"u{k}", "a", base(), amount=1000.0 * k) for k in range(8)], 1)
    second = run_etl(spark, store)
    assert second.base_run == first.run_id and second.files_read
    assert all("batch_id=1" in f or "etl_pending" in f for f in second.files_read)
    assert second.rows_extracted == 12 and second.rows_inserted == 6
    assert totals(store, 2) == direct(store)
    assert refs(read_snapshot(store, 2)) == refs(extract_clean(store))
    assert second.summary.first()["tx_count"] == 12
    third = run_etl(spark, store)  # nothing new
    assert (third.rows_extracted, third.rows_inserted, third.base_run) == (12, 0, 2)
    assert totals(store, 3) == direct(store)


def test_incremental_runs_equal_full_runs(spark):
    """Late flags, alerts before their transaction, several alerts a row, a new writer, a replay."""
    full, step = new_store(spark, "full-runs"), new_store(spark, "step-runs")
    rows = lambda tag, n: [txn(f"{tag}{k}", "a", base(), amount=700.0 * k, country="US" if k % 2 else "DE") for k in range(n)]

    def both(act):
        for s in (full, step):
            act(s)

    acts = [
        lambda s: put(s, rows("a", 12), 0),
        lambda s: (put(s, rows("b", 9), 1, alerts=False), put_alerts(s, ["a1", "a1", "b2", "c3", "nowhere"], 1)),  # a1 late, c3 early
        lambda s: (put(s, rows("c", 5), 2, alerts=False), put_alerts(s, ["a9", "a1", "c4"], 2)),  # a9 and a1 were flagged before
        lambda s: put(s, [], 3),
        lambda s: put(s, rows("x", 4), 0, "other-writer"),  # new keys of a second writer
        lambda s: put(s, rows("a", 3) + rows("y", 4), 1, "other-writer", second=99),  # keys that the first one has
        lambda s: put(s, rows("b", 10), 1),  # a replay replaces a partition that was read
        lambda s: put(s, rows("z", 3), 4),
    ]
    bases = []
    for run, act in enumerate(acts, 1):
        both(act)
        a = run_etl(spark, full, replace(DEFAULT, etl_incremental=False))
        b = run_etl(spark, step, replace(DEFAULT, snapshot_layers=3))
        bases.append(b.base_run)
        assert a.run_id == b.run_id == run and a.base_run is None
        assert (a.rows_extracted, a.rows_inserted) == (b.rows_extracted, b.rows_inserted), run
        assert totals(full, run) == totals(step, run) == direct(step), run
        assert refs(read_snapshot(step, run)) == refs(spark.read.parquet(a.snapshot_path)), run
        for name in ("by_merchant", "by_country", "summary"):
            assert sorted(map(tuple, getattr(a, name).collect()), key=str) == sorted(map(tuple, getattr(b, name).collect()), key=str)
    assert bases == [None, 1, 2, 3, 4, None, None, 7]
    assert refs(full.read("validated_ledger")) == refs(step.read("validated_ledger"))


def test_a_rerun_of_the_last_run_stays_incremental(spark):
    store = new_store(spark, "rerun-inc")
    put(store, [txn("a", "x", base(), amount=1.0)], 0)
    run_etl(spark, store)
    put(store, [txn("b", "x", base(), amount=2.0)], 1)
    want = run_etl(spark, store)
    again = run_etl(spark, store, run_id=2)
    assert again.base_run == want.base_run == 1 and again.rows_inserted == 1
    assert store.read("reconciliation_log").count() == 2 and totals(store, 2) == direct(store)
    assert run_etl(spark, store, run_id=1).base_run is None  # not the last: a full run
    assert totals(store, 1)[0] == direct(store)[0]


def test_staging_is_left_empty(spark):
    store = new_store(spark, "staging")
    put(store, [txn("a", "x", base())], 0)
    run_etl(spark, store)
    left = [f for _, _, files in os.walk(local_path(store.path("_staging"))) for f in files if f.startswith("part-")]
    assert left == []


def test_a_seeded_store_alerts_on_its_own_rows(spark):
    store = seed_store(spark, SF)
    t = store.read("all_transactions").withColumn("event_time", F.try_to_timestamp("event_ts"))
    assert rules.all_alerts(t).count() == store.read("flagged_transactions").count() == 178
