"""Compaction of stored batches, lost offsets, late-row accounting, session settings."""

from __future__ import annotations

import json
import os
import random
from argparse import Namespace
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import offsets
from cardsentry.plans import jobs
from cardsentry.plans.etl import run_etl
from cardsentry.session import local_path, scratch_path
from cardsentry.sinks.store import TableStore
from cardsentry.streaming import detector, progress
from helpers import base, plus, txn, wire_docs, wire_frame
from test_store import direct, new_store, put, put_alerts, refs, totals
from test_streaming import Feed


# -- compaction ---------------------------------------------------------------


def folders(store, name):
    return len({os.path.dirname(f) for f in store.read(name).inputFiles()})


def narrow(store, writer, batches, name="flagged_transactions"):
    """Many one-row batches, written without the store's own listing of each."""
    rows = store.spark.createDataFrame([(f"{writer}-{b}", f"t{b}") for b in range(batches)], "flag_id string, txn_ref string")
    rows = rows.selectExpr("*", "'a' AS account_id", "'HIGH_VALUE' AS fraud_type", "current_timestamp() AS detection_ts", "'{}' AS details")
    one = rows.withColumn("batch_id", F.substring_index("flag_id", "-", -1).cast("long"))
    tmp = f"{store.path(name)}/writer={writer}"
    one.repartition(4, "batch_id").withColumn("attempt", F.lit("00000000000000000001-a")).write.partitionBy("batch_id", "attempt").mode("append").parquet(tmp)
    top = local_path(tmp)
    for b in range(batches):
        open(os.path.join(top, f"batch_id={b}", "attempt=00000000000000000001-a", "_SUCCESS"), "w").close()


def test_two_hundred_batches_are_packed(spark):
    store = new_store(spark, "compact")
    narrow(store, "w", 200)
    narrow(store, "x", 3)
    key = ("writer", "batch_id", "flag_id", "txn_ref")
    before = sorted(tuple(r) for r in store.read("flagged_transactions").select(*key).collect())
    reader, listed = store.read("flagged_transactions"), store.partitions("flagged_transactions")
    assert len(before) == 203 and folders(store, "flagged_transactions") == 203
    packed = store.compact("flagged_transactions")
    assert len(packed) == 1  # writer x has too few batches
    assert len(spark.read.parquet(packed[0]).inputFiles()) == 1
    assert folders(store, "flagged_transactions") == 1 + 2 + 3
    assert sorted(tuple(r) for r in store.read("flagged_transactions").select(*key).collect()) == before
    assert reader.count() == 203  # began before: its files are there until the next call
    now = store.partitions("flagged_transactions")
    assert [(p.id, p.attempt) for p in now] == [(p.id, p.attempt) for p in listed]
    assert store.compact("flagged_transactions") == []
    assert not os.path.exists(local_path(listed[0].path))
    assert sorted(tuple(r) for r in store.read("flagged_transactions").select(*key).collect()) == before


def test_compaction_survives_a_crash_and_replays(spark):
    store = new_store(spark, "compact-crash")
    for b in range(8):
        put(store, [txn(f"t{b}", "a", base())], b, alerts=False)
    (folder,) = store.compact("all_transactions", keep_last=2)
    marker = os.path.join(local_path(folder), "_SUCCESS")
    os.remove(marker)  # the job died before it published
    assert refs(store.read("all_transactions")) == [f"t{b}" for b in range(8)] and folders(store, "all_transactions") == 8
    open(marker, "w").close()  # and here after
    assert refs(store.read("all_transactions")) == [f"t{b}" for b in range(8)] and folders(store, "all_transactions") == 3
    put(store, [txn("again", "a", base())], 3, alerts=False)  # a packed batch is written again
    assert refs(store.read("all_transactions")) == sorted([f"t{b}" for b in range(8) if b != 3] + ["again"])
    store.compact("all_transactions", keep_last=0, least=2)
    store.compact("all_transactions", keep_last=0)
    assert refs(store.read("all_transactions")) == sorted([f"t{b}" for b in range(8) if b != 3] + ["again"])
    assert folders(store, "all_transactions") == 1 and len(store.attempts("all_transactions")) == 8


def test_incremental_runs_and_keys_go_on_over_packed_batches(spark):
    store = new_store(spark, "compact-etl")
    for b in range(6):
        put(store, [txn(f"t{b}", "a", base(), amount=1000.0 * b)], b)
    run_etl(spark, store)
    for name in ("all_transactions", "flagged_transactions", "transaction_key_runs"):
        assert store.compact(name, keep_last=1)
    put(store, [txn("new", "a", base(), amount=5.0)], 6)
    put_alerts(store, ["t1"], 7)  # flags a packed row
    second = run_etl(spark, store)
    assert second.base_run == 1 and all("batch_id=6" in f or "batch_id=7" in f or "etl_pending" in f for f in second.files_read)
    assert totals(store, 2) == direct(store) and second.rows_extracted == 6
    put(store, [txn("t2", "late copy", base())], 0, "x", second=99)
    assert store.read("all_transactions").where("txn_ref = 't2'").first()["account_id"] == "a"
    assert store.key_hashes("all_transactions", store.partitions("all_transactions")).count() == 8


def test_only_stream_tables_are_packed(spark):
    with pytest.raises(ValueError):
        new_store(spark, "compact-ledger").compact("validated_ledger")


# -- lost offsets -------------------------------------------------------------


def brute_lost(seen):
    out = []
    for p in sorted({p for p, _ in seen}):
        have = sorted({o for q, o in seen if q == p})
        out += [(p, a + 1, b - 1, b - a - 1) for a, b in zip(have, have[1:], strict=False) if b > a + 1]
    return out


@pytest.mark.parametrize("stretch", [7, 1 << 20])
def test_gaps_equal_brute_force(spark, stretch):
    rng = random.Random(stretch)
    seen = [(0 if rng.random() < 0.6 else rng.randint(1, 3), rng.randint(0, 120)) for _ in range(260)]
    seen += [(9, 5), (8, 2**40), (8, 2**40 + 3)]
    docs = spark.createDataFrame([*seen, (None, 4), (2, None)], "partition int, offset long")
    runs = offsets.islands(docs, stretch=stretch)
    assert runs.agg(F.sum("n_documents")).first()[0] == len(seen)
    assert sorted(tuple(r) for r in offsets.lost_ranges(runs).collect()) == brute_lost(seen)
    halves = [offsets.islands(docs.where(f"offset % 2 = {k}"), stretch=stretch) for k in (0, 1)]
    both = offsets.lost_ranges(halves[0].unionByName(halves[1]).unionByName(halves[0]))  # a batch read twice
    assert sorted(tuple(r) for r in both.collect()) == brute_lost(seen)
    first = spark.createDataFrame([(9, 0)], "partition long, first_offset long")
    assert (9, 0, 4, 5) in {tuple(r) for r in offsets.lost_ranges(runs, first).collect()}


def test_batches_store_their_source_ranges(spark, tmp_path, capsys):
    store = TableStore(spark, str(tmp_path / "store"))
    raw = wire_frame(spark, wire_docs([txn(f"t{k}", "a", base()) for k in range(9)]) + ["bad"])
    number = F.get_json_object(F.col("value").cast("string"), "$.txn_ref")
    at = F.coalesce(F.substring(number, 2, 3).cast("long"), F.lit(20))
    raw = raw.withColumn("offset", at).withColumn("partition", (at % 2).cast("int"))
    sink = detector.transactions_sink(store, lambda: "w")
    for _ in range(2):  # a replay counts once
        sink(detector.transaction_rows(raw.where("offset not in (4, 5)")), 0)
    assert store.read("rejected_events").count() == 1  # lost documents only: rejected ones were read
    jobs.cmd_lost_offsets(spark, Namespace(store=store.root, out=str(tmp_path / "lost")))
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    got = sorted(tuple(r) for r in spark.read.parquet(out["lost"]).collect())
    want = brute_lost([(k % 2, k) for k in (0, 1, 2, 3, 6, 7, 8, 20)])
    assert got == want and out["ranges"] == len(want) and out["documents"] == sum(r[3] for r in want)


# -- late rows ----------------------------------------------------------------


def test_late_rows_are_counted_beside_their_batch(spark, tmp_path):
    feed, b = Feed(str(tmp_path)), base(12)
    feed.push([txn("x1", "X", plus(b, 30), "US")])
    feed.push([txn("x2", "X", plus(b, 31), "US")])
    feed.push([txn("late1", "L", plus(b, 3), "US"), txn("late2", "L", plus(b, 4), "BR")])
    feed.push([txn("x3", "X", plus(b, 60), "US")])
    store = TableStore(spark, scratch_path(spark, "progress"))
    log = progress.ProgressLog(spark, store)
    det = detector.start_detector(detector.json_file_stream(spark, feed.dir), detector.json_file_stream(spark, feed.dir),
                                  store, f"{store.root}/_ckpt", log=log)
    det.await_all()
    batches = [json.loads(p.json) for q in (det.transactions, det.alerts) for p in q.recentProgress]
    for p in batches + batches:  # as the listener gets them; a batch that runs again replaces its counts
        log.record(p)
    rows = store.read("stream_progress").collect()
    whole = [r for r in rows if r["operator"] is None]
    assert sum(r["input_rows"] for r in whole if r["query"] == "transactions") == 2 * 5
    late = progress.late_rows(store).collect()
    # both rows, in the aggregate (each in two windows) and in the join (each once, under its last window)
    dropped = Counter()
    for r in late:
        dropped[r["operator"].split(":")[1]] += r["late_rows"]
    assert set(dropped) == {"stateStoreSave", "symmetricHashJoin"} and dropped["symmetricHashJoin"] == 2
    assert len({r["batch_id"] for r in late}) == 1 and all(r["query"] == "alerts" for r in late)


def test_the_listener_keeps_batches_until_it_knows_the_query(spark):
    store = TableStore(spark, scratch_path(spark, "progress-wait"))
    log = progress.ProgressLog(spark, store)
    log.record({"id": "q1", "batchId": 0, "numInputRows": 3, "stateOperators": []})
    assert store.read("stream_progress").count() == 0
    log.follow(Namespace(id="q1"), "alerts")
    r = store.read("stream_progress").first()
    assert (r["query"], r["input_rows"], r["late_rows"], r["writer"], r["batch_id"]) == ("alerts", 3, 0, "q1", 0)


# -- settings -----------------------------------------------------------------


def test_a_detector_brings_its_state_provider(spark, tmp_path):
    """Also in a session that another program built."""
    key, feed = "spark.sql.streaming.stateStore.providerClass", Feed(str(tmp_path))
    feed.push([txn("t1", "A", base(), "US")])
    store = TableStore(spark, scratch_path(spark, "provider"))
    old, other = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, other)
    try:
        detector.start_detector(detector.json_file_stream(spark, feed.dir), detector.json_file_stream(spark, feed.dir),
                                store, f"{store.root}/_ckpt").await_all()
        assert spark.conf.get(key) == other  # the session's own setting is back
    finally:
        spark.conf.set(key, old)
    for query in ("all_txn", "flagged"):
        with open(local_path(f"{store.root}/_ckpt/{query}/offsets/0")) as f:
            assert "RocksDBStateStoreProvider" in f.read()


def test_session_settings_from_environment_and_flags(monkeypatch):
    for name in jobs.SESSION_ENVIRONMENT:
        monkeypatch.delenv(name, raising=False)
    assert jobs.spark_settings(Namespace()) == {}
    monkeypatch.setenv("SPARK_DRIVER_MEM", "3g")
    monkeypatch.setenv("SPARK_SHUFFLE_PARTS", "12")
    args = Namespace(conf=["spark.sql.shuffle.partitions=40", "spark.speculation=true"])
    assert jobs.spark_settings(args) == {
        "spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "40", "spark.speculation": "true"}
    with pytest.raises(SystemExit):
        jobs.spark_settings(Namespace(conf=["speculation=true"]))
