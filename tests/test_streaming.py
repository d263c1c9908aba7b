"""Structured Streaming: emission under the watermark, late data, restart,
replay and duplicates, with scripted micro-batches (one file each)."""

from __future__ import annotations

import json
import os
import time
from pyspark.sql import functions as F

from cardsentry.config import DEFAULT
from cardsentry.session import scratch_path
from cardsentry.sinks.store import TableStore
from cardsentry.streaming import detector
from helpers import base, plus, txn, wire_docs, wire_frame


class Feed:
    """Input folder of JSON-lines files, one micro-batch per file."""

    def __init__(self, root):
        self.dir = os.path.join(root, "in")
        os.makedirs(self.dir, exist_ok=True)
        self.n = 0

    def push(self, rows):
        path = os.path.join(self.dir, f"{self.n:04d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(wire_docs(rows)) + "\n")
        stamp = time.time() - 1000 + self.n
        os.utime(path, (stamp, stamp))
        self.n += 1


def run(spark, feed, store, ckpt, cfg=DEFAULT):
    det = detector.start_detector(
        detector.json_file_stream(spark, feed.dir),
        detector.json_file_stream(spark, feed.dir),
        store,
        ckpt,
        cfg,
    )
    det.await_all()
    return det


def alerts(store, kind=None):
    df = store.read("flagged_transactions")
    if kind:
        df = df.where(F.col("fraud_type") == kind)
    return sorted((r["txn_ref"], r["fraud_type"]) for r in df.collect())


def setup(spark, scratch, label):
    store = TableStore(spark, scratch_path(spark, label))
    return Feed(scratch), store, f"{store.root}/_ckpt"


def test_append_emits_after_watermark_and_survives_restart(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "emit")
    b = base(12)
    feed.push([txn("a1", "A", plus(b, 1), "US"), txn("a2", "A", plus(b, 2), "UK")])
    run(spark, feed, store, ckpt)
    # watermark 12:00: neither window of account A has closed
    assert alerts(store, "IMPOSSIBLE_TRAVEL") == []
    assert store.read("all_transactions").count() == 2

    # restart on the same checkpoint; a later event moves the watermark to 12:18
    feed.push([txn("b1", "B", plus(b, 20), "US")])
    run(spark, feed, store, ckpt)
    got = alerts(store, "IMPOSSIBLE_TRAVEL")
    assert got == [("a1", "IMPOSSIBLE_TRAVEL")] * 2 + [("a2", "IMPOSSIBLE_TRAVEL")] * 2
    # nothing from the first run was reprocessed
    assert store.read("all_transactions").count() == 3


def test_late_rows_two_batches_after_jump_skip_rule_two(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "late")
    b = base(12)
    feed.push([txn("x1", "X", plus(b, 30), "US")])  # watermark -> 12:28
    feed.push([txn("x2", "X", plus(b, 31), "US")])  # late filter now uses 12:28
    feed.push([txn("late1", "L", plus(b, 3), "US", 9000.0), txn("late2", "L", plus(b, 4), "BR")])
    feed.push([txn("x3", "X", plus(b, 60), "US")])
    run(spark, feed, store, ckpt)
    got = alerts(store)
    assert ("late1", "HIGH_VALUE") in got
    assert not [r for r in got if r[1] == "IMPOSSIBLE_TRAVEL"]
    # late rows are still ingested as transactions
    refs = {r["txn_ref"] for r in store.read("all_transactions").collect()}
    assert {"late1", "late2"} <= refs


def test_late_rows_one_batch_after_jump_are_still_accepted(spark, scratch):
    """Spark filters late rows with the previous batch's watermark."""
    feed, store, ckpt = setup(spark, scratch, "late1")
    b = base(12)
    feed.push([txn("x1", "X", plus(b, 30), "US")])  # watermark -> 12:28
    feed.push([txn("late1", "L", plus(b, 3), "US"), txn("late2", "L", plus(b, 4), "BR")])
    run(spark, feed, store, ckpt)
    got = alerts(store, "IMPOSSIBLE_TRAVEL")
    assert sorted({r[0] for r in got}) == ["late1", "late2"]


def test_duplicates_across_batches_first_write_wins(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "dups")
    b = base(12)
    feed.push([txn("d1", "A", plus(b, 1), "US", 10.0)])
    feed.push([txn("d1", "A", plus(b, 1), "US", 99.0), txn("d1", "A", plus(b, 1), "US", 98.0),
               txn("d2", "A", plus(b, 2), "US")])
    run(spark, feed, store, ckpt)
    rows = {r["txn_ref"]: r["amount"] for r in store.read("all_transactions").collect()}
    assert len(rows) == 2 and float(rows["d1"]) == 10.0


def test_malformed_rows_are_quarantined_not_fatal(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "bad")
    b = base(12)
    feed.push([txn("g1", "A", plus(b, 1), "US", 7000.0)])
    with open(os.path.join(feed.dir, f"{feed.n:04d}.json"), "w") as fh:
        fh.write("{not json\n" + json.dumps(dict(txn("n1", None, plus(b, 2)))) + "\n")
    feed.n += 1
    run(spark, feed, store, ckpt)
    assert alerts(store) == [("g1", "HIGH_VALUE")]
    rej = sorted(r["reason"] for r in store.read("rejected_events").collect())
    assert rej == ["malformed_json", "null_key"]


def test_replayed_batch_is_idempotent(spark):
    store = TableStore(spark, scratch_path(spark, "replay"))
    b = base(12)
    raw = wire_frame(spark, wire_docs([txn("r1", "A", plus(b, 1), "US", 9000.0),
                                       txn("r2", "A", plus(b, 2), "US")]))
    tagged = detector.transaction_rows(raw)
    tx_sink = detector.transactions_sink(store, lambda: "w")
    al_sink = detector.alerts_sink(store, lambda: "w")
    batch_alerts = detector.alert_stream(raw).select("txn_ref", "account_id", "fraud_type",
                                                     "detection_ts", "details")
    for _ in range(2):  # same batch id twice, as after a failure
        tx_sink(tagged, 5)
        al_sink(batch_alerts, 5)
    assert store.read("all_transactions").count() == 2
    assert alerts(store) == [("r1", "HIGH_VALUE")]


def test_stream_equals_batch_on_fixture(spark):
    """Stream over sf0.001 events == batch rules on closed windows."""
    from cardsentry.operators import rules
    from cardsentry.sources import fixture

    qs = detector.q_stream_all_alerts(spark, "/root/testdata/sf0.001")
    batch = rules.all_alerts(fixture.transactions(spark, "/root/testdata/sf0.001"))
    assert qs.count() == 178 == batch.count()
    cols = ["txn_ref", "fraud_type", "details"]
    assert qs.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_bounded_key_check_and_duplicate_alerts(spark, scratch):
    from dataclasses import replace

    feed, store, ckpt = setup(spark, scratch, "wm-dedupe")
    b = base(12)
    cfg = replace(DEFAULT, txn_dedupe="watermark", dedupe_within_watermark=True)
    feed.push([txn("w1", "A", plus(b, 1), "US", 7000.0), txn("w1", "A", plus(b, 1), "US", 7000.0)])
    feed.push([txn("w1", "A", plus(b, 1), "US", 7000.0), txn("w2", "A", plus(b, 30), "US")])
    run(spark, feed, store, ckpt, cfg)
    assert sorted(r["txn_ref"] for r in store.read("all_transactions").collect()) == ["w1", "w2"]
    # one high-value alert although the event was delivered three times
    assert alerts(store, "HIGH_VALUE") == [("w1", "HIGH_VALUE")]


def test_await_any_then_stop(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "any")
    feed.push([txn("q1", "A", plus(base(12), 1), "US", 8000.0)])
    spark.streams.resetTerminated()
    det = detector.start_detector(
        detector.json_file_stream(spark, feed.dir), detector.json_file_stream(spark, feed.dir),
        store, ckpt,
    )
    det.await_any()  # returns once either query has ended
    det.await_all()
    det.stop()
    assert not det.transactions.isActive and not det.alerts.isActive
    assert store.read("all_transactions").count() == 1


def test_default_trigger_keeps_running(spark, scratch):
    feed, store, ckpt = setup(spark, scratch, "continuous")
    feed.push([txn("c1", "A", plus(base(12), 1), "US")])
    det = detector.start_detector(
        detector.json_file_stream(spark, feed.dir), detector.json_file_stream(spark, feed.dir),
        store, ckpt, trigger={},
    )
    try:
        det.transactions.processAllAvailable()
        assert det.transactions.isActive and det.alerts.isActive
        feed.push([txn("c2", "A", plus(base(12), 2), "US")])
        det.transactions.processAllAvailable()
        assert store.read("all_transactions").count() == 2
    finally:
        det.stop()


def test_branches_of_the_rules_share_one_decoded_read(spark, scratch):
    path = os.path.join(scratch, "wire")
    spark.createDataFrame([(d,) for d in wire_docs([txn("s1", "A", plus(base(12), 1), "US", 7000.0)])], "value string").write.text(path)
    raw = spark.read.text(path).select(F.col("value").cast("binary").alias("value"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans find reused exchanges when they run
    try:
        for plan in (detector.alert_stream(raw), detector.travel_stream(raw)):
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert text.count("FileScan text") == 1 and "ReusedExchange" in text
        assert [r["txn_ref"] for r in detector.alert_stream(raw).collect()] == ["s1"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_rows_of_the_state_need_not_be_counted(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    old = spark.conf.get(key, None)
    with detector.state_partitions(spark, count_state=False):
        assert spark.conf.get(key) == "false"
    with detector.state_partitions(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == old
