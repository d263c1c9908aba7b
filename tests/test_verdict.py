"""Stored rows survive other writers; rules see what the table rejects; one parse; split hot keys."""

from __future__ import annotations

import json
from argparse import Namespace
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cardsentry.config import DEFAULT
from cardsentry.functions.codec import decode_events
from cardsentry.operators import quality, rules
from cardsentry.plans import jobs
from cardsentry.plans.etl import run_etl, seed_store
from cardsentry.session import scratch_path
from cardsentry.sinks.store import MissingTableError, TableStore
from cardsentry.sources import fixture
from cardsentry.sources.kafka import kafka_reader_options, start_now
from cardsentry.streaming import detector
from helpers import base, plus, txn, txn_frame, wire_docs, wire_frame

SF = "/root/testdata/sf0.001"


def detect(spark, folder, store, checkpoint):
    detector.start_detector(
        detector.json_file_stream(spark, folder), detector.json_file_stream(spark, folder), store, checkpoint
    ).await_all()


def test_a_load_and_two_checkpoints_keep_each_others_rows(spark, tmp_path):
    store = seed_store(spark, SF, root=scratch_path(spark, "writers"))
    feed = tmp_path / "in"
    feed.mkdir()
    (feed / "0.json").write_text("\n".join(wire_docs([txn("n1", "A", base(), amount=9000.0)])) + "\n")
    for k in (1, 2):  # a new checkpoint starts at batch 0 again
        detect(spark, str(feed), store, f"{store.root}/_ckpt{k}")
    assert store.read("all_transactions").count() == 1000 + 1  # both stored the key, it is read once
    assert store.read("flagged_transactions").count() == 178 + 2
    assert store.read("flagged_transactions").select("flag_id").distinct().count() == 178 + 2
    detect(spark, str(feed), store, f"{store.root}/_ckpt2")  # nothing new
    seed_store(spark, SF, root=store.root)  # the same load again replaces itself
    assert store.read("all_transactions").count() == 1000 + 1


def test_the_transactions_query_keeps_every_rejected_document(spark, tmp_path):
    store = TableStore(spark, scratch_path(spark, "one-scan"))
    feed = tmp_path / "in"
    feed.mkdir()
    rows = wire_docs([txn(f"t{k % 900}", "A", base()) for k in range(1000)] + [txn("bad", None, base())])
    (feed / "0.json").write_text("\n".join(rows + ["not json"] * 5) + "\n")
    det = detector.start_detector(
        detector.json_file_stream(spark, str(feed)), detector.json_file_stream(spark, str(feed)), store, f"{store.root}/_ckpt"
    )
    det.await_all()
    # one scan for the documents, one for the keys
    assert sum(p["numInputRows"] for p in det.transactions.recentProgress) == 2 * 1006
    assert store.read("all_transactions").count() == 900
    assert sorted(r["reason"] for r in store.read("rejected_events").collect()) == ["malformed_json"] * 5 + ["null_key"]


def test_rule_one_sees_the_raw_amount_of_rejected_rows(spark):
    docs = wire_docs([
        txn("overflow", "a", base(), amount=1e13), txn("no-time", "a", None, amount=6000.0),
        txn(None, "a", base(), amount=6000.0), txn("sub-cent", "a", base(), amount=5000.004),
        txn("typed", "a", base(), amount=6000.0), txn("equal", "a", base(), amount=5000.0)])
    docs[4] = docs[4].replace('"flagged": false', '"flagged": "yes"')
    docs.append(docs[0].replace("10000000000000.0", "NaN").replace("overflow", "nan"))
    raw = wire_frame(spark, docs)
    got = sorted(str(r["txn_ref"]) for r in detector.alert_stream(raw).collect())
    assert got == ["None", "no-time", "overflow", "sub-cent", "typed"]
    valid, rejected = quality.split_valid(decode_events(raw))
    assert sorted(r["txn_ref"] for r in valid.collect()) == ["equal", "sub-cent", "typed"]
    assert sorted(r["reason"] for r in rejected.collect()) == ["amount_overflow", "bad_amount", "null_key", "null_key"]


def test_each_document_is_parsed_once(spark):
    decoded = decode_events(fixture.wire_events(spark, SF))
    for df in (*quality.split_valid(decoded), rules.high_value_alerts(decoded)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1, plan


def test_hot_account_is_split_in_the_batch_join(spark):
    rows = [txn(f"h{k}", "hot", plus(base(), k % 4), "US" if k % 2 else "DE") for k in range(4000)]
    rows += [txn(f"o{k}", f"acc{k}", plus(base(), 1), "US") for k in range(50)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rules.travel_alerts(txn_frame(spark, rows), replace(DEFAULT, travel_salt_buckets=8))
        assert out.count() == 2 * 4000
        assert "pmod" in out._jdf.queryExecution().optimizedPlan().toString()
        salted = rules.windowed_rows(txn_frame(spark, rows)).withColumn("s", F.pmod(F.xxhash64("txn_ref"), F.lit(8)))
        largest = salted.groupBy("window", "account_id", "s").count().agg(F.max("count")).first()[0]
        assert largest < 4000 / 8 * 1.5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_snapshot_of_a_rerun_drops_vanished_partitions(spark):
    store = TableStore(spark, scratch_path(spark, "shrink"))
    cfg = replace(DEFAULT, snapshot_partition_by=("country",))

    def write(rows):
        t = txn_frame(spark, rows).withColumn("proc_ts", F.current_timestamp())
        store.write_partition("all_transactions", t, 0, "w")
        store.write_partition("flagged_transactions", rules.all_alerts(t).withColumn("flag_id", F.lit("x")), 0, "w")

    write([txn("t1", "a", base(), "US"), txn("t2", "b", base(), "DE")])
    assert run_etl(spark, store, cfg, run_id=1).rows_extracted == 2
    write([txn("t1", "a", base(), "US")])
    res = run_etl(spark, store, cfg, run_id=1)
    assert res.rows_extracted == 1
    assert [r["txn_ref"] for r in spark.read.parquet(res.snapshot_path).collect()] == ["t1"]


def test_a_wrong_store_is_an_error(spark, tmp_path):
    wrong = str(tmp_path / "nothing-here")
    with pytest.raises(MissingTableError):
        run_etl(spark, TableStore(spark, wrong))
    for job in (jobs.cmd_merchant_report, jobs.cmd_full_report):
        with pytest.raises(MissingTableError):
            job(spark, Namespace(store=wrong, out=str(tmp_path / "out")))
    with pytest.raises(SystemExit):
        jobs.main(["etl"])  # --store is required


def test_both_kafka_queries_start_at_one_moment():
    cfg = start_now(DEFAULT)
    first, second = kafka_reader_options(cfg), kafka_reader_options(start_now(cfg))
    assert first == second
    assert first["startingTimestamp"] == str(cfg.start_timestamp_ms)
    assert first["startingOffsetsByTimestampStrategy"] == "latest"
    pinned = replace(DEFAULT, starting_offsets="earliest")
    assert start_now(pinned) is pinned and "startingTimestamp" not in kafka_reader_options(pinned)


def test_every_setting_from_flags_and_environment(monkeypatch):
    monkeypatch.setenv("CARDSENTRY_TRAVEL_SLIDE", "null")
    monkeypatch.setenv("CARDSENTRY_TOP_ACCOUNTS", "3")
    args = Namespace(set=["high_value_threshold=10.5", 'snapshot_partition_by=["country"]', "top_accounts=4",
                          'extra_kafka_options={"kafka.security.protocol": "SSL"}', "watermark_delay=5 minutes"])
    cfg = jobs.config_from(args)
    assert cfg.travel_slide is None and cfg.top_accounts == 4 and cfg.high_value_threshold == 10.5
    assert cfg.snapshot_partition_by == ("country",) and cfg.watermark_delay == "5 minutes"
    assert kafka_reader_options(cfg)["kafka.security.protocol"] == "SSL"
    with pytest.raises(SystemExit):
        jobs.config_from(Namespace(set=["no_such_field=1"]))


def test_etl_job_reports_its_summaries(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    jobs.cmd_load_events(spark, Namespace(store=root, events_dir=SF))
    jobs.cmd_etl(spark, Namespace(store=root))
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {"expected_valid", "difference", "summaries"} <= set(out)
    assert spark.read.parquet(f"{out['summaries']}/by_country").agg(F.sum("tx_count")).first()[0] == 843


def test_label_mix_counts_every_class(spark):
    from cardsentry.plans.catalog import registry

    row = registry()["label_mix"](spark, SF).first()
    assert row["normal"] > 0 and row["high_value"] > 0 and row["impossible_travel"] > 0
