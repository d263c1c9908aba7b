"""Hot-key fixture: one account holds a third of all rows.

The travel rule is checked against a brute-force Python evaluation, in
batch and through the streaming detector, and the plans are checked for
per-group lists.
"""

from __future__ import annotations

import json
import os
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import joins, rules
from cardsentry.session import scratch_path
from cardsentry.sinks.store import TableStore
from cardsentry.streaming import detector
from helpers import txn, txn_frame, wire_docs

COUNTRIES = ["US", "UK", "DE", "SG"]
T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def _fixture(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        acct = "HOT" if hot else f"acc{rnd.randrange(200)}"
        ts = T0 + timedelta(seconds=rnd.randrange(0, 6 * 3600), microseconds=rnd.randrange(10**6))
        # the hot account mostly stays home, so only some of its windows are guilty
        country = "US" if hot and rnd.random() < 0.97 else rnd.choice(COUNTRIES)
        rows.append(txn(f"t{i}", acct, ts, country, amount=round(rnd.uniform(1, 9000), 2)))
    return rows


def _brute_travel(rows, width=600, slide=300):
    groups = defaultdict(list)
    for r in rows:
        t = datetime.fromisoformat(r["event_ts"]).timestamp()
        first = (t // slide) * slide
        for ws in (first, first - slide):
            if ws <= t < ws + width:
                groups[(ws, r["account_id"])].append(r)
    out = Counter()
    for (ws, acct), rs in groups.items():
        if len({r["country"] for r in rs if r["country"]}) > 1:
            for r in rs:
                out[(r["txn_ref"], int(ws))] += 1
    return out


def _spark_travel(df):
    return Counter(
        (r["txn_ref"], int(r["ws"]))
        for r in df.select(
            "txn_ref",
            F.get_json_object("details", "$.window.start").alias("s"),
        )
        .select("txn_ref", F.unix_timestamp(F.to_timestamp("s")).alias("ws"))
        .collect()
    )


@pytest.fixture(scope="module")
def skewed():
    return _fixture()


def test_batch_travel_matches_brute_force(spark, skewed):
    expected = _brute_travel(skewed)
    hot_alerts = sum(v for (ref, _), v in expected.items() if int(ref[1:]) % 3 == 0)
    assert hot_alerts > 0 and len(expected) > 0
    got = _spark_travel(rules.travel_alerts(txn_frame(spark, skewed)))
    assert got == expected


def test_no_group_lists_in_plans(spark, skewed):
    df = txn_frame(spark, skewed)
    plan = rules.all_alerts(df)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    assert "partial_collect_set" in plan  # bounded by the country domain


def test_stream_travel_matches_brute_force(spark, skewed, tmp_path):
    expected = _brute_travel(skewed)
    # one extra late event closes every window of the fixture
    closer = txn("closer", "nobody", T0 + timedelta(hours=7), "US")
    feed = tmp_path / "in"
    os.makedirs(feed)
    half = len(skewed) // 2
    for i, part in enumerate((skewed[:half], skewed[half:], [closer])):
        (feed / f"{i:03d}.json").write_text("\n".join(wire_docs(part)) + "\n")
        os.utime(feed / f"{i:03d}.json", (1000 + i, 1000 + i))
    store = TableStore(spark, scratch_path(spark, "skew-stream"))
    det = detector.start_detector(
        detector.json_file_stream(spark, str(feed), max_files=3),
        detector.json_file_stream(spark, str(feed), max_files=3),
        store,
        f"{store.root}/_ckpt",
    )
    det.await_all()
    travel = store.read("flagged_transactions").where("fraud_type = 'IMPOSSIBLE_TRAVEL'")
    assert _spark_travel(travel) == expected


def test_weighted_join_collapses_hot_transaction(spark):
    """A transaction alerted 3000 times joins as one weighted row."""
    alerts = spark.createDataFrame([("hot", "IMPOSSIBLE_TRAVEL")] * 3000 + [("t2", "HIGH_VALUE")],
                                   "txn_ref string, fraud_type string")
    t = txn_frame(spark, [txn("hot", "A", T0, amount=1.5), txn("t2", "B", T0, amount=2.0)])
    w = joins.weighted_alert_transactions(alerts, t)
    rows = sorted((r["txn_ref"], r["n"]) for r in w.collect())
    assert rows == [("hot", 3000), ("t2", 1)]
