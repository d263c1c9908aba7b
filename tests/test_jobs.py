"""Job entry points, called in-process with the test session."""

from __future__ import annotations

import glob
import json
import os
from argparse import Namespace

from cardsentry.plans import jobs
from cardsentry.session import local_path
from helpers import base, plus, txn, wire_docs


def test_load_etl_reports(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    jobs.cmd_load_events(spark, Namespace(store=root, events_dir="/root/testdata/sf0.001"))
    jobs.cmd_etl(spark, Namespace(store=root))
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows_inserted"] == 843 and out["status"] == "FAIL"
    jobs.cmd_merchant_report(spark, Namespace(store=root, out=str(tmp_path / "csv")))
    jobs.cmd_full_report(spark, Namespace(store=root, out=str(tmp_path / "rep")))
    text = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / "rep" / "part-*"))))
    assert "Flagged as fraud            :      178   $  1,090,382.00" in text
    assert glob.glob(str(tmp_path / "csv" / "part-*.csv"))
    # default output: a UTC-stamped folder under the store
    jobs.cmd_full_report(spark, Namespace(store=root, out=None))
    stamped = glob.glob(os.path.join(root, "deliverables", "full_report_*"))
    assert len(stamped) == 1 and len(os.path.basename(stamped[0])) == len("full_report_20240101_000000")


def test_detector_on_json_files(spark, tmp_path):
    feed = tmp_path / "in"
    os.makedirs(feed)
    b = base(9)
    (feed / "0.json").write_text("\n".join(wire_docs([
        txn("j1", "A", plus(b, 1), "US", 6000.0), txn("j2", "A", plus(b, 2), "DE"),
        txn("j3", "B", plus(b, 40), "US")])) + "\n")
    root = str(tmp_path / "store")
    jobs.cmd_detector(spark, Namespace(store=root, json_dir=str(feed), bootstrap="x:1", topic="t",
                                       starting_offsets="latest", trigger="availableNow"))
    from cardsentry.sinks.store import TableStore

    store = TableStore(spark, root)
    kinds = sorted((r["txn_ref"], r["fraud_type"]) for r in store.read("flagged_transactions").collect())
    assert kinds == [("j1", "HIGH_VALUE")] + [("j1", "IMPOSSIBLE_TRAVEL")] * 2 + [("j2", "IMPOSSIBLE_TRAVEL")] * 2
    assert store.read("all_transactions").count() == 3
    assert os.path.isdir(local_path(f"{root}/_checkpoints/detector/all_txn"))
