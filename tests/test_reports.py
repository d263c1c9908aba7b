"""Report sinks and cross-section invariants."""

from __future__ import annotations

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from cardsentry.plans import reports
from cardsentry.plans.etl import run_etl, seed_store
from cardsentry.session import local_path


@pytest.fixture(scope="module")
def store(spark):
    s = seed_store(spark, "/root/testdata/sf0.001")
    run_etl(spark, s)
    return s


def test_merchant_csv(spark, store, tmp_path):
    rep = reports.merchant_report(store.read("flagged_transactions"), store.read("all_transactions"))
    out = str(tmp_path / "csv")
    assert reports.write_merchant_csv(rep, out)
    parts = sorted(glob.glob(os.path.join(local_path(out), "part-*.csv")))
    assert len(parts) == 1
    with open(parts[0]) as fh:
        rows = list(csv.DictReader(fh))
    assert list(rows[0].keys()) == reports.CSV_COLUMNS
    assert sum(int(r["fraud_count"]) for r in rows) == 178
    counts = [int(r["fraud_count"]) for r in rows]
    assert counts == sorted(counts, reverse=True)


def test_merchant_csv_skipped_when_empty(spark, store, tmp_path):
    rep = reports.merchant_report(store.read("flagged_transactions").limit(0), store.read("all_transactions"))
    out = str(tmp_path / "empty")
    assert not reports.write_merchant_csv(rep, out)
    assert not os.path.exists(out)


def test_sections_agree(spark, store):
    from cardsentry.operators import aggregates as agg

    t, a = store.read("all_transactions"), store.read("flagged_transactions")
    flagged = agg.volume_flagged(a, t).first()
    by_m = agg.alerts_by_merchant(a, t).agg(F.sum("alert_count"), F.sum("total_amount")).first()
    by_c = agg.alerts_by_country(a, t).agg(F.sum("alert_count"), F.sum("total_amount")).first()
    by_mt = agg.fraud_by_merchant(a, t).agg(F.sum("fraud_count"), F.sum("total_fraud_amount")).first()
    assert flagged["txn_count"] == by_m[0] == by_c[0] == by_mt[0] == 178
    assert flagged["total_amount"] == by_m[1] == by_c[1] == by_mt[1]


def test_full_report_text(spark, store, tmp_path):
    rep = reports.full_report(spark, store)
    out = str(tmp_path / "report")
    reports.write_report(rep, out)
    text = "".join(
        open(f).read() for f in sorted(glob.glob(os.path.join(local_path(out), "part-*")))
    )
    lines = [r["line"] for r in rep.collect()]
    assert text.splitlines() == lines
    assert lines[1] == "=" * 65 and lines[2].strip() == reports.TITLE
    heads = [i for i, x in enumerate(lines) if x.startswith("  ") and x.strip()[:2] in
             ("1.", "2.", "3.", "4.", "5.", "6.")]
    assert len(heads) == 6 and heads == sorted(heads)
    assert "  Total transactions ingested :    1,000   $  2,502,509.50" in lines
    assert "  HIGH_VALUE                   136 alerts" in lines
    assert "  Status           : FAIL" in lines
    assert lines[-2] == "  END OF REPORT"
    # top accounts: 10 rows, counts non-increasing
    i = lines.index("  " + f"{'Account ID (truncated)':<38} {'Alerts':>6}")
    counts = [int(x.split()[-1]) for x in lines[i + 1 : i + 11]]
    assert len(counts) == 10 and counts == sorted(counts, reverse=True)


def test_report_without_reconciliation(spark):
    s = seed_store(spark, "/root/testdata/sf0.001")
    lines = [r["line"] for r in reports.full_report(spark, s).collect()]
    assert "  No reconciliation runs found." in lines
    assert not any(x.startswith("  Status") for x in lines)
