"""FIXTURES.md section 3 values at sf0.001, through the registered queries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q(spark):
    qs = entry.queries()
    return lambda name: qs[name](spark, SF)


def test_published_counts(q):
    vol = q("volume_ingested").first()
    assert vol["txn_count"] == 1000 and vol["total_amount"] == 2502509.50
    assert q("high_value").count() == 136
    assert q("travel_windows").count() == 21
    travel = q("travel_alerts")
    assert travel.count() == 42 and travel.select("txn_ref").distinct().count() == 28
    tumbling = q("travel_windows_tumbling")
    assert tumbling.count() == 11 and tumbling.agg(F.sum("txn_count")).first()[0] == 22
    alerts = q("all_alerts")
    assert alerts.count() == 178 and alerts.select("txn_ref").distinct().count() == 157
    assert q("volume_flagged").first()["total_amount"] == 1090382.00
    clean = q("clean_summary").first()
    assert clean["tx_count"] == 843 and clean["total_clean_amount"] == 1496144.50
    assert q("scan_transactions").where("amount = 5000").count() == 0


def test_published_reconciliation(q):
    assert q("reconcile").first()["status"] == "FAIL"
    assert q("reconcile_distinct").first()["status"] == "PASS"
