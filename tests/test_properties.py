"""Property tests: random small inputs against brute-force evaluation."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardsentry.config import DEFAULT
from cardsentry.operators import aggregates as agg
from cardsentry.operators import joins, rules
from helpers import txn, txn_frame
from test_skew import T0, _brute_travel, _spark_travel

row = st.tuples(
    st.sampled_from(["A", "B", "C"]),  # account (few, so groups collide)
    st.integers(min_value=0, max_value=3 * 3600),  # seconds after T0
    st.sampled_from(["US", "UK", "DE", None]),
    st.decimals(min_value=Decimal("0.01"), max_value=Decimal("9999.99"), places=2),
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(data):
    return [
        txn(f"t{i}", acct, T0 + timedelta(seconds=sec), country, float(amount))
        for i, (acct, sec, country, amount) in enumerate(data)
    ]


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_travel_rule_equals_brute_force(spark, data):
    rows = _rows(data)
    df = txn_frame(spark, rows)
    assert _spark_travel(rules.travel_alerts(df)) == _brute_travel(rows)
    assert _spark_travel(rules.travel_alerts(df, DEFAULT.tumbling())) == _brute_travel(
        rows, width=600, slide=600
    )


@SETTINGS
@given(st.lists(row, min_size=0, max_size=40))
def test_clean_plus_flagged_partition_the_table(spark, data):
    rows = _rows(data)
    df = txn_frame(spark, rows)
    alerts = rules.all_alerts(df)
    clean = {r["txn_ref"] for r in joins.clean_transactions(df, alerts).collect()}
    flagged = {r["txn_ref"] for r in joins.flagged_transactions(df, alerts).collect()}
    assert clean | flagged == {r["txn_ref"] for r in rows} and not clean & flagged
    hv = {r["txn_ref"] for r in rows if Decimal(str(r["amount"])) > 5000}
    assert hv <= flagged
    # the merchant x type cube adds up to the alert-weighted volume
    vol = agg.volume_flagged(alerts, df).first()
    by = agg.fraud_by_merchant(alerts, df).collect()
    assert sum(r["fraud_count"] for r in by) == vol["txn_count"] == alerts.count()
    assert sum((r["total_fraud_amount"] for r in by), Decimal(0)) == vol["total_amount"]
    counts = Counter(r["fraud_type"] for r in alerts.collect())
    assert counts["HIGH_VALUE"] == len(hv)
