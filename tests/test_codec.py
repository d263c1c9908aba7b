"""Wire decode/encode, quarantine reasons, money coercion."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import functions as F

from cardsentry.functions.codec import decode_events, encode_events
from cardsentry.functions.money import normalize_amount, round_cents, to_amount
from cardsentry.operators import quality
from helpers import base, txn, wire_docs, wire_frame


def test_json_round_trip_preserves_fields(spark):
    rows = [txn("t1", "acct-002", base(), "UK", 99.99, merchant="Online Payment", channel="Online")]
    enc = encode_events(spark.createDataFrame(rows).withColumn("amount", F.col("amount").cast("double")))
    doc = json.loads(enc.first()["value"].decode("utf-8"))
    assert doc["account_id"] == "acct-002" and doc["amount"] == 99.99
    assert doc["flagged"] is False and doc["flag_reason"] is None and "flag_reason" in doc
    dec = decode_events(enc).first()
    assert dec["account_id"] == "acct-002" and dec["amount"] == 99.99 and dec["country"] == "UK"


def test_unknown_fields_ignored(spark):
    d = dict(txn("t1", "a1", base()), extra_field="x")
    row = decode_events(wire_frame(spark, wire_docs([d]))).first()
    assert row["txn_ref"] == "t1" and row["_corrupt_record"] is None


def test_cents_rounding(spark):
    df = spark.createDataFrame([(123.456789,), (2.675,), (327.49999999999994,)], "x double")
    got = [r[0] for r in df.select(round_cents(F.col("x"))).collect()]
    assert got == [Decimal("123.46"), Decimal("2.68"), Decimal("327.50")]


def test_normalize_amount_null_and_zero(spark):
    df = spark.createDataFrame([(Decimal("123.45"),), (None,), (Decimal("0"),)], "a decimal(14,2)")
    got = [r[0] for r in df.select(normalize_amount(F.col("a"))).collect()]
    assert got == [123.45, 0.0, 0.0] and all(isinstance(v, float) for v in got)


def test_amount_overflow_is_null(spark):
    df = spark.createDataFrame([(1e20,), (float("nan"),), (12.5,)], "a double")
    got = [r[0] for r in df.select(to_amount(F.col("a"))).collect()]
    assert got == [None, None, Decimal("12.50")]


def _split(spark, docs):
    valid, rejected = quality.split_valid(decode_events(wire_frame(spark, docs)))
    return valid, rejected


def test_quarantine_reasons(spark):
    good = txn("ok", "a1", base())
    docs = wire_docs([good]) + [
        "this is not json",
        json.dumps(dict(txn("nk", None, base()))),
        json.dumps(dict(txn("ts", "a1", None))),
        json.dumps(dict(txn("bad", "a1", base()))).replace('"amount": 100.0', '"amount": NaN'),
        json.dumps(dict(txn("typ", "a1", base()))).replace('"amount": 100.0', '"amount": "7"'),
        json.dumps(dict(txn("big", "a1", base(), amount=1e20))),
    ]
    valid, rejected = _split(spark, docs)
    # a mistyped field is NULL and its row stays
    assert sorted((r["txn_ref"], r["amount"] is None) for r in valid.collect()) == [("ok", False), ("typ", True)]
    reasons = {(r["txn_ref"], r["reason"]) for r in rejected.collect()}
    assert reasons == {
        (None, "malformed_json"),
        ("nk", "null_key"),
        ("ts", "null_key"),
        ("bad", "bad_amount"),
        ("big", "amount_overflow"),
    }
    raw = {r["reason"]: r["raw"] for r in rejected.collect()}
    assert raw["malformed_json"] is not None


def test_unparseable_event_ts_stays_valid_with_null_time(spark):
    docs = wire_docs([txn("t1", "a1", "yesterday-ish")])
    valid, rejected = _split(spark, docs)
    row = valid.first()
    assert row["event_ts"] == "yesterday-ish" and row["event_time"] is None
    assert rejected.count() == 0


def test_event_time_parses_offset_and_micros(spark):
    docs = wire_docs([txn("t1", "a1", "2024-01-01T00:00:07.179575+00:00")])
    row = decode_events(wire_frame(spark, docs)).first()
    assert str(row["event_time"]) == "2024-01-01 00:00:07.179575"


def test_currency_default_absent_vs_null(spark):
    with_key = dict(txn("k1", "a1", base()), currency=None)
    without = {k: v for k, v in txn("k2", "a1", base()).items() if k != "currency"}
    present = txn("k3", "a1", base())
    d = decode_events(wire_frame(spark, wire_docs([with_key, without, present])))
    out = dict(
        (r["txn_ref"], r["currency"])
        for r in quality.currency_default(d, raw_col="raw").collect()
    )
    assert out == {"k1": None, "k2": "USD", "k3": "USD"}


def test_currency_default_missing_column(spark):
    df = spark.createDataFrame([("t1",)], "txn_ref string")
    assert quality.currency_default(df).first()["currency"] == "USD"
