"""Small hand-written fixtures (the shape of the reference's unit tests)."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

TXN_DDL = (
    "txn_ref string, account_id string, event_ts string, merchant_category string, "
    "amount decimal(14,2), country string, channel string, currency string"
)


def iso(dt: datetime) -> str:
    return dt.astimezone(timezone.utc).isoformat()


def base(hour: int = 12, minute: int = 0) -> datetime:
    return datetime(2024, 6, 1, hour, minute, 0, tzinfo=timezone.utc)


def txn(ref, account, ts, country="US", amount=100.0, merchant="POS Terminal", channel="POS"):
    return {
        "txn_ref": ref,
        "account_id": account,
        "event_ts": ts if ts is None or isinstance(ts, str) else iso(ts),
        "merchant_category": merchant,
        "amount": amount,
        "country": country,
        "channel": channel,
        "currency": "USD",
    }


def txn_frame(spark, rows):
    """Typed transactions (amount NUMERIC(14,2), parsed event time)."""
    from decimal import Decimal

    data = [
        tuple(
            Decimal(str(r[c])) if c == "amount" and r[c] is not None else r[c]
            for c in ("txn_ref", "account_id", "event_ts", "merchant_category", "amount",
                      "country", "channel", "currency")
        )
        for r in rows
    ]
    df = spark.createDataFrame(data, TXN_DDL)
    return df.withColumn("event_time", F.try_to_timestamp("event_ts"))


def wire_docs(rows, flagged=False):
    out = []
    for r in rows:
        d = dict(r)
        d.setdefault("flagged", flagged)
        d.setdefault("flag_reason", None)
        out.append(json.dumps(d))
    return out


def wire_frame(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


def plus(dt: datetime, minutes: float) -> datetime:
    return dt + timedelta(minutes=minutes)
