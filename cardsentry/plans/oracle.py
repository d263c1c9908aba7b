"""DuckDB oracle: the same queries in plain SQL over the raw tables.

Each statement rebuilds the transaction mapping from ``events`` on its
own, so it checks the Spark adapter as well as the operators.
"""

from __future__ import annotations

# Transaction mapping, the wire defect class ``k`` and the two rules.
_BASE = r"""
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_ref,
         CAST(user_id AS VARCHAR) AS account_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_ts,
         ts AS event_time,
         event_type AS merchant_category,
         CAST(CAST(value AS DECIMAL(14,2)) * 50 AS DECIMAL(14,2)) AS amount,
         ['US','UK','DE','SG','AU','IN','NG','BR'][CAST(event_id % 8 AS INT) + 1] AS country,
         ['ATM','Online','POS','Mobile','Branch'][CAST(json_extract_string(props, '$.k') AS INT) % 5 + 1] AS channel,
         'USD' AS currency,
         value * 50.0 AS raw_amount,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
hv AS (
  SELECT txn_ref, account_id, 'HIGH_VALUE' AS fraud_type,
         '{"amount":' || CAST(CAST(amount AS DOUBLE) AS VARCHAR) || ',"country":"' || country
           || '","merchant_category":"' || merchant_category || '"}' AS details
  FROM txn WHERE amount > 5000),
slid AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS ws, * FROM txn WHERE event_time IS NOT NULL
  UNION ALL
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE AS ws, * FROM txn
  WHERE event_time IS NOT NULL),
tumb AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, event_time) AS ws, * FROM txn WHERE event_time IS NOT NULL),
guilty AS (
  SELECT ws, ws + INTERVAL 10 MINUTE AS we, account_id,
         list_sort(list(DISTINCT country)) AS countries, count(txn_ref) AS txn_count
  FROM slid GROUP BY ws, account_id HAVING count(DISTINCT country) > 1),
guilty_tumbling AS (
  SELECT ws, ws + INTERVAL 10 MINUTE AS we, account_id,
         list_sort(list(DISTINCT country)) AS countries, count(txn_ref) AS txn_count
  FROM tumb GROUP BY ws, account_id HAVING count(DISTINCT country) > 1),
travel AS (
  SELECT s.txn_ref, s.account_id, 'IMPOSSIBLE_TRAVEL' AS fraud_type,
         '{"window":{"start":"' || strftime(g.ws, '%Y-%m-%dT%H:%M:%S') || '.000Z","end":"'
           || strftime(g.we, '%Y-%m-%dT%H:%M:%S') || '.000Z"},"countries":'
           || CAST(to_json(g.countries) AS VARCHAR) || '}' AS details,
         g.we AS we
  FROM slid s JOIN guilty g ON s.ws = g.ws AND s.account_id = g.account_id
  WHERE s.txn_ref IS NOT NULL),
alerts AS (
  SELECT txn_ref, account_id, fraud_type, details FROM hv
  UNION ALL
  SELECT txn_ref, account_id, fraud_type, details FROM travel),
clean AS (
  SELECT t.* FROM txn t WHERE NOT EXISTS (SELECT 1 FROM alerts a WHERE a.txn_ref = t.txn_ref)),
wire AS (
  SELECT CASE WHEN k IN (0, 9) THEN NULL ELSE txn_ref END AS txn_ref,
         CASE WHEN k IN (0, 3) THEN NULL ELSE account_id END AS account_id,
         CASE WHEN k IN (0, 10) THEN NULL WHEN k = 1 THEN 'not-a-timestamp' ELSE event_ts END AS event_ts,
         CASE WHEN k IN (0, 1, 10) THEN NULL ELSE event_time END AS event_time,
         CASE WHEN k = 0 THEN NULL ELSE merchant_category END AS merchant_category,
         CASE WHEN k IN (0, 6) THEN NULL WHEN k = 2 THEN CAST('NaN' AS DOUBLE)
              WHEN k = 8 THEN 1e12 WHEN k = 11 THEN 5000.004
              ELSE CAST(amount AS DOUBLE) END AS amount,
         CASE WHEN k = 0 THEN NULL ELSE country END AS country,
         CASE WHEN k = 0 THEN NULL ELSE channel END AS channel,
         CASE WHEN k IN (0, 4, 5) THEN NULL ELSE currency END AS currency,
         CASE WHEN k IN (0, 7) THEN NULL ELSE k % 4 IN (1, 2) END AS flagged,
         CASE WHEN k = 0 THEN NULL WHEN k % 4 IN (1, 3) THEN 'HIGH_VALUE'
              WHEN k % 4 = 2 THEN 'IMPOSSIBLE_TRAVEL' END AS flag_reason,
         k
  FROM txn)
"""

REJECTED = (
    "SELECT txn_ref, account_id, CASE WHEN k = 0 THEN 'malformed_json' WHEN k = 2 THEN 'bad_amount'"
    " WHEN k = 8 THEN 'amount_overflow' ELSE 'null_key' END AS reason"
    " FROM wire WHERE k IN (0, 2, 3, 8, 9, 10)"
)
TXN_COLS = "txn_ref, account_id, event_ts, merchant_category, amount, country, channel, currency"
MONEY = "DECIMAL(38,2)"


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip()


def _windows(src: str) -> str:
    return _q(
        "SELECT ws AS window_start, we AS window_end, account_id,"
        f" CAST(to_json(countries) AS VARCHAR) AS countries, txn_count FROM {src}"
    )


_SQL = {
    # -- decode / normalise
    "decode_events": _q(
        "SELECT txn_ref, account_id, event_ts, merchant_category, amount, country, channel,"
        " currency, CAST(flagged AS VARCHAR) AS flagged, flag_reason FROM wire"
    ),
    "event_time_parse": _q("SELECT txn_ref, event_ts, event_time FROM wire"),
    "encode_events": _q(
        """SELECT txn_ref, '{"txn_ref":"' || txn_ref || '","account_id":"' || account_id
           || '","event_ts":"' || event_ts || '","merchant_category":"' || merchant_category
           || '","amount":' || CAST(CAST(amount AS DOUBLE) AS VARCHAR) || ',"country":"' || country
           || '","channel":"' || channel || '","currency":"' || currency
           || '","flagged":false,"flag_reason":null}' AS value FROM txn"""
    ),
    "scan_transactions": _q(f"SELECT {TXN_COLS} FROM txn"),
    "project_transactions": _q(f"SELECT {TXN_COLS} FROM txn"),
    "normalize_amount": _q(
        "SELECT txn_ref, CASE WHEN k IN (2, 8) OR amount IS NULL THEN 0.0 WHEN k = 11 THEN 5000.0"
        " ELSE amount END AS amount FROM wire"
    ),
    "round_amount": _q(
        "SELECT txn_ref, raw_amount / 16 AS raw_amount,"
        " CAST(ROUND(CAST(CAST(raw_amount / 16 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(14,2)) AS amount FROM txn"
    ),
    "currency_default": _q(
        "SELECT txn_ref, CASE WHEN k = 4 THEN 'USD' ELSE currency END AS currency FROM wire"
    ),
    "amount_decimal": _q(
        "SELECT txn_ref, CASE WHEN k IN (2, 8) THEN NULL ELSE CAST(amount AS DECIMAL(14,2)) END"
        " AS amount FROM wire"
    ),
    "valid_events": _q(
        "SELECT txn_ref, account_id, event_ts, merchant_category,"
        " CAST(amount AS DECIMAL(14,2)) AS amount, country, channel, currency"
        " FROM wire WHERE k IS NULL OR k NOT IN (0, 2, 3, 8, 9, 10)"
    ),
    "rejected_events": _q(REJECTED),
    # -- rules
    "high_value": _q(
        "SELECT txn_ref, account_id, amount, country, merchant_category FROM txn WHERE amount > 5000"
    ),
    "high_value_alerts": _q("SELECT txn_ref, account_id, fraud_type, details FROM hv"),
    "travel_windows": _windows("guilty"),
    "travel_windows_tumbling": _windows("guilty_tumbling"),
    "travel_alerts": _q("SELECT txn_ref, account_id, fraud_type, details FROM travel"),
    "all_alerts": _q("SELECT txn_ref, account_id, fraud_type, details FROM alerts"),
    # -- joins
    "clean_transactions": _q(f"SELECT {TXN_COLS} FROM clean"),
    "alert_transactions": _q(
        "SELECT a.txn_ref, a.account_id, a.fraud_type, t.merchant_category, t.country, t.amount"
        " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref"
    ),
    "insert_if_absent": _q(
        """SELECT txn_ref, amount, 'existing' AS origin FROM txn WHERE amount > 5000
           UNION ALL
           SELECT DISTINCT txn_ref, amount, 'inserted' AS origin
           FROM (SELECT * FROM txn UNION ALL SELECT * FROM txn) b
           WHERE txn_ref NOT IN (SELECT txn_ref FROM txn WHERE amount > 5000)"""
    ),
    # -- aggregates
    "volume_ingested": _q(
        f"SELECT count(*) AS txn_count, CAST(COALESCE(SUM(amount), 0) AS {MONEY}) AS total_amount"
        " FROM txn"
    ),
    "volume_flagged": _q(
        f"SELECT count(*) AS txn_count, CAST(COALESCE(SUM(t.amount), 0) AS {MONEY}) AS total_amount"
        " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref"
    ),
    "alerts_by_type": _q(
        "SELECT fraud_type, count(*) AS alert_count FROM alerts GROUP BY fraud_type"
    ),
    "alerts_by_merchant": _q(
        f"SELECT t.merchant_category, count(*) AS alert_count,"
        f" CAST(COALESCE(SUM(t.amount), 0) AS {MONEY}) AS total_amount"
        " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref"
        " GROUP BY t.merchant_category ORDER BY alert_count DESC, t.merchant_category"
    ),
    "alerts_by_country": _q(
        f"SELECT t.country, count(*) AS alert_count,"
        f" CAST(COALESCE(SUM(t.amount), 0) AS {MONEY}) AS total_amount"
        " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref"
        " GROUP BY t.country ORDER BY alert_count DESC, t.country"
    ),
    "fraud_by_merchant": _q(
        f"SELECT t.merchant_category, a.fraud_type, count(*) AS fraud_count,"
        f" CAST(COALESCE(SUM(t.amount), 0) AS {MONEY}) AS total_fraud_amount"
        " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref"
        " GROUP BY t.merchant_category, a.fraud_type"
        " ORDER BY fraud_count DESC, t.merchant_category, a.fraud_type"
    ),
    "top_accounts": _q(
        "SELECT account_id, count(*) AS alert_count FROM alerts GROUP BY account_id"
        " ORDER BY alert_count DESC, account_id LIMIT 10"
    ),
    "clean_by_merchant": _q(
        "SELECT merchant_category, count(txn_ref) AS tx_count,"
        " CAST(SUM(COALESCE(amount, 0)) AS DOUBLE) AS total_amount FROM clean"
        " WHERE merchant_category IS NOT NULL GROUP BY merchant_category"
    ),
    "clean_by_country": _q(
        "SELECT country, count(txn_ref) AS tx_count,"
        " CAST(SUM(COALESCE(amount, 0)) AS DOUBLE) AS total_amount FROM clean"
        " WHERE country IS NOT NULL GROUP BY country"
    ),
    "clean_summary": _q(
        "SELECT CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS total_clean_amount,"
        " count(*) AS tx_count FROM clean"
    ),
    "label_mix": _q(
        """SELECT count(*) AS total,
                  count(*) FILTER (WHERE NOT COALESCE(flagged, false) OR flag_reason IS NULL) AS normal,
                  count(*) FILTER (WHERE flagged AND lower(flag_reason) = 'high_value') AS high_value,
                  count(*) FILTER (WHERE flagged AND lower(flag_reason) = 'impossible_travel')
                    AS impossible_travel,
                  normal / greatest(total, 1) * 100.0 AS pct_normal,
                  high_value / greatest(total, 1) * 100.0 AS pct_high_value,
                  impossible_travel / greatest(total, 1) * 100.0 AS pct_impossible_travel
           FROM wire"""
    ),
}


# Output columns that are DECIMAL in the SQL; the registered Spark queries
# expose money as DOUBLE, so the oracle converts the same columns.
_MONEY_OUT = {
    "alert_transactions": ["amount"],
    "alerts_by_country": ["total_amount"],
    "alerts_by_merchant": ["total_amount"],
    "amount_decimal": ["amount"],
    "clean_transactions": ["amount"],
    "fraud_by_merchant": ["total_fraud_amount"],
    "high_value": ["amount"],
    "insert_if_absent": ["amount"],
    "latest_reconciliation": ["total_ingested", "fraud_amount", "validated_amt"],
    "merchant_report": ["total_fraud_amount"],
    "project_transactions": ["amount"],
    "reconcile": ["total_ingested", "fraud_amount", "validated_amt", "expected_valid", "difference"],
    "reconcile_distinct": [
        "total_ingested", "fraud_amount", "validated_amt", "expected_valid", "difference",
    ],
    "stream_two_writers_reconcile": [
        "total_ingested", "fraud_amount", "validated_amt", "expected_valid", "difference",
    ],
    "round_amount": ["amount"],
    "scan_transactions": ["amount"],
    "stream_transactions": ["amount"],
    "valid_events": ["amount"],
    "validated_ledger": ["amount"],
    "volume_flagged": ["total_amount"],
    "volume_ingested": ["total_amount"],
    "volume_validated": ["total_amount"],
}


def _as_double(sql: str, cols: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) AS q"


def oracle_sql() -> dict[str, str]:
    from . import audits, etl, reports  # noqa: F401  (their statements register below)
    from ..streaming import detector  # noqa: F401

    return {k: _as_double(v, _MONEY_OUT[k]) if k in _MONEY_OUT else v for k, v in _SQL.items()}


def add(name: str, body: str) -> None:
    """Register an oracle statement that uses the shared CTEs."""
    _SQL[name] = _q(body)


def statement(name: str) -> str:
    """A registered statement, to be used inside another one."""
    return _SQL[name]


def add_whole(name: str, sql: str) -> None:
    """Register a complete oracle statement."""
    _SQL[name] = sql
