"""Reports: fraud by merchant (CSV) and the sectioned text report.

The text report is one long frame ``(section, pos, sort_num, sort_key,
line)``: each section is a small aggregate formatted with column
expressions, the sections are unioned and sorted once, and the sorted
lines are written as text.  Every table is read once per report; the
alert/transaction join feeds the volume, merchant and country sections
from pre-aggregated alert weights.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, RuleConfig
from ..functions import format as fmt
from ..operators import aggregates as agg
from ..session import ensure_utc
from ..sinks.store import TableStore
from . import oracle
from .catalog import register
from .etl import latest_reconciliation, run_etl, seed_store

# ---------------------------------------------------------------------------
# Report layout.
#   titles, row labels and column headers as written below
#   heading rule widths 65 ("=") and 55 ("-"); rows start with two spaces
#   merchant rows: name padded to 22, count to 6, amount to 13 after "$"
#   country rows: name padded to 10; account rows: id padded to 38
#   CSV columns: merchant_category, fraud_type, fraud_count, total_fraud_amount
# ---------------------------------------------------------------------------
H1 = "=" * 65
H2 = "-" * 55
TITLE = "CARD FRAUD ANALYTICAL REPORT"
SECTIONS = [
    "1. TRANSACTION VOLUME",
    "2. FRAUD BY TYPE",
    "3. FRAUD ATTEMPTS BY MERCHANT CATEGORY",
    "4. FRAUD ATTEMPTS BY COUNTRY",
    "5. TOP 10 FLAGGED ACCOUNTS",
    "6. LATEST RECONCILIATION",
]
VOLUME_LABELS = [
    "Total transactions ingested : ",
    "Flagged as fraud            : ",
    "Validated (clean)           : ",
]
RECON_LABELS = ["Total ingested   : $", "Fraud amount     : $", "Validated amount : $", "Status           : "]
RUN_LABEL, STAMP_LABEL = "Run timestamp    : ", "Generated : "
NO_RUNS, END = "No reconciliation runs found.", "END OF REPORT"
HEADERS = {
    3: f"{'Category':<22} {'Count':>6}  {'Amount':>14}",
    4: f"{'Country':<10} {'Count':>6}  {'Amount':>14}",
    5: f"{'Account ID (truncated)':<38} {'Alerts':>6}",
}
CSV_COLUMNS = ["merchant_category", "fraud_type", "fraud_count", "total_fraud_amount"]
LINE_COLUMNS = ["section", "pos", "sort_num", "sort_key", "line"]


def merchant_report(alerts: DataFrame, txns: DataFrame) -> DataFrame:
    return agg.fraud_by_merchant(alerts, txns).select(*CSV_COLUMNS)


def write_merchant_csv(report: DataFrame, path: str) -> bool:
    """One CSV file with a header, largest count first; nothing when empty.

    The report has at most (merchant categories x fraud types) rows, so it
    is gathered into one ordered part after the aggregation.
    """
    report.persist()  # the few aggregated rows serve the check and the write
    try:
        if report.isEmpty():
            return False
        (
            report.repartition(1)
            .sortWithinPartitions(
                F.desc("fraud_count"), F.asc_nulls_first("merchant_category"), F.asc_nulls_first("fraud_type")
            )
            .write.mode("overwrite")
            .option("header", True)
            .csv(path)
        )
        return True
    finally:
        report.unpersist()


def _rows(df: DataFrame, section: int, line, sort_num=None, sort_key=None, pos: int = 2):
    return df.select(
        F.lit(section).alias("section"),
        F.lit(pos).alias("pos"),
        (sort_num if sort_num is not None else F.lit(0)).cast("long").alias("sort_num"),
        (sort_key if sort_key is not None else F.lit("")).cast("string").alias("sort_key"),
        line.alias("line"),
    )


def _fixed(spark: SparkSession, section: int, pos: int, lines: list[str]) -> DataFrame:
    rows = F.posexplode(F.array(*[F.lit(x) for x in lines])).alias("at", "text")
    return _rows(spark.range(1).select(rows), section, F.col("text"), F.col("at"), pos=pos)


def _volume_line(label: str, df: DataFrame) -> DataFrame:
    return df.select(
        fmt.line(
            label,
            fmt.pad_left(F.format_number(F.col("txn_count"), 0), 8),
            "   $",
            fmt.pad_left(fmt.money(F.col("total_amount")), 14),
        ).alias("line")
    )


def data_lines(store: TableStore, cfg: RuleConfig = DEFAULT) -> DataFrame:
    """Formatted data rows of sections 1-6 (no headings, no clock times)."""
    txns = store.read("all_transactions", must_exist=True)
    alerts = store.read("flagged_transactions", must_exist=True)
    ledger = store.read("validated_ledger")
    cube = agg.fraud_cube(alerts, txns)

    volume = (
        _rows(_volume_line(VOLUME_LABELS[0], agg.volume(txns)), 1, F.col("line"), F.lit(0))
        .unionByName(
            _rows(
                _volume_line(VOLUME_LABELS[1], agg.volume_flagged(alerts, txns, cube)),
                1,
                F.col("line"),
                F.lit(1),
            )
        )
        .unionByName(
            _rows(_volume_line(VOLUME_LABELS[2], agg.volume(ledger)), 1, F.col("line"), F.lit(2))
        )
    )
    by_type = agg.alerts_by_type(alerts)
    types = _rows(
        by_type,
        2,
        fmt.line(
            fmt.pad_right(F.col("fraud_type"), 25),
            " ",
            fmt.pad_left(F.col("alert_count"), 6),
            " alerts",
        ),
        sort_key=F.col("fraud_type"),
    )
    merchants = _rows(
        agg.alerts_by_merchant(alerts, txns, cube),
        3,
        fmt.line(
            fmt.pad_right(F.col("merchant_category"), 22),
            " ",
            fmt.pad_left(F.col("alert_count"), 6),
            "  $",
            fmt.pad_left(fmt.money(F.col("total_amount")), 13),
        ),
        -F.col("alert_count"),
        F.col("merchant_category"),
    )
    countries = _rows(
        agg.alerts_by_country(alerts, txns, cube),
        4,
        fmt.line(
            fmt.pad_right(F.col("country"), 10),
            " ",
            fmt.pad_left(F.col("alert_count"), 6),
            "  $",
            fmt.pad_left(fmt.money(F.col("total_amount")), 13),
        ),
        -F.col("alert_count"),
        F.col("country"),
    )
    accounts = _rows(
        agg.top_accounts(alerts, cfg.top_accounts),
        5,
        fmt.line(fmt.pad_right(F.col("account_id"), 38), " ", fmt.pad_left(F.col("alert_count"), 6)),
        -F.col("alert_count"),
        F.col("account_id"),
    )
    rec = latest_reconciliation(store)
    recon = (
        _rows(rec, 6, fmt.line(RECON_LABELS[0], fmt.money(F.col("total_ingested"))), F.lit(1))
        .unionByName(
            _rows(rec, 6, fmt.line(RECON_LABELS[1], fmt.money(F.col("fraud_amount"))), F.lit(2))
        )
        .unionByName(
            _rows(rec, 6, fmt.line(RECON_LABELS[2], fmt.money(F.col("validated_amt"))), F.lit(3))
        )
        .unionByName(_rows(rec, 6, fmt.line(RECON_LABELS[3], F.col("status")), F.lit(4)))
    )
    return (
        volume.unionByName(types)
        .unionByName(merchants)
        .unionByName(countries)
        .unionByName(accounts)
        .unionByName(recon)
    )


def full_report(
    spark: SparkSession,
    store: TableStore,
    cfg: RuleConfig = DEFAULT,
    generated_at: datetime | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """The whole text report as ordered lines.

    ``generated_at`` and ``run_ts`` pin the two clock values (default: now,
    and the logged time of the latest run).
    """
    ensure_utc(spark)
    stamp = (generated_at or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")

    def h2(section: int, title: str) -> DataFrame:
        return _fixed(spark, section, 0, ["", H2, f"  {title}", H2])

    rec = latest_reconciliation(store)
    logged = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")) if run_ts else F.col("run_ts").cast("string")
    parts = [
        _fixed(spark, 0, 0, ["", H1, f"  {TITLE}", H1]),
        _rows(
            spark.range(1),
            0,
            fmt.line(STAMP_LABEL, F.lit(stamp), " UTC"),
            pos=1,
        ),
        *[h2(k, title) for k, title in enumerate(SECTIONS, 1)],
        *[_fixed(spark, k, 1, ["  " + header]) for k, header in HEADERS.items()],
        _rows(rec, 6, fmt.line(RUN_LABEL, logged), F.lit(0)),
        # shown only when the log is empty
        _rows(
            store.read("reconciliation_log").agg(F.count(F.lit(1)).alias("n")).where("n = 0"),
            6,
            F.lit("  " + NO_RUNS),
        ),
        data_lines(store, cfg),
        _fixed(spark, 7, 0, ["", H1, f"  {END}", H1]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # The lines are bounded by the key domains (merchants, countries, top-k),
    # not by the data: gather them into one ordered text part after the
    # shuffle, so every upstream stage keeps its parallelism.
    return out.repartition(1).sortWithinPartitions(*LINE_COLUMNS[:-1])


def write_report(report: DataFrame, path: str) -> None:
    """Sorted lines -> text files (one line per row, order kept)."""
    report.select("line").write.mode("overwrite").text(path)


@register("report_lines")
def q_report_lines(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    return data_lines(store).select("section", "line")


@register("full_report")
def q_full_report(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    run_etl(spark, store)
    pinned = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)  # the two clock values
    return full_report(spark, store, generated_at=pinned, run_ts=pinned).select("section", "pos", "line")


@register("merchant_report")
def q_merchant_report(spark, sf_dir):
    store = seed_store(spark, sf_dir)
    return merchant_report(store.read("flagged_transactions"), store.read("all_transactions"))


# DuckDB builds the same lines with Python-style format specs.
oracle.add(
    "report_lines",
    r""", fr AS (SELECT t.* , a.fraud_type, a.account_id AS alert_account
       FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref),
vol AS (
  SELECT 'Total transactions ingested : ' AS label, 0 AS o, count(*) AS c,
         COALESCE(SUM(amount), 0) AS s FROM txn
  UNION ALL SELECT 'Flagged as fraud            : ', 1, count(*), COALESCE(SUM(amount), 0) FROM fr
  UNION ALL SELECT 'Validated (clean)           : ', 2, count(*), COALESCE(SUM(amount), 0) FROM clean),
tot AS (SELECT COALESCE(SUM(amount), 0) AS t FROM txn),
fsum AS (SELECT COALESCE(SUM(amount), 0) AS f FROM fr),
val AS (SELECT COALESCE(SUM(amount), 0) AS v FROM clean)
SELECT 1 AS section, '  ' || label || format('{:>8}', format('{:,}', c)) || '   $' || format('{:>14}', format('{:,.2f}', s)) AS line FROM vol
UNION ALL
SELECT 2, '  ' || format('{:<25}', fraud_type) || ' ' || format('{:>6}', count(*)) || ' alerts'
FROM alerts GROUP BY fraud_type
UNION ALL
SELECT 3, '  ' || format('{:<22}', merchant_category) || ' ' || format('{:>6}', count(*)) || '  $'
       || format('{:>13}', format('{:,.2f}', COALESCE(SUM(amount), 0)))
FROM fr GROUP BY merchant_category
UNION ALL
SELECT 4, '  ' || format('{:<10}', country) || ' ' || format('{:>6}', count(*)) || '  $'
       || format('{:>13}', format('{:,.2f}', COALESCE(SUM(amount), 0)))
FROM fr GROUP BY country
UNION ALL
SELECT 5, line FROM (
  SELECT '  ' || format('{:<38}', account_id) || ' ' || format('{:>6}', count(*)) AS line
  FROM alerts GROUP BY account_id ORDER BY count(*) DESC, account_id LIMIT 10)
UNION ALL SELECT 6, '  Total ingested   : $' || format('{:,.2f}', t) FROM tot
UNION ALL SELECT 6, '  Fraud amount     : $' || format('{:,.2f}', f) FROM fsum
UNION ALL SELECT 6, '  Validated amount : $' || format('{:,.2f}', v) FROM val
UNION ALL SELECT 6, '  Status           : '
  || CASE WHEN ROUND(ABS(ROUND(t - f, 2) - v), 2) < 0.02 THEN 'PASS' ELSE 'FAIL' END
FROM tot, fsum, val""",
)
oracle.add(
    "merchant_report",
    "SELECT t.merchant_category, a.fraud_type, count(*) AS fraud_count,"
    " CAST(COALESCE(SUM(t.amount), 0) AS DECIMAL(38,2)) AS total_fraud_amount"
    " FROM alerts a JOIN txn t ON a.txn_ref = t.txn_ref GROUP BY t.merchant_category, a.fraud_type",
)


def _oracle_full_report() -> str:
    """The data rows of ``report_lines`` and the fixed lines around them."""
    clock = "2026-01-02 03:04:05"
    heads = ["1. TRANSACTION VOLUME", "2. FRAUD BY TYPE", "3. FRAUD ATTEMPTS BY MERCHANT CATEGORY",
             "4. FRAUD ATTEMPTS BY COUNTRY", "5. TOP 10 FLAGGED ACCOUNTS", "6. LATEST RECONCILIATION"]
    fixed = [(0, 0, x) for x in ("", H1, f"  {TITLE}", H1)] + [(0, 1, f"  Generated : {clock} UTC")]
    for k, title in enumerate(heads, 1):
        fixed += [(k, 0, x) for x in ("", H2, f"  {title}", H2)]
    fixed += [(3, 1, "  Category                Count          Amount"), (4, 1, "  Country     Count          Amount"),
              (5, 1, "  Account ID (truncated)                 Alerts"), (6, 2, f"  Run timestamp    : {clock}")]
    fixed += [(7, 0, x) for x in ("", H1, "  END OF REPORT", H1)]
    rows = ", ".join(f"({s}, {p}, '{x}')" for s, p, x in fixed)
    return (f"SELECT section, 2 AS pos, line FROM ({oracle.statement('report_lines')}) d"
            f" UNION ALL SELECT * FROM (VALUES {rows}) f(section, pos, line)")


oracle.add_whole("full_report", _oracle_full_report())
