"""Job entry points: ``python -m cardsentry <job> --store ROOT ...``.

* ``detector``        the two streaming queries (Kafka, or JSON files)
* ``etl``             one ETL run: snapshot, ledger, summaries, reconciliation
* ``merchant-report`` fraud by merchant x type as CSV
* ``full-report``     the sectioned text report
* ``compact``         pack the small stored batches of the stream tables
* ``lost-offsets``    source positions that no stored batch has read
* ``load-events``     write ``events`` of a test-data folder as the two stream
                      tables (what the detector would have written)
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import fields, replace
from datetime import datetime, timezone

from ..config import DEFAULT, RuleConfig
from ..session import build_session, ensure_utc
from ..sinks.jdbc_store import JdbcStore
from ..sinks.store import STREAM_TABLES, TableStore
from ..streaming.progress import ProgressLog


def _store(spark, args) -> TableStore:
    """Parquet tables under ``--store``, or database tables with ``--jdbc-url`` (files stay under it)."""
    if getattr(args, "jdbc_url", None):
        options = dict(item.split("=", 1) for item in args.jdbc_option or [])
        return JdbcStore(spark, args.store, args.jdbc_url, **options)
    return TableStore(spark, args.store)


def config_from(args) -> RuleConfig:
    """Every ``RuleConfig`` field: ``--set name=value``, else ``CARDSENTRY_<NAME>``, else its default.

    Values are JSON, or plain text where they are not.
    """
    names = {f.name for f in fields(RuleConfig)}
    given = {n: os.environ[f"CARDSENTRY_{n.upper()}"] for n in names if f"CARDSENTRY_{n.upper()}" in os.environ}
    for item in getattr(args, "set", None) or []:
        name, eq, value = item.partition("=")
        if not eq or name not in names:
            raise SystemExit(f"--set {item}: expected name=value with one of {', '.join(sorted(names))}")
        given[name] = value

    def parsed(text: str):
        try:
            value = json.loads(text)
        except ValueError:
            return text
        return tuple(value) if isinstance(value, list) else value

    return replace(DEFAULT, **{n: parsed(v) for n, v in given.items()})


# Environment variables of the session's size and the settings they give.
SESSION_ENVIRONMENT = {
    "SPARK_MASTER": "spark.master",
    "SPARK_DRIVER_MEM": "spark.driver.memory",
    "SPARK_EXECUTOR_MEM": "spark.executor.memory",
    "SPARK_SHUFFLE_PARTS": "spark.sql.shuffle.partitions",
    "SPARK_CHECKPOINT_DIR": "spark.checkpoint.dir",
}


def spark_settings(args) -> dict[str, str]:
    """Spark settings from the environment, then from ``--conf NAME=VALUE``."""
    out = {conf: os.environ[name] for name, conf in SESSION_ENVIRONMENT.items() if os.environ.get(name)}
    for item in getattr(args, "conf", None) or []:
        name, eq, value = item.partition("=")
        if not eq or not name.startswith("spark."):
            raise SystemExit(f"--conf {item}: expected spark.name=value")
        out[name] = value
    return out


def _stamped(store: TableStore, out: str | None, name: str) -> str:
    """Explicit path, or ``<store>/deliverables/<name>_<UTC yyyyMMdd_HHmmss>``."""
    if out:
        return out
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{store.root}/deliverables/{name}_{stamp}"


def _trigger(spec: str) -> dict:
    if spec == "availableNow":
        return {"availableNow": True}
    if spec.startswith("processingTime="):
        return {"processingTime": spec.split("=", 1)[1]}
    return {}  # default trigger: next batch as soon as the last one ends


def cmd_detector(spark, args) -> int:
    from ..streaming import detector

    store = _store(spark, args)
    cfg = config_from(args)
    flags = {"kafka_bootstrap": args.bootstrap, "kafka_topic": args.topic, "starting_offsets": args.starting_offsets}
    cfg = replace(cfg, **{k: v for k, v in flags.items() if v is not None})
    ckpt = f"{store.root}/_checkpoints/detector"
    if args.json_dir:
        src = [detector.json_file_stream(spark, args.json_dir) for _ in range(2)]
    else:
        from ..sources.kafka import kafka_stream, start_now

        cfg = start_now(cfg)  # one position for both queries
        src = [kafka_stream(spark, cfg) for _ in range(2)]
    trigger = _trigger(args.trigger)
    log = ProgressLog(spark, store).attach()
    try:
        det = detector.start_detector(src[0], src[1], store, ckpt, cfg, trigger, log)
        if trigger.get("availableNow"):
            det.await_all()  # both queries drain what is there, then end
        else:
            det.await_any()  # run until either query stops or fails
            det.stop()
    finally:
        log.detach()
    return 0


def cmd_compact(spark, args) -> int:
    store = TableStore(spark, args.store)
    packed = {name: len(store.compact(name, args.target_mb << 20)) for name in STREAM_TABLES}
    print(json.dumps({"packed": packed}))
    return 0


def cmd_lost_offsets(spark, args) -> int:
    from ..operators.offsets import lost_ranges

    lost = lost_ranges(TableStore(spark, args.store).read("source_ranges"))
    out = _stamped(TableStore(spark, args.store), args.out, "lost_offsets")
    lost.write.parquet(out)
    row = spark.read.parquet(out).selectExpr("count(*) AS ranges", "coalesce(sum(n_lost), 0) AS documents").first()
    print(json.dumps({"lost": out, **row.asDict()}))
    return 0


def cmd_etl(spark, args) -> int:
    from .etl import run_etl

    res = run_etl(spark, _store(spark, args), config_from(args))
    rec = res.reconciliation.first().asDict()
    # the summaries are written beside the snapshot they describe
    summaries = f"{res.snapshot_path.replace('/validated/', '/summaries/')}"
    for name in ("by_merchant", "by_country", "summary"):
        getattr(res, name).write.mode("overwrite").parquet(f"{summaries}/{name}")
    print(json.dumps({
        "run_id": res.run_id,
        "rows_extracted": res.rows_extracted,
        "rows_inserted": res.rows_inserted,
        "snapshot": res.snapshot_path,
        "status": rec["status"],
        "total_ingested": str(rec["total_ingested"]),
        "fraud_amount": str(rec["fraud_amount"]),
        "validated_amt": str(rec["validated_amt"]),
        "expected_valid": str(rec["expected_valid"]),
        "difference": str(rec["difference"]),
        "summaries": summaries,
    }))
    return 0


def cmd_merchant_report(spark, args) -> int:
    from . import reports

    store = _store(spark, args)
    out = _stamped(store, args.out, "fraud_by_merchant")
    rep = reports.merchant_report(
        store.read("flagged_transactions", must_exist=True), store.read("all_transactions", must_exist=True)
    )
    wrote = reports.write_merchant_csv(rep, out)
    print(json.dumps({"csv": out if wrote else None}))
    return 0


def cmd_full_report(spark, args) -> int:
    from . import reports

    store = _store(spark, args)
    out = _stamped(store, args.out, "full_report")
    reports.write_report(reports.full_report(spark, store, config_from(args)), out)
    print(json.dumps({"report": out}))
    return 0


def cmd_load_events(spark, args) -> int:
    from .etl import seed_store

    store = seed_store(spark, args.events_dir, config_from(args), store=_store(spark, args))
    print(json.dumps({"store": store.root}))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="cardsentry")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="job", required=True)

    d = sub.add_parser("detector")
    d.add_argument("--store", required=True)
    d.add_argument("--json-dir", help="read JSON lines files instead of Kafka")
    d.add_argument("--bootstrap")
    d.add_argument("--topic")
    d.add_argument("--starting-offsets")
    d.add_argument("--trigger", default="default", help="default | availableNow | processingTime=<interval>")
    d.set_defaults(fn=cmd_detector)

    e = sub.add_parser("etl")
    e.add_argument("--store", required=True)
    e.set_defaults(fn=cmd_etl)

    m = sub.add_parser("merchant-report")
    m.add_argument("--store", required=True)
    m.add_argument("--out", help="default: <store>/deliverables/fraud_by_merchant_<UTC stamp>")
    m.set_defaults(fn=cmd_merchant_report)

    f = sub.add_parser("full-report")
    f.add_argument("--store", required=True)
    f.add_argument("--out", help="default: <store>/deliverables/full_report_<UTC stamp>")
    f.set_defaults(fn=cmd_full_report)

    c = sub.add_parser("compact")
    c.add_argument("--store", required=True)
    c.add_argument("--target-mb", type=int, default=128, help="size of a packed file")
    c.set_defaults(fn=cmd_compact)

    o = sub.add_parser("lost-offsets")
    o.add_argument("--store", required=True)
    o.add_argument("--out", help="default: <store>/deliverables/lost_offsets_<UTC stamp>")
    o.set_defaults(fn=cmd_lost_offsets)

    s = sub.add_parser("load-events")
    s.add_argument("--store", required=True)
    s.add_argument("--events-dir", required=True)
    s.set_defaults(fn=cmd_load_events)

    for job in sub.choices.values():
        job.add_argument("--jdbc-url", help="keep the tables in a database")
        job.add_argument("--jdbc-option", action="append", metavar="NAME=VALUE", help="user, password, driver, ...")
        job.add_argument("--set", action="append", metavar="NAME=VALUE", help="a RuleConfig field")
        job.add_argument("--conf", action="append", metavar="NAME=VALUE", help="a Spark setting")
    args = p.parse_args(argv)
    spark = build_session(args.master, app_name=f"cardsentry-{args.job}", extra=spark_settings(args))
    ensure_utc(spark)
    try:
        return args.fn(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
