"""Fixed schemas of the wire format and of the four tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# JSON document carried in the stream value (10 fields, all nullable).
WIRE_SCHEMA = StructType(
    [
        StructField("txn_ref", StringType()),
        StructField("account_id", StringType()),
        StructField("event_ts", StringType()),
        StructField("merchant_category", StringType()),
        StructField("amount", DoubleType()),
        StructField("country", StringType()),
        StructField("channel", StringType()),
        StructField("currency", StringType()),
        StructField("flagged", BooleanType()),
        StructField("flag_reason", StringType()),
    ]
)
WIRE_COLUMNS = [f.name for f in WIRE_SCHEMA.fields]

# Column that receives the raw text of a document from_json cannot parse.
CORRUPT_COLUMN = "_corrupt_record"
WIRE_SCHEMA_WITH_CORRUPT = StructType(
    WIRE_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType())]
)

# Columns of all_transactions / validated_ledger, in table order.
TXN_COLUMNS = [
    "txn_ref",
    "account_id",
    "event_ts",
    "merchant_category",
    "amount",
    "country",
    "channel",
    "currency",
    "proc_ts",
]
# The same without the processing time (not reproducible across engines).
TXN_VALUE_COLUMNS = TXN_COLUMNS[:-1]

TRANSACTIONS_SCHEMA = StructType(
    [
        StructField("txn_ref", StringType(), False),
        StructField("account_id", StringType()),
        StructField("event_ts", StringType()),
        StructField("merchant_category", StringType()),
        StructField("amount", DecimalType(14, 2)),
        StructField("country", StringType()),
        StructField("channel", StringType()),
        StructField("currency", StringType()),
        StructField("proc_ts", TimestampType()),
    ]
)

ALERT_COLUMNS = ["txn_ref", "account_id", "fraud_type", "detection_ts", "details"]
ALERTS_SCHEMA = StructType(
    [
        StructField("flag_id", StringType()),
        StructField("txn_ref", StringType()),
        StructField("account_id", StringType()),
        StructField("fraud_type", StringType()),
        StructField("detection_ts", TimestampType()),
        StructField("details", StringType()),
    ]
)

# Totals are NUMERIC(38,2): 18 digits overflow near 1e16 at full scale.
RECON_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("run_ts", TimestampType()),
        StructField("total_ingested", DecimalType(38, 2)),
        StructField("fraud_amount", DecimalType(38, 2)),
        StructField("validated_amt", DecimalType(38, 2)),
        StructField("expected_valid", DecimalType(38, 2)),
        StructField("difference", DecimalType(38, 2)),
        StructField("status", StringType()),
    ]
)

LOAD_METRICS_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("rows_extracted", LongType()),
        StructField("rows_inserted", LongType()),
        StructField("rows_snapshotted", LongType()),
        # the run that an incremental run builds on (NULL: a full run) and the folder of its snapshot layer
        StructField("base_run", LongType()),
        StructField("snapshot_path", StringType()),
    ]
)

# What a run has read: the attempt of each partition of a table.
ETL_MARKS_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("table_name", StringType()),
        StructField("writer", StringType()),
        StructField("batch_id", LongType()),
        StructField("read_attempt", StringType()),  # not "attempt": folders have that name
    ]
)

# Alerts whose transaction had not been stored when a run ended.
ETL_PENDING_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("txn_ref", StringType()),
        StructField("n_alerts", LongType()),
    ]
)

# Rows of earlier snapshot layers that were flagged since.
RETRACTION_SCHEMA = StructType(
    [
        StructField("run_id", LongType(), False),
        StructField("txn_ref", StringType()),
    ]
)

# Sorted hashes of the keys of one stored batch.
KEY_RUN_SCHEMA = StructType([StructField("key_hash", LongType())])

REJECTED_SCHEMA = StructType(
    [
        StructField("txn_ref", StringType()),
        StructField("account_id", StringType()),
        StructField("reason", StringType()),
        StructField("raw", StringType()),
        StructField("proc_ts", TimestampType()),
    ]
)

# The source positions that a batch read: runs of neighbouring offsets.
SOURCE_COLUMNS = ("partition", "offset")
SOURCE_RANGES_SCHEMA = StructType(
    [
        StructField("partition", LongType()),
        StructField("first_offset", LongType()),
        StructField("last_offset", LongType()),
        StructField("n_documents", LongType()),
    ]
)

# What a micro-batch read and dropped, by stateful operator (NULL: the whole batch).
PROGRESS_SCHEMA = StructType(
    [
        StructField("query", StringType()),
        StructField("operator", StringType()),
        StructField("input_rows", LongType()),
        StructField("late_rows", LongType()),
        StructField("state_rows", LongType()),
        StructField("watermark", StringType()),
    ]
)
