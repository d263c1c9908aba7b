"""Wire codec: JSON value <-> transaction columns (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COLUMN, SOURCE_COLUMNS, WIRE_COLUMNS, WIRE_SCHEMA_WITH_CORRUPT

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a numeric UTC offset."""
    return F.date_format(ts, ISO_MICROS)


def parse_event_time(event_ts: Column) -> Column:
    """Text -> timestamp; unparseable text gives NULL instead of failing."""
    return F.try_to_timestamp(event_ts)


def decode_value(value: Column) -> Column:
    """Binary/string stream value -> wire struct (PERMISSIVE).

    A document that is not JSON, or has a field of the wrong type, keeps
    its raw text in ``_corrupt_record``; a mistyped field is NULL and the
    other fields stay; unknown keys are ignored.
    """
    return F.from_json(
        value.cast("string"),
        WIRE_SCHEMA_WITH_CORRUPT,
        {"columnNameOfCorruptRecord": CORRUPT_COLUMN, "mode": "PERMISSIVE"},
    )


def decode_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Stream/batch of ``value`` documents -> decoded transaction rows.

    Adds ``raw`` (the text, kept for quarantine), ``event_time`` (parsed)
    and ``proc_ts`` (processing time).  The struct goes through ``inline``:
    a generator is never merged into the expressions above it, so each
    document is parsed once however many columns and filters use it.
    A source's ``partition`` and ``offset`` stay with the row.
    """
    source = [c for c in SOURCE_COLUMNS if c in raw.columns]
    d = raw.select(
        *source,
        F.col(value_col).cast("string").alias("raw"),
        F.inline(F.array(decode_value(F.col(value_col)))),
    )
    return d.select(
        *WIRE_COLUMNS,
        CORRUPT_COLUMN,
        "raw",
        *source,
    ).select(
        "*",
        parse_event_time(F.col("event_ts")).alias("event_time"),
        F.current_timestamp().alias("proc_ts"),
    )


def decode_once(rows: DataFrame, parts: int) -> DataFrame:
    """``rows``, dealt evenly, for a plan that reads them in several branches.

    Each branch would scan and decode the documents again: its own columns and filters are pushed
    into its copy, so no two copies are alike.  Here a row passes the exchange as one struct and
    is opened by a generator, which lets neither through: the branches share one exchange.
    """
    packed = rows.select(F.struct(*rows.columns).alias("row")).repartition(parts)
    return packed.select(F.inline(F.array("row")))


def encode_events(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Transactions -> ``value`` BINARY documents, the Kafka sink shape.

    ``amount`` travels as a JSON number (double); absent wire columns are
    sent as nulls (``flagged`` false by default, like a fresh event).
    """
    cols = []
    for c in WIRE_COLUMNS:
        if c in df.columns:
            col = F.col(c)
            if c == "amount":
                col = col.cast("double")
            cols.append(col.alias(c))
        elif c == "flagged":
            cols.append(F.lit(False).alias(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).cast("binary")
    out = [value.alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("binary").alias("key"))
    return df.select(*out)
