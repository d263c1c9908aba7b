"""JDBC read/append adapters (driver jar supplied by the cluster).

Spark's JDBC writer has no ``ON CONFLICT``; keyed tables stay in the
Parquet ``TableStore`` and JDBC is used as a plain source or an
append-only export of already-deduplicated frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def partitioned_read_options(column: str, lower: int, upper: int, partitions: int) -> dict:
    """Split a JDBC scan into ``partitions`` range queries on ``column``."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def quantile_bounds(spark: SparkSession, options: dict, column: str, tasks: int) -> list[str]:
    """``tasks - 1`` values that cut ``column`` into even parts, as text: one aggregate in the database."""
    picks = ", ".join(
        f"PERCENTILE_DISC({k / tasks:.6f}) WITHIN GROUP (ORDER BY {column}) AS q{k}" for k in range(1, tasks)
    )
    asked = {k: v for k, v in options.items() if k != "dbtable"} | {"query": f"SELECT {picks} FROM {options['dbtable']}"}
    row = read_jdbc(spark, asked).first()
    return sorted({str(v) for v in row if v is not None}) if row else []


def range_predicates(column: str, bounds: list[str]) -> list[str]:
    """Predicates of ranges that cover every row once; nulls are in the first."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not quoted:
        return []
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:], strict=False)]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def read_jdbc_parallel(spark: SparkSession, options: dict, column: str | None, tasks: int) -> DataFrame:
    """A scan of ``tasks`` range queries of even size on ``column`` (a text key; one query without it)."""
    if column is None or tasks < 2:
        return read_jdbc(spark, options)
    predicates = range_predicates(column, quantile_bounds(spark, options, column, tasks))
    if not predicates:
        return read_jdbc(spark, options)
    parts = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=parts)


def append_jdbc(df: DataFrame, options: dict) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
