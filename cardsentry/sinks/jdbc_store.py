"""Database tables behind the store's interface (driver jar supplied by the cluster).

Spark's JDBC writer can only append, so every write adds its rows under
``writer``, the partition id and an ``attempt`` name, and then publishes the attempt
with one row in the table ``published_attempts``.  A read takes, of each (writer,
partition), the rows of the last published attempt: a replayed micro-batch or a rerun replaces
its rows for every reader, also with none, and rows of a lost job are never seen.
The last attempts come from an aggregate that the database computes.  Keys that
several writers stored are read once, as in the Parquet store.  Snapshots and staging
stay under the file root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.jdbc import append_jdbc, jdbc_options, read_jdbc, read_jdbc_parallel
from .store import KEYED, STREAM_TABLES, TABLES, MissingTableError, Partition, TableStore, create_exclusively, key_hash, new_attempt

#: One row for each published attempt of each table's partition.
PUBLISHED = "published_attempts"


class JdbcStore(TableStore):
    """Tables in one database; ``options`` are further JDBC options (user, driver, ...)."""

    lists_partitions = False

    def __init__(self, spark: SparkSession, root: str, url: str, prefix: str = "", read_tasks: int = 8, **options):
        super().__init__(spark, root)
        self.url, self.prefix, self.read_tasks, self.options = url, prefix, read_tasks, options

    def table_options(self, name: str) -> dict:
        return jdbc_options(self.url, f"{self.prefix}{name}", **self.options)

    def table_exists(self, name: str) -> bool:
        listed = self.table_options(name)
        listed.pop("dbtable")
        listed["query"] = f"SELECT 1 AS one FROM information_schema.tables WHERE table_name = '{self.prefix}{name}'"
        return not read_jdbc(self.spark, listed).isEmpty()

    def require(self, *names: str) -> None:
        for name in names:
            if not self.table_exists(name):
                raise MissingTableError(f"{self.prefix}{name} does not exist in {self.url}")

    def published(self, name: str) -> DataFrame:
        """``writer, part, attempt``: the last attempt of each partition, from an aggregate in the database."""
        options = self.table_options(PUBLISHED)
        options.pop("dbtable")
        options["query"] = (
            f"SELECT writer, part, MAX(attempt) AS attempt FROM {self.prefix}{PUBLISHED} "
            f"WHERE table_name = '{name}' GROUP BY writer, part"
        )
        return read_jdbc(self.spark, options)

    def read(self, name: str, must_exist: bool = False, found: list[Partition] | None = None) -> DataFrame:
        if found:
            raise ValueError("a database table is read whole")
        schema, part = self.schema(name), TABLES[name][1]
        if found is not None or not self.table_exists(name):
            if must_exist:
                self.require(name)
            return self.spark.createDataFrame([], schema)
        rows = read_jdbc_parallel(self.spark, self.table_options(name), self.split_column(name), self.read_tasks)
        last = self.published(name).withColumnsRenamed({"writer": "_writer", "part": "_part", "attempt": "_attempt"})
        same = (rows[part] == last["_part"]) & (rows["attempt"] == last["_attempt"])
        if name in STREAM_TABLES:
            same &= rows["writer"] == last["_writer"]
        rows = rows.join(last, same, "left_semi").select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
        if name in KEYED and name in STREAM_TABLES:
            hashes = rows.select(key_hash(F.col(KEYED[name][0])).alias("key_hash"))
            return self.one_row_a_key(name, rows, hashes.groupBy("key_hash").count().where("count > 1").select("key_hash"))
        return rows

    @staticmethod
    def split_column(name: str) -> str | None:
        """The column by whose ranges a large table's scan is split."""
        return {"all_transactions": "txn_ref", "validated_ledger": "txn_ref", "flagged_transactions": "flag_id"}.get(name)

    def write_partition(self, name: str, df: DataFrame, value: int, writer: str | None = None) -> str:
        schema, part = TABLES[name]
        self.check_writer(name, writer)
        attempt = new_attempt()
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != part]
        extra = [F.lit(value).cast("long").alias(part), F.lit(attempt).alias("attempt")]
        if writer:
            extra.append(F.lit(writer).alias("writer"))
        append_jdbc(df.select(*cols, *extra), self.table_options(name))
        done = self.spark.createDataFrame(
            [(name, writer or "", value, attempt)], "table_name string, writer string, part long, attempt string"
        )
        append_jdbc(done, self.table_options(PUBLISHED))
        return attempt

    def claim_run(self, run_id: int | None = None) -> int:
        """A run id behind those in the log, claimed in the file root."""
        if run_id is None:
            run_id = 1 + int(self.read("reconciliation_log").agg(F.max("run_id").alias("m")).first()["m"] or 0)
            while not create_exclusively(self.spark, f"{self.root}/_runs/{run_id}"):
                run_id += 1
        return run_id

    def partitions(self, name: str) -> list[Partition]:
        return []
