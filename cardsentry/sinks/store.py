"""Tables as Parquet directories under one shared root.

Stream tables are laid out as ``writer=<id>/batch_id=<n>``: a writer is one
checkpoint (the id Spark keeps in it) or one load, and it replaces only its
own batches.  So a replayed micro-batch rewrites the same rows, while a new
checkpoint, whose batch numbers start at 0 again, adds to what other writers
stored.  The ETL owns ``run_id=<n>`` partitions in the same way.

A partition is written to a new folder ``attempt=<time>-<random>`` below it.  The
committer's ``_SUCCESS`` file publishes the attempt in one step; readers take, of
each partition, the last published attempt.  A reader during a replay therefore
sees the old rows or the new ones, never none or both, and what a lost job left
is never read.  The attempt before the last one stays for readers that began with it.

``all_transactions`` is keyed by ``txn_ref``.  A writer keeps its own keys once, but two
writers can each store a key (a new checkpoint that rereads a topic, a load over
a stream).  Each of its partitions therefore has a key run beside it: the sorted
40-bit hashes of its keys, some two to five bytes a key.  A read over several writers first
finds the hashes that occur twice from the runs alone; rows without such a hash pass
as they are, and only the others meet by key, where the earliest ``proc_ts`` wins.

Many small batches of one writer can be packed into one folder ``compacted=<attempt>``
(``compact``).  Its ``_covers.json`` names the batches and attempts that it holds, so each
still counts as the partition it was: a reader takes it from there as soon as the
folder is published, and from its own folder until then, or if it was replaced since.

Readers always pass the fixed schema: no inference; an absent table reads as an empty
frame only where the caller allows it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import schemas
from ..operators.joins import dedupe_by_key

TABLES: dict[str, tuple[StructType, str]] = {
    "all_transactions": (schemas.TRANSACTIONS_SCHEMA, "batch_id"),
    "flagged_transactions": (schemas.ALERTS_SCHEMA, "batch_id"),
    "rejected_events": (schemas.REJECTED_SCHEMA, "batch_id"),
    "transaction_key_runs": (schemas.KEY_RUN_SCHEMA, "batch_id"),
    "source_ranges": (schemas.SOURCE_RANGES_SCHEMA, "batch_id"),
    "stream_progress": (schemas.PROGRESS_SCHEMA, "batch_id"),
    "validated_ledger": (schemas.TRANSACTIONS_SCHEMA, "run_id"),
    "reconciliation_log": (schemas.RECON_SCHEMA, "run_id"),
    "load_metrics": (schemas.LOAD_METRICS_SCHEMA, "run_id"),
    "etl_marks": (schemas.ETL_MARKS_SCHEMA, "run_id"),
    "etl_pending": (schemas.ETL_PENDING_SCHEMA, "run_id"),
    "snapshot_retractions": (schemas.RETRACTION_SCHEMA, "run_id"),
}


#: Tables that stream queries and loads append to, each under its own writer.
STREAM_TABLES = (
    "all_transactions", "flagged_transactions", "rejected_events", "transaction_key_runs", "source_ranges", "stream_progress",
)

#: Table with a key -> (the key, the column whose smallest value wins, its key runs if it has any).
KEYED = {
    "all_transactions": ("txn_ref", "proc_ts", "transaction_key_runs"),
    "validated_ledger": ("txn_ref", "run_id", None),
}

#: Bits of a key's hash in a key run: 2^40 hashes, so few different keys share one.
RUN_BITS = 40


class MissingTableError(FileNotFoundError):
    """A table that must exist was not found under the store's root."""


def checkpoint_writer(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark stores in a checkpoint at its first start (one scalar)."""
    return spark.read.json(f"{checkpoint}/metadata").select("id").first()["id"]


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's file system and path object (PySpark has no public file-system API)."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there already (one of two callers wins)."""
    fs, hpath = _hadoop(spark, path)
    fs.mkdirs(hpath.getParent())
    return fs.createNewFile(hpath)


def new_attempt() -> str:
    """A name that sorts behind those of earlier attempts."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def key_hash(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - RUN_BITS)


@dataclass(frozen=True, order=True)
class Partition:
    """One published partition: its place, and the attempt that is read."""

    writer: str | None
    value: int
    attempt: str
    path: str
    #: Whether ``path`` holds other partitions as well.
    compacted: bool = False

    @property
    def id(self) -> tuple[str | None, int]:
        return self.writer, self.value


class TableStore:
    #: Whether partitions can be listed and read one by one.
    lists_partitions = True

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- layout ------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> StructType:
        schema, part = TABLES[name]
        fields = [f for f in schema.fields if f.name != part]
        if name in STREAM_TABLES:
            fields.append(StructField("writer", StringType(), False))
        return StructType(fields + [StructField(part, LongType(), False)])

    def attempts(self, name: str) -> list[Partition]:
        """Every published attempt, oldest first (one listing of the table's folders)."""
        _, part = TABLES[name]
        writer = "writer=*/" if name in STREAM_TABLES else ""
        fs, pattern = _hadoop(self.spark, f"{self.path(name)}/{writer}{part}=*/attempt=*/_SUCCESS")
        out = []
        for status in fs.globStatus(pattern) or []:
            folder = status.getPath().getParent().toString()
            names = dict(x.split("=", 1) for x in folder.split("/")[-3:] if "=" in x)
            out.append(Partition(names.get("writer") if writer else None, int(names[part]), names["attempt"], folder))
        if writer:
            for folder in self.compacted_folders(name):
                owner = folder.split("/")[-2].split("=", 1)[1]
                for value, attempt in self.covers(folder).items():
                    out.append(Partition(owner, value, attempt, folder, True))
        # of one attempt in two places the younger compacted folder is read
        return sorted(out, key=lambda p: (p.attempt, p.compacted, p.path))

    def compacted_folders(self, name: str) -> list[str]:
        """The published compacted folders, oldest first."""
        fs, pattern = _hadoop(self.spark, f"{self.path(name)}/writer=*/compacted=*/_SUCCESS")
        return sorted((s.getPath().getParent().toString() for s in fs.globStatus(pattern) or []), key=lambda f: f.split("/")[-1])

    def covers(self, folder: str) -> dict[int, str]:
        """The batches that a compacted folder holds, each with its attempt."""
        fs, hpath = _hadoop(self.spark, f"{folder}/_covers.json")
        stream = fs.open(hpath)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(k): v for k, v in json.loads(text).items()}

    def partitions(self, name: str) -> list[Partition]:
        """The last published attempt of each partition."""
        return sorted({p.id: p for p in self.attempts(name)}.values(), key=lambda p: (p.writer or "", p.value))

    # -- read / write ------------------------------------------------------
    def read(self, name: str, must_exist: bool = False, found: list[Partition] | None = None) -> DataFrame:
        """The table's rows (or those of the partitions ``found``), each key once."""
        if found is None:
            found = self.partitions(name)
        if not found and must_exist:
            self.require(name)
        rows = self.read_partitions(name, found)
        if self.may_repeat(name, found):
            return self.one_row_a_key(name, rows, self.repeated_hashes(name, found))
        return rows

    def require(self, *names: str) -> None:
        for name in names:
            if not path_exists(self.spark, self.path(name)):
                raise MissingTableError(f"{self.path(name)} does not exist: is {self.root} the right store?")

    def may_repeat(self, name: str, found: list[Partition]) -> bool:
        """Whether a key can be stored twice: by two writers, or by two runs at the same time."""
        if name == "validated_ledger":
            return len(found) > 1 and bool(self.overlapping_runs())
        return name in KEYED and len({p.writer for p in found}) > 1

    def read_partitions(self, name: str, found: list[Partition]) -> DataFrame:
        """The rows of these partitions as they were stored."""
        schema = self.schema(name)
        plain, packed = [p.path for p in found if not p.compacted], defaultdict(list)
        for p in found:
            if p.compacted:
                packed[p.path].append(p)
        parts = []
        if plain:
            rows = self.spark.read.schema(schema).option("basePath", self.path(name))
            parts.append(rows.parquet(*plain).select(*schema.fieldNames()))
        _, part = TABLES[name]
        for folder, held in packed.items():
            rows = self.spark.read.schema(StructType([f for f in schema if f.name != "writer"])).parquet(folder)
            if len(held) < len(self.covers(folder)):
                rows = rows.where(F.col(part).isin([p.value for p in held]))
            parts.append(rows.withColumn("writer", F.lit(held[0].writer)).select(*schema.fieldNames()))
        if not parts:
            return self.spark.createDataFrame([], schema)
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    def read_writer(self, name: str, writer: str) -> DataFrame:
        """What one writer stored."""
        return self.read_partitions(name, [p for p in self.partitions(name) if p.writer == writer])

    def key_hashes(self, name: str, found: list[Partition]) -> DataFrame:
        """``key_hash`` of every stored row, from the key runs where there is one."""
        key, _, runs = KEYED[name]
        known = {p.id: p for p in self.partitions(runs)} if runs else {}
        # a run is written after its rows: it is of this attempt if it is younger
        fresh = [known[p.id] for p in found if p.id in known and known[p.id].attempt > p.attempt]
        have = {p.id for p in fresh}
        rest = self.read_partitions(name, [p for p in found if p.id not in have])
        rest = rest.select(key_hash(F.col(key)).alias("key_hash"))
        return self.read_partitions(runs, fresh).select("key_hash").unionByName(rest) if fresh else rest

    def repeated_hashes(self, name: str, found: list[Partition]) -> DataFrame:
        """The hashes that more than one stored row has."""
        return self.key_hashes(name, found).groupBy("key_hash").count().where("count > 1").select("key_hash")

    @staticmethod
    def one_row_a_key(name: str, rows: DataFrame, repeated: DataFrame) -> DataFrame:
        """``rows`` with each key once: only rows with a repeated hash meet by key."""
        key, first, _ = KEYED[name]
        marked = rows.withColumn("key_hash", key_hash(F.col(key))).join(
            repeated.withColumn("repeats", F.lit(True)), "key_hash", "left"
        )
        alone = marked.where(F.col("repeats").isNull()).select(*rows.columns)
        meet = marked.where(F.col("repeats")).select(*rows.columns)
        return alone.unionByName(dedupe_by_key(meet, key, order_cols=(first,)))

    def write_partition(self, name: str, df: DataFrame, value: int, writer: str | None = None) -> str:
        """Replace partition ``<part>=<value>`` (of ``writer``, for a stream table) with ``df``."""
        folder = self._write(name, df, value, writer)
        key, _, runs = KEYED.get(name, (None, None, None))
        if runs:
            stored = self.spark.read.schema(self.schema(name)).parquet(folder)
            hashes = stored.select(key_hash(F.col(key)).alias("key_hash")).sortWithinPartitions("key_hash")
            self._write(runs, hashes, value, writer)
        return folder

    def _write(self, name: str, df: DataFrame, value: int, writer: str | None) -> str:
        schema, part = TABLES[name]
        self.check_writer(name, writer)
        cols = [f.name for f in schema.fields if f.name != part]
        out = df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in cols])
        place = self.path(name) + (f"/writer={writer}" if writer else "") + f"/{part}={value}"
        folder = f"{place}/attempt={new_attempt()}"
        out.write.parquet(folder)
        self._drop_superseded(place)
        return folder

    def _drop_superseded(self, place: str, keep: int = 2) -> None:
        """Delete attempts older than the one before the last (readers may still hold that one)."""
        fs, pattern = _hadoop(self.spark, f"{place}/attempt=*/_SUCCESS")
        published = sorted(s.getPath().getParent().toString() for s in fs.globStatus(pattern) or [])
        for old in published[:-keep]:
            fs.delete(_hadoop(self.spark, old)[1], True)

    # -- compaction --------------------------------------------------------
    def size_of(self, path: str) -> int:
        fs, hpath = _hadoop(self.spark, path)
        return fs.getContentSummary(hpath).getLength()

    def compact(self, name: str, target_bytes: int = 128 << 20, keep_last: int = 2, least: int = 4) -> list[str]:
        """Pack the small closed batches of each writer into files of about ``target_bytes``.

        The last ``keep_last`` batches of a writer stay as they are: a restart may write them
        again.  Publishing the new folder is one step.  What it replaces goes in the next call, so
        readers that began before keep their files, and a job that dies between the two steps
        leaves nothing but folders that no reader takes.  Returns the new folders.
        """
        if name not in STREAM_TABLES:
            raise ValueError(f"{name} is no stream table")
        self._sweep(name)
        by_writer, out = defaultdict(list), []
        for p in self.partitions(name):
            by_writer[p.writer].append(p)
        for writer, held in by_writer.items():
            closed = sorted(held, key=lambda p: p.value)[: max(0, len(held) - keep_last)]
            size = {path: self.size_of(path) for path in {p.path for p in closed}}
            small = [p for p in closed if size[p.path] < target_bytes // 2]
            if len({p.path for p in small}) < least:
                continue
            total = sum(size[path] for path in {p.path for p in small})
            out.append(self._pack(name, writer, small, max(1, -(-total // target_bytes))))
        return out

    def _pack(self, name: str, writer: str, held: list[Partition], files: int) -> str:
        folder = f"{self.path(name)}/writer={writer}/compacted={new_attempt()}"
        rows = self.read_partitions(name, held).drop("writer")
        self._cover(folder, held)
        rows.coalesce(files).write.mode("append").parquet(folder)  # its _SUCCESS publishes
        return folder

    def _cover(self, folder: str, held: list[Partition]) -> None:
        fs, hpath = _hadoop(self.spark, f"{folder}/_covers.json")
        stream = fs.create(hpath, True)
        try:
            stream.write(bytearray(json.dumps({p.value: p.attempt for p in held}).encode()))
        finally:
            stream.close()

    def _sweep(self, name: str) -> None:
        """Delete the batch folders and compacted folders that a published compacted folder replaces."""
        taken = {p.path for p in self.partitions(name)}
        folders = self.compacted_folders(name)
        covered = {(f.split("/")[-2].split("=", 1)[1], value): attempt for f in folders for value, attempt in self.covers(f).items()}
        for p in self.attempts(name):
            if p.path not in taken and p.attempt <= covered.get(p.id, ""):
                self.delete_path(p.path)

    @staticmethod
    def check_writer(name: str, writer: str | None) -> None:
        if (name in STREAM_TABLES) != (writer is not None):
            raise ValueError(f"{name}: a writer is needed for stream tables and for no others")

    # -- runs --------------------------------------------------------------
    def claim_run(self, run_id: int | None = None) -> int:
        """A run id that no other run has: the next free one, claimed by creating its file.

        A run that begins while another one is unfinished is marked as overlapping: both may
        insert the same keys, so the ledger is then read by key.
        """
        ended = {p.value for p in self.partitions("reconciliation_log")}
        if run_id is None:
            run_id = 1 + max(ended, default=0)
            while not create_exclusively(self.spark, f"{self.root}/_runs/{run_id}"):
                run_id += 1
        else:
            create_exclusively(self.spark, f"{self.root}/_runs/{run_id}")
        others = {int(x) for x in self._names("_runs/*") if x.isdigit()} - ended - {run_id}
        if others:
            create_exclusively(self.spark, f"{self.root}/_runs/{run_id}.overlaps")
        return run_id

    def overlapping_runs(self) -> list[int]:
        return [int(x.split(".")[0]) for x in self._names("_runs/*.overlaps")]

    def _names(self, pattern: str) -> list[str]:
        fs, hpath = _hadoop(self.spark, f"{self.root}/{pattern}")
        return [s.getPath().getName() for s in fs.globStatus(hpath) or []]

    def staging_path(self, run_id: int, what: str) -> str:
        """A fresh staging folder of one attempt of one run."""
        return f"{self.root}/_staging/run_id={run_id}/{what}-{new_attempt()}"

    def new_snapshot_path(self, run_id: int) -> str:
        return f"{self.root}/warehouse/validated/run_id={run_id}/attempt={new_attempt()}"

    def delete_path(self, path: str) -> None:
        fs, hpath = _hadoop(self.spark, path)
        fs.delete(hpath, True)
