"""Accounting of micro-batches: rows read, and rows that the watermark dropped.

Spark counts late rows in each stateful operator, after the sink has run, so a listener
takes them from the progress of a batch and stores them beside it, under the same
writer and batch id.  A batch that is run again replaces its counts.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from .. import schemas
from ..sinks.store import TableStore


def progress_rows(progress: dict, query: str) -> list[tuple]:
    """One row for the batch and one for each stateful operator that dropped late rows."""
    mark = progress.get("eventTime", {}).get("watermark")
    operators = progress.get("stateOperators", [])
    late = sum(op.get("numRowsDroppedByWatermark", 0) for op in operators)
    state = sum(op.get("numRowsTotal", 0) for op in operators)
    out = [(query, None, progress.get("numInputRows", 0), late, state, mark)]
    for k, op in enumerate(operators):
        if op.get("numRowsDroppedByWatermark", 0):
            out.append((query, f"{k}:{op['operatorName']}", None, op["numRowsDroppedByWatermark"], op.get("numRowsTotal", 0), mark))
    return out


class ProgressLog(StreamingQueryListener):
    """Stores the progress of the queries that it follows."""

    def __init__(self, spark: SparkSession, store: TableStore):
        self.spark, self.store = spark, store
        self.names: dict[str, str] = {}
        self.waiting: dict[str, list[dict]] = {}  # batches that ended before ``follow`` was called

    def attach(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def follow(self, query, name: str) -> None:
        self.names[str(query.id)] = name
        for progress in self.waiting.pop(str(query.id), []):
            self.record(progress)

    def record(self, progress: dict) -> None:
        name = self.names.get(progress["id"])
        if name is None:
            self.waiting.setdefault(progress["id"], []).append(progress)
            return
        frame = self.spark.createDataFrame(progress_rows(progress, name), schemas.PROGRESS_SCHEMA).coalesce(1)
        self.store.write_partition("stream_progress", frame, int(progress["batchId"]), progress["id"])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(store: TableStore):
    """Late rows by query, batch and operator."""
    rows = store.read("stream_progress")
    return rows.where("operator is not null").select("query", "batch_id", "operator", "late_rows", "watermark")
