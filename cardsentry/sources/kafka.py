"""Kafka source and sink options (connector jar supplied by the cluster)."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, RuleConfig


def kafka_reader_options(cfg: RuleConfig = DEFAULT, starting_offsets: str | None = None) -> dict:
    """Options of the transaction topic subscription.

    Pass one resolved ``starting_offsets`` (a JSON offsets map) to every
    query reading the topic so they all start at the same position.
    """
    opts = {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap,
        "subscribe": cfg.kafka_topic,
        "startingOffsets": starting_offsets or cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.start_timestamp_ms is not None and not starting_offsets:
        # the first start of a query: messages from this moment on, the end of a quiet partition
        opts["startingTimestamp"] = str(cfg.start_timestamp_ms)
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    opts.update(cfg.extra_kafka_options)
    return opts


def start_now(cfg: RuleConfig) -> RuleConfig:
    """``latest`` resolved to one moment, so that all queries of a job start at the same position."""
    if cfg.starting_offsets != "latest" or cfg.start_timestamp_ms is not None:
        return cfg
    return replace(cfg, start_timestamp_ms=int(time.time() * 1000))


def kafka_stream(
    spark: SparkSession, cfg: RuleConfig = DEFAULT, starting_offsets: str | None = None
) -> DataFrame:
    """Streaming DataFrame with the Kafka ``value`` column (BINARY)."""
    return spark.readStream.format("kafka").options(**kafka_reader_options(cfg, starting_offsets)).load()


def kafka_writer_options(cfg: RuleConfig = DEFAULT, topic: str | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": cfg.kafka_bootstrap, "topic": topic or cfg.kafka_topic}
    opts.update(cfg.extra_kafka_options)
    return opts


def write_kafka(encoded: DataFrame, cfg: RuleConfig = DEFAULT, topic: str | None = None) -> None:
    """Batch-publish ``(key?, value)`` rows built by ``encode_events``."""
    encoded.write.format("kafka").options(**kafka_writer_options(cfg, topic)).save()
