"""The corpus pipeline: filter, clean, deduplicate, decontaminate and pack documents.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; its result is written as Parquet and reread.

Defined results of every stage: texts of any length are read whole; rows that repeat in full share
one decision (the join keeps one of them); a null id is an id like others; other columns pass through
unchanged, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import fresh, materialize, table
from cardsentry.llm.decontaminate import decontaminated
from cardsentry.llm.jaccard_join import one_of_each
from cardsentry.llm.line_dedup import drop_boilerplate
from cardsentry.llm.packing import pack
from cardsentry.llm.quality_classifier import with_scores
from cardsentry.llm.queries import QUALITY_LIMIT, quality_model, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored as padding; a score equal to the limit is kept.
    """
    score = fresh("score")
    model = quality_model(spark, docs, sf_dir)
    return with_scores(spark, docs, model, into=score).where(F.col(score) >= QUALITY_LIMIT).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its source's boilerplate lines.

    Null and empty texts come back unchanged; a null source is a source of its own.
    """
    return drop_boilerplate(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id.

    Null texts and texts without words are kept, each as its own group; rows that repeat in full
    are kept once.  Where ids repeat, the smallest hash of id and text is kept.
    """
    return one_of_each(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts are clean; null items match nothing; an empty benchmark keeps all.
    """
    return decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences.

    Null and empty texts are the end id alone; repeated rows are packed as often as they occur.
    """
    return pack(spark, docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontaminate", decontamination),
    ("packing", packing),
]

#: The classifier is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
