"""Quality rules with cross-document line frequency (DataFrame functions only).

Per-text counts decide the base rules.  Then every normalised line is hashed,
the distinct documents of each host that contain it are counted, lines above
a share of the host's documents or above an absolute number are removed, and documents that lose more than half of their words
are rejected as depleted.

Defined results: null or empty text has no words and fails the base rules;
repeated rows each count as a document; a null host is a host of its own; a text of
any length is judged whole; a count equal to a limit is within it; an empty table gives
an empty result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, let
from .host_lines import SPACE, line_keys, lines, normal_lines, shared_lines, with_shared

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line may stand in at most this share of a host's documents (5 at least), and in at most so many.
LINE_RATIO, LINE_MIN_DOCS, LINE_MOST_DOCS = 0.08, 5, 1000
#: A document that loses more than this percentage of its words is depleted.
MAX_REMOVED_PERCENT = 50


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows become 64-bit keys.  Most texts repeat none, which the distinct
    count shows; else (key, position) pairs are sorted, neighbours with equal
    keys mark repeated windows, and the marked positions' union is measured
    from one sorted pass.
    """

    def covered(keys: Column) -> Column:
        ordered = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def marked(s: Column) -> Column:
            same = lambda a, b: F.coalesce(F.get(s, a)["k"] == F.get(s, b)["k"], F.lit(False))
            hits = F.filter(s, lambda _, j: same(j - 1, j) | same(j, j + 1))
            return F.sort_array(F.transform(hits, lambda x: x["i"]))

        total = F.aggregate(
            let(ordered, marked),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        )
        return total["n"]

    keys = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    found = let(keys, lambda k: F.when(F.size(F.array_distinct(k)) < F.size(k), covered(k)).otherwise(0))
    return F.when(F.size(w) >= 4, found).otherwise(0)


def text_counts(text: Column) -> Column:
    """Struct of the base counts, computed from one split of the text."""
    has_word = F.filter(lines(text), lambda x: x.rlike(f"[^{SPACE}]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(has_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    return let(words(text), counts)


def words_in_shared(text: Column, shared: Column) -> Column:
    """Words of the lines whose key is among ``shared``."""
    return let(
        line_keys(text),
        lambda keys: F.aggregate(
            F.filter(normal_lines(text), lambda _, i: F.coalesce(F.array_contains(shared, F.get(keys, i)), F.lit(False))),
            F.lit(0),
            lambda n, x: n + F.size(F.split(x, " ")),
        ),
    )


def apply_rules(
    spark: SparkSession, docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
    line_ratio: float = LINE_RATIO, line_min_docs: int = LINE_MIN_DOCS, line_most_docs: int | None = LINE_MOST_DOCS,
    max_removed_percent: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``removed_words`` and ``kept``."""
    flagged = shared_lines(spark, docs, text, host, line_min_docs, line_ratio, line_most_docs)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    shared = fresh("shared")
    out = with_shared(narrow, flagged, "text", "host", "doc_id", shared)
    out = out.select(
        "doc_id",
        text_counts(F.col("text")).alias("c"),
        F.coalesce(
            F.when(F.col(shared).isNotNull(), words_in_shared(F.col("text"), F.col(shared))), F.lit(0)
        ).cast("long").alias("removed_words"),
    ).select("doc_id", "c.*", "removed_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * F.col("removed_words") > max_removed_percent * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
