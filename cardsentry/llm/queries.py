"""Registered queries of the training-data operators: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_crc, let, table

#: Documents that score lower are predicted to be of bad quality.
QUALITY_LIMIT = 0.3

QueryFn = Callable[[SparkSession, str], DataFrame]


#: The written rules of the URL filter.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(spark, table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (document, benchmark item) pairs in which the document holds the item."""
    from .decontaminate import leaks

    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that also start elsewhere."""
    from .suffix_dedup import remove_repeats

    return remove_repeats(spark, table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import scratch_path
    from .token_output import read_shards, write_shards

    folder = scratch_path(spark, "llm-token-shards")
    docs = table(spark, sf_dir, "documents")
    # the vocabulary has 50,257 ids: two bytes hold one
    manifest = write_shards(spark, docs, folder, tokenizer_file("byte_bpe_50k.json"), end_id=0, id_bytes=2)
    return read_shards(spark, manifest, folder, id_bytes=2)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import Training, fit, identify, sample

    docs = table(spark, sf_dir, "documents")
    held_out = doc_crc(F.col("doc_id")) % 4 == 2
    cfg = Training()
    usable = F.coalesce(~held_out, F.lit(False))
    model = fit(sample(docs, cfg, "doc_id", "text", "lang", usable), cfg)
    out = identify(spark, docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document that its path names (``/en/123``)."""
    from .url_filter import judge

    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(
        F.col("doc_id").cast("string").alias("ref"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    ).where("ref is not null and bad is not null")
    number = F.regexp_extract(F.col("path"), r"^/[a-z]{2}/(\d+)(?:[./].*)?$", 1)
    return judge(spark, table(spark, sf_dir, "pages"), outcomes, URL_RULES, F.when(number != "", number))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Classifier fitted to the labelled documents outside the held-out fold."""
    from .quality_classifier import Training, fit, sample

    usable = F.coalesce(doc_crc(F.col("doc_id")) % 5 != 0, F.lit(False))
    rows, share = sample(docs, table(spark, sf_dir, "labels"), Training(), "doc_id", "text", "quality", usable)
    return fit(rows, share)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import with_scores

    docs = table(spark, sf_dir, "documents")
    out = with_scores(spark, docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return out.select(
        "doc_id", (doc_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_rules

    return apply_rules(spark, table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and the number of verified links of its text."""
    from .jaccard_join import counted

    return counted(spark, table(spark, sf_dir, "documents")).select("doc_id", "class_id", "text_class", "n_links")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its line counts and its text without boilerplate lines."""
    from .line_dedup import drop_boilerplate

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = drop_boilerplate(spark, docs, n_lines="n_lines", n_dropped="n_dropped")
    return out.select("doc_id", "n_lines", "n_dropped", "text")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents, one in ten with its tail repeating a stretch of its own words.

    With ``h`` the id's checksum and ``g = h // 10``: if ``h % 10`` is 0, each of the n
    words from word ``a = g % n`` on becomes one of the ``1 + (n - a) // (3 + g % 8)``
    words there, in turn.
    """
    h = doc_crc(F.col("doc_id"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)

        def tail(a: Column) -> Column:
            period = 1 + F.floor((n - a) / (3 + g % 8))
            at = F.sequence(F.lit(0), n - 1)
            return F.array_join(F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int"))), " ")

        return F.when(n > 0, let((g % n).cast("int"), tail))

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    edited = F.coalesce(let(words, repeated), F.col("text"))
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, its longest run, and digests of all runs and of the collapsed text."""
    from .periodic_runs import periodic_runs

    found = periodic_runs(spark, with_planted_runs(table(spark, sf_dir, "documents")))
    # longest, then first, then shortest period: the smallest of (-length, start, period)
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.withColumn("best", first).withColumn("length", -F.col("best.less"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), "length",
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    from .lexical_rank import ranked

    return ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and the likeness to that and to the next document."""
    from .fingerprints import compare_versions, with_edit, with_next

    rows = with_edit(with_next(spark, table(spark, sf_dir, "documents")))
    # what comes from the texts alone goes through the comparison as its key
    about = F.struct("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    found = compare_versions(spark, rows.withColumn("about", about), "about", "text", ["edited", "next"])
    return found.select(
        "about.*", "fingerprint", "fingerprint_edited", "near_edited", "near_next", "cells_edited", "cells_next"
    ).withColumnRenamed("fingerprint_edited", "edited_fingerprint")


def registry() -> dict[str, QueryFn]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
