"""Lines that many documents of one host share; counts and removal flags.

Shared by the line-frequency rules and the site-relative line dedup.  Built
from DataFrame functions only.

A document is one row; its host is the ``source`` column (null is a host of
its own).  Lines are compared after lower-casing and collapsing ASCII white
space; lines without a word are never counted or removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, fresh, let, materialize

#: ASCII white space.
SPACE = r"\x20\x09-\x0D"


def lines(text: Column) -> Column:
    """The ``\\n``-separated lines as written."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def normal_lines(text: Column) -> Column:
    """One normalised line for each written line (blank lines become '')."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(flat, "\n"), lambda x: F.trim(x))


def line_keys(text: Column) -> Column:
    """64-bit key of each line; null where the line has no word."""
    return F.transform(normal_lines(text), lambda x: F.when(x != "", F.xxhash64(x)))


def shared_lines(
    spark: SparkSession, docs: DataFrame, text: str, host: str, min_docs: int, ratio: float, most_docs: int | None = None
) -> DataFrame:
    """``(host, line)`` keys found in at least ``min_docs`` documents of the
    host and in more than ``ratio`` of them (or, if given, in more than ``most_docs``);
    written to the shared folder.

    Each document first reduces its lines to distinct keys, so a count of
    rows is a count of documents.  The count is combined on the map side and
    keyed by (host, line): neither a hot host nor a hot line reaches one task
    as rows.  A host keeps fewer than (mean distinct lines of a document) /
    ``ratio`` lines.
    """
    one = docs.select(F.col(host).alias("host"), F.array_distinct(line_keys(F.col(text))).alias("keys"))
    seen = (
        one.select("host", F.explode("keys").alias("line"))
        .where("line is not null")
        .groupBy("host", "line")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    totals = docs.groupBy(F.col(host).alias("of")).agg(F.count("*").alias("host_docs"))
    over = F.col("n_docs") > F.col("host_docs") * F.lit(ratio)
    if most_docs is not None:
        over |= F.col("n_docs") > F.lit(most_docs)
    flagged = (
        seen.join(totals, F.col("host").eqNullSafe(F.col("of")))
        .where(over)
        .select("host", "line", "n_docs", "host_docs")
    )
    return materialize(spark, flagged, "host-lines")


def with_shared(
    docs: DataFrame, flagged: DataFrame, text: str, host: str, doc_id: str, into: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``into``: the flagged line keys that concern a document (null: none).

    While the flagged table is measured small, its keys by host are broadcast,
    the texts do not move, and each document keeps those that it holds (one
    intersection, so later look-ups are in a short list).  Beyond that, the (document, line) pairs meet
    the flagged lines in a shuffle join and come back as one short list for
    each document, which joins the texts on the document id, never on the host.
    """
    if flagged.limit(broadcast_rows + 1).count() <= broadcast_rows:
        of, every = fresh("host"), fresh("lines")
        by_host = flagged.groupBy(F.col("host").alias(of)).agg(F.collect_list("line").alias(every))
        out = docs.join(F.broadcast(by_host), docs[host].eqNullSafe(by_host[of]), "left")
        own = let(F.array_intersect(line_keys(F.col(text)), F.col(every)), lambda x: F.when(F.size(x) > 0, x))
        return out.withColumn(into, F.when(F.col(every).isNotNull(), own)).drop(of, every)
    pairs = docs.select(
        F.col(doc_id).alias("id"), F.col(host).alias("h"), F.explode(F.array_distinct(line_keys(F.col(text)))).alias("k")
    ).where("k is not null")
    f = flagged.select(F.col("host"), F.col("line"))
    hit = pairs.join(f, (pairs.k == f.line) & pairs.h.eqNullSafe(f.host), "left_semi")
    a, b = fresh("id"), fresh("host")
    per_doc = hit.groupBy(F.col("id").alias(a), F.col("h").alias(b)).agg(F.collect_set("k").alias(into))
    return docs.join(
        per_doc, docs[doc_id].eqNullSafe(per_doc[a]) & docs[host].eqNullSafe(per_doc[b]), "left"
    ).drop(a, b)


def kept_lines(text: Column, shared: Column) -> Column:
    """The written lines that are not flagged, in order."""
    return let(
        line_keys(text),
        lambda keys: let(
            lines(text),
            lambda ls: F.filter(
                ls, lambda _, i: ~F.coalesce(F.array_contains(shared, F.get(keys, i)), F.lit(False))
            ),
        ),
    )
