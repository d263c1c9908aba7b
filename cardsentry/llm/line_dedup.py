"""Line dedup by site-relative frequency (DataFrame functions only).

Pages are grouped by host; a line's share is the number of the host's pages
that contain it divided by the host's pages.  Lines whose share exceeds the
boilerplate ratio (and that at least ``min_docs`` pages of the host contain)
are dropped from every page of that host.

Defined results: null or empty text has no lines and comes back unchanged;
blank lines stay; a line repeated within one page counts once; a null host is
a host of its own; repeated rows each count as a page; a share equal to the ratio is kept; texts of
any length are read whole; an empty table gives an empty result; other columns pass
through, whatever their names (own columns get names that cannot clash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh
from .host_lines import kept_lines, lines, shared_lines, with_shared

#: Production parameters: a line on more than 8 % of a host's pages, and on
#: at least 5 of them, is boilerplate.
MIN_DOCS, RATIO = 5, 0.08


def drop_boilerplate(
    spark: SparkSession, docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
    min_docs: int = MIN_DOCS, ratio: float = RATIO, into: str | None = None, n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines dropped from ``text``.

    ``into`` writes the cleaned text to another column instead; ``n_lines``
    and ``n_dropped`` name optional counters of written and dropped lines.
    """
    flagged = shared_lines(spark, docs, text, host, min_docs, ratio)
    shared, kept = fresh("shared"), fresh("kept")
    out = with_shared(docs, flagged, text, host, doc_id, shared)
    # documents without a flagged line are left as they are
    out = out.withColumn(
        kept, F.when(F.col(text).isNotNull() & F.col(shared).isNotNull(), kept_lines(F.col(text), F.col(shared)))
    )
    written = F.size(lines(F.col(text)))
    if n_lines:
        out = out.withColumn(n_lines, F.when(F.coalesce(F.col(text), F.lit("")) == "", 0).otherwise(written).cast("long"))
    if n_dropped:
        out = out.withColumn(n_dropped, F.coalesce(written - F.size(F.col(kept)), F.lit(0)).cast("long"))
    cleaned = F.when(F.col(kept).isNotNull(), F.array_join(F.col(kept), "\n")).otherwise(F.col(text))
    return out.withColumn(into or text, cleaned).drop(shared, kept)
