"""URL filter: written rules first, then empirical-Bayes host reputation.

A host's labelled page outcomes are shrunk towards its registered domain,
the domain towards its public suffix, the suffix towards all pages.  Each
level's prior is a beta distribution whose mean is the level above and whose
strength is fitted by the method of moments for beta-binomial counts.  A host
is blocked when the lower credible bound of its rate of bad pages exceeds the
limit; a host with few outcomes stays close to its prior and is let through.

Defined results: a url that is null or has no ``://`` has an empty host and
path (all such pages form one host); user names and ports are part of the host that is
returned, but not of the site that is judged; sites without outcomes take their
domain's prior; repeated rows count as pages; no outcomes at all means that
every site is allowed; a bound equal to the limit is allowed; of rules of one length that fit
the first counts; urls of any length are read whole; an empty table gives an empty result; only
the named columns are read, so other columns cannot clash.

Only per-host counts are joined: pages are counted by (host, outcome key)
before the outcomes arrive, so a host with a third of all pages is a few
partial sums.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize

#: Public suffixes of more than one label that the filter knows.
MULTI_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "co.in")


@dataclass(frozen=True)
class Reputation:
    """Parameters of the method's verdict."""

    max_bad_rate: float = 0.4  #: block when the lower bound exceeds this
    z: float = 1.645  #: one-sided 95 % bound, normal approximation to the beta posterior
    multi_suffixes: tuple[str, ...] = MULTI_SUFFIXES


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both '' without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest (host, path, verdict) rule that fits; null if none does."""
    text, verdict = [], []
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text.append(F.when(fits, F.lit(h + p)))
        verdict.append(F.when(fits, F.lit(v)))
    none = F.lit(None).cast("string")
    return F.coalesce(*text, none), F.coalesce(*verdict, none)


def site_of(host: Column) -> Column:
    """The host without a user name before ``@`` and a port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def levels(host: Column, multi: Iterable[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    last1, last2 = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    is_multi = last2.isin(list(multi))
    domain = F.when(is_multi, F.substring_index(host, ".", -3)).otherwise(last2)
    return domain, F.when(is_multi, last2).otherwise(last1)


def _strength(units: DataFrame) -> tuple[float, float]:
    """(mean, strength) of a beta prior over units with ``n`` outcomes, ``k`` bad (one-row aggregate)."""
    r = units.where("n > 0").agg(
        F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("k").alias("k"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    return prior(r["m"], r["n"], r["k"], r["kk"], r["nn"])


def prior(m: int, n: int | None, k: int | None, kk: float | None, nn: float | None) -> tuple[float, float]:
    """Method of moments: between-unit spread beyond binomial noise gives the strength."""
    if not n:
        return 0.0, 1.0
    p = k / n
    noise, room = p * (1 - p), n - nn / n - m + 1
    if m < 2 or noise == 0 or room <= 0:
        return p, 1e4
    spread = (kk - n * p * p - noise * (m - 1)) / (noise * room)
    spread = min(max(spread, 1e-4), 0.99)
    return p, (1 - spread) / spread


def host_reputation(spark: SparkSession, counts: DataFrame, cfg: Reputation = Reputation()) -> DataFrame:
    """``host, n, k, bad_rate, bad_bound, blocked`` from per-host outcome counts ``host, n, k``."""
    domain, suffix = levels(F.col("host"), cfg.multi_suffixes)
    hosts = counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    (p0, c0), (_, c1), (_, c2) = _strength(suffixes), _strength(domains), _strength(hosts)
    s = suffixes.select("suffix", ((F.col("k") + p0 * c0) / (F.col("n") + c0)).alias("s_rate"))
    d = domains.join(s, "suffix").select(
        "domain", "suffix", ((F.col("k") + F.col("s_rate") * c1) / (F.col("n") + c1)).alias("d_rate")
    )
    a = F.col("k") + F.col("d_rate") * c2
    total = F.col("n") + F.lit(c2)
    rate = a / total
    bound = rate - cfg.z * F.sqrt(rate * (1 - rate) / (total + 1))
    return hosts.join(d, ["domain", "suffix"]).select(
        "host", "n", "k", F.round(rate, 6).alias("bad_rate"), F.round(bound, 6).alias("bad_bound"),
        (bound > cfg.max_bad_rate).alias("blocked"),
    )


def judge(
    spark: SparkSession, pages: DataFrame, outcomes: DataFrame, rules: Iterable[tuple[str, str, str]],
    ref: Column, cfg: Reputation = Reputation(), page_id: str = "page_id", url: str = "url",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Verdict for every page, with the reputation of its site.

    ``outcomes`` has ``ref, bad`` (boolean); ``ref`` is the column expression
    over ``host``/``path`` that says which outcome a page carries.
    """
    host, path = split_url(F.col(url))
    own = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    own = own.withColumn("site", site_of(F.col("host")))
    known = outcomes.groupBy("ref").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    # one row for each site and outcome, whatever the number of pages
    seen = own.groupBy("site", ref.alias("ref")).agg(F.count("*").alias("c"))
    counts = seen.join(known, "ref", "left").groupBy(F.col("site").alias("host")).agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("c"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("bad") == 1, F.col("c"))), F.lit(0)).alias("k"),
    )
    rep = host_reputation(spark, materialize(spark, counts, "host-counts"), cfg)
    rep = materialize(spark, rep.withColumnsRenamed({"host": "site", "n": "n_outcomes", "k": "n_bad"}), "reputation")
    if rep.limit(broadcast_rows + 1).count() <= broadcast_rows:
        rep = F.broadcast(rep)
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return own.join(rep, "site").select(
        "page_id", "host", "path", text.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "n_outcomes", "n_bad", "bad_rate", "bad_bound",
    )
