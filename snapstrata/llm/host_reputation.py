"""URL filtering by host reputation, with empirical-Bayes shrinkage.  Native DataFrame operations only.

Labelled outcomes of a host's pages (bad or not) are shrunk through beta-binomial
priors: a host towards its registered domain, a domain towards its public suffix, a suffix
towards all pages.  The strength of each level's prior comes from the data: with m the
parent's posterior mean, the moment equation of the beta-binomial,

    sum n (k/n - m)^2  =  sum m (1 - m) (1 + (n - 1) rho),

gives the correlation rho, and the prior counts as 1 / rho - 1 pages.  A host is blocked
if its bad rate is above the limit with the certainty asked for: the posterior mean less
z standard deviations.  Rules of the operator come first; the longest that fits wins.

A url that is null or has no ``://`` has an empty host and path, counts for no host, and is
judged by the rate of all pages.  Pages without a label only take part in the result;
hosts without labelled pages have their domain's reputation.  Repeated rows
count as often as they occur; several labels of one page are one, bad if any is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: suffixes of two labels below which names are registered; all others are the last label
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br")
MAX_BAD_RATE = 0.5
CERTAINTY_Z = 1.645
RHO_RANGE = (0.001, 0.5)


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit(f".{self.host}"))) & F.startswith(path, F.lit(self.path))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    known = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    behind = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    authority = F.regexp_extract(behind, r"^[^/?#]*", 0)
    rest = F.substring(behind, F.length(authority) + 1, F.length(url))
    host = F.translate(authority, CAPITALS, CAPITALS.lower())
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def _suffixes(two_label: tuple[str, ...]) -> str:
    return "|".join(s.replace(".", r"\.") for s in two_label)


def suffix_of(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    return F.regexp_extract(host, rf"(^|\.)({_suffixes(two_label)}|[^.]*)\z", 2)


def domain_of(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    return F.regexp_extract(host, rf"(^|\.)([^.]+\.(?:{_suffixes(two_label)})|[^.]+\.[^.]*|[^.]*)\z", 2)


def _strength(children: DataFrame) -> DataFrame:
    """One row: how many pages the prior of this level counts for; children have n, k and the parent's mean m."""
    spread = F.sum(F.when(F.col("n") > 0, F.col("n") * F.pow(F.col("k") / F.nullif(F.col("n"), F.lit(0)) - F.col("m"), F.lit(2)) - F.col("m") * (1 - F.col("m"))))
    most = F.sum(F.when(F.col("n") > 0, F.col("m") * (1 - F.col("m")) * (F.col("n") - 1)))
    rho = F.coalesce(F.when(most > 0, spread / most), F.lit(RHO_RANGE[0]))
    held = F.greatest(F.lit(RHO_RANGE[0]), F.least(F.lit(RHO_RANGE[1]), rho))
    return children.agg((1 / held - 1).alias("s"))


def _shrunk(children: DataFrame) -> DataFrame:
    """Adds the posterior's parameters a and b, and its mean.  The one-row strength is a scalar for every child."""
    strength = _strength(children)
    return (
        children.crossJoin(F.broadcast(strength))  # one row
        .withColumn("a", F.col("k") + F.col("s") * F.col("m"))
        .withColumn("b", F.col("n") - F.col("k") + F.col("s") * (1 - F.col("m")))
        .withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        .drop("s")
    )


def host_reputation(outcomes: DataFrame, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """outcomes: host, bad (boolean, null if unlabelled).  A row per host: host, n, k, a, b, mean; and '' for all pages."""
    counted = F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k")
    hosts = (
        outcomes.groupBy("host").agg(*counted)
        .withColumn("domain", domain_of(F.col("host"), two_label))
        .withColumn("suffix", suffix_of(F.col("host"), two_label))
    )
    named = hosts.where("host <> ''")
    totals = F.sum("n").alias("n"), F.sum("k").alias("k")
    # a uniform prior stands above all pages
    every = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m"))
    suffixes = _shrunk(named.groupBy("suffix").agg(*totals).crossJoin(F.broadcast(every)))  # one row
    above = suffixes.select("suffix", F.col("mean").alias("m"))
    domains = _shrunk(named.groupBy("domain", "suffix").agg(*totals).join(above, "suffix"))
    above = domains.select("domain", F.col("mean").alias("m"))
    posterior = _shrunk(named.select("host", "domain", "n", "k").join(above, "domain"))
    whole = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    whole = whole.select(F.lit("").alias("host"), "n", "k", (F.col("k") + 1.0).alias("a"), (F.col("n") - F.col("k") + 1.0).alias("b"))
    whole = whole.withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
    return posterior.select("host", "n", "k", "a", "b", "mean").unionAll(whole)


def posterior_bound(z: float = CERTAINTY_Z) -> Column:
    """The rate that the bad rate is above, with the certainty of z."""
    a, b = F.col("a"), F.col("b")
    return F.col("mean") - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: list[UrlRule], page_id: str = "page_id", url: str = "url",
    document_of: Column | None = None, doc_id: str = "doc_id", bad: Column | None = None,
    max_bad_rate: float = MAX_BAD_RATE, z: float = CERTAINTY_Z, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages.

    document_of gives the labelled document that a page holds (default: page_id), bad its
    outcome from the columns of labels (default: quality is 0 or toxic is 1).
    """
    outcome = bad if bad is not None else (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled_doc")).agg(F.bool_or(outcome).alias("bad"))
    host, path = url_parts(F.col(url))
    parts = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
        (document_of if document_of is not None else F.col(page_id)).alias("document"),
    )
    outcomes = parts.select("host", "document").join(known, F.col("document") == F.col("labelled_doc"), "left").select("host", "bad")
    judged = host_reputation(outcomes, two_label).select("host", (posterior_bound(z) > max_bad_rate).alias("bad_host"))
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, decided = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(decided)
    by_host = F.when(F.coalesce("bad_host", F.lit(False)), "block").otherwise("allow")
    return parts.join(judged, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, by_host).alias("verdict")
    )
