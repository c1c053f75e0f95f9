"""URL filter: rules first, then the reputation of the host by empirical Bayes. Native throughout.

Outcomes of labelled pages are counted per host, and added up per registered domain and suffix.
Each level is shrunk to the one above it with a beta-binomial prior: the prior's mean is the
parent's posterior mean; its weight comes from how much siblings differ (method of moments) and from
how much is known of the parent. A host
is blocked if even the optimistic bound of its posterior share of good pages is too low, so a host
that nobody has labelled lives on the reputation of its domain.

The suffix of a host is its last label, or its last two where those are in a list of suffixes under
which anybody may register; the registered domain is one label more. The list shipped is short: under
a suffix that it lacks, unrelated sites share a prior. A port is no part of a label, and an address of
numbers is a domain and a suffix of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.sources.workspace import materialize

Rule = tuple[str, str, str]

# A host is blocked if the bound of its share of good pages is below LEAST_GOOD; the bound is
# BOUND_Z standard deviations above the centre, on the scale of log odds.
LEAST_GOOD = 0.5
BOUND_Z = 1.64
# Range of the correlation of outcomes within a node: the prior weighs 1 / correlation - 1 pages.
CORRELATION = (0.02, 0.5)
# Common suffixes of two labels; more can be given.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.jp", "co.kr", "co.in",
    "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "github.io", "gitlab.io", "blogspot.com", "wordpress.com",
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``? #``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, ties to the first in order; null if none does.

    A rule ``(verdict, host, path)`` fits its host and all subdomains where the path starts with the
    rule's. Rules are a short list given by the caller; they become one CASE expression.
    """
    text = verdict = None
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, value = F.lit(rule_host + rule_path), F.lit(decision)
        text = F.when(fits, name) if text is None else text.when(fits, name)
        verdict = F.when(fits, value) if verdict is None else verdict.when(fits, value)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def levels(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    number = bare.rlike(r"^[0-9.]+$") | bare.startswith("[")
    two = F.substring_index(bare, ".", -2)
    shared = two.isin(*suffixes) if suffixes else F.lit(False)
    domain = F.when(number, bare).when(shared, F.substring_index(bare, ".", -3)).otherwise(two)
    suffix = F.when(number, bare).when(shared, two).otherwise(F.substring_index(bare, ".", -1))
    return domain, suffix


def _prior_weight(nodes: DataFrame) -> float:
    """How many pages the prior of a level weighs, from nodes with n, good and their parent's m."""
    spread = F.col("m") * (1 - F.col("m"))
    gap = (F.col("good") - F.col("n") * F.col("m")) ** 2 / F.col("n") - spread
    sums = nodes.where("n > 0").agg(F.sum(gap), F.sum(spread * (F.col("n") - 1))).head()
    low, high = CORRELATION
    return 1 / min(max(sums[0] / sums[1] if sums[1] else low, low), high) - 1


def _weighed(nodes: DataFrame) -> DataFrame:
    """Adds ``w``, the weight of a node's prior: it is no surer than what is known of the parent."""
    return nodes.withColumn("w", 1 / (F.lit(1 / _prior_weight(nodes)) + 1 / F.col("p")))


def _posterior() -> list[Column]:
    """Mean ``m`` and weight ``p`` of the nodes, for the level below."""
    p = F.col("n") + F.col("w")
    return [((F.col("good") + F.col("w") * F.col("m")) / p).alias("m"), p.alias("p")]


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """One row per host of ``pages``: n, good, share (posterior mean) and bound.

    ``pages`` has page_id and host, ``outcomes`` page_id and good (1 or 0; null is no outcome). A
    page or an outcome that repeats counts each time. Without any outcome the shares are 0.5.
    """
    # One row per id first: an id that repeats on both sides makes no products of rows.
    each = outcomes.where("good is not null").groupBy("page_id").agg(F.count("good").alias("n"), F.sum("good").alias("good"))
    labelled = pages.join(each, "page_id", "left")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n", "good")]
    counts = labelled.groupBy("host").agg(*sums)
    domain, suffix = levels(F.col("host"), suffixes)
    counts = counts.withColumns({"domain": domain, "suffix": suffix})
    hosts = materialize(counts, "hosts")

    totals = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    every = hosts.agg(*totals).head()
    # One pseudo outcome each way keeps the top level inside (0, 1).
    top = ((every["good"] or 0) + 1) / ((every["n"] or 0) + 2)
    suffixes = hosts.groupBy("suffix").agg(*totals).withColumns({"m": F.lit(top), "p": F.lit(float((every["n"] or 0) + 2))})
    suffixes = suffixes.transform(_weighed).select("suffix", *_posterior())
    domains = hosts.groupBy("suffix", "domain").agg(*totals).join(suffixes, "suffix")
    domains = domains.transform(_weighed).select("domain", *_posterior())
    nodes = hosts.join(domains, "domain").transform(_weighed)
    a = F.col("good") + F.col("w") * F.col("m")
    b = F.col("n") - F.col("good") + F.col("w") * (1 - F.col("m"))
    odds = F.log(a / b) + F.lit(BOUND_Z) * F.sqrt(1 / a + 1 / b)
    return nodes.select("host", "n", "good", (a / (a + b)).alias("share"), (1 / (1 + F.exp(-odds))).alias("bound"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    page_id: str = "page_id",
    url: str = "url",
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's share and bound.

    A null url, or one without ``://``, has empty host and path; such pages share one reputation.
    Null ids are judged, but have no outcome. Repeated rows are judged each. Columns of the input
    besides the two named are not read. An empty table gives no rows.
    """
    parts = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    known = reputation(parts.select("page_id", "host"), outcomes, suffixes).select("host", "share", "bound")
    rule, decision = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") < LEAST_GOOD, "block").otherwise("allow")
    return parts.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, own).alias("verdict"), "share", "bound"
    )
