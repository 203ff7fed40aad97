"""URL filters: rules first, then empirical-Bayes reputation of the host.

Labelled pages are good or bad. The good rate of a host is shrunk towards that of its
registered domain, the domain's towards its suffix, the suffix's towards all pages, each
by a beta-binomial prior whose strength is estimated from how much the rates of one level
differ within the next. A host is blocked when even the upper bound of its posterior good
rate is low beside the rate of all pages. All of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import stored

# (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Public suffixes of two labels; any other last label is a suffix.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn",
    "com.mx", "com.tr", "gov.uk", "ne.jp", "or.jp", "org.au", "org.uk",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "://([^/?#]*)([^?#]*)"
# Standard deviations of the upper bound, and the share of the good rate of all pages below
# which it lies for a host that is blocked.
Z, LEAST_SHARE = 1.64, 0.6
# Intraclass correlations are kept between these; one that cannot be estimated is _RHO.
_RHO_RANGE, _RHO = (0.001, 0.5), 0.1


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Both empty for a null url and for one without ``://``."""
    part = [F.coalesce(F.regexp_extract(F.col(url), _URL, k), F.lit("")) for k in (1, 2)]
    return F.translate(part[0], _UPPER, _LOWER), part[1]


def matching_rule(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, the first of equals;
    null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for its, host, path in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col(
            "path"
        ).startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(its)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix() -> tuple[Column, Column]:
    labels = F.split("host", r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    known = two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(known, two).otherwise(F.element_at(labels, -1))
    more = F.when(known, F.lit(3)).otherwise(F.lit(2))
    domain = F.when(
        F.size(labels) >= more, F.array_join(F.slice(labels, F.size(labels) - more + 1, more), ".")
    ).otherwise(F.col("host"))
    return domain, suffix


def _strength(children: DataFrame) -> float:
    """Prior strength of a level from its groups (n, k) within their parents (pn, pk):
    the analysis-of-variance estimate of the intraclass correlation."""
    rate, parent = F.try_divide("k", "n"), F.try_divide("pk", "pn")
    s = (
        children.where("n > 0")
        .groupBy("parent")
        .agg(
            F.count("*").alias("groups"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * (rate - parent) ** 2).alias("between"),
            F.sum(F.col("k") * (1 - rate)).alias("within"),
            F.sum(F.try_divide(F.col("n") * F.col("n"), "pn")).alias("squares"),
        )
        .agg(
            F.count("*").alias("parents"),
            *[F.sum(c).alias(c) for c in ("groups", "n", "between", "within", "squares")],
        )
        .first()
    )
    rho = _RHO
    if s.parents and s.groups > s.parents and s.n > s.groups:
        between = s.between / (s.groups - s.parents)
        within = s.within / (s.n - s.groups)
        size = (s.n - s.squares) / (s.groups - s.parents)
        if between + (size - 1) * within > 0:
            rho = (between - within) / (between + (size - 1) * within)
            rho = min(max(rho, _RHO_RANGE[0]), _RHO_RANGE[1])
    return (1 - rho) / rho


def _with_parent(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """``parents``: key, n, k, mean."""
    named = parents.select(
        F.col(key).alias("parent"),
        F.col("n").alias("pn"),
        F.col("k").alias("pk"),
        F.col("mean").alias("prior"),
    )
    return children.join(named, F.col(key) == F.col("parent"))


def _posterior_mean(strength: float) -> Column:
    return (F.lit(strength) * F.col("prior") + F.col("k")) / (F.lit(strength) + F.col("n"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, good_rate, upper, all_pages) for every host of the pages (page_id, host): the
    mean and upper bound of its posterior good rate, and the good rate of all pages. The
    bound is taken on the log-odds, where a beta distribution is nearly normal, so that it
    lies between 0 and 1.

    ``outcomes``: (page_id, good) with good 0 or 1; of several for one id the worst
    counts, and a null one is none. Hosts without labelled pages take over their domain's
    rate. Counts cover all pages; totals of domains and suffixes are sums of those of
    hosts. Every table is stored before it is joined, so that adaptive execution can split
    a suffix or domain that holds most hosts. Three rows of sums come to the driver.
    """
    outcomes = outcomes.where("good is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    domain, suffix = domain_and_suffix()
    hosts = (
        pages.join(outcomes, "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("k"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    hosts = stored(hosts, "hosts")
    total = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = stored(hosts.groupBy("domain", "suffix").agg(*total), "domains")
    suffixes = stored(domains.groupBy("suffix").agg(*total), "suffixes")
    n, k = suffixes.agg(*[F.coalesce(c, F.lit(0)) for c in total]).first()
    mean = (k + 1) / (n + 2)

    below = suffixes.select(
        "*", F.lit("").alias("parent"), F.lit(n).alias("pn"), F.lit(k).alias("pk"),
        F.lit(mean).alias("prior"),
    )
    for children, key in ((domains, "suffix"), (hosts, "domain")):
        parents = stored(below.withColumn("mean", _posterior_mean(_strength(below))), "level")
        below = _with_parent(children, parents, key)
    strength = _strength(below)
    good = F.lit(strength) * F.col("prior") + F.col("k")
    bad = F.lit(strength) * (1 - F.col("prior")) + F.col("n") - F.col("k")
    odds = F.log(good / bad) + Z * F.sqrt(1 / good + 1 / bad)
    return below.select(
        "host",
        _posterior_mean(strength).alias("good_rate"),
        (1 / (1 + F.exp(-odds))).alias("upper"),
        F.lit(mean).alias("all_pages"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, good_rate, upper.

    The verdict is the longest fitting rule's, else ``block`` where the upper bound of the
    host's good rate is below ``least_share`` of the rate of all pages, else ``allow``. Urls without a host share
    the empty host; repeated rows and null ids are judged like any other and count as
    pages of their host.
    """
    host, path = host_and_path()
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    reputation = stored(host_reputation(pages.select("page_id", "host"), outcomes), "reputation")
    rule, verdict = matching_rule(rules)
    low = F.col("upper") < least_share * F.col("all_pages")
    method = F.when(low, F.lit("block")).otherwise(F.lit("allow"))
    return pages.join(reputation, "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"),
        "good_rate",
        "upper",
    )
