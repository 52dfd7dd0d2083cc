"""URL filter: fixed rules first, then empirical-Bayes host reputation (DataFrame operations only).

A page outcome is 1 (bad) or 0 (good) where a label exists. Counts of outcomes are shrunk through a
beta-binomial hierarchy: the prior of a host is its registered domain's posterior mean, whose prior
is its suffix's, whose prior is the overall rate. The strength of the prior (its pseudo-count) is
fitted at each level by moments over all groups of that level, and kept between ``floor`` and ``ceiling`` (2 and 200: moments
of few groups give no or an unbounded strength). A host is blocked when the lower
bound of its posterior bad rate (mean less ``z`` standard deviations of the beta) is above
``limit``; one bad page of an unknown host therefore blocks nothing.

Suffixes are a table of the public suffix list's form (``read_suffixes``): plain names, ``*.name`` and ``!name``; the
last label of a host is a suffix where no rule fits. By default it holds ``TWO_PART_SUFFIXES`` only. A host is named without
user and port; an address is its own domain and suffix.

Counts are summed per host before anything is joined and written once, so a host holding a third of all pages is
one row after map-side aggregation; the verdict goes back to pages by host.

Defined results: a null url, or one without ``://``, has an empty host and path, takes no part in
the counts and is allowed; a host with fewer than three labels is its own registered domain where
it is a bare suffix; repeated pages count as often as they occur; unlabelled hosts get their
prior's verdict, and without any label no host is blocked; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: The contract's rules: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Second-level public suffixes under which names are registered.
TWO_PART_SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "ne.jp", "or.jp", "com.au", "net.au", "org.au",
                     "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.nz", "co.za"]

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), ASCII_UPPER, ASCII_LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, what in sorted(rules, key=lambda r: len(r[0] + r[1])):    # the longest is tested first
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a file in the public suffix list's form: one a line, up to the first space; ``//`` begins a comment."""
    rule = F.split(F.trim("value"), r"\s")[0]
    return spark.read.text(path).select(rule.alias("rule")).filter("rule <> '' AND NOT startswith(rule, '//')").distinct()


def default_suffixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in TWO_PART_SUFFIXES], "rule string")


def host_name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def named_hosts(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``hosts`` (distinct ``host``, any others) with domain (suffix and one label before it) and suffix.

    A host's tails meet the rules by equality: a plain rule cuts at its tail, a wildcard one label before, and an exception one
    label behind; an exception counts before the others, of those the longest."""
    labels = F.split(host_name(F.col("host")), r"\.")
    tail = lambda at: F.array_join(F.slice("__labels", at + 1, F.size("__labels")), ".")
    split = hosts.withColumn("__labels", labels)
    places = split.select("host", F.posexplode("__labels").alias("i", "label"), "__labels").select("host", "i", tail(F.col("i")).alias("name"))
    rules = suffixes.select(F.regexp_replace("rule", r"^(!|\*\.)", "").alias("name"),
                            F.when(F.col("rule").startswith("!"), 1).when(F.col("rule").startswith("*."), -1).otherwise(0).alias("shift"))
    hits = places.join(rules, "name").withColumn("cut", F.col("i") + F.col("shift")).filter("cut >= 0")
    cuts = hits.groupBy("host").agg(F.coalesce(F.min(F.when(F.col("shift") == 1, F.col("cut"))), F.min("cut")).alias("cut"))
    out = split.join(cuts, "host", "left").withColumn("cut", F.coalesce("cut", F.size("__labels") - 1))
    address = host_name(F.col("host")).rlike(r"^\[.*\]$|^[0-9]+(\.[0-9]+){3}$")
    whole = host_name(F.col("host"))
    return out.select(*hosts.columns, F.when(address, whole).otherwise(tail(F.greatest(F.col("cut") - 1, F.lit(0)))).alias("domain"),
                      F.when(address, whole).otherwise(tail(F.col("cut"))).alias("suffix"))


def strength(groups: DataFrame, n: str, bad: str, mean: str, floor: float, ceiling: float) -> DataFrame:
    """One row: the pseudo-count of the beta prior by moments. The spread of the groups' rates around
    their prior means beyond binomial noise gives the prior's variance fraction rho; strength = 1/rho - 1."""
    m, k = F.col(mean), F.col(n)
    noise = m * (1 - m)
    g = groups.filter(k > 0).agg(
        F.sum((F.col(bad) - k * m) * (F.col(bad) - k * m)).alias("sq"), F.sum(k * noise).alias("bin"),
        F.sum(k * (k - 1) * noise).alias("over"))
    rho = F.when(F.col("over") > 0, (F.col("sq") - F.col("bin")) / F.col("over"))
    return g.select(F.least(F.greatest(F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(ceiling)), F.lit(floor)),
                            F.lit(ceiling)).alias("strength"))


def host_reputation(outcomes: DataFrame, floor: float = 2.0, ceiling: float = 200.0, z: float = 1.645,
                    suffixes: DataFrame | None = None) -> DataFrame:
    """``outcomes``: host, n, bad (one row per host). Adds mean and lower bound of the posterior bad rate."""
    def one(df: DataFrame, value: str) -> Column:   # a one-row frame as a scalar subquery
        return F.coalesce(df.select(value).scalar(), F.lit(ceiling))

    rules = suffixes if suffixes is not None else default_suffixes(outcomes.sparkSession)
    hosts = materialise(named_hosts(outcomes, rules), "reputation-hosts")
    domains = materialise(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "reputation-domains")
    tops = materialise(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "reputation-suffixes")
    overall = tops.agg(F.when(F.sum("n") > 0, F.sum("bad") / F.sum("n")).otherwise(F.lit(0.0)).alias("rate"))

    s = tops.withColumn("prior", overall.select("rate").scalar())
    s = s.withColumn("k", one(strength(s, "n", "bad", "prior", floor, ceiling), "strength"))
    s = s.select("suffix", ((F.col("bad") + F.col("k") * F.col("prior")) / (F.col("n") + F.col("k"))).alias("prior"))
    s = materialise(s, "reputation-suffix-priors")
    d = domains.join(s, "suffix")
    d = d.withColumn("k", one(strength(d, "n", "bad", "prior", floor, ceiling), "strength"))
    d = d.select("domain", "suffix", ((F.col("bad") + F.col("k") * F.col("prior")) / (F.col("n") + F.col("k"))).alias("prior"))
    d = materialise(d, "reputation-domain-priors")
    h = hosts.join(d, ["domain", "suffix"])
    h = h.withColumn("k", one(strength(h, "n", "bad", "prior", floor, ceiling), "strength"))
    a, total = F.col("bad") + F.col("k") * F.col("prior"), F.col("n") + F.col("k")
    mean = a / total
    return h.select("host", "n", "bad", mean.alias("mean"),
                    (mean - z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, limit: float = 0.3, rules=RULES, id_col: str = "page_id",
               url: str = "url", outcome_id: str = "page_id", outcome: str = "bad", suffixes: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``outcomes``: page id and 0/1 (null: unlabelled)."""
    p = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    known = outcomes.select(F.col(outcome_id).alias("page_id"), F.col(outcome).cast("long").alias("bad")) \
                    .filter("page_id IS NOT NULL AND bad IS NOT NULL") \
                    .groupBy("page_id").agg(F.max("bad").alias("bad"))
    counts = p.filter(F.col("host") != "").select("page_id", "host").join(known, "page_id", "left") \
              .groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    rep = host_reputation(counts, suffixes=suffixes).select("host", (F.col("lower") > limit).alias("__blocked"))
    rule, fixed = rule_of(F.col("host"), F.col("path"), rules)
    return p.join(rep, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(fixed, F.when(F.col("__blocked"), "block").otherwise("allow")).alias("verdict"))
