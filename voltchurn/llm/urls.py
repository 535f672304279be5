"""Empirical-Bayes host reputation for page urls, behind explicit rules.

The rate of bad pages of a host is shrunk to that of its registered domain,
that of the domain to its public suffix, that of the suffix to the corpus.
Each level's prior is a beta distribution whose mean is the parent's posterior
mean and whose strength is fitted, by the method of moments, to how much the
groups of that level scatter about their parents.  A host is blocked when the
lower posterior bound of its bad rate exceeds a limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.llm.lines import UPPER

# The rules, as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Public suffixes of more than one label that are told apart.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_name(host: str, path: str) -> str:
    return host + path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(rule_name(r[1], r[2]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(rule_name(h, p)).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def suffix_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*SUFFIXES), F.substring_index(host, ".", -3)) \
        .otherwise(F.substring_index(host, ".", -2))


def host_reputation(outcomes: DataFrame, z: float = 1.6448536269514722) -> DataFrame:
    """One row per host: n, bad, prior mean, posterior mean and lower bound.

    ``outcomes``: host and bad (1, 0 or null for an unlabelled page).  Hosts
    without labelled pages get their domain's posterior mean as both means and
    the bound of that prior alone.  Without any labelled page the corpus rate
    counts as 0.  Three group-bys with map-side sums; only the level tables,
    one row per host at most, are joined.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "k")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.coalesce(F.sum("k") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("mean"))
    parent = suffixes.select("suffix", "n", "k", total.scalar().alias("m"))
    suffixes = _posterior(parent)
    domains = _posterior(domains.join(suffixes.select("suffix", F.col("post").alias("m")), "suffix"))
    hosts = _posterior(hosts.join(domains.select("domain", "suffix", F.col("post").alias("m")), ["domain", "suffix"]))
    a = F.col("s") * F.col("m") + F.col("k")
    b = F.col("s") * (1 - F.col("m")) + F.col("n") - F.col("k")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select("host", "n", F.col("k").alias("bad"), F.col("m").alias("prior_mean"), F.col("post").alias("post_mean"),
                        (F.col("post") - z * sd).alias("lower_bound"))


def _posterior(groups: DataFrame) -> DataFrame:
    """Adds the level's prior strength s and each group's posterior mean post."""
    var = F.col("m") * (1 - F.col("m"))
    scatter = F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) - F.col("n") * var)
    room = F.sum(F.col("n") * (F.col("n") - 1) * var)
    rho = F.when(room > 0, scatter / room).otherwise(F.lit(0.0))
    strength = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH))).otherwise(F.lit(MAX_STRENGTH))
    fitted = groups.agg(F.coalesce(strength, F.lit(MAX_STRENGTH)).alias("s"))
    out = groups.withColumn("s", fitted.scalar())
    return out.withColumn("post", (F.col("s") * F.col("m") + F.col("k")) / (F.col("s") + F.col("n")))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               max_bad_rate: float = 0.3, z: float = 1.6448536269514722) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every page.

    ``labels`` (page_id, bad 0/1) are the labelled outcomes; a page may have
    several, rows with a null page_id or outcome say nothing.  The longest
    fitting rule decides; pages that no rule fits are blocked when the lower
    posterior bound of their host's bad rate is above ``max_bad_rate``.  A null
    url, or one without ``://``, has an empty host, which is a host like any
    other.  Repeated pages give repeated rows.  The join of pages to hosts is a
    plain equi-join with the pages on the outer side, so that AQE splits a host
    with a third of the pages.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    src = src.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = labels.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad")) \
        .where(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
    reputation = host_reputation(src.join(known, "page_id", "left"), z)
    judged = src.join(reputation.select("host", "lower_bound"), "host", "left")
    found = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower_bound") > max_bad_rate, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", found.alias("found"), method.alias("method")) \
        .select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                F.coalesce(F.col("found.verdict"), F.col("method")).alias("verdict"))
