"""URL filter: stated rules first, else an empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes are counted by host.  A host's good rate has a beta
prior around its registered domain's rate, a domain's around its suffix's, a
suffix's around the overall rate.  How strongly a level holds to its parent is
estimated by the method of moments for a beta-binomial: with children (s of n
good) and the parent's rate p,

    rho = sum((s - n p)^2 - n p (1 - p)) / sum(n (n - 1) p (1 - p)),  strength = (1 - rho) / rho.

A host is allowed when the lower bound ``mean - Z * sd`` of its beta posterior
reaches ``LEAST``.  Hosts without an outcome have their prior.

Outcomes are counted by partial aggregation before the shuffle, so a hot host
is one row a task; pages get their verdict by an equi-join with the written
table of hosts, which Spark broadcasts when small and splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.llm.common import LOWER, UPPER, staged

Z, LEAST = 1.645, 0.5
LOW_RHO, HIGH_RHO, NO_RHO = 0.001, 0.999, 0.1
#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): from the first ``://`` to ``/ ? #``, A-Z lower-cased; then to ``? #``.  Else both empty."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # a longer one overrides
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def strength(children: DataFrame) -> float:
    """The prior strength of ``children`` (``n, s, p``: their counts and the parent's rate)."""
    num, den = children.where("n > 0").selectExpr(
        "sum((s - n * p) * (s - n * p) - n * p * (1 - p))", "sum(n * (n - 1) * p * (1 - p))").first()
    rho = NO_RHO if not den else min(max(num / den, LOW_RHO), HIGH_RHO)
    return (1 - rho) / rho


def host_reputation(spark: SparkSession, hosts: DataFrame) -> DataFrame:
    """``host, mean, bound`` from ``hosts`` (``host, n, s``): posterior mean and lower bound of the good rate."""
    bare = F.regexp_replace("host", r"^.*@|:\d*$", "")
    hosts = hosts.select("host", "n", "s", F.regexp_extract(bare, r"([^.]+)$", 1).alias("suffix"),
                         F.regexp_extract(bare, r"([^.]+(?:\.[^.]+)?)$", 1).alias("domain"))
    hosts = staged(spark, hosts, "hosts")
    n, s = hosts.selectExpr("coalesce(sum(n), 0)", "coalesce(sum(s), 0)").first()
    overall = (s + 1) / (n + 2)

    def rate(k: float) -> str:
        return f"(s + {k!r}D * p) / (n + {k!r}D)"

    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("p", F.lit(overall))
    suffixes = suffixes.selectExpr("suffix AS sx", f"{rate(strength(suffixes))} AS p")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(suffixes, F.expr("suffix = sx"))
    domains = domains.selectExpr("domain AS dx", f"{rate(strength(domains))} AS p")
    own = hosts.join(domains, F.expr("domain = dx"))
    k = strength(own)
    own = own.selectExpr("host", f"s + {k!r}D * p AS a", f"n - s + {k!r}D * (1 - p) AS b")
    return own.selectExpr("host", "a / (a + b) AS mean",
                          f"a / (a + b) - {Z}D * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound")


def judge_urls(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES,
               least: float = LEAST) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, bound``.

    ``outcomes`` has ``page_id`` and ``good`` (0 or 1; other values and null ids
    count for nothing).  A null url, or one without ``://``, has an empty host,
    which is a host like any other.  Rows that repeat a page are judged one by
    one, and each counts as a page.  Empty outcomes: a rate of one half.  An
    empty table gives an empty result; other columns are not read.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    good = outcomes.where("good IN (0, 1) AND page_id IS NOT NULL").select(F.col("page_id").alias("p_"), F.col("good").cast("long").alias("good"))
    good = good.groupBy("p_").agg(F.max("good").alias("good"))
    seen = urls.select("page_id", "host").join(good, F.expr("page_id = p_"), "left")
    counts = seen.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("s"))
    known = staged(spark, host_reputation(spark, counts).selectExpr("host AS h_", "mean", "bound"), "reputation")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = urls.join(known, F.expr("host = h_")).withColumn("rule", rule).withColumn("said", verdict)
    return judged.select("page_id", "host", "path", "rule",
                         F.expr(f"coalesce(said, if(bound >= {least}D, 'allow', 'block'))").alias("verdict"),
                         F.round("bound", 4).alias("bound"))
