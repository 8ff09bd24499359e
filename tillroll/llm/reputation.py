"""URL filters: explicit rules first, then an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad: toxic, or of low quality) are counted per host,
registered domain and suffix.  At each level the spread of rates around the
parent's mean gives, by moments, how strongly a beta prior holds a child to its
parent; the posterior mean of the parent is the prior mean of the child.  A
host is blocked if the lower bound of the posterior rate of bad pages, ``Z``
deviations under its mean, lies above ``LIMIT``; hosts without labels inherit
their domain's, and so on up.

Only DataFrame functions are used.  Counting is one map-side combined
aggregation; hosts meet pages again in a join of written tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

Z, LIMIT = 1.645, 0.25
#: The spread that is assumed where a level has too few groups, and its bounds.
USUAL_RHO, LEAST_RHO, MOST_RHO = 0.1, 0.001, 0.9

#: (verdict, host, path) in any order.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, null if none does.

    The rules are a parameter and stay in the plan; of equally long ones the
    first by code point counts.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, on, under in reversed(ordered):
        fits = ((host == on) | F.endswith(host, F.lit("." + on))) & F.startswith(path, F.lit(under))
        out = F.when(fits, F.struct(F.lit(on + under).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _posterior(children: DataFrame, name: str) -> DataFrame:
    """Adds ``mean`` and ``strength`` of each child's posterior, given ``n``, ``k`` and the ``prior`` mean.

    The strength of the prior comes from the intra-class correlation of the
    children that have labels.
    """
    known = children.where("n > 0")
    m = F.least(F.greatest(F.col("prior"), F.lit(1e-6)), F.lit(1 - 1e-6))
    v = m * (1 - m)
    rate = F.col("k") / F.col("n")
    sums = known.agg(
        F.count("*").alias("groups"), F.sum("n").alias("pages"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * (rate - m) * (rate - m) / v).alias("spread"))
    extra = F.col("spread") - (F.col("groups") - 1)
    room = F.col("pages") - F.col("squares") / F.col("pages") - (F.col("groups") - 1)
    rho = F.when((F.col("groups") > 1) & (room > 0), extra / room).otherwise(USUAL_RHO)
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(USUAL_RHO)), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    sums = sums.select(((1 - rho) / rho).alias("hold"))  # one row
    out = children.crossJoin(F.broadcast(sums))
    out = out.withColumn("strength", F.col("n") + F.col("hold"))
    return out.withColumn("mean", (F.col("k") + F.col("hold") * m) / F.col("strength")).drop("hold")


def reputations(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per host of ``pages`` (``page_id``, ``host``): ``n, k, mean, bound``, the lower posterior bound.

    An id labelled more than once is bad if any label says so; labels without any
    outcome, and pages or labels without an id, count nothing.
    """
    bad = (F.coalesce(F.col("toxic") > 0, F.lit(False)) | F.coalesce(F.col("quality") < 1, F.lit(False))).cast("int")
    marks = labels.where("doc_id is not null and (toxic is not null or quality is not null)")
    marks = marks.groupBy(F.col("doc_id").alias("marked")).agg(F.max(bad).alias("bad"))
    rows = pages.join(marks, pages["page_id"] == marks["marked"], "left")
    hosts = written(rows.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")), "hosts")
    hosts = hosts.withColumn("domain", _domain(F.col("host"))).withColumn("suffix", _suffix(F.col("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = suffixes.agg(F.coalesce((F.sum("k") + 0.5) / (F.sum("n") + 1), F.lit(0.5)).alias("prior"))  # one row
    suffixes = written(_posterior(suffixes.crossJoin(F.broadcast(whole)), "suffix"), "suffixes")
    up = suffixes.select(F.col("suffix").alias("of"), F.col("mean").alias("prior"))
    domains = written(_posterior(domains.join(up, F.col("suffix") == F.col("of")).drop("of"), "domain"), "domains")
    up = domains.select(F.col("domain").alias("of"), F.col("mean").alias("prior"))
    hosts = _posterior(hosts.join(up, F.col("domain") == F.col("of")).drop("of"), "host")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    return hosts.select("host", "n", "k", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``): ``page_id, host, path, rule, verdict``.

    A null url, or one without ``://``, has an empty host, judged like any other;
    repeated rows repeat; other columns are left aside.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    known = written(reputations(rows.select("page_id", "host"), labels), "reputations")
    known = known.select(F.col("host").alias("of"), F.when(F.col("bound") > LIMIT, "block").otherwise("allow").alias("own"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.join(known, F.col("host") == F.col("of"), "left")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                       F.coalesce("fit.verdict", "own").alias("verdict"))
