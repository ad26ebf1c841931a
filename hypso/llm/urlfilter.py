"""URL filtering by explicit rules and, where none fits, an empirical-Bayes reputation of the host.

Labelled outcomes of pages are pre-aggregated to hosts. Beta-binomial priors shrink a host's rate of bad pages towards
its registered domain's, that towards its public suffix's, and that towards the overall rate; each level's prior weight
comes from the spread between its groups (method of moments). A host is blocked when the lower bound of its bad rate,
the posterior beta distribution's 5 % quantile, is above a threshold; that is, when the regularised incomplete beta
function at the threshold is below 5 %. DataFrame functions only; hosts and groups are joined by ordinary shuffles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule) with the rule as host, a slash and the rest of the path.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Suffixes of two labels, as in public lists of country domains; callers may pass a longer list.
TWO_LABEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ac.jp", "ne.jp", "com.br", "com.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr")
#: Prior weights, in labelled pages, lie between these.
WEIGHTS = (2.0, 1000.0)
#: The share of the posterior that may lie below the threshold, and the normal distribution's place for it.
SHARE, NORMAL = 0.05, 1.645
#: Steps of the continued fraction, and the evidence (pages and prior weight) up to which they are enough. Beyond, the
#: posterior is so narrow that its normal approximation is the bound.
STEPS, EVIDENCE = 200, 5000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("_url"))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("_url"))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        told = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        out = F.when(fits, told) if out is None else out.when(fits, told)
    return out


def site_columns(host: str, suffixes: Sequence[str] = TWO_LABEL) -> dict[str, Column]:
    """``suffix`` (its last label, or two for those in ``suffixes``) and ``domain`` (one label more)."""
    bare = F.regexp_replace(F.regexp_replace(F.col(host), r"^.*@", ""), r":\d*$", "")
    last2 = F.substring_index(bare, ".", -2)
    two = last2.isin(*suffixes)
    return {"suffix": F.when(two, last2).otherwise(F.substring_index(bare, ".", -1)), "domain": F.when(two, F.substring_index(bare, ".", -3)).otherwise(last2)}


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for positive arguments: Stirling's series eight places further on."""
    far = z + 8
    series = (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + 1 / (12 * far) - 1 / (360 * F.pow(far, 3)) + 1 / (1260 * F.pow(far, 5))
    steps = z
    for k in range(1, 8):
        steps = steps * (z + k)
    return series - F.log(steps)


def beta_share(a: Column, b: Column, x: float) -> Column:
    """The share of the beta distribution (a, b) below ``x``, by its continued fraction (Lentz's way, STEPS steps)."""

    def fraction(p: Column, q: Column, at: Column) -> Column:
        def step(s: Column, m: Column) -> Column:
            even = m * (q - m) * at / ((p - 1 + 2 * m) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * at / ((p + 2 * m) * (p + 1 + 2 * m))
            d1, c1 = 1 / (1 + even * s["d"]), 1 + even / s["c"]
            d2, c2 = 1 / (1 + odd * d1), 1 + odd / c1
            return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

        d = 1 / (1 - (p + q) * at / (p + 1))
        start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
        return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(STEPS)), lambda m: m.cast("double")), start, step, lambda s: s["h"])

    # The fraction converges fast on the near side of the mean; the far side is one less the other tail.
    near = F.lit(x) < (a + 1) / (a + b + 2)
    p, q, at = F.when(near, a).otherwise(b), F.when(near, b).otherwise(a), F.when(near, F.lit(x)).otherwise(F.lit(1 - x))
    tail = F.exp(p * F.log(at) + q * F.log(1 - at) + log_gamma(p + q) - log_gamma(p) - log_gamma(q)) * fraction(p, q, at) / p
    return F.when(near, tail).otherwise(1 - tail)


def _weight(groups: DataFrame) -> Column:
    """A level's prior weight from its groups' (n, bad): rate * (1 - rate) / variance between groups - 1, in bounds."""
    rate = F.sum("bad") / F.sum("n")
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n"), 2)) / F.sum("n") - F.pow(rate, 2)
    noise = rate * (1 - rate) * F.count("*") / F.sum("n")
    low, high = (F.lit(x) for x in WEIGHTS)
    return F.when(spread > noise, F.greatest(low, F.least(high, rate * (1 - rate) / (spread - noise) - 1))).otherwise(high)


def host_reputation(hosts: DataFrame, threshold: float = 0.5, suffixes: Sequence[str] = TWO_LABEL) -> DataFrame:
    """From (host, n, bad) of labelled pages: host, mean of the posterior rate of bad pages, and ``above``, whether the
    posterior's 5 % quantile is above ``threshold``."""
    hosts = hosts.withColumns(site_columns("host", suffixes))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg((F.sum("bad") / F.sum("n")).alias("p0"), _weight(suffixes).alias("m0"))
    of_domains = domains.agg(_weight(domains).alias("m1"))
    of_hosts = hosts.agg(_weight(hosts).alias("m2"))
    single = F.broadcast(overall.crossJoin(of_domains).crossJoin(of_hosts))  # one row
    s = suffixes.crossJoin(single).select("suffix", "m1", "m2", ((F.col("bad") + F.col("m0") * F.col("p0")) / (F.col("n") + F.col("m0"))).alias("ps"))
    d = domains.join(s, "suffix").select("domain", "suffix", "m2", ((F.col("bad") + F.col("m1") * F.col("ps")) / (F.col("n") + F.col("m1"))).alias("pd"))
    h = hosts.join(d, ["suffix", "domain"]).select("host", (F.col("bad") + F.col("m2") * F.col("pd")).alias("a"), (F.col("n") - F.col("bad") + F.col("m2") * (1 - F.col("pd"))).alias("b"))
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    normal = mean - NORMAL * F.sqrt(mean * (1 - mean) / (a + b + 1)) > threshold
    return h.select("host", mean.alias("mean"), F.when(a + b > EVIDENCE, normal).otherwise(beta_share(a, b, threshold) < SHARE).alias("above"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5, suffixes: Sequence[str] = TWO_LABEL) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``outcomes``: (page_id, bad) of labelled pages, bad 0 or 1; null outcomes count as unlabelled. The longest rule
    that fits decides; else a host is blocked if its posterior lower bound exceeds ``threshold``. Hosts without
    labelled pages, and pages without host, are allowed. Null urls have empty host and path. Repeated rows are judged
    alike; a null page_id is judged by its url, but no outcome is its; an empty table gives no rows; very long urls
    are like others; other columns of the input, whatever their names, play no part.
    """
    url = F.col("_url")
    rows = pages.select("page_id", F.col("url").cast("string").alias("_url")).select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    told = outcomes.where("bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = rows.where("host <> ''").join(told, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    blocked = host_reputation(hosts, threshold, suffixes).where("above").select("host", F.lit(True).alias("blocked"))
    judged = rows.withColumn("_r", _rule(F.col("host"), F.col("path"), rules))
    out = judged.join(blocked, "host", "left")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce(F.col("_r.verdict"), method).alias("verdict"))
