"""URL filter: fixed rules first, then the empirical-Bayes reputation of the host; DataFrame functions only.

A rule (host, path, verdict) fits its host and all subdomains where the url's
path starts with the rule's; the longest fitting rule decides.  Pages that no
rule fits are judged by their host's reputation.  The labelled outcomes are
the pages that a rule has judged (or any given 0/1 column).  Outcomes are
counted per host, registered domain and suffix, and shrunk downwards through
beta-binomial priors: the suffix towards all pages, the domain towards its
suffix, the host towards its domain.  The weight of each prior is fitted to the
outcomes themselves (moments of the between-unit variance).  A page is blocked
when the lower posterior bound of its host's block rate is above the threshold.

Scale: counting is a partial aggregate per host; the levels above aggregate
hosts; pages meet their host's row in one join that AQE can split where one host
holds a third of all pages.

Defined results: a null url, or one without "://", has an empty host and path,
fits no rule with a host and is judged as the empty host; with no labelled
outcomes at all everything is allowed; repeated rows repeat their result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir

#: (host, path, verdict); stated by the task
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name (host + path) and verdict of the longest rule that fits, else null."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, verdict)


def registered_domain(host: Column) -> Column:
    """The last two labels (the whole host where it has fewer)."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _shrunk(units: DataFrame, key: str, prior: str, spread: str) -> DataFrame:
    """units: one row per unit with n, k and its parent's posterior mean and variance; adds the unit's.

    The prior's weight m (pseudo-outcomes) comes from the spread of the units'
    rates around their parents' beyond binomial noise:
    rho = (S - D) / (Q - D), S = sum n (k/n - p)^2, D = sum p (1-p) over units
    with outcomes, Q = sum n p (1-p); m = (1 - rho) / rho within [0.5, 1e6].
    """
    p = F.col(prior)
    seen = F.when(F.col("n") > 0, 1.0).otherwise(0.0)
    rate = F.when(F.col("n") > 0, F.col("k") / F.col("n")).otherwise(0.0)
    fit = (units.agg(F.sum(seen * F.col("n") * F.pow(rate - p, 2)).alias("S"), F.sum(seen * p * (1 - p)).alias("D"),
                     F.sum(F.col("n") * p * (1 - p)).alias("Q"))
           .select(F.when((F.col("Q") > F.col("D")) & (F.col("S") > F.col("D")), (F.col("S") - F.col("D")) / (F.col("Q") - F.col("D"))).otherwise(0.0).alias("rho")))
    weight = fit.select(F.least(F.greatest((1 - F.col("rho")) / F.greatest(F.col("rho"), F.lit(1e-9)), F.lit(0.5)), F.lit(1e6)).alias("m")).scalar()
    a, b = weight * p + F.col("k"), weight * (1 - p) + F.col("n") - F.col("k")
    total = weight + F.col("n")
    # own beta variance, plus the parent's as far as the unit leans on it
    return (units.withColumn(f"{key}_mean", a / (a + b))
            .withColumn(f"{key}_var", a * b / (total * total * (total + 1)) + F.pow(weight / total, 2) * F.col(spread)))


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """host, n, k, mean, lower: posterior of each host's block rate.

    outcomes: host and blocked (1, 0, or null for a page without an outcome).
    """
    # one row per host; read by every level below
    ensure_checkpoint_dir(outcomes.sparkSession)
    hosts = (outcomes.groupBy("host").agg(F.count("blocked").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("k"))
             .withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("host"))).checkpoint())
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # one pseudo-outcome of each kind keeps the overall rate inside (0, 1)
    overall = suffixes.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("p")).scalar()
    suffixes = (_shrunk(suffixes.withColumn("p", overall).withColumn("v", F.lit(0.0)), "suffix", "p", "v")
                .select("suffix", "suffix_mean", "suffix_var").checkpoint())
    domains = (_shrunk(domains.join(suffixes, "suffix"), "domain", "suffix_mean", "suffix_var")
               .select("domain", "suffix", "domain_mean", "domain_var").checkpoint())
    hosts = _shrunk(hosts.join(domains, ["domain", "suffix"]), "host", "domain_mean", "domain_var")
    return hosts.select("host", "n", "k", F.col("host_mean").alias("mean"), (F.col("host_mean") - z * F.sqrt("host_var")).alias("lower"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, label: Column | None = None,
               threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, block_rate, block_bound.

    label: a 0/1 column of pages (1 = should be blocked, null = unknown); by
    default the outcome of the page's rule.
    """
    url = F.col(url_col)
    seen = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"),
                        (F.lit(None).cast("int") if label is None else label.cast("int")).alias("given"))
    name, verdict = match_rule(F.col("host"), F.col("path"), rules)
    ruled = seen.withColumn("rule", name).withColumn("ruled", verdict)
    outcome = F.col("given") if label is not None else F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    reputation = host_reputation(ruled.select("host", outcome.alias("blocked")), z).select("host", "mean", "lower")
    return (ruled.join(reputation, "host", "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("lower") > threshold, "block").otherwise("allow")).alias("verdict"),
                    F.col("mean").alias("block_rate"), F.col("lower").alias("block_bound")))
