"""URL filter by empirical-Bayes host reputation, in SQL functions only.

Labelled page outcomes (bad or not) are counted by host. A beta-binomial
model shrinks them: the suffix's rate is shrunk to the overall rate, the
registered domain's to its suffix, the host's to its domain. The prior
strength of a level comes from the spread of its groups around their
parents' rates (method of moments). A host is blocked when the lower bound
of its posterior exceeds a threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored

# fixed values: common public suffixes of two labels
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr", "com.br", "com.mx", "com.cn", "com.tr", "co.in", "co.za")


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains, ``path`` a path's start."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class ReputationSpec:
    """``z``: standard deviations from the posterior mean down to the bound.
    Hosts are blocked when the bound exceeds ``max_bad``. ``rho_range`` keeps
    the estimated correlation of outcomes in a group, 1 / (1 + prior
    strength), off 0 and 1; its upper end holds where no group of a level has
    two outcomes."""

    z: float = 1.645
    max_bad: float = 0.5
    rho_range: tuple[float, float] = (0.001, 0.5)
    suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES


def url_parts(df: DataFrame) -> DataFrame:
    """Adds host (after the first ``://`` up to ``/ ? #`` or the end, A-Z
    lower-cased) and path (up to ``?``, ``#`` or the end) of ``url``; both
    empty for null and without ``://``."""
    tail = F.coalesce(F.when(F.instr("url", "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")), F.lit(""))
    host = F.translate(F.regexp_extract(tail, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(tail, "^[^/?#]*([^?#]*)", 1))


def rule_of(rules: tuple[Rule, ...], pick: str) -> Column:
    """``pick`` (name or verdict) of the longest rule that fits host and path,
    of equally long ones the first given; else null. For short rule lists:
    every rule is a condition of the expression."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit(f".{r.host}"))) & F.startswith(F.col("path"), F.lit(r.path))
        out = F.when(fits, F.lit(getattr(r, pick))).otherwise(out)
    return out


def with_domain(hosts: DataFrame, spec: ReputationSpec) -> DataFrame:
    """Adds suffix and domain (suffix and one label) of ``host``, without
    user and port."""
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    long = two.isin(*spec.suffixes)
    return hosts.withColumn("suffix", F.when(long, two).otherwise(F.substring_index(name, ".", -1))).withColumn("domain", F.when(long, F.substring_index(name, ".", -3)).otherwise(two))


def strength(groups: DataFrame, spec: ReputationSpec) -> Column:
    """Prior strength of a level as a scalar subquery, from its groups' (n,
    bad, prior): outcomes of a group correlate by rho, which solves the
    beta-binomial variance of all groups, sum of (bad - n prior)^2."""
    n, k, p = F.col("n"), F.col("bad"), F.col("prior")
    binomial = n * p * (1 - p)
    excess, pairs = F.sum(F.pow(k - n * p, F.lit(2.0)) - binomial), F.sum(binomial * (n - 1))
    lo, hi = spec.rho_range
    rho = F.when(pairs > 0, F.greatest(F.lit(lo), F.least(F.lit(hi), excess / pairs))).otherwise(F.lit(hi))
    return groups.where("n > 0").agg(((1 - rho) / rho).alias("s")).scalar()


def host_reputation(pages: DataFrame, labels: DataFrame, spec: ReputationSpec = ReputationSpec()) -> DataFrame:
    """host, n, bad, mean and bound for every host of ``pages`` (page_id,
    host). ``labels`` (page_id, bad as boolean); null page_ids and null labels
    count for nothing, several labels of a page count each."""
    outcomes = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = (
        pages.select("page_id", "host")
        .join(outcomes, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    hosts = stored(with_domain(hosts, spec), "url-hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # the overall rate, with one bad outcome in two added
    total = hosts.agg(*sums).select(((F.coalesce("bad", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)).alias("p")).scalar()
    # each level: prior (the parent's mean), strength s, mean after its own outcomes
    suffixes = stored(hosts.groupBy("suffix").agg(*sums).withColumn("prior", total), "url-suffixes")
    suffixes = suffixes.withColumn("s", strength(suffixes, spec)).withColumn("mean", (F.col("bad") + F.col("s") * F.col("prior")) / (F.col("n") + F.col("s")))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = stored(domains, "url-domains")
    domains = domains.withColumn("s", strength(domains, spec)).withColumn("mean", (F.col("bad") + F.col("s") * F.col("prior")) / (F.col("n") + F.col("s")))
    own = stored(hosts.join(domains.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"]), "url-priors")
    own = own.withColumn("s", strength(own, spec))
    a, both = F.col("bad") + F.col("s") * F.col("prior"), F.col("n") + F.col("s")
    mean = a / both
    return own.select("host", "n", "bad", mean.alias("mean"), (mean - F.lit(spec.z) * F.sqrt(mean * (1 - mean) / (both + 1))).alias("bound"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], spec: ReputationSpec = ReputationSpec()) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), bound for every
    row of ``pages`` (page_id, url).

    The longest fitting rule decides, else the host's posterior bound. A null
    url or one without ``://`` has the empty host, which has a reputation
    like any other; repeated rows are all judged. With no labels every bound
    is below one half. Other columns are ignored.
    """
    parts = url_parts(pages.select(F.col("page_id").cast("long").alias("page_id"), "url")).drop("url")
    judged = host_reputation(parts, labels, spec).select("host", "bound")
    return parts.join(stored(judged, "url-judged"), "host", "left").select(
        "page_id",
        "host",
        "path",
        rule_of(rules, "name").alias("rule"),
        F.coalesce(rule_of(rules, "verdict"), F.when(F.col("bound") > spec.max_bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "bound",
    )
