"""URL filters: rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes are counted by host, registered domain and suffix.  Each
level is shrunk towards the one above by a beta-binomial prior whose strength is
estimated from the counts themselves, and a page is blocked when even the upper
bound of its host's good rate is below a threshold.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import look_up, written

# Bounds of a prior's strength, in pages.
STRENGTH = (1.0, 1000.0)


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Common public suffixes of two labels, below which domains are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "me.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "org.nz", "co.za", "org.za",
    "co.jp", "ne.jp", "or.jp", "co.kr", "or.kr", "com.cn", "net.cn", "org.cn", "com.hk", "com.tw", "com.sg", "com.my",
    "co.in", "net.in", "org.in", "co.id", "co.th", "com.vn", "com.ph", "com.br", "net.br", "org.br", "com.ar", "com.mx",
    "com.co", "com.pe", "com.tr", "co.il", "com.sa", "com.eg", "com.ng", "co.ke", "com.ua", "com.pl", "com.gr", "com.es",
)


@dataclass(frozen=True)
class Filter:
    """Block where the upper ``z`` bound of the good rate is below ``min_good``.

    ``suffixes`` are the public suffixes of two labels; any other suffix is the last label.
    """

    min_good: float = 0.5
    z: float = 1.645
    suffixes: tuple[str, ...] = SUFFIXES


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 2)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def site_of(host: Column) -> Column:
    """The host's name alone: without user, port and a closing dot."""
    return F.regexp_extract(host, r"(?s)^(?:.*@)?(.*?)\.?(?::[0-9]*)?$", 1)


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The registered domain: the public suffix and the label before it, if there is one."""
    site = site_of(host)
    two = F.substring_index(site, ".", -2)
    return F.when(two.isin(list(suffixes)), F.substring_index(site, ".", -3)).otherwise(two)


def suffix_of(domain: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    two = F.substring_index(domain, ".", -2)
    return F.when(two.isin(list(suffixes)), two).otherwise(F.substring_index(domain, ".", -1))


def prior(groups: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior that groups with ``n`` outcomes, ``good`` of them good, share.

    Moments of the beta-binomial (Kleinman): the spread of the groups' rates
    beyond chance gives the intra-class correlation.  One row reaches the driver.
    Without outcomes the mean is one half and the strength the smallest.
    """
    sums = groups.filter("n > 0").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("good").alias("good"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not sums.k:
        return 0.5, STRENGTH[0]
    mean = (sums.good + 0.5) / (sums.n + 1.0)
    chance = mean * (1 - mean)
    spread = sums.squares - sums.good * sums.good / sums.n
    room = chance * (sums.n - sums.nn / sums.n - (sums.k - 1))
    rho = (spread - chance * (sums.k - 1)) / room if room > 0 else 0.0
    return mean, min(STRENGTH[1], max(STRENGTH[0], (1 - rho) / rho)) if rho > 0 else STRENGTH[1]


def reputations(outcomes: DataFrame, settings: Filter = Filter()) -> DataFrame:
    """One row per host: pages ``pages``, outcomes ``n`` and ``good``, shrunk ``rate`` and its ``bound``.

    ``outcomes`` has ``host`` and ``good`` (true, false or null where unlabelled).
    Hosts are counted with map-side combine, so a hot host costs one row a task;
    domains and suffixes are counted from those counts.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count("good").alias("n"),
        F.sum(F.coalesce(F.col("good").cast("long"), F.lit(0))).alias("good"))
    hosts = written(hosts.withColumn("domain", domain_of(F.col("host"), settings.suffixes)), "hosts")
    sums = [F.sum(c).alias(c) for c in ("pages", "n", "good")]
    domains = hosts.groupBy("domain").agg(*sums).withColumn(
        "suffix", suffix_of(F.col("domain"), settings.suffixes))
    suffixes = domains.groupBy("suffix").agg(*sums)
    mean, strength = prior(suffixes)
    _, domain_strength = prior(domains)
    _, host_strength = prior(hosts)

    def shrunk(level: DataFrame, above: Column, by: float) -> Column:
        return (level["good"] + by * above) / (level["n"] + by)

    total = suffixes.agg(F.sum("pages")).first()[0] or 0
    s = suffixes.select("suffix", F.col("pages").alias("above_pages"),
                        shrunk(suffixes, F.lit(mean), strength).alias("above"))
    d = look_up(domains, s, "suffix", ["above"], "above_pages", total, F.col("domain"))
    d = d.select("domain", F.col("pages").alias("above_pages"), shrunk(d, d["above"], domain_strength).alias("above"))
    h = look_up(hosts, d, "domain", ["above"], "above_pages", total, F.col("host"))
    h = h.withColumn("rate", shrunk(h, h["above"], host_strength))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + host_strength + 1))
    return h.withColumn("bound", F.col("rate") + settings.z * deviation).select(
        "host", "pages", "n", "good", "rate", "bound")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], settings: Filter = Filter(),
          id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and the host's ``rate`` and ``bound``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``: a page with that id is good
    if its quality is 1 and it is not toxic (a null toxic counts as 0, a page with
    null quality as unlabelled; of several labels the worst counts).  The verdict is
    the longest fitting rule's, else that of the reputation.  Null, empty and odd
    urls have an empty host, which is a host like any other; repeated pages are
    judged each.  Columns of the same names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "rate", "bound")
    pages = pages.drop(*(c for c in added if c not in (id_column, url_column)))
    host, path = split_url(F.col(url_column))
    parsed = pages.withColumns({"host": host, "path": path})
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    outcome = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.min(good).alias("good"))
    known = parsed.select(F.col(id_column).alias("__id"), "host").join(outcome, "__id", "left").select("host", "good")
    hosts = written(reputations(known, settings), "reputations")
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    judged = look_up(parsed, hosts, "host", ["rate", "bound"], "pages", total, F.col(id_column))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") < settings.min_good, "block").otherwise("allow")
    return judged.withColumns({"rule": text, "verdict": F.coalesce(verdict, method)})
