"""URL filter: explicit rules, else the empirical-Bayes reputation of the host.

Method. Labelled page outcomes (good or not) are counted per host, registered domain and suffix. Each
level is shrunk towards the level above by a beta-binomial prior: its mean is the posterior mean of the
parent (the overall rate at the top), its strength comes from the spread of the level's own rates
(moment estimator). A host passes if the lower bound of its posterior (mean less ``z`` standard
deviations) reaches ``least``. Hosts without outcomes have the prior of the nearest level that has some.

Counts are partial aggregates, so a host with a third of all pages is no more work than others; the
page table meets the table of hosts, unique keys, in one join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import lower_ascii
from perimetry.plans.storage import written

# The rules, as (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SUFFIXES = ("example.com", "example.net", "example.org")  # under which anyone can register
WEAKEST, STRONGEST = 1.0, 1000.0  # strength of a prior, in outcomes
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    part = lambda group: F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))
    return lower_ascii(part(1)), part(2)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """(verdict, rule) of the longest rule whose host is the url's or a parent, and whose path starts its."""
    chosen = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen if chosen is not None else F.lit(None).cast("struct<verdict: string, rule: string>")


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The listed suffix that the host ends in, else its last label."""
    chosen = F.substring_index(host, ".", -1)
    for s in sorted(suffixes, key=len):
        chosen = F.when((host == s) | F.endswith(host, F.lit("." + s)), F.lit(s)).otherwise(chosen)
    return chosen


def domain_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The suffix and one label more; the host itself if it has no more."""
    plain = F.substring_index(host, ".", -2)
    for s in sorted(suffixes, key=len):
        listed = (host == s) | F.endswith(host, F.lit("." + s))
        plain = F.when(listed, F.substring_index(host, ".", -(s.count(".") + 2))).otherwise(plain)
    return plain


@dataclass(frozen=True)
class Prior:
    rate: float
    strengths: dict[str, float]  # per level


def _strength(groups: DataFrame, rate: float) -> float:
    """Strength of the beta prior behind the rates of groups (n, good), by moments: 1 / rho - 1."""
    if not 0 < rate < 1:
        return STRONGEST
    off = F.col("n") * F.pow(F.col("good") / F.col("n") - rate, 2)
    k, n, squares, spread = groups.agg(
        F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(off)).first()
    free = n - squares / n - (k - 1) if k else 0
    if free <= 0:
        return STRONGEST
    rho = (spread / (rate * (1 - rate)) - (k - 1)) / free
    return min(STRONGEST, max(WEAKEST, 1 / rho - 1)) if rho > 0 else STRONGEST


def reputations(hosts: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, mean, bound) of every distinct ``host`` of ``hosts``.

    ``outcomes`` has one row per labelled page: ``host`` and ``good`` (1 or 0); rows in which one is null
    and rows with an empty host are left out. Without any outcome the mean is one half.
    """
    levels = {"suffix": suffix_of(F.col("host")), "domain": domain_of(F.col("host")), "host": F.col("host")}
    counted = (
        outcomes.where(F.col("good").isin(0, 1) & (F.col("host") != ""))
        .groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    )
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    rate = total[1] / total[0] if total[0] else 0.5
    found = hosts.select("host").where(F.col("host").isNotNull()).distinct()
    found = found.select("host", levels["suffix"].alias("suffix"), levels["domain"].alias("domain"), F.lit(rate).alias("mean"))
    for name, key in levels.items():
        groups = counted.groupBy(key.alias(name)).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        strength = _strength(groups, rate)
        found = found.drop("n", "weight").join(groups, name, "left").withColumns({
            "mean": (F.col("mean") * strength + F.coalesce("good", F.lit(0))) / (strength + F.coalesce("n", F.lit(0))),
            "weight": strength + F.coalesce("n", F.lit(0)), "n": F.coalesce("n", F.lit(0)),
        }).drop("good")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return found.select("host", "n", "mean", (F.col("mean") - z * spread).alias("bound"))


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, least: float = 0.5,
    z: float = 1.645, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every row: the verdict of the rule that fits, else
    ``allow`` if the host's posterior bound is at least ``least`` and ``block`` if not.

    A url that is null or has no ``://`` has an empty host; no rule fits it and it is judged by the
    overall rate. Repeated rows give repeated rows, an empty table an empty result; other columns are
    not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # stored, so that the join on a host of any size can be split
    known = written(reputations(rows, outcomes, z).select("host", "bound"), "hosts")
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("bound") >= least, "allow").otherwise("block")
    return rows.join(known, "host", "left").select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", method).alias("verdict"), "bound")


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(host, good) of labelled pages: the number at the end of a page's path is the document it shows,
    whose quality label is the outcome."""
    host, path = host_and_path(F.col(url_col))
    shown = pages.select(host.alias("host"), F.regexp_extract(path, r"/([0-9]{1,18})(?:/|\.html)?$", 1).try_cast("long").alias("doc_id"))
    return shown.join(labels.select("doc_id", F.col("quality").alias("good")), "doc_id").select("host", "good")
