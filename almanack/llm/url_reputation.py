"""URL filter by rules and empirical-Bayes host reputation, in Spark expressions alone.

A page's url falls under rules (allow or block a host, its subdomains and a path) or, where
no rule fits, under the reputation of its host. A labelled page is good or bad. Outcomes are
counted by host, registered domain and suffix, and each level's share of bad pages is shrunk
towards the level above it: everything, suffix, domain, host. The prior of a level is a beta
distribution whose mean is the posterior mean of the parent, and whose strength is estimated
from all groups of that level by the method of moments: where the groups differ no more than
chance lets them, the prior is strong and a host's own few pages say little. A host without a
labelled page has the posterior of its domain or suffix. A host is blocked if a lower bound of
its posterior share of bad pages is above a limit.

Shuffles: pages that are labelled meet their labels; counts by host, domain and suffix have map-side
partials, so that a host with a third of all pages sends a row a task. Only blocked hosts
meet the pages again: broadcast if they measure small, else by a salted join.

Nulls: a null url, or one without ``://``, has an empty host and path; these count as one host.
A page without page_id is judged like any other and has no label. A label without doc_id
or without an outcome is none; several labels of a page all count. Repeated pages count and come back as often as they
are there. Empty tables: without labels, only the rules block; without pages, there is no row. Only page_id and url are
read of the pages, and the columns named of the labels; other columns are not looked at.
Urls of any length are cut by two patterns that do not backtrack.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.operators.joins import BROADCAST_BYTES, value_bytes

from .storage import shared_folder, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host and path after the first ``://``.
URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
#: Second-level labels below which, in a two-letter country, names are registered (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: A host is blocked if its share of bad pages is, by the bound, above this.
MAX_BAD_SHARE = 0.3
#: The bound lies so many standard deviations of the posterior below its mean (95 % one-sided).
DEVIATIONS = 1.645
#: Range of a prior's strength, in pages.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
#: Bad and good pages that everything is thought to have before any label is seen.
TOP_PRIOR = (1, 9)
#: Parts that a page's host is salted into where the blocked hosts are not broadcast.
SALT = 64
#: Levels of the hierarchy, the widest first.
LEVELS = ("suffix", "domain", "site")


class Rule(NamedTuple):
    """``verdict`` (allow or block) for the host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased, and the path."""
    known = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(known, URL, 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(known, URL, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null.

    Of rules with equally long names the one with the longer host is taken, then the first.
    """
    name = verdict = F.lit(None).cast("string")
    shortest_first = sorted(rules, key=lambda r: (len(r.name), len(r.host)))
    for rule in _last_wins(shortest_first):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _last_wins(rules: Sequence[Rule]) -> list[Rule]:
    """Equal rules once, so that the first of them stays the one that decides."""
    first = {}
    for rule in rules:
        first.setdefault((rule.host, rule.path), rule)
    return list(first.values())


def site_levels(host: Column) -> dict[str, Column]:
    """``site`` (the host without user and port), its registered ``domain`` and ``suffix``.

    The suffix is the last label, or the last two where the country's second level is
    known as one. An address in numbers is its own domain; a bare name its own suffix.
    """
    site = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"\.?(:[0-9]*)?$", "")
    labels = F.split(site, r"\.", -1)
    n = F.size(labels)
    second = F.coalesce(F.try_element_at(labels, F.lit(-2)), F.lit(""))
    deep = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & second.isin(*SECOND_LEVEL)
    taken = F.when(deep, 2).otherwise(1)

    def last(k: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), n), ".")

    numbers = site.rlike(r"^[0-9]+(\.[0-9]+){3}$|^\[")
    return {
        "site": site,
        "domain": F.when(numbers, site).otherwise(last(taken + 1)),
        "suffix": F.when(numbers, "").otherwise(last(taken)),
    }


def prior_strength(groups: DataFrame) -> float:
    """How many pages the prior of a level is worth, by the method of moments.

    ``groups`` has n, bad and the prior's mean. Counts k of n pages with prior mean m vary by
    n m (1 - m) (1 + (n - 1) r), where r is the correlation of a group's pages; a beta prior
    of strength s has r = 1 / (s + 1). Where no group has two pages, r counts as 0.
    """
    n, m = F.col("n"), F.col("prior")
    off = F.col("bad") - n * m
    found = groups.where("n > 0").agg(
        F.sum(off * off - n * m * (1 - m)).alias("excess"), F.sum(n * (n - 1) * m * (1 - m)).alias("room")
    )
    row = found.first()
    r = row["excess"] / row["room"] if row["room"] else 0.0
    return 1 / min(max(r, 1 / (MOST_STRENGTH + 1)), 1 / (LEAST_STRENGTH + 1)) - 1


def host_reputation(sites: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posterior of each site: site, n, bad, alpha, beta.

    ``sites`` has distinct (site, domain, suffix); ``outcomes`` has (site, n, bad), the labelled
    pages of a site and how many of them are bad. A prior is worth no more than the parent's
    posterior, so that few labels in all make no strong priors.
    """
    folder = shared_folder(sites.sparkSession, "reputation")
    counted = stored(sites.join(outcomes, "site", "left").na.fill(0, ["n", "bad"]), folder, "sites")
    total = counted.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    bad, n = total["bad"] or 0, total["n"] or 0
    prior, worth = (TOP_PRIOR[0] + bad) / (sum(TOP_PRIOR) + n), sum(TOP_PRIOR) + n
    found = None
    for depth, level in enumerate(LEVELS):
        above = list(LEVELS[depth - 1 : depth]) if depth else []
        groups = counted.groupBy(*above, level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if found is None:
            groups = groups.select("*", F.lit(prior).alias("prior"), F.lit(float(worth)).alias("worth"))
        else:
            mean, worth = F.col("alpha") / (F.col("alpha") + F.col("beta")), F.col("alpha") + F.col("beta")
            groups = groups.join(found.select(*above, mean.alias("prior"), worth.alias("worth")), above)
        groups = stored(groups, folder, f"{level}-counts")
        strength = F.least(F.lit(prior_strength(groups)), F.col("worth"))
        alpha = F.col("prior") * strength + F.col("bad")
        beta = (1 - F.col("prior")) * strength + F.col("n") - F.col("bad")
        found = groups.select(level, "n", "bad", alpha.alias("alpha"), beta.alias("beta"))
    return found


def lower_bound(alpha: Column, beta: Column, deviations: float = DEVIATIONS) -> Column:
    """Mean of the beta distribution less some of its standard deviations."""
    total = alpha + beta
    return alpha / total - deviations * F.sqrt(alpha * beta / (total * total * (total + 1)))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    outcome: Column | None = None,
    label_id: str = "doc_id",
    max_bad_share: float = MAX_BAD_SHARE,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """A row for each page: page_id, host, path, rule (or null) and verdict.

    ``outcome`` says whether a label calls its page bad (null: no outcome); unless given, low
    quality or toxic.
    """
    if outcome is None:
        outcome = (F.col("quality") == 0) | (F.col("toxic") == 1)
    host, path = url_parts(F.col("url"))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    placed = placed.select("*", rule.alias("rule"), decided.alias("decided"))
    judged = labels.select(F.col(label_id).alias("page_id"), outcome.alias("bad"))
    judged = judged.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")
    )
    site = site_levels(F.col("host"))["site"]
    outcomes = placed.select("page_id", site.alias("site")).join(judged, "page_id").groupBy("site").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    hosts = placed.select("host").distinct()
    levels = {k: c.alias(k) for k, c in site_levels(F.col("host")).items()}
    sites = hosts.select(*levels.values()).distinct()
    bad = host_reputation(sites, outcomes).where(lower_bound(F.col("alpha"), F.col("beta")) > max_bad_share)
    blocked = hosts.select("host", levels["site"]).join(bad.select("site"), "site").select("host")
    blocked = stored(blocked, shared_folder(pages.sparkSession, "reputation"), "blocked")
    marked = _marked(placed, blocked, max_broadcast_bytes)
    verdict = F.coalesce("decided", F.when(F.col("blocked"), "block").otherwise("allow"))
    return marked.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def _marked(placed: DataFrame, blocked: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """The pages with ``blocked``. A salted host is joined in ``SALT`` parts, none of them hot."""
    named = blocked.select("host", F.lit(True).alias("blocked"))
    if blocked.agg(value_bytes(blocked).alias("size")).first()["size"] <= max_broadcast_bytes:
        return placed.join(F.broadcast(named), "host", "left")
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("part")
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(SALT)).cast("int").alias("part")
    return placed.select("*", salt).join(named.select("*", parts), ["host", "part"], "left").drop("part")
