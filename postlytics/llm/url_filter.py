"""URL filters: rules by host and path, and trust that spreads over the link graph.

Hosts whose pages a rule mostly allows are trusted seeds, those whose pages a rule mostly blocks
are blocked seeds. Trust runs along links as a personalised PageRank from the trusted seeds;
distrust runs against them from the blocked seeds, since a host answers for what it links to. Both
are scaled so that a seed without inflow has 1. A host is blocked by the method when its distrust
reaches a threshold and exceeds its trust; pages without a rule get their host's verdict.

All of it is DataFrame code. Pages are reduced to one row per host, or per pair of hosts, by partial
aggregation before anything is shuffled; the state of each round is one row per reached host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Absolute and scheme-relative targets of <a href=..>. A tag ends at the next angle bracket and blanks
# are never given back, so the time is linear in the page also where tags are left open.
LINK = r"""(?i)<a\s[^<>]*?href\s*+=\s*+["']?\s*+((?:https?:)?//[^"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# The rules of the query.
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


@dataclass(frozen=True)
class Spread:
    damping: float = 0.85
    rounds: int = 20
    threshold: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both parts; empty where the url is null or has no `://`."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Number of the longest rule that fits, else null. The list is part of the plan."""
    found = F.lit(None).cast("int")
    for number, rule in sorted(enumerate(rules), key=lambda item: len(item[1].pattern)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(number)).otherwise(found)
    return found


def _pick(number: Column, values: list[str]) -> Column:
    found = F.lit(None).cast("string")
    for i, value in enumerate(values):
        found = F.when(number == i, F.lit(value)).otherwise(found)
    return found


def judged_by_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, by_rule): the longest rule's text and verdict, or nulls."""
    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    numbered = parts.withColumn("number", matched_rule(F.col("host"), F.col("path"), rules))
    return numbered.select(
        "page_id", "host", "path",
        _pick(F.col("number"), [rule.pattern for rule in rules]).alias("rule"),
        _pick(F.col("number"), [rule.verdict for rule in rules]).alias("by_rule"),
    )


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct pairs of different hosts with a link from a page of the one to the other."""
    own, _ = host_and_path(F.col("url").cast("string"))
    target = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    other, _ = host_and_path(target)
    links = pages.select(own.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link"))
    return links.select("src", other.alias("dst")).filter("src <> dst AND src <> '' AND dst <> ''").distinct()


def spread(edges: DataFrame, seeds: DataFrame, settings: Spread = Spread()) -> DataFrame:
    """(host, score): personalised PageRank along the edges (src, dst) from the seeds (host).

    A seed starts with 1 and gets it anew in each round; a host passes on `damping` of its score in
    equal parts to those it links to. Each round is saved by a reliable checkpoint.
    """
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    shares = checkpointed(edges.join(degree, "src").select("src", "dst", (settings.damping / F.col("degree")).alias("part")))
    start = checkpointed(seeds.select("host", F.lit(1.0).alias("score")))
    scores = start
    for _ in range(settings.rounds if not shares.isEmpty() else 0):
        moved = shares.join(scores, shares["src"] == scores["host"]).select(
            F.col("dst").alias("host"), (F.col("part") * F.col("score")).alias("score")
        )
        scores = checkpointed(moved.union(start).groupBy("host").agg(F.sum("score").alias("score")))
    return scores


def blocked_hosts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, settings: Spread = Spread()) -> DataFrame:
    """(host, distrust, trust) of the hosts that the method blocks."""
    counted = judged_by_rules(pages, rules).groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"),
    )
    hosts = checkpointed(counted.filter("host <> ''"))
    edges = checkpointed(host_edges(pages))
    trust = spread(edges, hosts.filter("2 * allowed > pages"), settings)
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = spread(against, hosts.filter("2 * blocked > pages"), settings)
    both = distrust.withColumnRenamed("score", "distrust").join(
        trust.withColumnRenamed("score", "trust"), "host", "left"
    ).withColumn("trust", F.coalesce("trust", F.lit(0.0)))
    return both.filter((F.col("distrust") >= settings.threshold) & (F.col("distrust") > F.col("trust")))


def url_verdicts(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, settings: Spread = Spread()
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of `pages`; repeated rows each give one.

    Null urls and null html have no host and no links; a page without host that no rule fits is
    allowed. A null page_id is carried.
    """
    flagged = blocked_hosts(pages, rules, settings).select("host", F.lit("block").alias("by_host"))
    return judged_by_rules(pages, rules).join(flagged, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict")
    )
