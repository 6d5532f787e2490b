"""Shares of other tags in all pairs, and the tags they promote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.operators.pairs import other_tag_buckets, total_buckets
from postlytics.operators.tags import has_tags
from postlytics.operators.windows import sliding_sum
from postlytics.settings import DEFAULTS, Settings

# more promoted tags per second than this are not kept as one array
_ARRAY_LIMIT = 10_000
# promoted tags of all seconds together that may be broadcast
_BROADCAST_TAGS = 1_000_000


def _share() -> Column:
    return F.col("n").cast("double") / F.nullif(F.col("pair_total"), F.lit(0)).cast("double")


def overall_shares(split: DataFrame) -> DataFrame:
    """Share of each other tag in all pairs of the input, no window."""
    counts = other_tag_buckets(split).groupBy("tag").agg(F.sum("n").alias("n"))
    total = total_buckets(split).agg(F.sum("n"))
    return counts.withColumn("pair_total", total.scalar()).withColumn("share", _share())


def windowed_shares(
    tag_buckets: DataFrame, totals: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """(tag, sec, n, pair_total, share) at every bucket of a tag."""
    counts = sliding_sum(tag_buckets, "tag", settings=settings)
    total = sliding_sum(totals, settings=settings).withColumnRenamed("n", "pair_total")
    return counts.join(total, "sec").withColumn("share", _share())


def shares_at(
    tag_buckets: DataFrame, totals: DataFrame, sec: int, settings: Settings = DEFAULTS
) -> DataFrame:
    """Shares in the one window that ends with second `sec`; older buckets are not read."""
    inside = F.col("sec").between(sec - settings.window_seconds + 1, sec)
    counts = tag_buckets.filter(inside).groupBy("tag").agg(F.sum("n").alias("n"))
    total = totals.filter(inside).agg(F.sum("n"))
    return counts.withColumn("pair_total", total.scalar()).withColumn("share", _share())


def promoted(shares: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Shares that reach the threshold; no total means no share and no promotion."""
    return shares.filter(F.col("share") >= settings.share_threshold)


def top_shares(shares: DataFrame, n: int = 10) -> DataFrame:
    return shares.orderBy(F.desc("share"), "tag").limit(n)


def mark_accepted(
    split: DataFrame,
    tag_buckets: DataFrame | None = None,
    totals: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    key: str = "key",
    seconds: int | None = None,
) -> DataFrame:
    """Adds `match_kind`: 'seed', else 'promoted', else null, for every post.

    A post without seed tag is accepted when one of its tags is promoted in the window that ends
    with the post's own second, counting the pairs of that second. A stream passes buckets that
    also hold what came before `split`.

    Posts with a seed tag need no lookup and are not shuffled. The others meet the promoted tags
    by second: the shares of one second add up to 1, so at most 1 / threshold tags are promoted
    in it and travel as one array. `seconds`, when known, bounds the number of seconds in the
    buckets; few enough are broadcast, which a micro-batch of one or two hot seconds needs. Else
    adaptive execution chooses by measured size and splits a second that holds most posts.
    Thresholds too small for the bound to help go by one row per tag.
    """
    if tag_buckets is None or totals is None:
        tag_buckets, totals = other_tag_buckets(split, probes=True), total_buckets(split, probes=True)
    hot = promoted(windowed_shares(tag_buckets, totals, settings), settings)
    seed = has_tags(F.col("seed_tags"))
    seeded, others = split.filter(seed), split.filter(~seed)
    if settings.share_threshold * _ARRAY_LIMIT >= 1:
        per_second = hot.groupBy("sec").agg(F.collect_list("tag").alias("promoted_tags"))
        if seconds is not None and seconds <= _BROADCAST_TAGS * settings.share_threshold:
            per_second = F.broadcast(per_second)
        joined = others.join(per_second, "sec", "left")
        by_promotion = F.arrays_overlap("other_tags", "promoted_tags")
    else:
        per_post = (
            others.select(key, "sec", F.explode("other_tags").alias("tag"))
            .join(hot.select("tag", "sec"), ["tag", "sec"], "left_semi")
            .select(key, F.lit(True).alias("promoted_tags"))
            .distinct()
        )
        joined = others.join(per_post, key, "left")
        by_promotion = F.col("promoted_tags")
    return seeded.withColumn("match_kind", F.lit("seed")).unionByName(
        joined.withColumn("match_kind", F.when(by_promotion, "promoted")).drop("promoted_tags")
    )


def accepted(marked: DataFrame) -> DataFrame:
    """Union of seed-accepted and promoted-accepted posts."""
    return marked.filter(F.col("match_kind").isNotNull())


def merge_buckets(now: DataFrame, before: DataFrame, *keys: str) -> DataFrame:
    """Buckets of a batch and of the time before it, one row per key again."""
    columns = [*keys, "n"]
    both = now.select(*columns).unionByName(before.select(*columns))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"))


# the counters of `funnel_columns`, in their order
FUNNEL = ("posts", "without_tags", "without_seed", "with_seed", "with_seed_or_promoted", "accepted_promoted")


def funnel_columns() -> list[Column]:
    """Counters over posts marked by `mark_accepted`."""
    tagged, seed = F.size("tags") > 0, F.size("seed_tags") > 0
    kind = F.col("match_kind")
    counted = (F.lit(True), ~tagged, tagged & ~seed, seed, kind.isNotNull(), kind == "promoted")
    return [F.count_if(which).alias(name) for name, which in zip(FUNNEL, counted)]


def ingest_columns() -> list[Column]:
    """Counters of the ingest job."""
    tagged = F.size("tags") > 0
    return [
        F.count(F.lit(1)).alias("posts"),
        F.count_if(tagged).alias("with_tags"),
        F.count_if(~tagged).alias("without_tags"),
    ]
