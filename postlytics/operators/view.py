"""Counts by country, follower group and topic, and dormant reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlytics.settings import DEFAULTS, Settings

# at most 2^17 blocks of values, of 2^14 values at least
_BLOCK_BITS, _BLOCKS_BITS = 14, 17


def topic_counts(posts: DataFrame, topic: str = "label") -> DataFrame:
    """(region, follower_group, topic, count); a missing country is a group of its own."""
    return (
        posts.groupBy(F.col("country").alias("region"), "follower_group", F.col(topic).alias("topic"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def topic_view(posts: DataFrame, topic: str = "label", settings: Settings = DEFAULTS) -> DataFrame:
    """Topic counts per flush interval, stamped with its end; works on tables and streams."""
    return (
        posts.groupBy(
            F.window("ts", settings.flush_interval).alias("flush"),
            F.col("country").alias("region"),
            "follower_group",
            F.col(topic).alias("topic"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("flush.end").alias("ts"), "region", "follower_group", "topic", "count")
    )


def follower_terciles(posts: DataFrame, followers: str = "followers") -> DataFrame:
    """(tercile, n, average, lowest, highest) of the follower counts in ascending order.

    With n posts the first third ends before rank n // 3 and the second before rank 2n // 3,
    ranks from 1; the cut ranks open the next third. Posts are first folded to one row per
    follower count, and ranks come from running counts in blocks of nearby values, so no window
    holds more than 2^14 values or 2^17 blocks whatever the number of posts. Equal counts are
    split over two thirds by number, which is exact because they are interchangeable.
    """
    value = F.col(followers).cast("long")
    folded = (
        posts.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("times"))
    )
    largest = posts.agg(F.max(F.abs(value))).first()[0] or 0
    bits = max(_BLOCK_BITS, largest.bit_length() + 1 - _BLOCKS_BITS)
    folded = folded.withColumn("block", F.shiftright("value", bits))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # at most 2^17 block rows, by the largest value
    blocks = folded.groupBy("block").agg(F.sum("times").alias("block_times"))
    offsets = blocks.select("block", F.coalesce(F.sum("block_times").over(earlier), F.lit(0)).alias("before_block"))
    inside = Window.partitionBy("block").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    total = blocks.agg(F.sum("block_times"))
    ranked = (
        folded.join(offsets, "block")
        .withColumn("before", F.col("before_block") + F.coalesce(F.sum("times").over(inside), F.lit(0)))
        .withColumn("total", total.scalar())
    )
    first, second = F.floor(F.col("total") / 3), F.floor(F.col("total") * 2 / 3)
    # last rank of each third
    thirds = F.array(
        _third("small", F.lit(0), first - 1),
        _third("medium", F.greatest(first - 1, F.lit(0)), second - 1),
        _third("big", F.greatest(second - 1, F.lit(0)), F.col("total")),
    )
    overlap = F.least(F.col("before") + F.col("times"), F.col("third.last")) - F.greatest(
        F.col("before"), F.col("third.skip")
    )
    return (
        ranked.select("value", "times", "before", F.explode(thirds).alias("third"))
        .select("value", F.col("third.name").alias("tercile"), overlap.alias("part"))
        .filter("part > 0")
        .groupBy("tercile")
        .agg(
            F.sum("part").alias("n"),
            (F.sum(F.col("value") * F.col("part")) / F.sum("part")).alias("average"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )


def _third(name: str, skip: Column, last: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"), skip.cast("long").alias("skip"), last.cast("long").alias("last")
    )


def location_text(location: Column) -> Column:
    return F.concat(
        location["latitude"].cast("string"), F.lit(","), location["longitude"].cast("string")
    )


def counts_by(posts: DataFrame, text: Column, name: str) -> DataFrame:
    """(name, count) with missing values counted as 'null'."""
    return posts.groupBy(F.coalesce(text, F.lit("null")).alias(name)).agg(
        F.count(F.lit(1)).alias("count")
    )
