"""Seed tag x other tag pairs inside a post, and their counts per second.

A post with s seed tags and o other tags stands for s * o pairs. Counting never builds them:
an other tag occurs in s pairs, a seed tag in o, and the post adds s * o to the total. So rows
per post grow with s + o.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(split: DataFrame, *by: str) -> DataFrame:
    """Pairs as (by.., seed_tag, other_tag, n); n counts repeated tags as often as they occur.

    Seed tags are folded to (tag, multiplicity) in the row first, so a post yields one row per
    distinct seed tag and other tag occurrence. Outer explodes as in `_per_tag`.
    """
    seeds = F.transform(
        F.array_distinct("seed_tags"),
        lambda t: F.named_struct(
            F.lit("tag"), t,
            F.lit("times"), F.size(F.filter("seed_tags", lambda x: x == t)).cast("long"),
        ),
    )
    return (
        split.select(*by, "other_tags", seeds.alias("seeds"))
        .select(*by, F.explode_outer("other_tags").alias("other_tag"), "seeds")
        .filter("other_tag IS NOT NULL")
        .select(*by, "other_tag", F.explode_outer("seeds").alias("seed"))
        .filter("seed IS NOT NULL")
        .groupBy(*by, F.col("seed.tag").alias("seed_tag"), "other_tag")
        .agg(F.sum("seed.times").alias("n"))
    )


def _per_tag(split: DataFrame, tags: str, pairs_of_one: Column) -> DataFrame:
    """(tag, sec, n) where each occurrence of a tag in `tags` stands for so many pairs.

    The number is computed before the array is opened, so rows do not carry the other array.
    explode_outer, because Catalyst adds a size test below a plain explode and pushes it to the
    scan, where it evaluates the tags a second time.
    """
    return (
        split.select("sec", tags, pairs_of_one.cast("long").alias("pairs"))
        .select("sec", "pairs", F.explode_outer(tags).alias("tag"))
        .filter("tag IS NOT NULL")
        .groupBy("tag", "sec")
        .agg(F.sum("pairs").alias("n"))
    )


def other_tag_buckets(split: DataFrame, probes: bool = False) -> DataFrame:
    """Pairs per (tag, sec) seen from the other tag.

    With `probes`, tags of posts without a seed tag give rows of n = 0, so that a window ends
    at each instant such a tag arrives.
    """
    buckets = _per_tag(split, "other_tags", F.size("seed_tags"))
    return buckets if probes else buckets.filter("n > 0")


def seed_tag_buckets(split: DataFrame) -> DataFrame:
    """Pairs per (tag, sec) seen from the seed tag."""
    return _per_tag(split, "seed_tags", F.size("other_tags")).filter("n > 0")


def total_buckets(split: DataFrame, probes: bool = False) -> DataFrame:
    """All pairs per second; with `probes` also seconds without pairs, as n = 0."""
    n = F.size("seed_tags").cast("long") * F.size("other_tags").cast("long")
    buckets = split.select("sec", n.alias("n")).groupBy("sec").agg(F.sum("n").alias("n"))
    return buckets if probes else buckets.filter("n > 0")
