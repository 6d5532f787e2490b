"""Tag lists and the split of a post's tags by a list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.settings import DEFAULTS, Settings

_NO_TAGS = "array<string>"


@dataclass(frozen=True)
class TagList:
    """Lowercase tags, held as literals while few and as a table otherwise."""

    table: DataFrame
    values: tuple[str, ...] | None

    @classmethod
    def of(cls, table: DataFrame, settings: Settings = DEFAULTS) -> TagList:
        """`table` has one column `tag` and may be empty; at most inline_list_limit + 1 rows reach the driver."""
        tags = table.select(F.lower("tag").alias("tag")).distinct()
        head = [r.tag for r in tags.limit(settings.inline_list_limit + 1).collect()]
        small = len(head) <= settings.inline_list_limit
        return cls(tags, tuple(sorted(head)) if small else None)


    @classmethod
    def required(cls, table: DataFrame, settings: Settings = DEFAULTS) -> TagList:
        """A list that must not be empty, such as the seeds of a job."""
        found = cls.of(table, settings)
        if found.values == ():
            raise ValueError("the tag list is empty")
        return found


def has_tags(tags: Column) -> Column:
    return F.size(tags) > 0


def split_tags(posts: DataFrame, seeds: TagList, key: str = "key") -> DataFrame:
    """Adds `seed_tags` and `other_tags`, both with duplicates; `tags` must be lowercase.

    A short list is tested in the row, without a shuffle. A long one is joined by tag, where
    adaptive execution picks broadcast or a skew-split sort-merge join by measured size; one
    group is then one post.
    """
    if seeds.values == ():
        none = F.array().cast(_NO_TAGS)
        return posts.withColumns({"seed_tags": none, "other_tags": F.coalesce("tags", none)})
    if seeds.values is not None:
        return posts.withColumns({
            "seed_tags": F.filter("tags", lambda t: t.isin(*seeds.values)),
            "other_tags": F.filter("tags", lambda t: ~t.isin(*seeds.values)),
        })
    marked = (
        posts.select(key, F.explode("tags").alias("tag"))
        .join(seeds.table.withColumn("listed", F.lit(True)), "tag", "left")
        .groupBy(key)
        .agg(
            F.collect_list(F.when(F.col("listed"), F.col("tag"))).alias("seed_tags"),
            F.collect_list(F.when(F.col("listed").isNull(), F.col("tag"))).alias("other_tags"),
        )
    )
    none = F.array().cast(_NO_TAGS)
    return posts.join(marked, key, "left").withColumns({
        "seed_tags": F.coalesce("seed_tags", none),
        "other_tags": F.coalesce("other_tags", none),
    })


def with_seed_tag(split: DataFrame) -> DataFrame:
    """Posts with at least one seed tag."""
    return split.filter(has_tags(F.col("seed_tags")))


def without_seed_tag(split: DataFrame) -> DataFrame:
    return split.filter(~has_tags(F.col("seed_tags")))


def tracked(posts: DataFrame, seeds: TagList, settings: Settings = DEFAULTS) -> DataFrame:
    """Ingest filter: one language and any of the seeds, or of the first n in sorted order if set."""
    wanted = seeds
    if settings.tracked_seeds is not None:
        wanted = TagList.of(seeds.table.orderBy("tag").limit(settings.tracked_seeds), settings)
    return with_seed_tag(
        split_tags(posts.filter(F.col("language") == settings.tracked_language), wanted)
    )
