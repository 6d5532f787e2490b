"""Topic of a post from the weights of its words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.operators.lookups import lookup
from postlytics.operators.topics import weights_by_word
from postlytics.settings import DEFAULTS, Settings

SUM, POSITIONAL = "sum", "positional"


def word_slots(word_topics: DataFrame, scoring: str = SUM, settings: Settings = DEFAULTS) -> DataFrame:
    """(word, w0 .. w{k-1}): what one occurrence of a word adds to each topic; a row per word.

    `sum` takes the entry of topic i. `positional` takes the i-th entry and counts it once for
    itself and once for each entry behind it.
    """
    k = settings.topics
    if scoring == SUM:
        slots = [
            F.coalesce(F.sum(F.when(F.col("topic") == i, F.col("weight"))), F.lit(0.0)).alias(f"w{i}")
            for i in range(k)
        ]
        return word_topics.groupBy("word").agg(*slots)
    if scoring == POSITIONAL:
        size = F.size("entries")
        slots = [
            F.when(size > i, F.get("entries", F.lit(i))["weight"] * (size - i))
            .otherwise(F.lit(0.0))
            .alias(f"w{i}")
            for i in range(k)
        ]
        return weights_by_word(word_topics).select("word", *slots)
    raise ValueError(f"unknown scoring {scoring!r}")


def slots_lookup(slots: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """`slots` marked for broadcast, unless it holds more than `broadcast_numbers` numbers.

    The table grows with the vocabulary only. Joined plainly, every word of every post would be
    shuffled and sorted by word, and its weights shuffled again by post.
    """
    return lookup(slots, settings.broadcast_numbers // settings.topics)


def topic_scores(
    posts: DataFrame,
    slots: DataFrame,
    *carry: str,
    settings: Settings = DEFAULTS,
    key: str = "key",
) -> DataFrame:
    """Posts (`key`, `words`, carry..) to (key, carry.., known_words, scores array<double>).

    `slots` comes from `word_slots`. Keys must be unique. A word joins one row that holds all its topic weights, so the fan-out
    is the number of words, not words x topics; the carried columns ride along as group keys,
    so posts are not joined back. Words of one post start in one task, so the partial sum leaves
    one row per post to shuffle. Posts without a known word stay, with zero scores.
    """
    k = settings.topics
    occurrences = posts.select(key, *carry, F.explode_outer("words").alias("word"))
    joined = occurrences.join(slots, "word", "left")
    sums = [F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)]
    return (
        joined.groupBy(key, *carry)
        .agg(F.count("w0").alias("known_words"), *sums)
        .select(key, *carry, "known_words", F.array(*[f"s{i}" for i in range(k)]).alias("scores"))
    )


def best_topic(scoring: str = SUM) -> Column:
    """Topic number from `scores`; ties go to the lowest number.

    `sum`: the highest score, null when no score is above zero. `positional`: topic 0 does not
    compete and is the answer when no other topic scores above zero.
    """
    if scoring == SUM:
        top = F.array_max("scores")
        return F.when(top > 0, F.array_position("scores", top) - 1).cast("int")
    rest = F.slice("scores", 2, F.greatest(F.size("scores") - 1, F.lit(0)))
    top = F.array_max(rest)
    return F.when(top > 0, F.array_position(rest, top)).otherwise(F.lit(0)).cast("int")


def assign_topics(
    posts: DataFrame,
    slots: DataFrame,
    topics: DataFrame,
    *carry: str,
    scoring: str = SUM,
    settings: Settings = DEFAULTS,
    key: str = "key",
) -> DataFrame:
    """(key, carry.., topic, label) of each post; `topics` has one row per topic number."""
    scored = topic_scores(posts, slots, *carry, settings=settings, key=key)
    return (
        scored.select(key, *carry, best_topic(scoring).alias("topic"))
        .join(topics.select("topic", "label"), "topic", "left")
        .select(key, *carry, "topic", "label")
    )
