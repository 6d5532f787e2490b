import random

import pytest
from pyspark.sql import functions as F

from dataclasses import replace

from postlytics.operators import scoring
from postlytics.operators.lookups import lookup
from postlytics.settings import DEFAULTS

SETTINGS = replace(DEFAULTS, topics=4)
WEIGHTS = [
    ("zero", 0, 5.0),
    ("tie", 1, 2.0), ("tie", 3, 2.0),
    ("all", 0, 1.0), ("all", 1, 2.0), ("all", 2, 3.0), ("all", 3, 2.5),
    ("two", 0, 1.0), ("two", 2, 4.0),
]


def best(spark, posts, mode, weights=WEIGHTS):
    df = spark.createDataFrame(posts, "key long, words array<string>")
    table = spark.createDataFrame(weights, "word string, topic int, weight double")
    slots = lookup(scoring.word_slots(table, mode, SETTINGS), 100)
    scores = scoring.topic_scores(df, slots, settings=SETTINGS)
    return {r.key: r.topic for r in scores.select("key", scoring.best_topic(mode).alias("topic")).collect()}


def by_hand(words, mode, weights=WEIGHTS, k=4):
    """Scores as the rules read, word by word."""
    scores = [0.0] * k
    for word in words:
        entries = sorted((t, w) for x, t, w in weights if x == word)
        for i, (topic, weight) in enumerate(entries):
            if mode == "sum":
                scores[topic] += weight
            else:
                scores[i] += weight * (len(entries) - i)
    if mode == "sum":
        top = max(scores)
        return scores.index(top) if top > 0 else None
    top = max(scores[1:])
    return scores.index(top, 1) if top > 0 else 0


@pytest.mark.parametrize("mode", ["sum", "positional"])
def test_cases(spark, mode):
    posts = [(1, ["zero"]), (2, ["tie"]), (3, ["unknown"]), (4, []), (5, ["all", "all"]), (6, ["two", "zero", "all"])]
    assert best(spark, posts, mode) == {k: by_hand(w, mode) for k, w in posts}


def test_edges_by_value(spark):
    posts = [(1, ["zero"]), (2, ["tie"]), (3, ["unknown"]), (4, [])]
    assert best(spark, posts, "sum") == {1: 0, 2: 1, 3: None, 4: None}
    assert best(spark, posts, "positional") == {1: 0, 2: 1, 3: 0, 4: 0}


@pytest.mark.parametrize("mode", ["sum", "positional"])
def test_random_posts(spark, mode):
    draw = random.Random(2)
    weights = [(f"w{i}", t, float(draw.randint(0, 9))) for i in range(40) for t in range(4)]
    posts = [(i, draw.choices([f"w{j}" for j in range(60)], k=draw.randint(0, 12))) for i in range(200)]
    assert best(spark, posts, mode, weights) == {k: by_hand(w, mode, weights) for k, w in posts}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        scoring.word_slots(spark.createDataFrame(WEIGHTS, "word string, topic int, weight double"), "mean")


def test_large_lookups_are_not_broadcast(spark):
    table = spark.range(50)
    assert "broadcast" in lookup(table, 50)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in lookup(table, 49)._jdf.queryExecution().logical().toString().lower()


def test_carried_columns_and_labels(spark):
    posts = spark.createDataFrame([(1, ["all"], "DE"), (2, [], None)], "key long, words array<string>, country string")
    table = spark.createDataFrame(WEIGHTS, "word string, topic int, weight double")
    labels = spark.createDataFrame([(2, "two")], "topic int, label string")
    rows = scoring.assign_topics(posts, scoring.word_slots(table, settings=SETTINGS), labels, "country", settings=SETTINGS)
    got = {r.key: (r.country, r.topic, r.label) for r in rows.select("*", F.lit(1)).collect()}
    assert got == {1: ("DE", 2, "two"), 2: (None, None, None)}


def test_weights_of_many_words_are_broadcast_and_joined_beyond_the_bound(spark):
    word = F.concat(F.lit("w"), F.col("id").cast("string")).alias("word")
    weights = spark.range(300_000).select(word, F.lit(0).alias("topic"), F.col("id").cast("double").alias("weight"))
    posts = spark.createDataFrame([(1, ["w3", "w299999", "w3"]), (2, ["none"]), (3, [])], "key long, words array<string>")

    def scores(settings):
        found = scoring.topic_scores(posts, scoring.slots_lookup(scoring.word_slots(weights), settings))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return "strategy=broadcast" in plan, {r.key: (r.known_words, r.scores[0]) for r in found.collect()}

    same = {1: (3, 300_005.0), 2: (0, 0.0), 3: (0, 0.0)}
    assert scores(DEFAULTS) == (True, same)
    assert scores(replace(DEFAULTS, broadcast_numbers=2_999_999)) == (False, same)
