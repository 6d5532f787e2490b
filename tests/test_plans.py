"""What the physical plans must look like for large input."""

import re

import pytest
from pyspark.sql import functions as F

from postlytics.operators import pairs, promotion, scoring, tags, topics, windows
from postlytics.plans import fixtures
from postlytics.plans.catalog import QUERIES
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def split(spark):
    return fixtures.split_posts(spark, SF_DIR)


@pytest.mark.parametrize("name", ["a1_seed_window_counts", "a2_tag_window_counts", "f8_funnel", "a6_topic_counts", "p6_country"])
def test_counts_do_not_read_texts(spark, name):
    schemas = re.findall(r"ReadSchema: (\S+)", plan(QUERIES[name](spark, SF_DIR)))
    assert schemas and not any("text:string" in s for s in schemas)


def test_seed_acceptance_has_no_shuffle(split):
    assert "Exchange" not in plan(tags.with_seed_tag(split))


def test_time_filters_reach_the_scan(split):
    shares = promotion.shares_at(pairs.other_tag_buckets(split), pairs.total_buckets(split), fixtures.EPOCH + 50)
    assert "GreaterThanOrEqual(sec" in plan(shares)


def test_windows_shuffle_buckets_once(spark):
    buckets = spark.createDataFrame([("a", 1, 1)], "tag string, sec long, n long")
    text = plan(windows.sliding_sum(buckets, "tag"))
    assert text.count("Exchange") == 1
    assert "hashpartitioning(tag" in text and "chunk" in text


def test_buckets_are_counted_before_the_shuffle(split):
    text = plan(pairs.other_tag_buckets(split))
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_top_words_are_limited_before_the_shuffle(spark):
    weights = spark.createDataFrame([("a", 0, 1.0)], "word string, topic int, weight double")
    assert "WindowGroupLimit" in plan(topics.top_words(weights))


def test_scoring_shuffles_partial_sums_of_posts_only(spark):
    posts = spark.createDataFrame([(1, ["a"])], "key long, words array<string>")
    slots = spark.createDataFrame([("a", *[1.0] * 10)], ["word", *[f"w{i}" for i in range(10)]])
    text = plan(scoring.topic_scores(posts, F.broadcast(slots)))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1


def test_no_query_uses_python_rows_or_cross_joins(spark):
    for name in ("f5_promoted_accept", "a4_overall_shares", "a13_follower_terciles", "a9_best_topic", "t5_clean_words"):
        text = plan(QUERIES[name](spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)
