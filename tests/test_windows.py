import random
from collections import defaultdict
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postlytics.operators import promotion
from postlytics.operators.tags import TagList, split_tags
from postlytics.operators.windows import sliding_sum
from postlytics.settings import DEFAULTS


def brute(rows, size=300):
    by_tag = defaultdict(dict)
    for tag, sec, n in rows:
        by_tag[tag][sec] = n
    return {
        (tag, sec): sum(m for s, m in secs.items() if sec - size < s <= sec)
        for tag, secs in by_tag.items()
        for sec in secs
    }


def run(spark, rows, **changes):
    df = spark.createDataFrame(rows, "tag string, sec long, n long")
    result = sliding_sum(df, "tag", settings=replace(DEFAULTS, **changes)).collect()
    got = {(r.tag, r.sec): r.n for r in result}
    assert len(got) == len(result)
    return got


def test_edges(spark):
    rows = [("t", 1000, 1), ("t", 1299, 10), ("t", 1300, 100), ("u", 1300, 7)]
    assert run(spark, rows) == {("t", 1000): 1, ("t", 1299): 11, ("t", 1300): 110, ("u", 1300): 7}


def test_window_reaches_over_a_chunk_border(spark):
    rows = [("t", s, 1) for s in range(3200, 4000)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("chunk", [300, 301, 777, 3600])
def test_chunk_size_does_not_matter(spark, chunk):
    draw = random.Random(chunk)
    hot = [("hot", s, draw.randint(0, 5)) for s in range(0, 2500)]
    rest = {(f"t{draw.randint(0, 20)}", draw.randint(-500, 4000)): draw.randint(0, 9) for _ in range(2000)}
    rows = hot + [(t, s, n) for (t, s), n in rest.items()]
    assert run(spark, rows, chunk_seconds=chunk) == brute(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.tuples(st.sampled_from("ab"), st.integers(-50, 60)), st.integers(0, 4), min_size=1))
def test_small_windows(spark, cells):
    rows = [(t, s, n) for (t, s), n in cells.items()]
    assert run(spark, rows, window_seconds=7, chunk_seconds=10) == brute(rows, 7)


def test_short_chunks_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [("t", 1, 1)], chunk_seconds=299)


def random_posts(seed, count):
    draw = random.Random(seed)
    tags = ["s1", "s2", "hot"] + [f"t{i}" for i in range(30)]
    return [
        (i, draw.randint(0, 1500), draw.choices(tags, [3, 1, 20] + [1] * 30, k=draw.randint(0, 5)))
        for i in range(count)
    ]


def expected_kinds(posts, threshold, window=300):
    pairs = []
    for _, sec, tags in posts:
        s = sum(t in ("s1", "s2") for t in tags)
        pairs += [(sec, t, s) for t in tags if t not in ("s1", "s2") and s]
    kinds = {}
    for key, sec, tags in posts:
        recent = [(t, n) for s, t, n in pairs if sec - window < s <= sec]
        total = sum(n for _, n in recent)
        if any(t in ("s1", "s2") for t in tags):
            kinds[key] = "seed"
        elif total and any(sum(n for t, n in recent if t == tag) / total >= threshold for tag in tags):
            kinds[key] = "promoted"
        else:
            kinds[key] = None
    return kinds


@pytest.mark.parametrize("threshold", [0.05, 0.5, 0.00005])
def test_acceptance_equals_brute_force(spark, threshold):
    """The last threshold is so small that promoted tags travel row by row."""
    posts = random_posts(3, 400)
    df = spark.createDataFrame(posts, "key long, sec long, tags array<string>")
    seeds = TagList.of(spark.createDataFrame([("s1",), ("s2",)], "tag string"))
    marked = promotion.mark_accepted(
        split_tags(df, seeds), settings=replace(DEFAULTS, share_threshold=threshold)
    ).collect()
    assert len(marked) == len(posts)
    got = {r.key: r.match_kind for r in marked}
    assert got == expected_kinds(posts, threshold)
    assert {"seed", "promoted", None} <= set(got.values())


def test_no_pairs_no_promotion(spark):
    df = spark.createDataFrame([(1, 5, ["a"]), (2, 6, ["s1"])], "key long, sec long, tags array<string>")
    seeds = TagList.of(spark.createDataFrame([("s1",)], "tag string"))
    split = split_tags(df, seeds)
    got = {r.key: r.match_kind for r in promotion.mark_accepted(split).collect()}
    assert got == {1: None, 2: "seed"}
    assert promotion.overall_shares(split).count() == 0


def test_shares_at_equals_the_window(spark):
    from postlytics.operators.pairs import other_tag_buckets, total_buckets

    posts = random_posts(5, 300)
    df = spark.createDataFrame(posts, "key long, sec long, tags array<string>")
    seeds = TagList.of(spark.createDataFrame([("s1",), ("s2",)], "tag string"))
    split = split_tags(df, seeds)
    b, t = other_tag_buckets(split), total_buckets(split)
    windowed = {(r.tag, r.sec): r.share for r in promotion.windowed_shares(b, t).collect()}
    last = max(sec for _, sec in windowed)
    at = {r.tag: r.share for r in promotion.shares_at(b, t, last).collect()}
    for (tag, sec), share in windowed.items():
        if sec == last:
            assert at[tag] == share
    assert abs(sum(at.values()) - 1) < 1e-9
