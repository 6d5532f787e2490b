from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from postlytics.operators import pairs
from postlytics.operators.tags import TagList, split_tags, tracked, with_seed_tag
from postlytics.settings import DEFAULTS
from postlytics.sources.seeds import parse_seed_lines, read_seeds

POSTS = [
    (1, 10, ["s1", "a", "a", "s2"]),
    (2, 10, ["s1", "s1", "b"]),
    (3, 11, ["s1"]),
    (4, 11, ["a", "b"]),
    (5, 12, []),
]
SEEDS = {"s1", "s2"}


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, "key long, sec long, tags array<string>")


@pytest.fixture(params=[1000, 1], ids=["inline", "joined"])
def split(spark, posts, request):
    table = spark.createDataFrame([("S1",), ("s2",), ("s1",)], "tag string")
    seeds = TagList.of(table, replace(DEFAULTS, inline_list_limit=request.param))
    assert (seeds.values is None) == (request.param == 1)
    return split_tags(posts, seeds)


def expected_pairs():
    found = Counter()
    for key, sec, tags in POSTS:
        for s in (t for t in tags if t in SEEDS):
            for o in (t for t in tags if t not in SEEDS):
                found[key, sec, s, o] += 1
    return found


def test_split_keeps_duplicates(split):
    got = {r.key: (sorted(r.seed_tags), sorted(r.other_tags)) for r in split.collect()}
    assert got == {
        k: (sorted(t for t in tags if t in SEEDS), sorted(t for t in tags if t not in SEEDS))
        for k, _, tags in POSTS
    }


def test_accept(split):
    assert sorted(r.key for r in with_seed_tag(split).collect()) == [1, 2, 3]


def test_pairs_equal_brute_force(split):
    got = {(r.key, r.seed_tag, r.other_tag): r.n for r in pairs.pair_counts(split, "key").collect()}
    assert got == {(k, s, o): n for (k, _, s, o), n in expected_pairs().items()}


def test_factored_counts_equal_the_pairs(split):
    others, seeds, totals = Counter(), Counter(), Counter()
    for (_, sec, s, o), n in expected_pairs().items():
        others[o, sec] += n
        seeds[s, sec] += n
        totals[sec] += n
    assert {(r.tag, r.sec): r.n for r in pairs.other_tag_buckets(split).collect()} == others
    assert {(r.tag, r.sec): r.n for r in pairs.seed_tag_buckets(split).collect()} == seeds
    assert {r.sec: r.n for r in pairs.total_buckets(split).collect()} == totals


def test_probes_add_empty_rows(split):
    got = {(r.tag, r.sec): r.n for r in pairs.other_tag_buckets(split, probes=True).collect()}
    assert got["a", 11] == got["b", 11] == 0
    assert {r.sec: r.n for r in pairs.total_buckets(split, probes=True).collect()} == {10: 6, 11: 0, 12: 0}


def test_empty_list_matches_nothing(spark):
    none = spark.createDataFrame([], "tag string")
    posts = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "key long, tags array<string>")
    rows = split_tags(posts, TagList.of(none)).orderBy("key").collect()
    assert [(r.seed_tags, r.other_tags) for r in rows] == [([], ["a", "b"]), ([], []), ([], [])]
    with pytest.raises(ValueError):
        TagList.required(none)


def test_seed_lines(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_bytes("﻿Trump##maga# #MAGA#\ntrump#usa\n".encode())
    assert sorted(r.tag for r in read_seeds(spark, str(path)).collect()) == ["maga", "trump", "usa"]


def test_seed_lines_of_a_table(spark):
    lines = spark.createDataFrame([("A#b",), ("",), (None,)], "value string")
    assert sorted(r.tag for r in parse_seed_lines(lines).collect()) == ["a", "b"]


def test_tracked_takes_the_first_sorted_seeds(spark):
    posts = spark.createDataFrame(
        [(1, "en", ["s1"]), (2, "en", ["s2"]), (3, "de", ["s1"])], "key long, language string, tags array<string>"
    )
    seeds = TagList.of(spark.createDataFrame([("s2",), ("s1",)], "tag string"))
    assert [r.key for r in tracked(posts, seeds, replace(DEFAULTS, tracked_seeds=1)).collect()] == [1]
    both = tracked(posts, seeds).agg(F.count("key")).first()[0]
    assert both == 2


def test_tracked_takes_all_seeds(spark):
    names = [f"s{i:04}" for i in range(1500)]
    seeds = TagList.of(spark.createDataFrame([(n,) for n in names], "tag string"))
    posts = spark.createDataFrame([(i, "en", [n]) for i, n in enumerate(names)], "key long, language string, tags array<string>")
    assert tracked(posts, seeds).count() == 1500
