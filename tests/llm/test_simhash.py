"""Golay keys, fingerprints and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from postlytics.llm import simhash
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_print(text, size=3):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=3):
    """key -> smallest reachable key; `prints` maps keys to fingerprints."""
    keys = sorted(prints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: root(k) for k in keys}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_code_is_perfect():
    assert len(set(simhash.ERRORS.tolist())) == 2048
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    data = simhash.nearest_codewords(words)
    codewords = data << 11
    codewords |= simhash._remainder(codewords)
    assert max(int(x).bit_count() for x in codewords ^ words) <= 3


@pytest.mark.parametrize(("distance", "keys"), [(3, simhash.exact_keys), (5, simhash.fuzzy_keys)])
def test_keys_meet_within_distance(distance, keys):
    draw = random.Random(3)
    for _ in range(400):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), distance):
            b ^= 1 << bit
        stored = keys(np.array([signed(a)]))[0]
        probes = simhash.fuzzy_keys(np.array([signed(b)]))[0]
        assert set(stored.tolist()) & set(probes.tolist())


@pytest.mark.parametrize("distance", [3, 5])
def test_links_join_dense_and_sparse_groups(spark, distance):
    draw = random.Random(distance)
    prints = {}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            value = centre
            for bit in draw.sample(range(64), draw.randrange(7)):
                value ^= 1 << bit
            prints[signed(value)] = value
    rows = spark.createDataFrame([(0, fp) for fp in prints], "which int, fp long")
    found = simhash.links(rows, distance).collect()
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= distance for r in found)
    assert len(found) == len({(r.a, r.b) for r in found})
    got = {r.node: r.label for r in simhash.components(spark.createDataFrame(found).select("a", "b")).collect()}
    want = plain_groups(prints, distance)
    assert {k: got.get(k, k) for k in prints} == want


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (500, 500)], "a long, b long")
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {doc_id: plain_print(text) for doc_id, text in docs.items()}
    groups = plain_groups(prints)
    rows = QUERIES["op6_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{prints[d]:016x}", groups[d]) for d in docs
    }


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.fingerprint_report(odd_docs).collect()
    assert len(rows) == 8
    assert {(r.doc_id, r.component_id) for r in rows if r.fingerprint == "0" * 16} == {(1, 1), (2, 1), (None, 1), (7, 1)}
    assert {r.component_id for r in rows if r.doc_id == 4} == {4}
    assert simhash.fingerprint_report(no_docs).count() == 0


def test_one_of_each_group(spark, odd_docs, no_docs):
    kept = simhash.one_of_each_group(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 4]
    assert simhash.one_of_each_group(no_docs).count() == 0


def test_one_row_stays_where_texts_share_an_id(spark):
    far = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b c"), (1, far), (1, far), (2, far), (3, "A  B c"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.one_of_each_group(docs).collect()) == [(1, "a b c"), (1, far), (4, None)]


@pytest.mark.parametrize("distance", [3, 5])
def test_exploded_keys_are_not_broadcast(spark, distance):
    rows = spark.range(2000).select(F.lit(0).alias("which"), F.xxhash64("id").alias("fp"))
    found = simhash.links(rows, distance)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
