"""WAND against full scoring, planted passages, and odd rows."""

import itertools
import random

import pytest

from postlytics.llm import decontaminate as dc
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def vocabulary(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 6))) for _ in range(n)]


def build(spark, items, settings):
    rows = dc.weighted_items(spark.createDataFrame(items, ITEMS), settings).orderBy("number").collect()
    return dc.Index([(r.item_id, r.text, [(p.term, p.weight) for p in r.postings]) for r in rows], settings)


@pytest.mark.parametrize("block", [1, 3, 32])
def test_wand_equals_full_scoring(spark, block):
    draw, words = random.Random(block), vocabulary(25, 1)
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(6, 30)))) for i in range(120)]
    settings = dc.Settings(threshold=0.3, block=block)
    index = build(spark, items, settings)
    for _ in range(150):
        terms = sorted(draw.sample(range(len(index.items)), draw.randrange(1, 60)))
        full = {}
        for term in terms:
            for item, weight in zip(index.items[term], index.weights[term]):
                full[item] = full.get(item, 0.0) + weight
        want = {item: score for item, score in full.items() if score >= settings.threshold - 1e-9}
        got = dict(index.wand(terms))
        assert got.keys() == want.keys()
        assert all(got[item] == pytest.approx(want[item]) for item in want)


def test_weights_are_scaled_bm25(spark):
    index = build(spark, [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, "x y z u v w x y")], dc.Settings())
    for item in range(3):
        total = sum(w for items, weights in zip(index.items, index.weights) for i, w in zip(items, weights) if i == item)
        assert total == pytest.approx(1.0)


def test_planted_passages_and_nothing_else(spark):
    draw, words = random.Random(2), vocabulary(400, 2)
    text = lambda n: [draw.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(draw.randrange(10, 90)))) for i in range(40)]
    docs, want = [], set()
    for doc_id in range(120):
        body = text(draw.randrange(20, 900))
        if doc_id % 3 == 0:
            item_id, item = items[doc_id // 3]
            own = item.split()
            if doc_id % 6 == 0 and len(own) > 20:
                own[len(own) // 4] = "changed"
            at = draw.randrange(len(body))
            body = body[:at] + ["X,\n".join(own[:1]), *own[1:]] + body[at:]
            want.add((doc_id, item_id))
        docs.append((doc_id, " ".join(body).upper() if doc_id % 9 == 0 else " ".join(body)))
    found = dc.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_shards_find_the_same(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = [
        sorted((r.doc_id, r.item_id) for r in dc.contaminated(docs, items, dc.Settings(shard_chars=chars)).collect())
        for chars in (1500, 4_000_000)
    ]
    assert found[0] == found[1]


def test_query_finds_every_item_that_stands_in_a_text(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    shares = {}
    for doc in docs:
        words = dc.words_of(doc.text)
        pairs = set(itertools.pairwise(words))
        for item in items:
            own = list(itertools.pairwise(dc.words_of(item.text)))
            shares[doc.doc_id, item.item_id] = sum(p in pairs for p in own) / len(own)
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](spark, SF_DIR).collect()}
    assert {pair for pair, share in shares.items() if share >= 0.95} == got
    assert all(shares[pair] > 0.5 for pair in got)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "too short"), (None, "lorem ipsum dolor sit amet consectetur lorem"), (5, "lorem ipsum dolor sit amet consectetur lorem")], ITEMS
    )
    found = dc.contaminated(odd_docs, items).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in found) == [(3, 0), (3, 5)]
    assert dc.contaminated(no_docs, items).count() == 0
    assert dc.contaminated(odd_docs, items.filter("item_id > 99")).count() == 0
    for chars in (20, 4_000_000):
        kept = dc.without_benchmark(odd_docs, items, dc.Settings(shard_chars=chars))
        assert kept.schema == odd_docs.schema
        assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 4, 4, 7]
    assert dc.without_benchmark(no_docs, items).count() == 0


def test_short_items_and_unspaced_scripts_are_found(spark):
    texts = ["Capital of France?", "Wer da", "???", "今日は天気がとても良いですから散歩に行きましょう", "ทำไมท้องฟ้าจึงเป็นสีฟ้า", None]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [
        "they ask: capital of  FRANCE? Paris", "capital and of France", "who: wer da?", "wer ist da ???",
        "先生は言いました今日は天気がとても良いですから散歩に行きましょうと", "今日は雨です", "ถามว่าทำไมท้องฟ้าจึงเป็นสีฟ้าครับ", None,
    ]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(frame, items).collect()}
    assert found == {(0, 0), (2, 1), (4, 3), (6, 4)}
    assert sorted(r.doc_id for r in dc.without_benchmark(frame, items).collect()) == [1, 3, 5, 7]


def test_a_single_word_is_no_evidence(spark):
    items = spark.createDataFrame([(1, "the"), (2, "The."), (3, "日"), (4, "the end")], ITEMS)
    docs = spark.createDataFrame([(1, "the start of 日本"), (2, "this is the end"), (3, "the")], DOCS)
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()] == [(2, 4)]
    assert sorted(r.doc_id for r in dc.without_benchmark(docs, items).collect()) == [1, 3]


def test_a_very_long_item(spark):
    draw, words = random.Random(4), vocabulary(3000, 4)
    long = " ".join(draw.choice(words) for _ in range(50_000))
    items = spark.createDataFrame([(1, long), (2, "one two three four five six seven")], ITEMS)
    docs = spark.createDataFrame([(1, f"before {long} after"), (2, "x one two three four five six seven y"), (3, "clean")], DOCS)
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}
    assert found == {(1, 1), (2, 2)}
