"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from postlytics.llm import sentencepiece_bpe as bpe
from postlytics.llm.queries import QUERIES, model_path
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def model():
    return bpe.read_model(model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def coder(model):
    return bpe.Coder(model)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_random_texts_equal_library(coder, library, model):
    draw = random.Random(7)
    letters = "  ▁ \n\t\r{});*/abcetihn.,'\"éü漢字😀\0=-_#0123²"
    pieces = [text.replace(bpe.SPACE, " ") for text, _, kind in model.pieces if kind == bpe.NORMAL]
    for _ in range(4000):
        text = "".join(
            draw.choice(letters) if draw.random() < 0.6 else draw.choice(pieces) for _ in range(draw.randrange(40))
        )
        ids = coder.encode(text)
        assert ids == library.encode(text)
        assert coder.decode(ids) == library.decode(ids)


def test_random_ids_decode_like_library(coder, library):
    draw = random.Random(8)
    for _ in range(2000):
        ids = [draw.randrange(500 if draw.random() < 0.5 else 32000) for _ in range(draw.randrange(12))]
        assert coder.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ["", " ", " " * 50_000, "thereforth" * 10_000, "\n" * 999, "a" * 5000, "ω漢" * 3000, "é" * 60 + "."])
def test_long_and_empty_texts(coder, library, text):
    assert coder.encode(text) == library.encode(text)


def test_query_equals_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op1_sentencepiece"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == digest(",".join(map(str, ids)))
        assert row.decoded_sha256 == digest(library.decode(ids))


def test_nulls_repeats_empty_table_and_clashing_names(spark, model):
    rows = [(1, None, 5, "x"), (2, "", 5, "x"), (3, "a b", 5, "x"), (3, "a b", 5, "x"), (None, "a b", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = bpe.round_trip(docs, model).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 0), (2, 0), (3, 2), (3, 2)]
    assert {r.decoded_sha256 for r in got if r.n_tokens == 0} == {digest("")}
    assert bpe.round_trip(docs.filter("doc_id > 9"), model).count() == 0
    assert bpe.encode_texts(docs, model).filter(F.size("ids") == 2).count() == 3


def test_tables_of_earlier_tasks_are_dropped(monkeypatch):
    from postlytics.llm import common

    built, task = [], [1]
    monkeypatch.setattr(common, "_TABLES", {})
    monkeypatch.setattr(common, "_task", lambda: task[0])
    build = lambda: built.append(task[0]) or object()
    first = common.worker_table("a", build)
    common.drop_unused_tables()
    assert common.worker_table("a", build) is first  # of the same task
    task[0] = 2
    assert common.worker_table("a", build) is first  # a later task of the operator
    task[0] = 3
    common.drop_unused_tables()  # another operator's task
    assert common.worker_table("a", build) is not first and built == [1, 3]
