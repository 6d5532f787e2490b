"""Accuracy on held-out documents, gradients, windows and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlytics.llm import langid
from postlytics.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SMALL = langid.Settings(window=16, embedding=3, filters=4, rows_per_language=40, epochs=20, rate=0.02)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = QUERIES["op9_language_id"](spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_windows_cover_the_text():
    for size in (1, 15, 16, 17, 100):
        text = bytes(range(size))
        rows = langid.windows_of(text, 16)
        assert rows.ravel()[: len(text)].astype(np.uint8).tobytes() == text
        assert (rows.ravel()[len(text) :] == langid.BLANK).all()


def test_gradients_equal_differences():
    network = langid.Network(["a", "b", "c"], SMALL)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    draw = np.random.default_rng(3)
    rows, labels = draw.integers(0, 257, (5, 16)).astype(np.int16), np.array([0, 1, 2, 1, 0])

    def loss():
        network.tabulate()
        network.tables = {w: [np.asarray(t, np.float64) for t in ts] for w, ts in network.tables.items()}
        return -network.log_probabilities(rows)[np.arange(5), labels].mean()

    grads = network.gradients(rows, labels)
    for name in network.weights:
        flat, grad = network.weights[name].ravel(), grads[name].ravel()
        for at in np.argsort(-np.abs(grad))[:3]:
            kept = flat[at]
            flat[at] = kept + 1e-3
            up = loss()
            flat[at] = kept - 1e-3
            down = loss()
            flat[at] = kept
            assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=1e-4)


def test_held_out_and_unlabelled_rows_teach_nothing(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "abc def", "x") for i in ids] + [(i, "abc def", None) for i in range(200) if i not in ids]
    network = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), SMALL)
    assert network.languages == []
    assert network.predict(["abc", None]) == [("und", 0.0)] * 2


def test_whole_texts_count(spark):
    rows = [(i, ("aaaa bbbb " if i % 2 else "zzzz yyyy ") * 5, "ab" if i % 2 else "zy") for i in range(160)]
    network = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), SMALL)
    mostly = "aaaa bbbb " * 30 + "zzzz yyyy " * 300
    assert network.predict([mostly])[0][0] == "zy"
    assert [p[0] for p in network.predict(["123 !!", "", None, "é漢"])][:3] == ["und"] * 3


def test_odd_rows(odd_docs, no_docs):
    network = langid.train(odd_docs, SMALL)
    rows = langid.predicted(odd_docs, network).collect()
    assert len(rows) == 8
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 7))
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    assert langid.predicted(no_docs, langid.train(no_docs, SMALL)).count() == 0
    assert odd_docs.select(langid.fold(F.col("doc_id"))).count() == 8
