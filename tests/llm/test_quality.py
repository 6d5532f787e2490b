"""Line rules, base counts by a plain second reading, and odd rows."""

import re
from collections import Counter

import pytest

from postlytics.llm import quality
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "".join(" ".join(f"word{i}x{j}" for j in range(10)) + ", the end.\n" for i in range(9))


def plain_counts(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(len(w) for w in words),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    }


def test_query_counts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op3_quality_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        want = plain_counts(docs[row.doc_id])
        assert {k: row[k] for k in want} == want
        assert not (row.base_failed and row.kept)


def test_verdicts_follow_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for row in QUERIES["op3_quality_rules"](spark, SF_DIR).collect():
        if row.doc_id in labels and not row.base_failed:
            assert row.kept == bool(labels[row.doc_id])


@pytest.mark.parametrize(
    ("line", "failure"),
    [
        ("Home | News | Sport | Weather | More", "navigation"),
        ("All rights reserved.", "boilerplate"),
        ("W*** w### w$$$ w&&&, w***", "punctuation"),
        ("no mark at all in here", "punctuation"),
        ("A plain sentence.", None),
        ("Ärger, ohne Ende", None),
    ],
)
def test_lines(line, failure):
    assert quality.line_failure(line, len(line.split()), quality.Rules()) == failure


def test_failing_lines_go_and_text_stays():
    text = "Home | News | Sport | More\n" + PROSE + "\nAll rights reserved."
    verdict = quality.judge(text, quality.Rules())
    assert verdict["kept"] and verdict["failures"] == {"navigation": 1, "boilerplate": 1}
    assert verdict["cleaned"] == PROSE


def test_text_that_loses_too_much_is_rejected():
    bars = "".join(f"{i} | a{i} | b{i} | c{i} | d{i}\n" for i in range(20))
    verdict = quality.judge(bars + PROSE[:200], quality.Rules())
    assert not verdict["base_failed"] and not verdict["kept"]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = quality.quality_report(odd_docs).collect()
    assert len(rows) == 8
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality.quality_report(no_docs).count() == 0
    assert quality.cleaned_documents(no_docs).schema == no_docs.schema
    prose = spark.createDataFrame([(1, PROSE, 5, "y")], "doc_id long, text string, n_chars int, judged string")
    kept = quality.cleaned_documents(prose).first()
    assert kept.judged == "y" and kept.n_chars == len(kept.text) and kept.text == prose.first().text
