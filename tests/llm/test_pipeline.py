"""The pipeline stage by stage against brute force, and on odd tables."""

import corpus_pipeline
import pytest
import sentencepiece

from postlytics.llm import decontaminate, quality
from postlytics.llm.queries import model_path
from tests.conftest import SF_DIR
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash import plain_groups, plain_print


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage, by name."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
        out[name] = docs.collect()
    return out


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_quality(kept):
    want = {r.doc_id: quality.judge(r.text, quality.Rules()) for r in kept[""]}
    assert {r.doc_id: r.text for r in kept["quality_rules"]} == {d: j["cleaned"] for d, j in want.items() if j["kept"]}
    assert all(r.n_chars == len(r.text) for r in kept["quality_rules"])


def test_dedup(kept):
    prints = {r.doc_id: plain_print(r.text, 3) for r in kept["quality_rules"]}
    stays = sorted(set(plain_groups(prints).values()))
    assert sorted(r.doc_id for r in kept["near_dedup"]) == stays
    texts = [r.text for r in kept["near_dedup"]]
    assert len(texts) == len(set(texts)) < len(kept["quality_rules"])


def test_decontamination(spark, kept):
    items = [" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = by_id(kept["benchmark_decontamination"])
    for row in kept["near_dedup"]:
        words = " ".join(decontaminate.words_of(row.text))
        assert (row.doc_id in left) == (not any(item in words for item in items))


def test_secrets(kept):
    assert by_id(kept["secret_scans"]).keys() == by_id(kept["benchmark_decontamination"]).keys()
    for row in kept["benchmark_decontamination"]:
        clean = by_id(kept["secret_scans"])[row.doc_id].text
        assert plain_base(clean) == []
        if not plain_base(row.text):
            assert clean == row.text


def test_tokens(kept):
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for row in kept["sentencepiece_coding"]:
        assert row.ids == library.encode(row.text) and row.n_tokens == len(row.ids) and row.same_text


def test_run_gives_the_last_stage(spark, kept):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(rows, key=lambda r: r.doc_id) == sorted(kept["sentencepiece_coding"], key=lambda r: r.doc_id)


def test_odd_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            out.count()
            if name != "sentencepiece_coding":
                assert out.columns == docs.columns
