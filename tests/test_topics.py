import math
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from postlytics.functions.weights import decode_weights, encode_weights
from postlytics.operators import topics
from postlytics.settings import DEFAULTS

SETTINGS = replace(DEFAULTS, topics=3, max_iter=5, min_doc_freq=2)


def documents(count=60):
    draw = random.Random(1)
    themes = [[f"{c}{i}" for i in range(12)] for c in "abc"]
    docs = []
    for i in range(count):
        docs.append((i, draw.choices(themes[i % 3], k=20) + (["everywhere"] if i % 2 else [])))
    return [*docs, (count, []), (count + 1, ["once", "once"])]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(documents(), "key long, words array<string>")


def test_statistics(corpus):
    n, df = Counter(), Counter()
    for _, words in documents():
        n.update(words)
        df.update(set(words))
    got = {r.word: (r.n, r.df) for r in topics.word_statistics(corpus).collect()}
    assert got == {w: (n[w], df[w]) for w in n}


def test_vocabulary_equals_count_vectorizer(corpus):
    words = topics.vocabulary_words(topics.vocabulary(corpus, SETTINGS))
    model = CountVectorizer(inputCol="words", outputCol="f", minDF=2).fit(corpus)
    assert set(words) == set(model.vocabulary)
    assert "once" not in words
    counts = Counter(w for _, ws in documents() for w in ws)
    assert words == sorted(words, key=lambda w: (-counts[w], w))


def test_too_many_words_are_refused_and_none_is_cut(corpus):
    tight = replace(SETTINGS, vocabulary_size=5)
    vocab = topics.vocabulary(corpus, tight)
    assert vocab.count() == topics.vocabulary(corpus, SETTINGS).count() > 5
    assert "TakeOrderedAndProject" not in vocab._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="min_doc_freq"):
        topics.vocabulary_words(vocab, tight)


def test_more_words_than_a_broadcast_list_become_terms(spark):
    word = F.concat(F.lit("w"), F.col("id").cast("string")).alias("word")
    words = topics.vocabulary_words(spark.range(300_000).select(word, F.lit(4).alias("n")))
    assert len(words) == 300_000 and words == sorted(words)
    corpus = spark.createDataFrame([(1, [words[-1], words[0], words[-1], "other"]), (2, [])], "key long, words array<string>")
    rows = topics.term_vectors(corpus, words).collect()
    assert [(r.key, dict(zip(r.features.indices.tolist(), r.features.values.tolist()))) for r in rows] == [(1, {0: 1.0, 299_999: 2.0})]
    odd = ["a\nb", "c"]
    rows = topics.term_vectors(spark.createDataFrame([(1, odd)], "key long, words array<string>"), odd).collect()
    assert rows[0].features.toArray().tolist() == [1.0, 1.0]


def test_a_fit_has_one_part_a_core(spark, corpus):
    words = topics.vocabulary_words(topics.vocabulary(corpus, SETTINGS))
    rows = topics.term_vectors(corpus, words)
    assert topics.placed_by_key(rows, "key").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.fixture(scope="module")
def fitted(corpus):
    words = topics.vocabulary_words(topics.vocabulary(corpus, SETTINGS))
    vectors = topics.term_vectors(corpus, words)
    return words, vectors, topics.fit_topics(vectors, settings=SETTINGS)


def test_topics_are_distributions(fitted):
    words, _, model = fitted
    mass = topics.describe_topics(model, words).groupBy("topic").agg(F.sum("weight").alias("m"), F.count("*").alias("n"))
    rows = mass.collect()
    assert len(rows) == 3
    assert all(abs(r.m - 1) < 1e-6 and r.n == len(words) for r in rows)


def test_same_seed_same_topics(fitted):
    words, vectors, model = fitted
    again = topics.fit_topics(vectors, settings=SETTINGS)
    labels = [
        {r.topic: r.label for r in topics.topic_labels(topics.describe_topics(m, words)).collect()}
        for m in (model, again)
    ]
    assert labels[0] == labels[1]


def test_evaluation_and_mixture(fitted):
    _, vectors, model = fitted
    row = topics.evaluate(model, vectors).first()
    assert math.isfinite(row.log_likelihood) and math.isfinite(row.log_perplexity)
    sums = topics.topic_mixture(model, vectors).groupBy("key").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-6 for r in sums if r.key < 60)


def test_idf_equals_spark_ml(corpus, fitted):
    words, vectors, _ = fitted
    model = IDF(inputCol="features", outputCol="idf").fit(vectors)
    ours = {r.word: r.idf for r in topics.inverse_document_frequency(corpus.filter(F.size("words") > 0)).collect()}
    for word, idf in zip(words, model.idf.toArray()):
        assert abs(ours[word] - idf) < 1e-12


def test_split_is_whole_and_stable(corpus):
    train, validation = topics.train_validation(corpus)
    a, b = ({r.key for r in d.collect()} for d in (train, validation))
    assert not a & b and len(a | b) == 62
    again = {r.key for r in topics.train_validation(corpus.repartition(3))[1].collect()}
    assert again == b


def test_labels_break_ties_by_word(spark):
    weights = spark.createDataFrame(
        [("b", 0, 1.0), ("a", 0, 1.0), ("c", 0, 2.0), ("d", 1, 1.0)], "word string, topic int, weight double"
    )
    assert {r.topic: r.label for r in topics.topic_labels(weights, 3).collect()} == {0: "c, a, b", 1: "d"}


def test_weights_json(spark):
    weights = spark.createDataFrame([("w", 1, 0.25), ("w", 0, 0.5)], "word string, topic int, weight double")
    row = topics.weights_by_word(weights).select(encode_weights(F.col("entries")).alias("r"))
    assert row.first().r == '[{"0":0.5},{"1":0.25}]'
    back = row.select(decode_weights(F.col("r")).alias("e")).first().e
    assert [(e.topic, e.weight) for e in back] == [(0, 0.5), (1, 0.25)]


def test_guards(spark):
    labels = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (1, "c")], "topic int, label string")
    found = topics.conflicting_labels(labels)
    assert [r.topic for r in found.collect()] == [0]
    with pytest.raises(ValueError, match="labels"):
        topics.require_none(found, "labels")
    weights = spark.createDataFrame([("w", 0), ("w", 0), ("v", 0)], "word string, topic int")
    assert [r.word for r in topics.repeated_weights(weights).collect()] == ["w"]


def test_weights_are_counted_by_topic_only_for_doubtful_words(spark):
    rows = [("a", t) for t in range(64)] + [("b", 1), ("b", 65), ("c", None), ("d", -1), (None, 3), (None, 4)]
    single = spark.createDataFrame(rows, "word string, topic int")
    assert sorted(r.word for r in topics.doubtful_words(single).collect()) == ["b", "c"]
    topics.require_single_weights(single)
    for word, topic in (("a", 63), ("d", -1), (None, 3), ("c", None)):
        more = single.unionByName(spark.createDataFrame([(word, topic)], single.schema))
        with pytest.raises(ValueError, match="repeated topics"):
            topics.require_single_weights(more)
