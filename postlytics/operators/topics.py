"""Vocabulary, LDA topics and their word tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlytics.settings import DEFAULTS, Settings


def word_statistics(corpus: DataFrame) -> DataFrame:
    """(word, n, df): occurrences and documents per word of `corpus(words)`.

    Both counts come from one exploded pass with map-side combine; nothing is shuffled by
    (document, word).
    """
    once = F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("word"), F.lit(0).alias("n"), F.lit(1).alias("df")))
    every = F.transform("words", lambda w: F.struct(w.alias("word"), F.lit(1).alias("n"), F.lit(0).alias("df")))
    return (
        corpus.select(F.explode(F.concat(every, once)).alias("e"))
        .groupBy("e.word")
        .agg(F.sum("e.n").alias("n"), F.sum("e.df").alias("df"))
    )


def vocabulary(corpus: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """All words with enough documents, with their counts."""
    return word_statistics(corpus).filter(F.col("df") >= settings.min_doc_freq)


def vocabulary_words(vocab: DataFrame, settings: Settings = DEFAULTS) -> list[str]:
    """The vocabulary in term order, by falling count, then word.

    Spark ML takes it from the driver. More than vocabulary_size words are refused, not cut: the
    count comes first, so no more than that many strings reach the driver.
    """
    kept = vocab.select("word", "n").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = kept.count()
        if found > settings.vocabulary_size:
            raise ValueError(
                f"{found} words are more than vocabulary_size={settings.vocabulary_size}; raise min_doc_freq"
            )
        return [r.word for r in kept.orderBy(F.desc("n"), "word").collect()]
    finally:
        kept.unpersist()


def count_model(words: list[str]) -> CountVectorizerModel:
    """As `CountVectorizerModel.from_vocabulary`, which sends one word at a time: 20 s for 100,000.

    The words go to the JVM as one text and are split there; only a word that holds the separator
    needs the slow way.
    """
    text = "\n".join(words)
    if not all(words) or text.count("\n") != len(words) - 1:
        return CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="features")
    terms = SparkSession.active()._jvm.java.util.regex.Pattern.compile("\n").split(text)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", terms)
    return model.setInputCol("words").setOutputCol("features")


def term_vectors(corpus: DataFrame, words: list[str], key: str = "key") -> DataFrame:
    """Term-frequency vectors `features` of the documents that hold any word at all."""
    return count_model(words).transform(corpus.filter(F.size("words") > 0).select(key, "words")).drop("words")


def placed_by_key(vectors: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt out and sorted by key, one part a core where no number is given."""
    parts = partitions or vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(parts, key).sortWithinPartitions(key)


def fit_topics(
    vectors: DataFrame,
    key: str = "key",
    settings: Settings = DEFAULTS,
    seed: int = 1,
    partitions: int | None = None,
) -> LDAModel:
    """LDA with the online optimizer.

    Rows are placed and sorted by key so that equal input gives equal mini-batches. The vectors
    are kept with spill to disk during the fit, as each iteration samples them again; a lost
    executor's part is recomputed from its source. Every part hands on words x topics numbers in
    every iteration, so there is one part a core, however many bytes the vectors have.
    """
    placed = placed_by_key(vectors, key, partitions).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return LDA(
            k=settings.topics, maxIter=settings.max_iter, seed=seed, featuresCol="features"
        ).fit(placed)
    finally:
        placed.unpersist()


def describe_topics(model: LDAModel, words: list[str], terms_per_topic: int | None = None) -> DataFrame:
    """(word, topic, weight), one row per topic and word: of all words, or of its heaviest ones.

    The terms are broadcast: they come from the driver and are at most vocabulary_size words.
    """
    terms = SparkSession.active().createDataFrame(
        pd.DataFrame({"term": np.arange(len(words), dtype="int32"), "word": words}),
        "term int, word string",
    )
    described = model.describeTopics(terms_per_topic or len(words))
    return (
        described.select(
            F.col("topic").cast("int").alias("topic"),
            F.explode(F.arrays_zip("termIndices", "termWeights")).alias("t"),
        )
        .join(F.broadcast(terms), F.col("t.termIndices") == F.col("term"))
        .select("word", "topic", F.col("t.termWeights").alias("weight"))
    )


def top_words(word_topics: DataFrame, n: int = DEFAULTS.words_per_topic) -> DataFrame:
    """(topic, rank, word, weight): the n heaviest words of each topic, ties by word."""
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
    return (
        word_topics.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("topic", "rank", "word", "weight")
    )


def topic_labels(word_topics: DataFrame, n: int = DEFAULTS.words_per_topic) -> DataFrame:
    """(topic, label): the top words in rank order, joined by a comma and a blank."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return (
        top_words(word_topics, n)
        .groupBy("topic")
        .agg(F.array_join(F.transform(ranked, lambda r: r["word"]), ", ").alias("label"))
    )


def weights_by_word(word_topics: DataFrame) -> DataFrame:
    """(word, entries): each word's array<struct<topic, weight>> in topic order.

    A group holds one word's weights, so at most as many rows as there are topics.
    """
    return word_topics.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("topic", "weight"))).alias("entries")
    )


def inverse_document_frequency(corpus: DataFrame) -> DataFrame:
    """(word, df, idf) with Spark ML's formula log((documents + 1) / (df + 1))."""
    documents = corpus.agg(F.count(F.lit(1)))
    stats = word_statistics(corpus).withColumn("documents", documents.scalar())
    return stats.select(
        "word", "df", F.log((F.col("documents") + 1) / (F.col("df") + 1)).alias("idf")
    )


def split_number(key: Column, parts: int = 5, salt: str = "1") -> Column:
    """A number 0 .. parts - 1 that depends on the key only, not on partitions or run order."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(parts))


def train_validation(df: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """A 4 : 1 split."""
    part = split_number(F.col(key))
    return df.filter(part > 0), df.filter(part == 0)


def evaluate(model: LDAModel, vectors: DataFrame) -> DataFrame:
    """One row: log likelihood and log perplexity bound of held-out vectors."""
    row = (float(model.logLikelihood(vectors)), float(model.logPerplexity(vectors)))
    return vectors.sparkSession.createDataFrame(
        [row], "log_likelihood double, log_perplexity double"
    )


def topic_mixture(model: LDAModel, vectors: DataFrame, key: str = "key") -> DataFrame:
    """(key, topic, share) for every topic of each document."""
    mixed = model.transform(vectors).select(
        key, vector_to_array("topicDistribution").alias("shares")
    )
    return mixed.select(key, F.posexplode("shares").alias("topic", "share"))


def conflicting_labels(topics: DataFrame) -> DataFrame:
    """Topics that carry more than one label."""
    return (
        topics.groupBy("topic")
        .agg(F.count_distinct("label").alias("labels"))
        .filter("labels > 1")
    )


def repeated_weights(word_topics: DataFrame) -> DataFrame:
    """Topics that a word lists more than once."""
    return (
        word_topics.groupBy("word", "topic")
        .agg(F.count(F.lit(1)).alias("entries"))
        .filter("entries > 1")
    )


def doubtful_words(word_topics: DataFrame) -> DataFrame:
    """Words with fewer different remainders of topics by 64 than entries; every word that repeats a topic is one.

    A row per word is shuffled, where counting by word and topic shuffles every weight.
    """
    bit = F.expr("shiftleft(1L, cast(pmod(topic, 64) AS int))")
    counts = word_topics.groupBy("word").agg(F.count(F.lit(1)).alias("entries"), F.bit_or(bit).alias("bits"))
    return counts.filter("bits IS NULL OR bit_count(bits) < entries").select("word")


def require_single_weights(word_topics: DataFrame) -> None:
    """Stop the job when a word lists a topic more than once; weights are counted only where a word is doubtful."""
    if not doubtful_words(word_topics).isEmpty():
        require_none(repeated_weights(word_topics), "words with repeated topics")


def require_none(violations: DataFrame, what: str) -> None:
    """Stop the job when a guard query finds anything."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {found}")
