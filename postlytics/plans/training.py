"""The topic batch job: corpus to published model, then retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlytics.operators import topics
from postlytics.settings import DEFAULTS, Settings
from postlytics.sources import models
from postlytics.sources.corpus import corpus_table, draw_retention


def train(corpus: DataFrame, model_root: str, settings: Settings = DEFAULTS, seed: int = 1) -> int:
    """Fit topics on `corpus(key, words)` and publish them; returns the new version."""
    words = topics.vocabulary_words(topics.vocabulary(corpus, settings))
    if not words:
        raise ValueError("no word occurs in enough documents")
    vectors = topics.term_vectors(corpus, words)
    weights = topics.describe_topics(topics.fit_topics(vectors, settings=settings, seed=seed), words)
    return models.publish(weights, model_root, settings.words_per_topic)


def train_and_shrink(spark: SparkSession, root: str, model_root: str, seed: int, settings: Settings = DEFAULTS) -> int:
    """The whole batch job on the corpus below `root`: fit, publish, forget one drawn share, fold old batches."""
    table = corpus_table(spark, root)
    version = train(table.read(), model_root, settings, seed)
    table.forget_share(*draw_retention(seed))
    table.compact()
    return version
