"""Posts, statuses and word weights derived from the given tables.

Every document is a post. The tables hold no hashtags, so the capitalized words of the whole
text serve as tags; all of them, however many a text has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.clustering import LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics.functions.records import follower_group
from postlytics.functions.text import clean_words
from postlytics.operators import topics
from postlytics.operators.records import lower_tags
from postlytics.operators.tags import TagList, split_tags
from postlytics.session import path_exists, workspace
from postlytics.settings import DEFAULTS
from postlytics.sources import models
from postlytics.sources.tables import scan, scan_spread

SEEDS = ("the", "and", "is", "la", "die")
EPOCH = 1_704_067_200  # 2024-01-01 00:00:00 UTC
# a token that is one capital letter followed by letters only
HASHTAG = r"(?<!\\S)[A-Z][A-Za-z]*+(?!\\S)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table derived once per application and kept in the shared folder."""
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _STORED or not path_exists(spark, _STORED[place]):
        path = workspace(spark, name)
        write(path)
        _STORED[place] = path
    return _STORED[place]


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts table; queries read only the columns they use."""

    def write(path: str) -> None:
        documents = scan_spread(
            spark, f"{sf_dir}/documents.parquet", "doc_id", "doc_id", "text", "lang"
        )
        with_country(posts_of(documents), table(spark, sf_dir, "nation")).write.option(
            "compression", "zstd"
        ).parquet(path)

    return scan(spark, _stored(spark, sf_dir, "posts", write))


def model_root(spark: SparkSession, sf_dir: str) -> str:
    """Where the stand-in weights are published as a model."""

    def write(path: str) -> None:
        models.publish(word_topics(spark, sf_dir), path)

    return _stored(spark, sf_dir, "model", write)


def stored_model(spark: SparkSession, sf_dir: str) -> models.Model:
    return models.load(spark, model_root(spark, sf_dir))


def posts_of(documents: DataFrame) -> DataFrame:
    """Posts from a table or a stream of documents."""
    sec = F.col("doc_id") + EPOCH
    followers = F.pmod(F.col("doc_id") * 7919, F.lit(5000))
    return (
        documents.select(
            F.col("doc_id").alias("post_id"),
            "text",
            F.col("lang").alias("language"),
            F.expr(f"regexp_extract_all(text, '{HASHTAG}', 0)").alias("hashtags"),
            followers.alias("followers"),
            F.timestamp_seconds(sec).alias("ts"),
            sec.alias("sec"),
        )
        .withColumns({
            "tags": lower_tags(F.col("hashtags")),
            "follower_group": follower_group(F.col("followers")),
        })
    )


def with_country(posts: DataFrame, nation: DataFrame) -> DataFrame:
    """Every seventh post has no country. Spark broadcasts the nations by their file size."""
    nations = nation.select("n_nationkey", "n_name")
    return posts.join(nations, F.col("post_id") % 25 == F.col("n_nationkey"), "left").select(
        *posts.columns, F.when(F.col("post_id") % 7 != 0, F.col("n_name")).alias("country")
    )


def tag_list(spark: SparkSession, values: tuple[str, ...] = SEEDS) -> TagList:
    return TagList(spark.createDataFrame([(v,) for v in values], "tag string"), values)


def split_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_tags(posts(spark, sf_dir), tag_list(spark), "post_id")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(post_id, words) with cleaned words."""
    return posts(spark, sf_dir).select("post_id", clean_words(F.col("text")).alias("words"))


def word_topics(spark: SparkSession, sf_dir: str, n_topics: int = DEFAULTS.topics) -> DataFrame:
    """A stand-in for a learned model with exact integer weights for every frequent word."""
    t = F.col("topic")
    weight = F.pmod(F.length("word") * (t + 3) + F.ascii("word") * (t + 1), F.lit(97))
    return (
        topics.word_statistics(corpus(spark, sf_dir))
        .filter(F.col("df") >= DEFAULTS.min_doc_freq)
        .select("word", F.explode(F.sequence(F.lit(0), F.lit(n_topics - 1))).alias("topic"))
        .select("word", "topic", weight.cast("double").alias("weight"))
    )


def vocabulary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, n, df) of the vocabulary, counted once per application."""

    def write(path: str) -> None:
        topics.vocabulary(corpus(spark, sf_dir)).write.parquet(path)

    return scan(spark, _stored(spark, sf_dir, "vocabulary", write))


def fitted_terms(spark: SparkSession, sf_dir: str) -> list[str]:
    return topics.vocabulary_words(vocabulary_of(spark, sf_dir))


def term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.term_vectors(corpus(spark, sf_dir), fitted_terms(spark, sf_dir), "post_id")


def fitted_topics(spark: SparkSession, sf_dir: str) -> LDAModel:
    """The topics of the corpus by the default settings, fitted once per application."""

    def write(path: str) -> None:
        topics.fit_topics(term_vectors(spark, sf_dir), "post_id").save(path)

    return LocalLDAModel.load(_stored(spark, sf_dir, "topics", write))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table read as a stream; a table that is one file is picked from its folder by name."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(scan(spark, path).schema)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jvm_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses_of(posts(spark, sf_dir))


def statuses_of(posts: DataFrame) -> DataFrame:
    """Posts in the shape the landing job writes; every third has no coordinates."""
    lat = (F.col("post_id") % 120 - 60).cast("double")
    lon = (F.col("post_id") % 300 - 150).cast("double")
    ring = F.array(
        F.array(lat, lon), F.array(lat, lon + 1), F.array(lat + 1, lon + 1), F.array(lat + 1, lon)
    )
    place = F.struct(
        F.col("country").alias("name"),
        F.lit(None).cast("string").alias("street_address"),
        F.upper(F.substring("country", 1, 2)).alias("country_code"),
        F.col("post_id").cast("string").alias("id"),
        "country",
        F.lit("country").alias("place_type"),
        F.lit(None).cast("string").alias("url"),
        F.col("country").alias("full_name"),
        F.lit("Polygon").alias("bounding_box_type"),
        F.array(ring).alias("bounding_box"),
        F.lit(None).cast("string").alias("geometry_type"),
        F.lit(None).cast("array<array<array<double>>>").alias("geometry"),
    )
    return posts.select(
        F.col("post_id").alias("id"),
        "text",
        F.col("language").alias("lang"),
        F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.struct(
            F.transform("hashtags", lambda h: F.struct(h.alias("text"))).alias("hashtags")
        ).alias("entities"),
        F.when(F.col("post_id") % 3 != 0, F.array(lat, lon)).alias("coordinates"),
        F.when(F.col("country").isNotNull(), place).alias("place"),
        F.struct(F.col("followers").alias("followers_count")).alias("user"),
    )
