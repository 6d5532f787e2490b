"""The corpus pipeline: raw documents to clean, tokenized ones, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in the
shared folder and gives it to the next stage. All stages but the last return the columns of
`documents`; the last adds the tokens. A null text has no words, so the first stage drops it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics.llm import decontaminate, quality, secrets, sentencepiece_bpe, simhash
from postlytics.llm.common import saved, table
from postlytics.llm.queries import model_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed and rejected documents go."""
    return quality.cleaned_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item stands go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    return secrets.redacted(docs)


def sentencepiece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole text, their number, and whether decoding gives the text back."""
    model = sentencepiece_bpe.read_model(model_path())
    coded = sentencepiece_bpe.encode_texts(docs.drop("ids", "n_tokens", "same_text"), model)
    same = sentencepiece_bpe.decoder(model)("ids").eqNullSafe(F.col("text"))
    return coded.withColumns({"n_tokens": F.size("ids").cast("long"), "same_text": same})


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_coding", sentencepiece_coding),
]

# SQL cannot express the stages: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
