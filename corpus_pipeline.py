"""A corpus pipeline: from ``documents`` to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontam, neardup, packing, pii, toxicity
from riskloom.llm.common import table, written


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose id was not dropped. The verdicts are narrow; the texts are shuffled once."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below one half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles of similarity 0.8 or more connect.

    Rows that share an id are one document; rows without an id stay."""
    groups = neardup.near_duplicates(docs.select("doc_id", "text"), percent=80)
    return _without(docs, groups.filter("NOT kept"))


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = decontam.overlaps(docs.select("doc_id", "text"),
                              table(spark, sf_dir, "benchmark", "item_id", "text"))
    return _without(docs, found)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and their new lengths."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_overlaps),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
