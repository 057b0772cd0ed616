"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Every stage takes all rows that its predecessor kept. Ids carry the decisions, so a stage that drops rows keeps
those whose (id, text) it decided to keep; of rows that repeat both, the deduplicating stages keep one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm import exact_dedup, jaccard, packing, quality, secrets
from segloom.llm.common import identity, rows_of, shared_path, table
from segloom.llm.queries import tokenizer_path

#: SQL can't express the classifier, the similarity join and the packing.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows that its held-out rule leaves."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    return exact_dedup.drop_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8 or more): the smallest id."""
    # rows that share an id are told apart by their text; null ids come last
    key = F.struct(*(identity("doc_id")[c].alias(c) for c in ("no_id", "id")), F.xxhash64("text").alias("text_hash"))
    groups = jaccard.jaccard_components(docs.select(key.alias("key"), "text"), words=5, percent=80, id_col="key")
    kept = groups.where(F.col("key") == F.col("component_id")).select("key.*").distinct()
    return rows_of(docs, F.xxhash64("text"), kept.select(F.struct("no_id", "id").alias("key"), F.col("text_hash").alias("text")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind; n_chars follows the text."""
    cleaned = secrets.redact_secrets(docs)
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their place in sequences of 2048."""
    return packing.pack(docs, tokenizer_path(), cache_entries=80_000)  # the workers keep it beside the other stages' memory


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
