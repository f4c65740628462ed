"""Corpus pipeline: five training-data operators in order over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that the stage before it kept; ``run`` writes
each stage's rows as Parquet in the shared folder and reads them back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.llm import decontaminate, exact_dedup, jaccard, mixing, quality
from lineage_spark.llm.common import limit_batches, written
from lineage_spark.session import load

# a trained classifier, hashes and random draws: no SQL for the rows of run()
ORACLE_SQL = None
MIN_QUALITY = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below 0.3; the classifier learns from the labelled documents."""
    # texts are scored when the rows are written, so this holds on in the session; the executors keep these workers for the next stages
    limit_batches(spark)
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.where(model.column(docs["text"]) >= MIN_QUALITY).select(*columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-word shingle similarity of 0.8 or more, the one with the least doc_id stays."""
    return jaccard.JaccardJoin(docs, n=5, percent=80).one_of_each()


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which an item of ``benchmark`` is found."""
    return decontaminate.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that a mix of 150% of what is left takes of each document, by source weight."""
    return mixing.Mix(docs, total=1.5, cap=2.0).per_document().select(
        F.col("key").alias("doc_id"), "source", "size", "source_size", "target", "taken", "n_draws", "n_shards")


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("leaks", leaks_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
