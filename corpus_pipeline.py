"""The corpus pipeline: quality, exact dedup, near dedup, decontamination, packing.

Each stage takes all that the one before kept, read from the Parquet files it
was written to.  The first four return the columns of ``documents``, the last
the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logloom.llm import decontaminate, exact_dedup, packing, pu_quality, simhash
from logloom.llm.common import quoted, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = pu_quality.score(docs, pu_quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.filter(F.col(scored.columns[-1]) >= pu_quality.KEEP_FROM).select(*map(quoted, docs.columns))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest doc_id stays."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the smallest doc_id stays."""
    return simhash.dedup(docs, words=simhash.SHINGLE, distance=simhash.DISTANCE)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, and their places."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]

#: SQL can't express the learned and the hashed stages; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
