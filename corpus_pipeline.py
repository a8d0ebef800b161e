"""From raw documents to a mixed training corpus: five stages, each written before the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebell.llm import decontaminate, host_quality, mixing, secrets, simhash
from closebell.llm.queries import MIX
from closebell.session import shared_folder, staging
from closebell.sources.derived import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from a host that is not rejected."""
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.mask(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with the epoch and the tokens taken of them. Documents without a domain
    get one from their source's name."""
    if "domain" not in docs.columns:
        docs = docs.withColumn("domain", mixing.source_domain(F.col("source")))
    return mixing.sample(docs, **MIX)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mixing),
]

# Fingerprints and edit distances are beyond SQL: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread.

    What a stage stages for itself is dropped once its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
