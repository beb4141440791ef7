"""A training corpus from raw documents: five stages, each an operator of ``costpulse.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared scratch folder and reads it again as the next stage's documents, so a
lost executor costs at most a part of one stage.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costpulse.llm import decontam, linededup, mixing, quality, simhash  # noqa: E402
from costpulse.llm.common import small_batches, table  # noqa: E402
from costpulse import session  # noqa: E402


def prepare(spark: SparkSession) -> None:
    session.prepare(spark)
    small_batches(spark)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labelled ones, doesn't reject."""
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier line already has or nearly has."""
    prepare(spark)
    return linededup.dedup_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal SimHash fingerprints."""
    prepare(spark)
    return simhash.near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    prepare(spark)
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix that weighs the sources alike."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
]

# Compression, MinHash and XXH64 have no counterpart in SQL; tests compare the pipeline with a
# brute-force version on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = session.scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
