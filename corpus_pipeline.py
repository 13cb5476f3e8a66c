"""The corpus pipeline: stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.llm import stages
from fleetscope.sinks.storage import Scratch

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("ngram_jaccard_join", stages.ngram_jaccard_join),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("source_mixing", stages.source_mixing),
]

# blocks of sketches, templates and a random splitting tree have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage read is dropped after it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
