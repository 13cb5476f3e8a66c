"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Every stage works on all documents that the one before kept, and returns their
columns; the last one returns the mix, a row for every time a document is taken.
Empty input gives empty output, with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.llm import decontamination, host_rules, mixing, ngram_join
from fleetscope.llm import line_dedup as lines_of
from fleetscope.sinks.storage import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go, and all of a host that fails too often."""
    return host_rules.keep_good(docs, Scratch(spark, "quality"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an equal or nearly equal earlier line go; documents stay."""
    cut, lines, lost = lines_of.without_repeated_lines(
        docs, Scratch(spark, "lines"), least=lines_of.SHORTEST, near=lines_of.SHORTEST_NEAR
    )
    return cut.drop(lines, lost)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the smallest id stays."""
    return ngram_join.keep_one_of_each(docs, Scratch(spark, "near"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark, Scratch(spark, "leaks"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents in shuffled shards, sources near their targets."""
    mixed, names = mixing.mix(docs, Scratch(spark, "mix"))
    return mixing.arranged(mixed.drop(*names[:-1]), names[-1])
