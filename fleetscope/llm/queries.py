"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import (
    decontamination,
    filter_audit,
    host_rules,
    line_dedup,
    mixing,
    ngram_join,
    oracles,
    pii,
    stream_bpe,
    substring_dedup,
    suffix_model,
    token_counts,
    toxicity,
    va_file,
)
from fleetscope.sinks.storage import Scratch


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(_documents(spark, sf_dir), benchmark, Scratch(spark, "op1"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "source")
    mixed, _ = mixing.mix(docs, Scratch(spark, "op2"))
    shards = F.transform("copies", lambda copy: copy["shard"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", shards.alias("shards"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_model.score_texts(_documents(spark, sf_dir), Scratch(spark, "op3"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality_report(_documents(spark, sf_dir), Scratch(spark, "op4"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(_documents(spark, sf_dir), labels, Scratch(spark, "op5"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeated_spans(_documents(spark, sf_dir), Scratch(spark, "op6"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    cut, lines, lost = line_dedup.without_repeated_lines(
        docs, Scratch(spark, "op7"), least=line_dedup.SHORTEST, near=line_dedup.SHORTEST_NEAR
    )
    return cut.select(
        "doc_id", F.col(lines).alias("n_lines"), F.col(lost).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir), Scratch(spark, "op8"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.component_ids(_documents(spark, sf_dir), Scratch(spark, "op9"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(_documents(spark, sf_dir), vocabulary, limit=1024)


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and its tokens decoded again."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = stream_bpe.encode(_documents(spark, sf_dir), vocabulary)
    hashed = encoded.withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = stream_bpe.decode(hashed, vocabulary)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(_documents(spark, sf_dir), labels, Scratch(spark, "op12"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of the whole-numbered vectors, after three rounds."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found, _ = va_file.cluster(embeddings, Scratch(spark, "op13"))
    return found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_source_mixing": op2_source_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_pii": op8_pii,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_token_counts": op10_token_counts,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_filter_audit": op12_filter_audit,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLE_SQL: dict[str, str] = {
    "op6_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_ngram_jaccard_join": oracles.NGRAM_JACCARD_JOIN,
    "op12_filter_audit": oracles.FILTER_AUDIT,
    "op13_centroid_clustering": oracles.CENTROID_CLUSTERING,
}
