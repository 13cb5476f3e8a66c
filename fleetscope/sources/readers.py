"""Batch readers. Each returns a lazy DataFrame over a distributed scan of the
files that the table has when the reader is called; of versioned tables these
are the current version's."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import fixed_values as fixed
from fleetscope.schema import DOCUMENT, TELEMETRY
from fleetscope.sinks.pointer import resolve

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TELEMETRY) -> DataFrame:
    """CSV with a header. The header must name the schema's columns in order,
    so a file of another telemetry version fails instead of shifting columns."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(resolve(spark, path))
    )


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = TELEMETRY
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(resolve(spark, path))


def read_documents(spark: SparkSession, path: str, keep_key: bool = False) -> DataFrame:
    """A document collection stored as JSON lines; ``_id`` is dropped by default."""
    documents = spark.read.schema(DOCUMENT).json(resolve(spark, path))
    return documents if keep_key else documents.drop("_id")


def sample_document(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row of ``df`` and its field names. The names cost no job."""
    return df.limit(1), df.columns


def in_stored_order(df: DataFrame) -> DataFrame:
    """A table straight from files, sorted the way it was written: by file, then
    by block, then by row. With a limit this runs as a top k."""
    place = F.struct(
        F.col("_metadata.file_name"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn("place", place).orderBy("place").drop("place")


def sample_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def read_if_present(
    reader: Callable[..., DataFrame], spark: SparkSession, path: str, **options: object
) -> DataFrame | None:
    """``reader(spark, path)``, or None with a log line where nothing is stored."""
    try:
        return reader(spark, path, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("skipped, nothing stored at %s", path)
        return None


def register_view(df: DataFrame, name: str = fixed.DEFAULT_VIEW) -> DataFrame:
    """Make ``df`` a temporary view for the caller's own SQL."""
    df.createOrReplaceTempView(name)
    return df
