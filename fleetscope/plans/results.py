"""The published result tables, written as one batch.

The facts are scanned once, for the rollup; the rollup is stored as a table,
which also cuts the lineage, and every result is derived from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.operators import counts, rates
from fleetscope.operators.rollup import rollup
from fleetscope.operators.topk import preview
from fleetscope.schema import TELEMETRY
from fleetscope.sinks.writers import Receipt, append_table, replace_table, write_result_csv
from fleetscope.sources.readers import in_stored_order, read_csv, read_if_present

RESULTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "category_counts": counts.category_counts,
    "shift_counts": counts.shift_counts,
    "zone_counts": counts.zone_counts,
    "status_counts": counts.status_counts,
    "avg_rssi_by_zone": counts.avg_rssi_by_zone,
    "active_work_by_forklift": counts.active_work_by_forklift,
    "unauthorized_by_forklift": counts.unauthorized_by_forklift_flags,
    "spark_sql_zone_shift_summary": counts.zone_shift_summary,
    "spark_sql_offline_summary": counts.offline_summary,
    "predict_downtime_by_forklift": rates.downtime_by_forklift,
    "predict_offline_risk": rates.predict_offline_risk,
    "predict_unauthorized_risk": rates.predict_unauthorized_risk,
    "predict_composite_risk_zone_shift": rates.composite_risk_zone_shift,
    "predict_zone_risk": rates.zone_risk,
    "predict_shift_risk": rates.shift_risk,
    # written as results, but not loaded into a collection of their own
    "unauthorized_by_forklift_category": counts.unauthorized_by_forklift_category,
    "spark_sql_offline_prediction": rates.offline_prediction,
    "offline_risk_by_forklift_shift": rates.offline_risk_by_forklift_shift,
    "unauthorized_risk_by_forklift_shift": rates.unauthorized_risk_by_forklift_shift,
    "offline_risk_by_zone_shift": rates.offline_risk_by_zone_shift,
}
COLLECTIONS = dict(fixed.RESULT_COLLECTIONS)
# the three results that are also appended to a history
HISTORY = (
    "predict_downtime_by_forklift",
    "predict_composite_risk_zone_shift",
    "predict_shift_risk",
)
_WRITERS = 8
REVIEWED = tuple(name for name in COLLECTIONS if not name.startswith("predict_"))


def result_path(target: str, name: str) -> str:
    return f"{target}/{COLLECTIONS.get(name, name)}"


def stored_rollup(df: DataFrame, path: str, quality: bool = False) -> DataFrame:
    replace_table(rollup(df, quality), path)
    return df.sparkSession.read.parquet(path)


def _for_each(
    spark: SparkSession, names: Iterable[str], load: Callable[[str], Receipt | None]
) -> dict[str, Receipt]:
    """Small independent loads, a few at a time so that they fill the cluster.
    The caller's job group and scheduler pool hold in the threads as well."""
    names = tuple(names)
    with ThreadPoolExecutor(_WRITERS) as pool:
        receipts = zip(names, pool.map(inheritable_thread_target(spark)(load), names))
    return {name: receipt for name, receipt in receipts if receipt is not None}


def write_from_rollup(
    base: DataFrame, target: str, names: Iterable[str] = tuple(COLLECTIONS), fmt: str = "parquet"
) -> dict[str, Receipt]:
    """Replace the result collections below ``target``, given a stored rollup."""
    def write(name: str) -> Receipt:
        return replace_table(RESULTS[name](base), result_path(target, name), fmt)

    return _for_each(base.sparkSession, names, write)


def write_results(
    df: DataFrame, target: str, names: Iterable[str] = tuple(COLLECTIONS), fmt: str = "parquet"
) -> dict[str, Receipt]:
    """Replace the result collections below ``target``, in one scan of ``df``."""
    return write_from_rollup(stored_rollup(df, f"{target}/rollup"), target, names, fmt)


def append_history(df: DataFrame, target: str, fmt: str = "parquet") -> dict[str, Receipt]:
    """Append three results, repeated runs included."""
    base = stored_rollup(df, f"{target}/rollup")

    def write(name: str) -> Receipt:
        return append_table(RESULTS[name](base), result_path(target, name), fmt)

    return _for_each(base.sparkSession, HISTORY, write)


def write_csv_results(
    df: DataFrame, folder: str, names: Iterable[str] = tuple(RESULTS)
) -> dict[str, Receipt]:
    """Every result as sorted CSV with a header, ``<name>.csv`` below ``folder``."""
    base = stored_rollup(df, f"{folder}/rollup")

    def write(name: str) -> Receipt:
        return write_result_csv(RESULTS[name](base), f"{folder}/{name}.csv")

    return _for_each(base.sparkSession, names, write)


def publish_csv_results(
    spark: SparkSession,
    folder: str,
    target: str,
    names: Iterable[str] = tuple(COLLECTIONS),
    fmt: str = "parquet",
    append: bool = False,
) -> dict[str, Receipt]:
    """Load CSV results into their collections, in full or appended. A result
    that is not there is skipped with a log line."""
    load = append_table if append else replace_table

    def publish(name: str) -> Receipt | None:
        schema = result_schema(spark, name)
        stored = read_if_present(read_csv, spark, f"{folder}/{name}.csv", schema=schema)
        return None if stored is None else load(stored, result_path(target, name), fmt)

    return _for_each(spark, names, publish)


def read_result(spark: SparkSession, target: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A stored result; text formats get the result's schema."""
    reader = spark.read
    if fmt != "parquet":
        reader = reader.schema(result_schema(spark, name))
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(result_path(target, name))


def result_schema(spark: SparkSession, name: str):
    """The schema a result has, found by analysis alone: no job runs."""
    return RESULTS[name](spark.createDataFrame([], TELEMETRY)).schema


def review_results(
    spark: SparkSession, target: str, names: Iterable[str] = REVIEWED, fmt: str = "parquet"
) -> DataFrame:
    """Number of rows and columns of each stored result."""
    reviews = []
    for name in names:
        stored = read_result(spark, target, name, fmt)
        reviews.append(
            stored.agg(
                F.lit(name).alias("result"),
                F.count(F.lit(1)).alias("rows"),
                F.lit(len(stored.columns)).alias("columns"),
            )
        )
    together = reviews[0]
    for review in reviews[1:]:
        together = together.unionByName(review)
    return together.orderBy("result")


def preview_result(spark: SparkSession, target: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The first rows of a stored result, in the order it was written in."""
    return preview(in_stored_order(read_result(spark, target, name, fmt)))
