"""Top-k reports. A sort with a limit runs as a per-task top-k and one merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import predicates as is_
from fleetscope.operators.counts import count_by
from fleetscope.operators.rates import downtime_by_forklift


def top_unauthorized_forklifts(df: DataFrame, k: int = 5) -> DataFrame:
    return count_by(df, "forklift_id", where=is_.unauthorized()).limit(k)


def top_forklifts_by_records(df: DataFrame, k: int = 5) -> DataFrame:
    return count_by(df, "forklift_id").limit(k)


def first_records_by_forklift(
    df: DataFrame, k: int = 5, tie_breakers: Sequence[str] = ("timestamp",)
) -> DataFrame:
    return df.orderBy("forklift_id", *tie_breakers).limit(k)


def top_downtime(df: DataFrame, k: int) -> DataFrame:
    return downtime_by_forklift(df).limit(k)


def preview(df: DataFrame, k: int = 10) -> DataFrame:
    """The first rows of a stored result, each as one line of JSON."""
    return df.limit(k).select(F.to_json(F.struct(*df.columns)).alias("row"))
