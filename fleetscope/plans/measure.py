"""Timing of actions. Building a plan costs next to nothing and says nothing,
so everything here runs the whole plan, warms up first and reports medians."""

from __future__ import annotations

import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.sources.readers import read_csv, read_parquet


def run(df: DataFrame) -> None:
    """Compute every row of ``df`` on the executors and keep none."""
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object], repeats: int = 3, warm_ups: int = 1) -> float:
    """Median wall time of ``action``."""
    for _ in range(warm_ups):
        action()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return median(times)


def compare_formats(
    spark: SparkSession, csv_path: str, parquet_path: str, repeats: int = 3
) -> dict[str, float]:
    """The same count, and the same scan of one column, on both formats. The
    scan tells them apart: a Parquet count reads file metadata only."""

    def scan(df: DataFrame) -> None:
        run(df.agg(F.avg("rssi")))

    readers = {
        "csv": lambda: read_csv(spark, csv_path),
        "parquet": lambda: read_parquet(spark, parquet_path),
    }
    times = {}
    for name, reader in readers.items():
        times[f"{name}_read_count"] = seconds(lambda: reader().count(), repeats)
        times[f"{name}_column_scan"] = seconds(lambda: scan(reader()), repeats)
    return times
