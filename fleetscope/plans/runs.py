"""The three batch runs end to end: analyse, load, review."""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.derive import with_day
from fleetscope.operators.summary import summary_document
from fleetscope.plans import incremental, reports, results
from fleetscope.schema import TELEMETRY, require_columns
from fleetscope.sinks import snapshots, writers
from fleetscope.sinks.pointer import resolve
from fleetscope.sources.readers import register_view


def _now() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


@contextmanager
def cached(df: DataFrame):
    """``df`` kept in memory and on disk for several queries, then released.

    Worth it for repeated ad-hoc queries over a selection that fits; the batch
    runs below need no cache because each scans its input once."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def prepare(df: DataFrame, start: date | None = None) -> DataFrame:
    """Telemetry of either version with all columns; a view for ad-hoc SQL."""
    complete = require_columns(df if start is None else with_day(df, start))
    names = TELEMETRY.fieldNames()
    others = [name for name in complete.columns if name not in names]
    return register_view(complete.select(*names, *others))


def analyse(df: DataFrame, target: str, fmt: str = "parquet") -> dict[str, writers.Receipt]:
    """Write every result below ``target`` and an execution report."""
    started = time.perf_counter()
    base = results.stored_rollup(df, f"{target}/rollup")
    rolled_up = time.perf_counter()
    receipts = results.write_from_rollup(base, target, results.RESULTS, fmt)
    finished = time.perf_counter()
    timings = {
        "scan_and_rollup": rolled_up - started,
        "write_results": finished - rolled_up,
        "total": finished - started,
    }
    records = base.agg(F.sum("rollup_rows")).first()[0] or 0
    report = reports.execution_report(df, records, timings, [r.path for r in receipts.values()])
    reports.write_report(report, f"{target}/execution_report", "EXECUTION REPORT", _now())
    return receipts


def load(
    df: DataFrame, target: str, by_day: bool = True, versioned: bool = False, **options: object
) -> writers.Receipt:
    """Load telemetry below ``target``, by day, as full replace or as the next
    version, and store the summary document and reports on what is now there: a
    load by day reads the days it has changed for that, any other the table."""
    spark = df.sparkSession
    path = f"{target}/telemetry"
    if versioned:
        by_day = False
        receipt, access_paths = snapshots.publish(df, path, **options), ()
    elif by_day:
        sort_by = options.setdefault("sort_by", ("timestamp",))
        receipt, access_paths = writers.replace_days(df, path, **options), ("day_index", *sort_by)
    else:
        receipt, access_paths = writers.replace_table(df, path, **options), ()
    # the shape of what was written, not of what is found
    stored = spark.read.schema(writers.keyed(df).schema if by_day else df.schema).parquet(resolve(spark, path))

    if by_day:
        base = incremental.refresh(stored, path, f"{target}/load_rollup")
    else:
        base = results.stored_rollup(stored, f"{target}/load_rollup", quality=True)

    generated_at = _now()
    document = summary_document(base).withColumn("generated_at", F.lit(generated_at))
    writers.replace_table(document, f"{target}/summary", "json")
    summary = spark.read.schema(document.schema).json(f"{target}/summary")
    report = reports.load_report(summary, receipt, access_paths)
    reports.write_report(report, f"{target}/load_report", "LOAD REPORT", generated_at)
    reports.write_report(
        reports.validation_report(base),
        f"{target}/validation_report",
        "DATA VALIDATION REPORT",
        generated_at,
    )
    return receipt


def review(spark: SparkSession, target: str, fmt: str = "parquet") -> None:
    """Write the review of stored results below ``target``."""
    report = reports.review_report(spark, target, fmt=fmt)
    reports.write_report(report, f"{target}/review_report", "RESULTS REVIEW REPORT", _now())
