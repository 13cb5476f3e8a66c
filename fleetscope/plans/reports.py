"""Text reports. A report is a DataFrame of (section, metric, value) lines,
written one line per row; its size depends on labels and results, never on the
number of readings.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators import quality
from fleetscope.plans import results
from fleetscope.schema import REPORT, schema_tree
from fleetscope.sinks.writers import Receipt


def _lines(spark: SparkSession, lines: Iterable[tuple[str, str, object]]) -> DataFrame:
    """Lines the driver knows anyway, in the given order."""
    rows = [(section, metric, str(value)) for section, metric, value in lines]
    return spark.createDataFrame(rows, REPORT).coalesce(1)


def execution_report(
    df: DataFrame, records: int, timings: Mapping[str, float], outputs: Iterable[str]
) -> DataFrame:
    """What a run read, how long its actions took and what it wrote."""
    lines: list[tuple[str, str, object]] = [
        ("totals", "records", records),
        ("totals", "columns", len(df.columns)),
    ]
    lines += [("schema", "line", text) for text in schema_tree(df).splitlines() if text]
    lines += [("timing_seconds", name, f"{spent:.4f}") for name, spent in timings.items()]
    lines += [("output", "path", path) for path in outputs]
    return _lines(df.sparkSession, lines)


def validation_report(df: DataFrame) -> DataFrame:
    report = quality.validation_report(df)
    return report.withColumn("value", F.col("value").cast("string"))


def load_report(
    document: DataFrame, receipt: Receipt, access_paths: Iterable[str] = ()
) -> DataFrame:
    """What was loaded, the columns its layout serves, and the summary document."""

    def line(section: str, metric: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            metric.cast("string").alias("metric"),
            value.cast("string").alias("value"),
        )

    head = [
        line("load", F.lit("path"), F.lit(receipt.path)),
        line("load", F.lit("written"), F.lit(receipt.written)),
        line("load", F.lit("stored"), F.lit(receipt.stored)),
        *[line("access_path", F.lit(i + 1), F.lit(p)) for i, p in enumerate(access_paths)],
        *[
            line("result", F.lit(name), F.col(name))
            for name in document.columns
            if name.endswith(("_records", "_count"))
        ],
    ]

    def entries(name: str) -> Column:
        return F.transform(name, lambda e: line(name, e["_id"], e["count"]))

    arrays = [entries(name) for name in ("top_unauthorized_forklifts", "zone_counts")]
    return document.select(F.inline(F.concat(F.array(*head), *arrays)))


def review_report(
    spark: SparkSession, target: str, names: Iterable[str] = results.REVIEWED, fmt: str = "parquet"
) -> DataFrame:
    """Shape and first rows of each stored result."""
    names = tuple(names)
    shapes = results.review_results(spark, target, names, fmt)
    shape = F.format_string("%d x %d", "rows", "columns")

    def lines(df: DataFrame, section: Column, metric: str, value: Column) -> DataFrame:
        columns = (section.alias("section"), F.lit(metric).alias("metric"), value.alias("value"))
        return df.select(*columns)

    report = lines(shapes, F.col("result"), "shape", shape)
    for name in names:
        first = results.preview_result(spark, target, name, fmt)
        report = report.unionByName(lines(first, F.lit(name), "preview", F.col("row")))
    return report


def write_report(report: DataFrame, path: str, title: str, generated_at: str) -> None:
    """Replace the report at ``path``: a heading, then a line per row."""
    line = F.concat_ws(" | ", "section", F.coalesce("metric", F.lit("null")), "value")
    body = report.select(line.alias("value"))
    heading = report.sparkSession.createDataFrame(
        [(f"=== {title} ===",), (f"Generated at: {generated_at}",)], "value string"
    )
    heading.coalesce(1).union(body).write.mode("overwrite").text(path)
