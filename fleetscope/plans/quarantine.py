"""Loads of CSV files that may hold malformed rows.

A row that does not parse (a text where a number should be, too many fields) is
kept as it stands in the file, in a table of its own, and never as a row of
NULLs. How many there are is observed while the good rows are staged, so a clean
file is parsed once; a load with more than the allowed share of malformed rows
fails before the table has changed, and leaves the rows that it refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.schema import TELEMETRY
from fleetscope.sinks.pointer import resolve
from fleetscope.sinks.writers import Receipt, replace_table

RECORD, FILE = "malformed_record", "malformed_file"


@dataclass(frozen=True)
class Outcome:
    """The load's receipt, and where its malformed rows are."""

    receipt: Receipt
    rejected: int
    rejects: str


def read_csv_rows(spark: SparkSession, path: str, schema: T.StructType = TELEMETRY) -> DataFrame:
    """All rows of a CSV with a header, with the text of those that don't parse."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())]))
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    return reader.options(**options).csv(resolve(spark, path))


def load_csv(
    spark: SparkSession,
    path: str,
    target: str,
    rejects: str,
    schema: T.StructType = TELEMETRY,
    most: float = 0.01,
    **options: object,
) -> Outcome:
    """Replace the table at ``target`` by the file's good rows, and the one at
    ``rejects`` by its malformed ones: their text, their file, and those fields
    that did parse. More than the share ``most`` of malformed rows is an error."""
    rows = read_csv_rows(spark, path, schema)
    malformed = F.col(RECORD).isNotNull()
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(malformed).alias("malformed"))
    # every column is selected: the parser checks those only that it is asked for
    good = counted.filter(~malformed).drop(RECORD)

    def verify() -> None:
        bad = rows.filter(malformed).select("*", F.col("_metadata.file_path").alias(FILE))
        replace_table(bad if seen.get["malformed"] else bad.limit(0), rejects)
        if seen.get["malformed"] > most * seen.get["rows"]:
            raise ValueError(
                f"{path}: {seen.get['malformed']} of {seen.get['rows']} rows are malformed, kept at {rejects}"
            )

    receipt = replace_table(good, target, verify=verify, **options)
    return Outcome(receipt, seen.get["malformed"], rejects)
