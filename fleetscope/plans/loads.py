"""Load a whole telemetry table, read it back, and sum it up.

Each plan writes below the shared checkpoint folder and sums up what its own
reader finds there: a load that lost, doubled or shifted anything shows. Only
the sums are kept; the copy of the readings is emptied again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.operators.counts import count_by
from fleetscope.plans import quarantine, results
from fleetscope.schema import TELEMETRY
from fleetscope.sinks import clustered, layout, snapshots, writers
from fleetscope.sources import readers, reconcile


def _fields(df: DataFrame) -> DataFrame:
    return df.select(*TELEMETRY.fieldNames())


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("day_index").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("rssi").alias("rssi_sum"),
        F.min("timestamp").cast("string").alias("first_timestamp"),
        F.max("timestamp").cast("string").alias("last_timestamp"),
        F.count("downtime_category").alias("categorised"),
    )


def _kept(sums: DataFrame, folder: str, *scratch: str) -> DataFrame:
    """The sums as a table of their own, with the scratch tables emptied."""
    spark = sums.sparkSession
    writers.replace_table(sums, f"{folder}/sums")
    for path in scratch:
        writers.empty_table(spark, path)
    key = sums.columns[0]
    return readers.read_parquet(spark, f"{folder}/sums", sums.schema).orderBy(key)


def _scanned(df: DataFrame, fmt: str, reader) -> DataFrame:
    folder = writers.shared_folder(df.sparkSession)
    path = f"{folder}/telemetry"
    writers.replace_table(df, path, fmt)
    return _kept(_per_day(reader(df.sparkSession, path)), folder, path)


def csv_scan(df: DataFrame) -> DataFrame:
    return _scanned(_fields(df), "csv", readers.read_csv)


def parquet_scan(df: DataFrame) -> DataFrame:
    """CSV converted to Parquet, then read."""
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    text, columnar = f"{folder}/csv", f"{folder}/parquet"
    writers.replace_table(_fields(df), text, "csv")
    writers.replace_table(readers.read_csv(spark, text), columnar)
    return _kept(_per_day(readers.read_parquet(spark, columnar)), folder, text, columnar)


def parquet_text_scan(df: DataFrame) -> DataFrame:
    """Parquet as a writer without types leaves it: times as text, flags wide."""
    texts = {name: F.col(name).cast("string") for name in ("timestamp", "date")}
    wide = {name: F.col(name).cast("bigint") for name in ("day_index", "rssi", "visible", "mov", "occ")}
    return _scanned(_fields(df).withColumns(texts | wide), "parquet", reconcile.read_any_parquet)


BROKEN_EVERY = (37, 41)  # events whose signal, or time, is no such thing in the file


def csv_quarantine(df: DataFrame) -> DataFrame:
    """A CSV with malformed rows: the good ones per day, and how many are kept apart."""
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    text, path, rejects = f"{folder}/csv", f"{folder}/telemetry", f"{folder}/rejects"
    no_signal, no_time = (F.col("event_id") % n == 0 for n in BROKEN_EVERY)
    broken = {
        "rssi": F.when(no_signal, "n/a").otherwise(F.col("rssi").cast("string")),
        "timestamp": F.when(no_time, "yesterday").otherwise(F.col("timestamp").cast("string")),
    }
    writers.replace_table(_fields(df.withColumns(broken)), text, "csv")
    quarantine.load_csv(spark, text, path, rejects, most=0.1)
    kept = readers.read_parquet(spark, rejects, None)
    per_day = _per_day(readers.read_parquet(spark, path))
    rejected = kept.groupBy("day_index").agg(F.count(quarantine.RECORD).alias("rejected"))
    return _kept(per_day.join(rejected, "day_index", "left").fillna(0, ["rejected"]), folder, text, path, rejects)


def document_scan(df: DataFrame) -> DataFrame:
    return _scanned(writers.keyed(_fields(df)), "json", readers.read_documents)


def _loaded_twice(df: DataFrame, load) -> DataFrame:
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    path = f"{folder}/telemetry"
    for _ in range(2):
        load(_fields(df), path)
    return _kept(_per_day(readers.read_parquet(spark, path)), folder, path)


def full_replace_load(df: DataFrame) -> DataFrame:
    """Loaded twice: the second load takes the place of the first."""
    return _loaded_twice(df, writers.replace_table)


def snapshot_load(df: DataFrame) -> DataFrame:
    """Published twice, and read through the pointer: the second version holds."""
    return _loaded_twice(df, snapshots.publish)


def append_load(df: DataFrame) -> DataFrame:
    """Loaded twice: every row is stored twice."""
    return _loaded_twice(df, writers.append_table)


def slice_replace_load(df: DataFrame) -> DataFrame:
    """Loaded twice by day: the days are replaced. Repeated keys are let in,
    so that the sums of the whole table can be compared."""
    return _loaded_twice(df, lambda rows, path: writers.replace_days(rows, path, unique=False))


def vehicle_layout(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    path = f"{folder}/telemetry"
    layout.write_by_vehicle(_fields(df), path)
    stored = readers.read_parquet(spark, path, None)
    per_shard = count_by(stored, "shard", name="record_count", by_size=False)
    return _kept(per_shard, folder, path)


def time_layout(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    path = f"{folder}/telemetry"
    layout.write_by_time(_fields(df), path)
    return _kept(_per_day(readers.read_parquet(spark, path)), folder, path)


def clustered_layout(df: DataFrame) -> DataFrame:
    """Clustered by zone and shift; one pair is read from the files that may hold it."""
    spark, folder = df.sparkSession, writers.shared_folder(df.sparkSession)
    path = f"{folder}/telemetry"
    clustered.write_clustered(_fields(df), path, "zone", "shift", files=16)
    bounds = {"zone": ("WIP", "WIP"), "shift": ("night", "night")}
    return _kept(_per_day(clustered.read_within(spark, path, TELEMETRY, bounds)), folder, path)


def result_tables(df: DataFrame) -> DataFrame:
    """All published results stored, then reviewed."""
    target = writers.shared_folder(df.sparkSession)
    results.write_results(df, target)
    return results.review_results(df.sparkSession, target, results.COLLECTIONS)
