"""Layouts that serve the access paths: by vehicle hash and by time range.

Parquet has no indexes. A partition column prunes directories, and sorting
inside the files makes their min/max statistics narrow enough to skip row
groups. No vehicle, day or instant is assumed to fit one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import derive
from fleetscope.sinks.writers import Receipt, _load

# the single-column access paths, and the compound one
ACCESS_PATHS = (
    ("forklift_id",),
    ("timestamp",),
    ("day_index",),
    ("shift",),
    ("zone",),
    ("status",),
    ("downtime_category",),
    ("zone", "shift"),
)


def bloom_filters(*columns: str) -> dict[str, object]:
    """Write options for lookups of single values, such as a record's ``_id``:
    readers skip row groups whose filter rules the value out."""
    return {f"parquet.bloom.filter.enabled#{column}": True for column in columns}


def write_by_vehicle(
    df: DataFrame,
    path: str,
    shards: int = 2,
    sort_by: tuple[str, ...] = ("forklift_id", "timestamp"),
    **options: object,
) -> Receipt:
    """One directory per hash shard of the vehicle, and few vehicles per file.
    The number of shards is stored with the table, as a directory above them.

    Rebalancing splits a vehicle that is too large for one task, which a
    bucketed table could not: its readers take a whole bucket per task."""
    sharded = df.withColumn("shard", derive.shard_of(F.col("forklift_id"), shards))
    sharded = sharded.withColumn("shards", F.lit(shards))
    gathered = sharded.hint("rebalance", "shard", "forklift_id")
    arranged = gathered.sortWithinPartitions("shard", *sort_by)
    return _load(arranged, path, "parquet", "overwrite", ("shards", "shard"), options)


def write_by_time(
    df: DataFrame, path: str, ranges: int | None = None, **options: object
) -> Receipt:
    """One directory per date, sorted by time within its files.

    By default a file holds whole hours, and rebalancing sizes the files: short
    hours share one, an hour too large for a task is split. With ``ranges`` the
    readings are cut into so many disjoint time ranges instead, which costs a
    second pass to sample them; the input split breaks ties then, so that even
    readings of one single instant spread over several ranges."""
    if ranges is None:
        by_hour = df.withColumn("hour", F.hour("timestamp"))
        gathered = by_hour.hint("rebalance", "date", "hour").drop("hour")
    else:
        by_split = df.withColumn("input_split", F.spark_partition_id())
        ranged = by_split.repartitionByRange(ranges, "timestamp", "input_split")
        gathered = ranged.drop("input_split")
    arranged = gathered.sortWithinPartitions("date", "timestamp")
    return _load(arranged, path, "parquet", "overwrite", ("date",), options)


def of_vehicle(stored: DataFrame, vehicle: str) -> DataFrame:
    """One vehicle's readings from a table written by vehicle: only its shard's
    directory is read. How many shards there are is read from the table."""
    shard = derive.shard_of(F.lit(vehicle), F.col("shards"))
    return stored.filter((F.col("shard") == shard) & (F.col("forklift_id") == vehicle))


def within(stored: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Readings in [start, end) from a table written by time: only the dates in
    question are read."""
    dates = F.col("date").between(F.lit(start.date()), F.lit(end.date()))
    first, last = (F.lit(at.isoformat(" ")).cast("timestamp_ntz") for at in (start, end))
    return stored.filter(dates & (F.col("timestamp") >= first) & (F.col("timestamp") < last))


def write_sorted(df: DataFrame, path: str, *access_path: str, **options: object) -> Receipt:
    """Sort each file by an access path, so that its filters skip row groups."""
    if access_path not in ACCESS_PATHS:
        raise ValueError(f"Not an access path: {access_path}")
    arranged = df.sortWithinPartitions(*access_path)
    return _load(arranged, path, "parquet", "overwrite", options=options)
