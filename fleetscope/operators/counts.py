"""Counts, averages and spread. Every order ends in the keys, so it is total.

All aggregates combine on the map side: a vehicle or zone that holds a third
of the rows reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import predicates as is_
from fleetscope.functions.derive import shard_of
from fleetscope.operators.rollup import mean_rssi, rows


def count_by(
    df: DataFrame,
    *keys: str,
    where: Column | None = None,
    name: str = "count",
    by_size: bool = True,
) -> DataFrame:
    """Readings per key, the largest group first (or in key order)."""
    kept = df if where is None else df.filter(where)
    counted = kept.groupBy(*keys).agg(rows(df).alias(name))
    return counted.orderBy(F.desc(name), *keys) if by_size else counted.orderBy(*keys)


# --- distributions ----------------------------------------------------------
def category_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "downtime_category")


def shift_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "shift", by_size=False)


def shift_counts_by_size(df: DataFrame) -> DataFrame:
    return count_by(df, "shift")


def zone_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "zone")


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(rows(df).alias("count"))


def flag_counts(df: DataFrame) -> DataFrame:
    """Value counts of the three flags, from their joint counts."""
    flags = ["visible", "mov", "occ"]
    joint = df.groupBy(*flags).agg(rows(df).alias("n"))
    return (
        joint.unpivot("n", flags, "flag", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("flag", "value")
        .agg(F.sum("n").alias("count"))
        .orderBy("flag", F.desc("count"), "value")
    )


def distinct_values(df: DataFrame) -> DataFrame:
    """Distinct non-null values of the label columns and the day index."""
    labels = ["status", "downtime_category", "shift", "day_index"]
    joint = df.select(*labels).distinct()
    as_text = joint.select(*[F.col(c).cast("string").alias(c) for c in labels])
    return (
        as_text.unpivot([], labels, "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("column", F.length("value"), "value")
    )


def distinct_days(df: DataFrame) -> DataFrame:
    return df.select("day_index").distinct().orderBy("day_index")


# --- per vehicle and per shift ----------------------------------------------
def active_work_by_forklift(df: DataFrame) -> DataFrame:
    return count_by(df, "forklift_id", where=is_.active())


def unauthorized_by_forklift_flags(df: DataFrame) -> DataFrame:
    return count_by(df, "forklift_id", where=is_.flagged_unauthorized())


def unauthorized_by_forklift_category(df: DataFrame) -> DataFrame:
    return count_by(df, "forklift_id", where=is_.unauthorized())


def offline_summary(df: DataFrame) -> DataFrame:
    return count_by(df, "shift", where=is_.offline(), name="offline_count", by_size=False)


def offline_by_shift_ranked(df: DataFrame) -> DataFrame:
    return count_by(df, "shift", where=is_.offline(), name="offline_count")


def shift_status_counts(df: DataFrame) -> DataFrame:
    counted = df.groupBy("shift", "status").agg(rows(df).alias("cnt"))
    return counted.orderBy("shift", F.desc("cnt"), "status")


# --- totals -----------------------------------------------------------------
def record_count(df: DataFrame) -> DataFrame:
    return df.agg(rows(df).alias("total_records"))


def status_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        rows(df, is_.active()).alias("active_work_count"),
        rows(df, is_.unauthorized()).alias("unauthorized_count"),
        rows(df, is_.offline()).alias("offline_count"),
    )


# --- signal and spread ------------------------------------------------------
def avg_rssi_by_zone(df: DataFrame) -> DataFrame:
    """Mean signal of visible readings; the sentinel 0 must not enter it."""
    seen = df.filter(is_.visible())
    return seen.groupBy("zone").agg(mean_rssi(df).alias("avg_rssi")).orderBy("avg_rssi", "zone")


def zone_shift_summary(df: DataFrame) -> DataFrame:
    seen = df.filter(is_.visible())
    return (
        seen.groupBy("zone", "shift")
        .agg(rows(df).alias("record_count"), F.round(mean_rssi(df), 2).alias("avg_rssi"))
        .orderBy("zone", "shift")
    )


def unauthorized_spread(df: DataFrame) -> DataFrame:
    """Minimum, maximum and sample deviation of unauthorized use per vehicle.

    Only vehicles with such use count; one vehicle alone has no deviation."""
    used = df.filter(is_.unauthorized() & F.col("forklift_id").isNotNull())
    per_vehicle = used.groupBy("forklift_id").agg(rows(df).alias("n"))
    return per_vehicle.agg(
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
        F.stddev_samp("n").alias("std_count"),
    )


# --- placement --------------------------------------------------------------
def zone_anchors(df: DataFrame) -> DataFrame:
    """Anchors seen in each zone, sorted. Duplicates go before the collect, so
    a group never holds more than the zone's distinct anchors."""
    pairs = df.select("zone", "anchor").filter(F.col("anchor").isNotNull()).distinct()
    return (
        pairs.groupBy("zone")
        .agg(F.sort_array(F.collect_list("anchor")).alias("anchors"))
        .orderBy("zone")
    )


def shard_balance(df: DataFrame, shards: int = 2) -> DataFrame:
    """Rows and vehicles per hash shard, and each shard's load over the mean.

    Vehicles are counted first, so one hash is taken per vehicle, not per row."""
    per_vehicle = df.groupBy("forklift_id").agg(rows(df).alias("n"))
    per_shard = (
        per_vehicle.withColumn("shard", shard_of(F.col("forklift_id"), shards))
        .groupBy("shard")
        .agg(F.sum("n").alias("record_count"), F.count("forklift_id").alias("vehicles"))
    )
    held = F.col("record_count")
    everything = per_shard.agg(
        F.sum(held).alias("total"),
        F.collect_list(F.struct("shard", "record_count", "vehicles")).alias("parts"),
    )
    return (
        everything.select("total", F.inline("parts"))
        .select(
            "shard",
            "record_count",
            "vehicles",
            F.round(held * shards / F.col("total"), 4).alias("load_over_mean"),
        )
        .orderBy("shard")
    )
