"""Data-quality checks. Each runs as one aggregate over the readings and
returns a row per check, zero included; ``validate`` raises on violations.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.functions import predicates as is_
from fleetscope.operators import presence
from fleetscope.operators.rollup import hidden_signals, nulls, rows
from fleetscope.schema import TELEMETRY, require_columns
from fleetscope.sources.dimensions import anchors, lookup, values_frame

DISTRIBUTION_COLUMNS = ("shift", "status", "downtime_category", "visible", "mov", "occ", "zone")

_LOGIC = {
    "offline_but_visible": is_.offline_but_visible,
    "hidden_with_signal": is_.hidden_with_signal,
    "moving_unoccupied": is_.flagged_unauthorized,
}


def _domain_checks() -> dict[str, Column]:
    return {
        "shift": ~F.col("shift").isin(*fixed.SHIFTS),
        "status": ~F.col("status").isin(*fixed.STATUSES),
        "forklift_id": ~derive.has_vehicle_prefix(F.col("forklift_id")),
    }


def _as_rows(df: DataFrame, checks: dict[str, Column], label: str, value: str) -> DataFrame:
    """All checks in one global aggregate, turned into one row each."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return counted.unpivot([], list(checks), label, value)


def null_counts(df: DataFrame) -> DataFrame:
    columns = TELEMETRY.fieldNames()
    return _as_rows(df, {c: F.col(c).isNull() for c in columns}, "column", "nulls")


def value_distributions(df: DataFrame) -> DataFrame:
    """Value counts of the label columns, nulls left out.

    The facts are counted by all columns at once; only these few joint counts
    are spread out per column."""
    names = list(DISTRIBUTION_COLUMNS)
    joint = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    as_text = joint.select("n", *[F.col(c).cast("string").alias(c) for c in names])
    return (
        as_text.unpivot("n", names, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("n").alias("count"))
        .orderBy("column", F.desc("count"), "value")
    )


def logic_checks(df: DataFrame) -> DataFrame:
    return _as_rows(df, {name: check() for name, check in _LOGIC.items()}, "check", "violations")


def domain_violations(df: DataFrame) -> DataFrame:
    """Labels outside the allowed sets. Nulls are the business of null_counts."""
    return _as_rows(df, _domain_checks(), "check", "violations")


def _per_key(df: DataFrame, *measures: Column) -> DataFrame:
    """Readings per vehicle and second, the columns behind the record key."""
    second = derive.second_of(F.col("timestamp")).alias("second")
    return df.groupBy("forklift_id", second).agg(F.count(F.lit(1)).alias("count"), *measures)


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Record keys that occur more than once, with their number of readings.

    What is shuffled is vehicle, second and count; the key text is made for
    duplicates only."""
    key = derive.record_key(F.col("forklift_id"), derive.time_of_second(F.col("second")))
    return (
        _per_key(df)
        .filter(F.col("count") > 1)
        .select(key.alias("_id"), "count")
        .orderBy(F.desc("count"), "_id")
    )


def repeated_key_days(df: DataFrame) -> DataFrame:
    """Days of vehicles that have more readings than seconds with a reading, and
    how many more. A bit stands for every second, so that what is shuffled is a
    number per vehicle and minute, and not the keys."""
    day = presence.day_of(F.col("minute"))
    return (
        presence.minutes(df)
        .groupBy("forklift_id", day.alias("date"))
        .agg(F.sum("rows").alias("record_count"), F.sum(F.bit_count("present")).cast("bigint").alias("seconds"))
        .filter("record_count > seconds")
        .withColumn("surplus", F.col("record_count") - F.col("seconds"))
        .orderBy("forklift_id", "date")
    )


def classification_mismatch(df: DataFrame) -> DataFrame:
    """Readings per recomputed category, and how many are stored otherwise."""
    expected = derive.downtime_category(
        *[F.col(c) for c in ("status", "visible", "mov", "occ", "zone")]
    )
    stored = F.col("downtime_category")
    return (
        df.groupBy(expected.alias("expected_category"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(~stored.eqNullSafe(expected)).alias("mismatches"),
        )
        .orderBy("expected_category")
    )


def rssi_out_of_range(df: DataFrame) -> DataFrame:
    """Visible readings per zone, and how many have an impossible signal."""
    outside = ~derive.rssi_in_range(F.col("zone"), F.col("rssi"))
    return (
        df.filter(is_.visible())
        .groupBy("zone")
        .agg(F.count(F.lit(1)).alias("visible_records"), F.count_if(outside).alias("out_of_range"))
        .orderBy("zone")
    )


def zone_anchor_mismatch(df: DataFrame) -> DataFrame:
    """Readings per stored zone, and how many have an anchor of another zone.

    Facts are counted per pair first; the dimension joins the counts only."""
    pairs = df.groupBy("anchor", "zone").agg(F.count(F.lit(1)).alias("n"))
    home = anchors(df.sparkSession).withColumnRenamed("zone", "anchor_zone")
    differs = ~F.col("zone").eqNullSafe(F.col("anchor_zone"))
    return (
        lookup(pairs, home, "anchor")
        .groupBy("zone")
        .agg(
            F.sum("n").alias("total_records"),
            F.sum(F.when(differs, F.col("n")).otherwise(0)).alias("mismatches"),
        )
        .orderBy("zone")
    )


def cadence_completeness(df: DataFrame, expected: int = fixed.READINGS_PER_DAY) -> DataFrame:
    """Readings per vehicle and day against the number a full day should have."""
    counted = df.groupBy("forklift_id", "date").agg(F.count(F.lit(1)).alias("record_count"))
    held = F.col("record_count")
    return counted.select(
        "forklift_id",
        "date",
        "record_count",
        F.lit(expected).cast("bigint").alias("expected_count"),
        (expected - held).cast("bigint").alias("missing_count"),
        F.round(held / expected, 4).alias("completeness"),
    ).orderBy("forklift_id", "date")


def validation_report(df: DataFrame) -> DataFrame:
    """Shape, nulls, distributions and logic checks as (section, metric, value),
    of readings or of their rollup with quality.

    One scan: the facts shrink to joint counts, whose few rows are then spread
    over the report lines. Lines that must show a zero are seeded."""
    columns = TELEMETRY.fieldNames()
    spread = set(DISTRIBUTION_COLUMNS)
    n = F.col("n")

    joint = df.groupBy(*DISTRIBUTION_COLUMNS).agg(
        rows(df).alias("n"),
        *[nulls(df, c).alias(f"nulls_{c}") for c in columns if c not in spread],
        rows(df, is_.offline_but_visible()).alias("offline_but_visible"),
        hidden_signals(df).alias("hidden_with_signal"),
        rows(df, is_.flagged_unauthorized()).alias("moving_unoccupied"),
    )

    def line(section: str, metric: str | Column, amount: Column) -> Column:
        metric = F.lit(metric) if isinstance(metric, str) else metric.cast("string")
        return F.struct(
            F.lit(section).alias("section"), metric.alias("metric"), amount.alias("amount")
        )

    lines = [line("shape", "rows", n)]
    for c in columns:
        missing = F.when(F.col(c).isNull(), n).otherwise(0) if c in spread else F.col(f"nulls_{c}")
        lines.append(line("missing_values", c, missing))
    lines += [line(f"{c}_distribution", F.col(c), n) for c in DISTRIBUTION_COLUMNS]
    lines += [line("logical_checks", name, F.col(name)) for name in _LOGIC]

    seeds = [("shape", "rows", 0), ("shape", "columns", len(columns))]
    seeds += [("missing_values", c, 0) for c in columns]
    seeds += [("logical_checks", name, 0) for name in _LOGIC]
    seeded = values_frame(df.sparkSession, "section, metric, amount", tuple(seeds))
    return (
        joint.select(F.inline(F.array(*lines)))
        .filter(F.col("metric").isNotNull())
        .unionByName(seeded)
        .groupBy("section", "metric")
        .agg(F.sum("amount").alias("value"))
        .orderBy("section", "metric")
    )


def validate(df: DataFrame, unique: bool = False) -> DataFrame:
    """``df`` itself if it is fit to be loaded, else ValueError.

    Missing columns, no rows, nulls and labels outside their domains fail, and
    with ``unique`` so do repeated record keys. Telemetry that passes is scanned
    once, and one row reaches the driver; what exactly is wrong is counted only
    where something is."""
    require_columns(df)
    problems = {f"null {c}": F.col(c).isNull() for c in TELEMETRY.fieldNames()}
    problems |= {f"invalid {c}": condition for c, condition in _domain_checks().items()}
    unfit = reduce(or_, [F.coalesce(condition, F.lit(False)) for condition in problems.values()])

    if unique:
        # a bit for every second: no row per reading is shuffled
        found = presence.minutes(df, F.count_if(unfit).alias("unfit")).agg(
            F.sum("rows").alias("rows"),
            F.sum("unfit").alias("unfit"),
            F.sum(F.col("rows") - F.bit_count("present")).alias("repeated"),
        )
    else:
        found = df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(unfit).alias("unfit"),
            F.lit(0).alias("repeated"),
        )
    seen = found.first()
    if not seen["rows"]:
        raise ValueError("Telemetry is empty")
    if seen["unfit"]:
        each = [F.count_if(condition).alias(name) for name, condition in problems.items()]
        counted = df.agg(*each).first().asDict()
        raise ValueError(f"Invalid telemetry: {({k: n for k, n in counted.items() if n})}")
    if seen["repeated"]:
        raise ValueError(f"Invalid telemetry: {seen['repeated']} readings with repeated record keys")
    return df
