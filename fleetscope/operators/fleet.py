"""Readings against the vehicle profiles: usage, preference and expected mix.

In each query the facts are aggregated before they meet a dimension, so the
join sees a row per vehicle (and zone or shift) instead of every reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.functions import predicates as is_
from fleetscope.operators.rollup import rows
from fleetscope.sources.dimensions import expected_mix, lookup, profiles


def profile_enriched_counts(df: DataFrame) -> DataFrame:
    """Vehicles and readings per usage and risk level."""
    per_vehicle = df.groupBy("forklift_id").agg(rows(df).alias("n"))
    unknown = {"usage_level": fixed.UNKNOWN, "risk_level": fixed.UNKNOWN}
    return (
        lookup(per_vehicle, profiles(df.sparkSession), "forklift_id", unknown)
        .groupBy("usage_level", "risk_level")
        .agg(F.count(F.lit(1)).alias("vehicles"), F.sum("n").alias("total_records"))
        .orderBy("usage_level", "risk_level")
    )


def preferred_zone_share(df: DataFrame) -> DataFrame:
    """How often a vehicle is in a zone it prefers: over all its readings, and
    over those whose state allows at least one preferred zone."""
    places = df.groupBy("forklift_id", "zone", "mov", "occ").agg(rows(df).alias("n"))
    placed = lookup(places, profiles(df.sparkSession), "forklift_id")
    candidates = derive.preferred_candidates(F.col("preferred_zones"), F.col("mov"), F.col("occ"))
    n = F.col("n")

    def readings(condition) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    counted = placed.groupBy("forklift_id").agg(
        F.sum(n).alias("total_records"),
        readings(F.array_contains("preferred_zones", F.col("zone"))).alias("preferred_records"),
        readings(F.size(candidates) > 0).alias("eligible_records"),
        readings(F.array_contains(candidates, F.col("zone"))).alias("candidate_records"),
    )
    return counted.select(
        "*",
        derive.rate(F.col("preferred_records"), F.col("total_records")).alias("preferred_share"),
        derive.rate(F.col("candidate_records"), F.col("eligible_records")).alias("candidate_share"),
    ).orderBy("forklift_id")


def state_mix_drift(df: DataFrame) -> DataFrame:
    """Observed minus expected share of each state and of offline readings, per
    vehicle and shift.

    A zone's bonus b lifts the base offline probability p to p + (1 - p) * b.
    Readings are counted per zone before a bonus is applied, and the bonuses are
    added up as exact decimals: the result does not depend on the order in which
    tasks finish."""
    total = F.col("total_records")
    seen = {
        "total_records": rows(df),
        **{
            f"seen_{name}": rows(df, derive.in_state(F.col("mov"), F.col("occ"), state))
            for name, state in fixed.STATES
        },
        "seen_offline": rows(df, is_.offline()),
    }
    per_zone = df.groupBy("forklift_id", "shift", "zone").agg(
        *[count.alias(name) for name, count in seen.items()]
    )
    observed = per_zone.groupBy("forklift_id", "shift").agg(
        *[F.sum(name).alias(name) for name in seen],
        F.sum(derive.offline_bonus(F.col("zone")) * total).alias("bonus"),
    )
    compared = lookup(observed, expected_mix(df.sparkSession), ["forklift_id", "shift"])
    base = F.col("expected_offline")
    offline = base + (1 - base) * (F.col("bonus").cast("double") / total)

    def drift(name: str, expected) -> Column:
        return F.round(F.col(f"seen_{name}") / total - expected, 6).alias(f"{name}_drift")

    return compared.select(
        "forklift_id",
        "shift",
        "total_records",
        *[drift(name, F.col(f"expected_{name}")) for name, _ in fixed.STATES],
        drift("offline", offline),
    ).orderBy("forklift_id", "shift")
