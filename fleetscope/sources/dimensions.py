"""The small fixed dimensions, and the lookup join that uses them.

Dimensions are SQL ``VALUES`` relations: Catalyst knows their exact size and
broadcasts them by its own threshold. Nothing here forces a broadcast, so a
large table passed to ``lookup`` falls back to a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions.derive import lookup_value, normalised


def _sql_literal(value: object) -> str:
    if isinstance(value, tuple):
        return "array(" + ", ".join(_sql_literal(v) for v in value) + ")"
    return f"'{value}'" if isinstance(value, str) else str(value)


def values_frame(spark: SparkSession, columns: str, rows: tuple[tuple, ...]) -> DataFrame:
    """A handful of literal rows as a relation of known size."""
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS dim({columns})")


def anchors(spark: SparkSession) -> DataFrame:
    """anchor, zone"""
    return values_frame(spark, "anchor, zone", fixed.ANCHOR_ZONES)


def profiles(spark: SparkSession) -> DataFrame:
    """forklift_id, usage_level, risk_level, preferred_zones"""
    columns = "forklift_id, usage_level, risk_level, preferred_zones"
    return values_frame(spark, columns, fixed.PROFILES)


def expected_mix(spark: SparkSession) -> DataFrame:
    """Expected state shares and base offline probability per vehicle and shift.

    Shifts are exploded onto the profiles, which needs no join."""
    names = [name for name, _ in fixed.STATES]
    shifts = F.array(
        *[
            F.struct(
                F.lit(shift).alias("shift"),
                *[F.lit(w).alias(n) for n, w in zip(names, weights)],
                F.lit(offline).alias("offline"),
            )
            for shift, weights, offline in fixed.SHIFT_MIX
        ]
    )
    rows = profiles(spark).select("forklift_id", "usage_level", "risk_level", F.inline(shifts))

    def adjusted(name: str, pick) -> Column:
        usage = [(level, pick(row)) for level, *row in fixed.USAGE_ADJUSTMENT]
        risk = [(level, pick(row)) for level, *row in fixed.RISK_ADJUSTMENT]
        by_usage = lookup_value(F.col("usage_level"), usage, 0.0)
        return F.col(name) + by_usage + lookup_value(F.col("risk_level"), risk, 0.0)

    weights = {name: adjusted(name, lambda row, i=i: row[0][i]) for i, name in enumerate(names)}
    return rows.select(
        "forklift_id",
        "shift",
        *[share.alias(f"expected_{name}") for name, share in normalised(weights).items()],
        adjusted("offline", lambda row: row[1]).alias("expected_offline"),
    )


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    key: str | list[str],
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Left join to a dimension; unmatched rows keep NULL or the given default."""
    joined = df.join(dimension, key, "left")
    if not defaults:
        return joined
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )
