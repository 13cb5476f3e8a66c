"""Historical rates: events over readings, per vehicle, zone and shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions import predicates as is_
from fleetscope.functions.derive import lookup_value, rate
from fleetscope.operators.rollup import rows

RATE_KEYS = (
    ("forklift_id", "shift"),
    ("zone", "shift"),
    ("forklift_id",),
    ("zone",),
    ("shift",),
)


def rate_by(
    df: DataFrame, keys: tuple[str, ...], event: Column, count: str, share: str
) -> DataFrame:
    """Readings, events and their rate per key, the highest rate first. An event
    that is NULL is no event, but the reading still counts below the line."""
    counted = df.groupBy(*keys).agg(
        rows(df).alias("total_records"), rows(df, event).alias(count)
    )
    rated = counted.withColumn(share, rate(F.col(count), F.col("total_records")))
    return rated.orderBy(F.desc(share), *keys)


def _composite(counted: DataFrame) -> DataFrame:
    """Both kinds of events are added up, not merged: on inconsistent data a
    reading can count twice."""
    return counted.withColumn(
        "total_risk_events", F.col("offline_count") + F.col("unauthorized_count")
    ).withColumn("risk_score", rate(F.col("total_risk_events"), F.col("total_records")))


def composite_scores(df: DataFrame) -> DataFrame:
    counted = df.groupBy("zone", "shift").agg(
        rows(df).alias("total_records"),
        rows(df, is_.offline()).alias("offline_count"),
        rows(df, is_.unauthorized()).alias("unauthorized_count"),
    )
    return _composite(counted)


def composite_risk_zone_shift(df: DataFrame) -> DataFrame:
    return composite_scores(df).orderBy(F.desc("risk_score"), "zone", "shift")


def offline_risk_by_forklift_shift(df: DataFrame) -> DataFrame:
    return rate_by(df, ("forklift_id", "shift"), is_.offline(), "offline_count", "offline_risk")


def unauthorized_risk_by_forklift_shift(df: DataFrame) -> DataFrame:
    return rate_by(
        df, ("forklift_id", "shift"), is_.unauthorized(), "unauthorized_count", "unauthorized_risk"
    )


def offline_risk_by_zone_shift(df: DataFrame) -> DataFrame:
    return rate_by(df, ("zone", "shift"), is_.offline(), "offline_count", "offline_risk")


def offline_prediction(df: DataFrame) -> DataFrame:
    return rate_by(
        df, ("forklift_id", "shift"), is_.offline(), "offline_count", "predicted_offline_risk"
    )


def downtime_by_forklift(df: DataFrame) -> DataFrame:
    return rate_by(df, ("forklift_id",), is_.not_active(), "downtime_count", "downtime_rate")


def predict_offline_risk(df: DataFrame) -> DataFrame:
    return rate_by(df, ("forklift_id", "shift"), is_.offline(), "offline_count", "offline_rate")


def predict_unauthorized_risk(df: DataFrame) -> DataFrame:
    return rate_by(
        df, ("forklift_id", "shift"), is_.unauthorized(), "unauthorized_count", "unauthorized_rate"
    )


def zone_risk(df: DataFrame) -> DataFrame:
    return rate_by(df, ("zone",), is_.offline(), "offline_count", "offline_rate")


def shift_risk(df: DataFrame) -> DataFrame:
    return rate_by(df, ("shift",), is_.offline(), "offline_count", "offline_rate")


def all_rates(df: DataFrame) -> DataFrame:
    """Every rate over every key set in one pass, told apart by ``grouping``.

    The facts shrink to a row per vehicle, zone and shift first; the grouping
    sets expand these few rows, never the facts."""
    names = ("forklift_id", "zone", "shift")
    counted = {
        "total_records": rows(df),
        "offline_count": rows(df, is_.offline()),
        "unauthorized_count": rows(df, is_.unauthorized()),
        "downtime_count": rows(df, is_.not_active()),
    }
    base = df.groupBy(*names).agg(*[count.alias(name) for name, count in counted.items()])
    summed = base.groupingSets([[F.col(k) for k in keys] for keys in RATE_KEYS], *names).agg(
        F.grouping_id().alias("set_id"), *[F.sum(name).alias(name) for name in counted]
    )

    def set_id(keys: tuple[str, ...]) -> int:
        """A bit per name, set where the name is left out, the first one highest."""
        return int("".join("0" if name in keys else "1" for name in names), 2)

    label = lookup_value(
        F.col("set_id"), [(set_id(keys), "+".join(keys)) for keys in RATE_KEYS]
    )
    total = F.col("total_records")
    return (
        _composite(summed)
        .select(
            label.alias("grouping"),
            *names,
            *counted,
            "total_risk_events",
            rate(F.col("offline_count"), total).alias("offline_rate"),
            rate(F.col("unauthorized_count"), total).alias("unauthorized_rate"),
            rate(F.col("downtime_count"), total).alias("downtime_rate"),
            "risk_score",
        )
        .orderBy("grouping", *names)
    )


def rates_of(rates: DataFrame, *keys: str) -> DataFrame:
    """The slice of ``all_rates`` for one key set."""
    others = [name for name in ("forklift_id", "zone", "shift") if name not in keys]
    return rates.filter(F.col("grouping") == "+".join(keys)).drop("grouping", *others)
