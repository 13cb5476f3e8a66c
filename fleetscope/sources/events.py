"""Telemetry read from the generic ``events`` table.

``telemetry`` maps an event to a sensor reading by plain arithmetic.
``damaged_telemetry`` breaks chosen fields by fixed rules, so that the quality
queries have something to find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.schema import TELEMETRY

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# --- fixed values: how an event becomes a reading --------------------------
FIRST_DAY = date(2024, 1, 1)
VEHICLES = 10
MOVING = ("click", "purchase", "error")
OCCUPIED = ("click", "purchase", "view")
# an event below its shift's limit counts as offline
OFFLINE_BELOW = (("morning", 1.0), ("afternoon", 1.5), ("night", 3.0))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry columns and ``event_id``, over the whole events table."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    event_id, ts, user = F.col("event_id"), F.col("ts"), F.col("user_id")
    anchor_number = (event_id * 7 + user) % len(fixed.ANCHOR_ZONES) + 1
    anchor, zone, shift = F.col("anchor"), F.col("zone"), F.col("shift")
    strength = (
        F.when(zone.isin("Production", "WIP"), 50 + event_id % 26)
        .when(zone.isin("Storage", "Packing"), 55 + event_id % 31)
        .otherwise(60 + event_id % 31)
    )
    rows = (
        events.select(
            "event_id",
            ts.alias("timestamp"),
            F.to_date(ts).alias("date"),
            derive.day_index(ts, FIRST_DAY).alias("day_index"),
            derive.vehicle_id(user % VEHICLES + 1).alias("forklift_id"),
            F.concat(F.lit("A"), anchor_number.cast("string")).alias("anchor"),
            derive.shift_of(ts).alias("shift"),
            _flag(F.col("event_type").isin(*MOVING)).alias("mov"),
            _flag(F.col("event_type").isin(*OCCUPIED)).alias("occ"),
            "value",
        )
        .withColumns(
            {
                "zone": derive.zone_of(anchor),
                "visible": 1 - _flag(F.col("value") < derive.lookup_value(shift, OFFLINE_BELOW)),
            }
        )
        .withColumns(
            {
                "status": F.when(F.col("visible") == 0, fixed.OFFLINE).otherwise(fixed.ONLINE),
                "rssi": derive.signal_of(F.col("visible"), -strength).cast("int"),
            }
        )
    )
    category = derive.downtime_category(
        F.col("status"), F.col("visible"), F.col("mov"), F.col("occ"), zone
    )
    complete = rows.withColumn("downtime_category", category)
    return complete.select(*TELEMETRY.fieldNames(), "event_id")


def damaged_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings with fixed damage; columns not named stay as they are."""
    event_id = F.col("event_id")
    hidden = F.col("visible") == 0

    def every(n: int) -> Column:
        return event_id % n == 0

    def damaged(name: str, *cases: tuple[Column, object]) -> Column:
        column = F.col(name)
        for condition, value in reversed(cases):
            column = F.when(condition, value).otherwise(column)
        return column.alias(name)

    foreign = F.concat(F.lit("TRK_"), F.right(F.col("forklift_id"), F.lit(2)))
    broken = {
        "visible": damaged("visible", (hidden & every(7), 1)),
        "rssi": damaged("rssi", (hidden & every(5), -60), (~hidden & every(19), -95)),
        "zone": damaged("zone", (every(13), "Charging")),
        "shift": damaged("shift", (every(29), "evening")),
        "downtime_category": damaged(
            "downtime_category",
            (every(23), F.lit(None)),
            (every(17) | (hidden & every(3)), fixed.UNAUTHORIZED),
        ),
        "forklift_id": damaged("forklift_id", (every(31), foreign)),
    }
    clean = telemetry(spark, sf_dir)
    return clean.select(*[broken.get(name, F.col(name)) for name in clean.columns])


SILENT_VEHICLE, PAUSED_VEHICLE = "FL_07", "FL_03"
PAUSED_DAYS = (11, 15)  # first and last day index


def silenced_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged readings without one vehicle, and without five days of another."""
    vehicle = F.col("forklift_id")
    paused = (vehicle == PAUSED_VEHICLE) & F.col("day_index").between(*PAUSED_DAYS)
    return damaged_telemetry(spark, sf_dir).filter((vehicle != SILENT_VEHICLE) & ~paused)
