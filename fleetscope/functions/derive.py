"""Derived columns. Every function maps Columns to a Column, so Catalyst sees
plain expressions: they stay in generated code and need no Python workers.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed


def lookup_value(
    key: Column, pairs: Iterable[tuple[object, object]], default: object = None
) -> Column:
    """``key`` looked up in a small fixed table, ``default`` where it is absent."""
    entries = [F.lit(part) for pair in pairs for part in pair]
    found = F.create_map(*entries)[key]
    return found if default is None else F.coalesce(found, F.lit(default))


# --- time -------------------------------------------------------------------
def parse_timestamp(text: Column) -> Column:
    """Text to a timestamp without zone; typed timestamps pass unchanged."""
    return text.cast("timestamp_ntz")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``. Cutting the plain text keeps the session zone out."""
    return F.substring(ts.cast("string"), 1, 19)


def second_of(ts: Column) -> Column:
    """The second a reading falls in, counted from 1970 on the wall clock."""
    in_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + in_day


def time_of_second(second: Column) -> Column:
    """The timestamp of a second counted by ``second_of``."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=second)


def shift_of(ts: Column) -> Column:
    hour = F.hour(ts)

    def within(hours: tuple[int, int]) -> Column:
        return (hour >= hours[0]) & (hour < hours[1])

    morning, afternoon, night = fixed.SHIFTS
    return (
        F.when(within(fixed.MORNING_HOURS), morning)
        .when(within(fixed.AFTERNOON_HOURS), afternoon)
        .otherwise(night)
    )


def day_index(ts: Column, start: date) -> Column:
    """1 on the start day, 2 on the next one, and so on."""
    return F.datediff(F.to_date(ts), F.lit(start)) + 1


def with_day(df: DataFrame, start: date) -> DataFrame:
    """Add ``date`` and ``day_index`` to telemetry that lacks them."""
    ts = F.col("timestamp")
    return df.withColumns({"date": F.to_date(ts), "day_index": day_index(ts, start)})


# --- identity ---------------------------------------------------------------
def vehicle_id(number: Column, prefix: str = fixed.VEHICLE_PREFIX) -> Column:
    """The prefix and the number padded to at least two digits."""
    digits = number.cast("string")
    return F.when(number < 10, F.concat(F.lit(prefix + "0"), digits)).otherwise(
        F.concat(F.lit(prefix), digits)
    )


def record_key(vehicle: Column, ts: Column) -> Column:
    """The deterministic document key: vehicle and second of the reading."""
    return F.concat_ws("_", vehicle, timestamp_text(ts))


def has_vehicle_prefix(vehicle: Column) -> Column:
    return vehicle.startswith(fixed.VEHICLE_PREFIX)


def shard_of(vehicle: Column, shards: int | Column) -> Column:
    """Hash bucket of a vehicle; the rule is reproducible outside Spark."""
    head = F.substring(F.md5(vehicle), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % shards).cast("int")


# --- place, signal and state ------------------------------------------------
def zone_of(anchor: Column) -> Column:
    return lookup_value(anchor, fixed.ANCHOR_ZONES)


def signal_of(visible: Column, rssi: Column) -> Column:
    """The reading, or the no-signal sentinel while the vehicle is not visible."""
    return F.when(visible == 0, fixed.RSSI_NO_SIGNAL).otherwise(rssi)


def rssi_in_range(zone: Column, rssi: Column) -> Column:
    """Whether a visible reading lies in its zone's range."""
    low_elsewhere, high_elsewhere = fixed.RSSI_RANGE_ELSEWHERE
    low = lookup_value(zone, [(z, low) for z, low, _ in fixed.RSSI_RANGES], low_elsewhere)
    high = lookup_value(zone, [(z, high) for z, _, high in fixed.RSSI_RANGES], high_elsewhere)
    return rssi.between(low, high)


def in_state(mov: Column, occ: Column, state: tuple[int, int]) -> Column:
    return (mov == state[0]) & (occ == state[1])


def downtime_category(
    status: Column, visible: Column, mov: Column, occ: Column, zone: Column
) -> Column:
    """Ordered rules: losing the signal outranks whatever the flags say."""
    at_rest = in_state(mov, occ, (0, 0))
    return (
        F.when((status == fixed.OFFLINE) | (visible == 0), fixed.SIGNAL_LOSS)
        .when(in_state(mov, occ, (1, 1)), fixed.ACTIVE)
        .when(in_state(mov, occ, (0, 1)), fixed.IDLE)
        .when(in_state(mov, occ, (1, 0)), fixed.UNAUTHORIZED)
        .when(at_rest & zone.isin(*fixed.PARKING_ZONES), fixed.PARKED)
        .when(at_rest, fixed.AVAILABLE)
        .otherwise(fixed.UNKNOWN)
    )


def allowed_zones(mov: Column, occ: Column) -> Column:
    """Zones a vehicle may be in during the state; NULL for no known state."""
    picked = F.lit(None)
    for state, zones in reversed(fixed.STATE_ZONES):
        zone_list = F.array(*[F.lit(z) for z in zones])
        picked = F.when(in_state(mov, occ, state), zone_list).otherwise(picked)
    return picked


def preferred_candidates(preferred: Column, mov: Column, occ: Column) -> Column:
    """Preferred zones allowed in the state, in order of preference."""
    return F.array_intersect(preferred, allowed_zones(mov, occ))


def offline_bonus(zone: Column) -> Column:
    """Extra dropout chance of a zone as an exact decimal, never below zero."""
    bonus = lookup_value(zone, fixed.ZONE_OFFLINE_BONUS, Decimal("0.000"))
    return F.greatest(bonus, F.lit(Decimal("0.000"))).cast("decimal(18,3)")


# --- arithmetic -------------------------------------------------------------
def rate(events: Column, total: Column) -> Column:
    """Share of ``total``, to four places; NULL instead of a division error."""
    return F.round(F.try_divide(events, total), 4)


def normalised(weights: dict[str, Column]) -> dict[str, Column]:
    """Weights clipped at zero and scaled to sum to one."""
    clipped = {name: F.greatest(weight, F.lit(0.0)) for name, weight in weights.items()}
    total = sum(list(clipped.values())[1:], next(iter(clipped.values())))
    return {name: weight / total for name, weight in clipped.items()}
