"""When vehicles were heard: bits for seconds, and runs of missing readings.

A vehicle's seconds of one minute are 60 bits of one number, set by ``bit_or`` in
the map tasks. A reading every three seconds thus reaches the shuffle as a
twentieth of a small row, and readings of one second, however many, as one bit.
Coarser slots (a reading every hour, say) are bits of longer blocks alike.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.sinks.storage import Scratch
from fleetscope.sources.dimensions import profiles

_BITS = 60  # slots in a block: as many as a minute has seconds
_DAY = 86400


def _shifted(value: Column, places: Column) -> Column:
    return F.call_function("shiftleft", value, places.cast("int"))


def _blocks(df: DataFrame, slot: int, name: str, *measures: Column) -> DataFrame:
    place = F.floor(derive.second_of(F.col("timestamp")) / slot)
    bit = _shifted(F.lit(1).cast("bigint"), F.pmod(place, F.lit(_BITS)))
    return df.groupBy("forklift_id", F.floor(place / _BITS).alias(name)).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_or(bit).alias("present"), *measures
    )


def minutes(df: DataFrame, *measures: Column) -> DataFrame:
    """forklift_id, minute, rows and the seconds that are present, as bits."""
    return _blocks(df, 1, "minute", *measures)


def day_of(minute: Column) -> Column:
    """The date of a minute that is counted from 1970."""
    return F.date_from_unix_date(F.floor(minute * _BITS / _DAY).cast("int"))


def _slots(present: Column) -> Column:
    """The slots of a block without a reading."""
    places = F.sequence(F.lit(0), F.lit(_BITS - 1))
    return F.filter(places, lambda b: F.getbit(present, b) == 0)


def _islands(pieces: DataFrame, *keys: str) -> DataFrame:
    """Merge pieces (``keys``, start, end) that touch within a key."""
    by_start = Window.partitionBy(*keys).orderBy("start")
    begins = (F.col("start") != F.lag("end").over(by_start) + 1) | F.lag("end").over(by_start).isNull()
    numbered = pieces.withColumn("begins", begins.cast("int")).withColumn("island", F.sum("begins").over(by_start))
    return numbered.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def cadence_gaps(
    df: DataFrame,
    scratch: Scratch,
    slot: int = fixed.READING_SECONDS,
    first: date | None = None,
    last: date | None = None,
    vehicles: DataFrame | None = None,
) -> DataFrame:
    """Runs of slots of ``slot`` seconds in which a vehicle was not heard:
    forklift_id, first_missing, last_missing (starts of slots) and missing_slots.

    The calendar has every day from ``first`` to ``last`` (the first and last that
    any vehicle was heard) for all ``vehicles`` (the known ones) and those heard,
    so silent days and vehicles are gaps as well. Days are looked at one by one; a
    silent day, and a silent block within a day, is a piece of its own and never
    spread into slots. Only gaps at a day's bounds are joined beyond that day, two
    of a vehicle and day at most."""
    per_day = _DAY // slot
    if _DAY % slot:
        raise ValueError(f"A day has no whole number of slots of {slot} seconds")
    spark = df.sparkSession
    blocks = _blocks(df.filter("forklift_id IS NOT NULL AND timestamp IS NOT NULL"), slot, "block")
    heard = scratch.save(blocks)  # small: all that follows reads this alone
    # a block may hold slots of several days: its bits are dealt to each
    start = F.col("block") * _BITS
    days = F.sequence(F.floor(start / per_day), F.floor((start + _BITS - 1) / per_day))
    of_day = heard.select("forklift_id", "block", "present", F.explode(days).alias("day"))
    low = F.greatest(F.col("day") * per_day - start, F.lit(0))
    high = F.least((F.col("day") + 1) * per_day - 1 - start, F.lit(_BITS - 1))
    ones = _shifted(F.lit(1).cast("bigint"), high - low + 1) - 1
    within = of_day.withColumn("inside", _shifted(ones, low))
    within = within.withColumn("present", F.col("present").bitwiseAND(F.col("inside")))
    within = within.filter("present <> 0")
    epoch = date(1970, 1, 1)
    low_day, high_day = ((day - epoch).days if day else None for day in (first, last))
    if low_day is None or high_day is None:
        seen = within.agg(F.min("day"), F.max("day")).first()
        low_day = seen[0] if low_day is None else low_day
        high_day = seen[1] if high_day is None else high_day
    empty = low_day is None or high_day is None or high_day < low_day
    known = profiles(spark).select("forklift_id") if vehicles is None else vehicles.select("forklift_id")
    everyone = known.union(heard.select("forklift_id")).distinct()
    days = F.array().cast("array<bigint>") if empty else F.expr(f"sequence({low_day}L, {high_day}L)")
    calendar = everyone.select("forklift_id", F.explode(days).alias("day"))
    held = within.groupBy("forklift_id", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("block", "present"))).alias("held")
    )
    both = calendar.join(held, ["forklift_id", "day"], "left")
    begin, end = F.col("day") * per_day, (F.col("day") + 1) * per_day - 1

    def missing(block: Column) -> Column:
        """A block's pieces: all of it, or its single slots; cut to the day."""
        present = F.try_element_at("held", block)
        whole = F.array(F.struct((block * _BITS).alias("start"), (block * _BITS + _BITS - 1).alias("end")))
        single = F.transform(
            _slots(present), lambda b: F.struct((block * _BITS + b).alias("start"), (block * _BITS + b).alias("end"))
        )
        return F.when(present.isNull(), whole).otherwise(single)

    in_day = F.flatten(F.transform(F.sequence(F.floor(begin / _BITS), F.floor(end / _BITS)), missing))
    silent = F.array(F.struct(begin.alias("start"), end.alias("end")))
    pieces = both.select(
        "forklift_id", "day", begin.alias("begin"), end.alias("until"),
        F.inline(F.when(F.col("held").isNull(), silent).otherwise(in_day)),
    )
    cut = pieces.select(
        "forklift_id", "day", F.greatest("start", "begin").alias("start"), F.least("end", "until").alias("end")
    ).filter("start <= end")
    daily = _islands(cut, "forklift_id", "day")
    at_bound = (F.col("start") == begin) | (F.col("end") == end)
    daily = daily.withColumn("at_bound", at_bound)
    joined = _islands(daily.filter("at_bound").select("forklift_id", "start", "end"), "forklift_id")
    runs = daily.filter("NOT at_bound").select("forklift_id", "start", "end").unionByName(joined)
    return runs.select(
        "forklift_id",
        derive.time_of_second(F.col("start") * slot).alias("first_missing"),
        derive.time_of_second(F.col("end") * slot).alias("last_missing"),
        (F.col("end") - F.col("start") + 1).alias("missing_slots"),
    ).orderBy("forklift_id", "first_missing")
