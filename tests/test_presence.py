"""Bits for seconds, repeated keys and runs of missing readings, by hand and by brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import presence, quality, reshape
from fleetscope.sinks.storage import Scratch
from fleetscope.sources import events
from tests.test_plans import explained

START = datetime(2024, 3, 30)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def heard(spark, times):
    return spark.createDataFrame(times, "forklift_id string, timestamp timestamp_ntz")


def vehicles(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "forklift_id string")


def plain_gaps(times, slot, first, last, names):
    """Slot by slot."""
    seen = {(v, int((t - START).total_seconds() // slot)) for v, t in times}
    begin = int((first - START.date()).days * 86400 // slot)
    end = int(((last - START.date()).days + 1) * 86400 // slot)
    found = []
    for name in sorted({*names, *(v for v, _ in times)}):
        run = None
        for place in range(begin, end + 1):
            missing = place < end and (name, place) not in seen
            if missing and run is None:
                run = place
            if not missing and run is not None:
                at = [START + timedelta(seconds=s * slot) for s in (run, place - 1)]
                found.append((name, *at, place - run))
                run = None
    return found


@pytest.mark.parametrize("slot", [3, 60, 3600, 21600, 86400])
def test_gaps_are_those_of_every_slot(spark, scratch, slot):
    chance = random.Random(slot)
    times = []
    for day in range(6):
        for name in ("FL_01", "FL_02"):
            if (name, day) in {("FL_01", 1), ("FL_01", 2), ("FL_02", 5)}:
                continue  # silent days
            at = START + timedelta(days=day)
            hole = chance.randrange(0, 80000)
            for second in range(0, 86400, max(3, slot // 2)):
                if not hole <= second < hole + 3 * slot and chance.random() < 0.98:
                    times.append((name, at + timedelta(seconds=second, microseconds=chance.randrange(999999))))
    times += times[:50]  # repeated readings
    found = presence.cadence_gaps(heard(spark, times).repartition(4), scratch, slot, vehicles=vehicles(spark, "FL_02", "FL_09"))
    last = max(t for _, t in times).date()
    assert [tuple(r) for r in found.collect()] == plain_gaps(times, slot, START.date(), last, ("FL_02", "FL_09"))


def test_a_calendar_may_be_given(spark, scratch):
    times = [("FL_01", datetime(2024, 3, 31, 12, 30))]
    found = presence.cadence_gaps(
        heard(spark, times), scratch, 3600, date(2024, 3, 30), date(2024, 4, 1), vehicles(spark, "FL_02")
    )
    assert [tuple(r) for r in found.collect()] == plain_gaps(times, 3600, date(2024, 3, 30), date(2024, 4, 1), ("FL_02",))
    nothing = heard(spark, [])
    assert presence.cadence_gaps(nothing, scratch, 3600, vehicles=vehicles(spark, "FL_02")).collect() == []
    silent = presence.cadence_gaps(nothing, scratch, 3600, date(2024, 3, 30), date(2024, 4, 1), vehicles(spark, "FL_02"))
    assert [tuple(r) for r in silent.collect()] == [("FL_02", START, datetime(2024, 4, 1, 23), 72)]
    with pytest.raises(ValueError, match="whole number"):
        presence.cadence_gaps(nothing, scratch, 7)


def test_rows_without_vehicle_or_time_are_no_readings(spark, scratch):
    times = [("FL_01", START), (None, START), ("FL_01", None)]
    found = presence.cadence_gaps(heard(spark, times), scratch, 43200, vehicles=vehicles(spark, "FL_01"))
    assert [tuple(r) for r in found.collect()] == [("FL_01", START + timedelta(hours=12), START + timedelta(hours=12), 1)]


def test_a_silent_vehicle_and_silent_days_are_gaps(spark, medium, scratch):
    df = events.silenced_telemetry(spark, medium)
    found = presence.cadence_gaps(df, scratch, slot=3600)
    silent = found.filter(F.col("forklift_id") == events.SILENT_VEHICLE).collect()
    assert [r["missing_slots"] for r in silent] == [30 * 24]
    paused = found.filter((F.col("forklift_id") == events.PAUSED_VEHICLE) & (F.col("missing_slots") >= 120)).collect()
    assert len(paused) == 1 and paused[0]["first_missing"] <= datetime(2024, 1, 11)


def test_repeated_days_are_those_of_repeated_keys(spark, medium):
    df = events.telemetry(spark, medium)
    keys = quality.duplicate_keys(df).collect()
    surplus = {}
    for row in keys:
        name, day = row["_id"].rsplit("_", 1)[0], row["_id"].rsplit("_", 1)[1][:10]
        surplus[name, day] = surplus.get((name, day), 0) + row["count"] - 1
    found = quality.repeated_key_days(df).collect()
    assert {(r["forklift_id"], str(r["date"])): r["surplus"] for r in found} == surplus and surplus


def test_a_dense_fleet_shuffles_a_number_per_minute(spark, capsys):
    dense = spark.range(0, 2 * 28800, numPartitions=2).select(
        F.concat(F.lit("FL_0"), (F.col("id") % 2).cast("string")).alias("forklift_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(F.col("id") / 2) * 3)).alias("timestamp"),
    )
    assert presence.minutes(dense).agg(F.sum("rows"), F.sum(F.bit_count("present"))).first() == (57600, 57600)
    assert presence.minutes(dense).count() == 2 * 1440  # and no more than twice that leave the two tasks
    plan = explained(presence.minutes(dense), capsys).split("\n\n")[0]
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_crosstabs_scan_the_readings_once(spark, small, scratch, capsys, monkeypatch):
    df = events.damaged_telemetry(spark, small)
    saved, real = [], scratch.save
    monkeypatch.setattr(scratch, "save", lambda rows: saved.append(explained(rows, capsys)) or real(rows))
    tables = [reshape.observed_crosstab(df, scratch), reshape.observed_risk_matrix(df, scratch)]
    for plan, table in zip(saved, tables, strict=True):
        assert plan.split("\n\n")[0].count("Scan parquet") == 1 and "events.parquet" in plan
        assert "events.parquet" not in explained(table, capsys)
    assert tables[1].columns == ["zone", "morning", "afternoon", "night", "evening"]


def test_too_many_labels_make_no_table(spark, small, scratch):
    df = events.telemetry(spark, small).withColumn("status", F.concat("status", F.col("event_id").cast("string")))
    with pytest.raises(ValueError, match="too many"):
        reshape.with_observed(df.unionAll(df.withColumn("status", F.concat("status", F.lit("x")))), "status", ["online"])
