"""Column functions against plain Python, over all inputs that matter."""

import itertools
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.functions import derive
from fleetscope.operators import quality
from fleetscope.schema import TELEMETRY_V1
from fleetscope.sources.dimensions import anchors, expected_mix, lookup, profiles
from tests.fixture import READINGS, reading, rows


@pytest.mark.parametrize(
    "clock, shift",
    [
        ("00:00:00", "night"),
        ("05:59:59", "night"),
        ("06:00:00", "morning"),
        ("13:59:59", "morning"),
        ("14:00:00", "afternoon"),
        ("21:59:59", "afternoon"),
        ("22:00:00", "night"),
    ],
)
def test_shift_bounds(spark, clock, shift):
    ts = F.lit(f"2026-04-01 {clock}").cast("timestamp_ntz")
    assert spark.range(1).select(derive.shift_of(ts)).first()[0] == shift


def test_classification_over_every_combination(spark):
    by_state = {
        (1, 1): fixed.ACTIVE,
        (0, 1): fixed.IDLE,
        (1, 0): fixed.UNAUTHORIZED,
        (0, 0): fixed.AVAILABLE,
    }

    def by_hand(status, visible, mov, occ, zone):
        category = by_state.get((mov, occ), fixed.UNKNOWN)
        if category == fixed.AVAILABLE and zone in fixed.PARKING_ZONES:
            category = fixed.PARKED
        lost = visible == 0 or status == fixed.OFFLINE
        return fixed.SIGNAL_LOSS if lost else category

    cases = list(
        itertools.product(
            ("online", "offline", None),
            (0, 1, None),
            (0, 1, 2, None),
            (0, 1, None),
            ("WIP", "Charging", "Maintenance", None),
        )
    )
    df = spark.createDataFrame(cases, "status string, visible int, mov int, occ int, zone string")
    found = df.select("*", derive.downtime_category(*[F.col(c) for c in df.columns]).alias("c"))
    for *inputs, category in found.collect():
        assert category == by_hand(*inputs), inputs


def test_zones(spark):
    df = spark.createDataFrame([(f"A{i}",) for i in range(1, 10)], "anchor string")
    table = dict(df.select("anchor", derive.zone_of(F.col("anchor"))).collect())
    assert table["A8"] == "WIP" and table["A9"] is None
    joined = lookup(df, anchors(spark), "anchor", {"zone": "elsewhere"})
    found = dict(joined.select("anchor", "zone").collect())
    assert found.pop("A9") == "elsewhere"
    assert found == {a: z for a, z in table.items() if a != "A9"}


def test_day_index_and_upgrade(spark):
    full = rows(spark)
    older = full.select(*TELEMETRY_V1.fieldNames())
    upgraded = derive.with_day(older, date(2026, 4, 1)).select(*full.columns)
    assert upgraded.exceptAll(full).count() == 0
    assert dict(upgraded.dtypes) == dict(full.dtypes)


def test_vehicle_ids(spark):
    ids = spark.range(1, 13).select(derive.vehicle_id(F.col("id"))).collect()
    assert [row[0] for row in ids] == [f"FL_{n:02d}" for n in range(1, 13)]
    assert spark.range(1).select(derive.vehicle_id(F.lit(123))).first()[0] == "FL_123"


def test_text_and_sentinel(spark):
    one = rows(spark, [READINGS[5], READINGS[1]])
    keys = one.select(derive.record_key(F.col("forklift_id"), F.col("timestamp"))).collect()
    assert [k[0] for k in keys] == ["FL_02_2026-04-02 21:59:59", "FL_01_2026-04-01 05:59:59"]
    signal = one.select(derive.signal_of(F.col("visible"), F.col("rssi"))).collect()
    assert [s[0] for s in signal] == [-55, 0]
    parsed = spark.range(1).select(derive.parse_timestamp(F.lit("2026-04-01 05:59:59")))
    assert parsed.first()[0] == datetime(2026, 4, 1, 5, 59, 59)


def test_wall_clock_does_not_follow_the_session_zone(spark):
    # 02:30 does not exist on this day in New York
    gap = rows(
        spark,
        [
            reading(f"2026-03-08 {clock}", "FL_01", "A1", "Production", "night", -60, 1, 1, 1, "online", "active_work")
            for clock in ("02:30:00", "03:30:00", "05:59:59")
        ],
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.col("timestamp")
        shifts = gap.select(derive.shift_of(ts), derive.timestamp_text(ts), F.to_date(ts))
        assert [tuple(map(str, row)) for row in shifts.collect()] == [
            ("night", "2026-03-08 02:30:00", "2026-03-08"),
            ("night", "2026-03-08 03:30:00", "2026-03-08"),
            ("night", "2026-03-08 05:59:59", "2026-03-08"),
        ]
        assert quality.duplicate_keys(gap).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_preferred_candidates_keep_the_order_of_preference(spark):
    wanted = {
        ("FL_02", 1, 1): ["Production", "Storage"],
        ("FL_02", 0, 0): ["Storage"],
        ("FL_09", 0, 0): ["Maintenance", "Storage"],
        ("FL_01", 0, 0): [],
    }
    dim = profiles(spark)
    for (vehicle, mov, occ), zones in wanted.items():
        picked = derive.preferred_candidates(F.col("preferred_zones"), F.lit(mov), F.lit(occ))
        assert dim.filter(F.col("forklift_id") == vehicle).select(picked).first()[0] == zones


def test_expected_mix(spark):
    mix = expected_mix(spark)
    assert mix.count() == 30
    shares = [F.col(f"expected_{name}") for name, _ in fixed.STATES]
    assert mix.filter(F.abs(shares[0] + shares[1] + shares[2] + shares[3] - 1) > 1e-12).isEmpty()
    row = mix.filter("forklift_id = 'FL_08' AND shift = 'night'").first()
    # low usage, low risk at night: .07 .13 .70 .06, in total .96
    assert row["expected_active"] == pytest.approx(0.07 / 0.96)
    assert row["expected_offline"] == 0.06


def test_negative_weights_are_clipped(spark):
    weights = derive.normalised({"a": F.lit(-0.5), "b": F.lit(0.5), "c": F.lit(1.5)})
    assert tuple(spark.range(1).select(*weights.values()).first()) == (0.0, 0.25, 0.75)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["FL_01", "FL_02", None]),
            st.sampled_from(["morning", "night", None]),
            st.sampled_from(["online", "offline", None]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_rates_against_brute_force(spark, triples):
    from fleetscope.operators.rates import predict_offline_risk

    df = spark.createDataFrame(triples, "forklift_id string, shift string, status string")
    found = {row[:2]: row[2:4] for row in predict_offline_risk(df).collect()}
    wanted = {}
    for vehicle, shift, status in triples:
        total, offline = wanted.get((vehicle, shift), (0, 0))
        wanted[(vehicle, shift)] = (total + 1, offline + (status == "offline"))
    assert found == wanted
