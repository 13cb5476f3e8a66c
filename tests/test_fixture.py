"""Queries over the hand-made readings: values, null rules and sort orders."""

import math

import pytest
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.operators import counts, fleet, quality, rates, reshape, summary, topk
from fleetscope.plans import catalog
from fleetscope.plans.sql_queries import SQL, run_sql, run_sql_on_view
from fleetscope.sources.readers import register_view
from tests.fixture import READINGS, listed, reading, rows


@pytest.fixture(scope="module")
def df(spark):
    return rows(spark).cache()


def test_null_category_is_a_group_of_its_own(df):
    assert listed(counts.category_counts(df)) == [
        ("active_work", 3),
        ("parked_or_charging_candidate", 2),
        ("signal_loss_or_offline", 2),
        ("unauthorized_operation", 2),
        (None, 1),
        ("available", 1),
        ("idle_waiting", 1),
    ]


def test_counts_are_sorted_as_documented(df):
    assert listed(counts.shift_counts(df)) == [
        ("afternoon", 5), ("evening", 1), ("morning", 4), ("night", 2)
    ]
    assert listed(counts.shift_counts_by_size(df)) == [
        ("afternoon", 5), ("morning", 4), ("night", 2), ("evening", 1)
    ]
    assert listed(counts.zone_counts(df)) == [
        ("WIP", 4), ("Charging", 2), ("Packing", 2), ("Production", 2), ("Storage", 2)
    ]


def test_status_and_totals(df):
    assert dict(listed(counts.status_counts(df))) == {"offline": 3, "online": 8, "unknown": 1}
    assert listed(counts.record_count(df)) == [(12,)]
    assert listed(counts.status_totals(df)) == [(3, 2, 3)]


def test_flags_and_categories_disagree_on_unauthorized_use(df):
    assert listed(counts.unauthorized_by_forklift_flags(df)) == [("FL_01", 2), ("FL_02", 1)]
    assert listed(counts.unauthorized_by_forklift_category(df)) == [("FL_01", 1), ("FL_02", 1)]


def test_ties_are_broken_by_vehicle(df):
    assert listed(topk.top_unauthorized_forklifts(df, 1)) == [("FL_01", 1)]
    assert listed(topk.top_forklifts_by_records(df, 2)) == [("FL_02", 6), ("FL_01", 5)]


def test_shift_without_offline_readings(df):
    assert listed(counts.offline_summary(df)) == [("morning", 1), ("night", 2)]
    assert listed(counts.offline_by_shift_ranked(df)) == [("night", 2), ("morning", 1)]
    assert listed(reshape.shift_status_crosstab(df)) == [
        ("afternoon", 0, 5), ("evening", 0, 0), ("morning", 1, 3), ("night", 2, 0)
    ]


def test_normalized_crosstab_divides_by_all_known_statuses(df):
    table = {row[0]: row[1:] for row in listed(reshape.shift_status_crosstab_normalized(df))}
    assert table["morning"] == (0.25, 0.75)
    assert table["evening"] == (0.0, 0.0)  # its only reading has another status
    whole = reshape.shift_status_crosstab_normalized(df, ("offline", "online", "unknown"))
    for _, *shares in listed(whole):
        assert math.isclose(sum(shares), 1.0)


def test_cross_tabulations_keep_every_label(df):
    table = catalog.CLEAN["shift_status_crosstab"](df)
    assert table.columns == ["shift", "offline", "online", "unknown"]
    assert ("evening", 0, 0, 1) in listed(table)
    for _, *shares in listed(catalog.CLEAN["shift_status_crosstab_normalized"](df)):
        assert math.isclose(sum(shares), 1.0)
    matrix = reshape.composite_risk_matrix(df, reshape.with_observed(df, "shift", fixed.SHIFTS))
    assert matrix.columns == ["zone", "morning", "afternoon", "night", "evening"]
    scores = {row[:2]: row[-1] for row in listed(rates.composite_risk_zone_shift(df))}
    packing = matrix.filter("zone = 'Packing'").first()
    assert packing["evening"] == scores["Packing", "evening"]


def test_sentinel_signal_stays_out_of_averages(df):
    table = dict(listed(counts.avg_rssi_by_zone(df)))
    assert table["WIP"] == pytest.approx((-60 - 95 - 60) / 3)
    assert table["Storage"] == -70.0
    assert listed(counts.zone_shift_summary(df))[:2] == [
        ("Charging", "afternoon", 2, -65.0),
        ("Packing", "evening", 1, -70.0),
    ]


def test_spread(spark, df):
    assert listed(counts.unauthorized_spread(df)) == [(1, 1, 0.0)]
    alone = rows(spark, [READINGS[0]])
    assert listed(counts.unauthorized_spread(alone)) == [(1, 1, None)]


def test_null_category_counts_in_the_denominator_only(df):
    # FL_01: five readings, one without a category; none is active work
    assert listed(rates.downtime_by_forklift(df)) == [
        ("FL_01", 5, 4, 0.8), ("FL_02", 6, 4, 0.6667), ("TRK_1", 1, 0, 0.0)
    ]


def test_composite_risk_adds_both_events(df):
    table = {row[:2]: row[2:] for row in listed(rates.composite_risk_zone_shift(df))}
    # the offline reading that is still called unauthorized counts twice
    assert table[("WIP", "morning")] == (2, 1, 2, 3, 1.5)
    assert table[("WIP", "night")] == (1, 1, 0, 1, 1.0)
    matrix = {row[0]: row[1:] for row in listed(reshape.composite_risk_matrix(df))}
    assert matrix["WIP"] == (1.5, 0.0, 1.0)
    assert matrix["Charging"] == (None, 0.0, None)


def test_rates_of_nothing_are_no_rows(spark):
    nothing = rows(spark, [])
    assert listed(rates.shift_risk(nothing)) == []
    assert listed(rates.all_rates(nothing)) == []
    assert listed(counts.status_totals(nothing)) == [(0, 0, 0)]


def test_null_counts(df):
    table = dict(listed(quality.null_counts(df)))
    assert table["downtime_category"] == 1
    assert sum(table.values()) == 1
    assert len(table) == 13


def test_logic_and_domains(df):
    assert dict(listed(quality.logic_checks(df))) == {
        "offline_but_visible": 1, "hidden_with_signal": 1, "moving_unoccupied": 3
    }
    assert dict(listed(quality.domain_violations(df))) == {
        "shift": 1, "status": 1, "forklift_id": 1
    }


def test_duplicate_keys_ignore_microseconds(df):
    assert listed(quality.duplicate_keys(df)) == [
        ("FL_02_2026-04-02 15:00:00", 2),
        ("FL_02_2026-04-02 21:59:59", 2),
    ]


def test_stored_category_is_compared_null_safely(df):
    table = {row[0]: row[1:] for row in listed(quality.classification_mismatch(df))}
    # offline but visible is signal loss; the null category should be available
    assert table["signal_loss_or_offline"] == (3, 1)
    assert table["available"] == (2, 1)
    assert sum(bad for _, bad in table.values()) == 2


def test_signal_ranges_and_anchors(df):
    signal = {row[0]: row[1:] for row in listed(quality.rssi_out_of_range(df))}
    assert signal["WIP"] == (3, 1)
    assert sum(bad for _, bad in signal.values()) == 1
    anchors = {row[0]: row[1:] for row in listed(quality.zone_anchor_mismatch(df))}
    assert anchors["WIP"] == (4, 1)
    assert sum(bad for _, bad in anchors.values()) == 1


def test_cadence(df):
    table = listed(quality.cadence_completeness(df, 8))
    assert [(row[0], str(row[1]), *row[2:]) for row in table][:2] == [
        ("FL_01", "2026-04-01", 4, 8, 4, 0.5),
        ("FL_01", "2026-04-02", 1, 8, 7, 0.125),
    ]
    assert quality.cadence_completeness(df).first()["expected_count"] == 28800


def test_value_distributions_leave_nulls_out(df):
    table = listed(quality.value_distributions(df))
    per_column = {}
    for column, _, n in table:
        per_column[column] = per_column.get(column, 0) + n
    assert per_column["downtime_category"] == 11
    assert per_column["visible"] == 12
    assert ("zone", "WIP", 4) in table


def test_validation_report_agrees_with_its_parts(df):
    report = {row[:2]: row[2] for row in listed(quality.validation_report(df))}
    assert report[("shape", "rows")] == 12
    assert report[("shape", "columns")] == 13
    for column, nulls in listed(quality.null_counts(df)):
        assert report[("missing_values", column)] == nulls
    for check, found in listed(quality.logic_checks(df)):
        assert report[("logical_checks", check)] == found
    for column, value, n in listed(quality.value_distributions(df)):
        assert report[(f"{column}_distribution", value)] == n


def test_validation_report_of_nothing_shows_zeros(spark):
    report = {row[:2]: row[2] for row in listed(quality.validation_report(rows(spark, [])))}
    assert report[("shape", "rows")] == 0
    assert report[("missing_values", "zone")] == 0
    assert len(report) == 2 + 13 + 3


def test_validate_names_what_is_wrong(spark, df):
    with pytest.raises(ValueError, match="null downtime_category"):
        quality.validate(df)
    with pytest.raises(ValueError, match="empty"):
        quality.validate(rows(spark, []))
    with pytest.raises(ValueError, match=r"Missing columns: \['zone'\]"):
        quality.validate(df.drop("zone"))
    fit = df.filter("forklift_id = 'FL_02'")
    assert quality.validate(fit) is fit
    with pytest.raises(ValueError, match="repeated"):
        quality.validate(fit, unique=True)


def test_summary_document(df):
    document = summary.summary_document(df).first().asDict(recursive=True)
    assert document["total_records"] == 12
    assert (document["active_work_count"], document["unauthorized_count"]) == (3, 2)
    assert document["offline_count"] == 3
    assert document["top_unauthorized_forklifts"] == [
        {"_id": "FL_01", "count": 1}, {"_id": "FL_02", "count": 1}
    ]
    assert document["zone_counts"][0] == {"_id": "WIP", "count": 4}
    assert [z["_id"] for z in document["zone_counts"][1:]] == [
        "Charging", "Packing", "Production", "Storage"
    ]


def test_summary_keeps_all_zones_and_only_k_vehicles(spark):
    many = [
        reading("2026-04-01 06:00:00", f"FL_{v:02d}", "A1", f"Z{v}", "morning", -60, 1, 1, 0, "online", "unauthorized_operation")
        for v in range(1, 13)
        for _ in range(v)
    ]
    document = summary.summary_document(rows(spark, many), 5).first()
    assert [(e["_id"], e["count"]) for e in document["top_unauthorized_forklifts"]] == [
        ("FL_12", 12), ("FL_11", 11), ("FL_10", 10), ("FL_09", 9), ("FL_08", 8)
    ]
    assert len(document["zone_counts"]) == 12


def test_summary_of_nothing(spark):
    document = summary.summary_document(rows(spark, [])).first()
    assert document["total_records"] == 0
    assert document["zone_counts"] == []


def test_profiles(df):
    assert listed(fleet.profile_enriched_counts(df)) == [
        ("high", "high", 2, 11), ("unknown", "unknown", 1, 1)
    ]
    share = {row[0]: row[1:] for row in listed(fleet.preferred_zone_share(df))}
    # FL_01 prefers Production and WIP; resting vehicles may be in neither of them
    assert share["FL_01"] == (5, 3, 4, 3, 0.6, 0.75)
    assert share["TRK_1"] == (1, 0, 0, 0, 0.0, None)


def test_state_mix_drift_by_hand(spark):
    some = rows(spark, [r for r in READINGS if r[3] == "FL_01" and r[6] == "morning"])
    (found,) = listed(fleet.state_mix_drift(some))
    # high usage and risk, morning: .60 .28 .08 .11, in total 1.07
    expected = [0.60 / 1.07, 0.28 / 1.07, 0.08 / 1.07, 0.11 / 1.07]
    observed = [0.0, 0.0, 0.5, 0.5]
    assert found[:3] == ("FL_01", "morning", 2)
    assert found[3:7] == pytest.approx([o - e for o, e in zip(observed, expected)], abs=1e-6)
    # base 0.025; one of two readings is in Storage, bonus 0.003; WIP has no effect
    assert found[7] == pytest.approx(0.5 - (0.025 + 0.975 * 0.0015), abs=1e-6)


def test_zone_anchors(df):
    table = dict(listed(counts.zone_anchors(df)))
    assert table["WIP"] == ["A3", "A7"]


def test_distinct(df):
    table = listed(counts.distinct_values(df))
    assert [v for c, v in table if c == "day_index"] == ["1", "2"]
    assert ("downtime_category", None) not in table
    assert listed(counts.distinct_days(df)) == [(1,), (2,)]


def test_first_records(df):
    first = listed(topk.first_records_by_forklift(df, 2))
    assert [str(row[0]) for row in first] == ["2026-04-01 05:59:59", "2026-04-01 06:00:00"]
    assert topk.preview(df, 3).count() == 3


def test_sql_and_dataframe_queries_agree(df):
    twins = {"offline_prediction_sql": rates.offline_prediction}
    assert set(twins) == set(SQL)
    for name, twin in twins.items():
        assert listed(run_sql(name, df)) == listed(twin(df)), name
        register_view(df, "readings")
        assert listed(run_sql_on_view(df.sparkSession, name, "readings")) == listed(twin(df)), name


def test_shards_cover_all_rows(df):
    table = listed(counts.shard_balance(df, 4))
    assert sum(row[1] for row in table) == 12
    assert sum(row[2] for row in table) == 3
    assert all(0 <= row[0] < 4 for row in table)
    assert sum(row[3] for row in table) == pytest.approx(4.0, abs=1e-3)


def test_flag_counts(df):
    assert listed(counts.flag_counts(df))[:2] == [("mov", 1, 7), ("mov", 0, 5)]
    total = counts.flag_counts(df).groupBy("flag").agg(F.sum("count").alias("n"))
    assert {row["n"] for row in total.collect()} == {12}
