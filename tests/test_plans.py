"""What the plans must look like to hold at a thousand times the data, and
relations between queries that hold on any data."""

import re

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import counts, quality, rates, reshape, summary
from fleetscope.operators.rollup import rollup
from fleetscope.plans import catalog, results
from fleetscope.schema import TELEMETRY
from fleetscope.sinks.writers import replace_table
from fleetscope.sources import events, readers
from tests.fixture import explained, listed

LAZY = {
    name: query
    for name, query in (catalog.CLEAN | catalog.DAMAGED).items()
    if name not in catalog.LOADS
}
# results with a row per reading; everything else must shrink before a shuffle
ROW_LEVEL = {*catalog.DERIVED, "signal_sentinel"}


@pytest.fixture(scope="module")
def stored(spark, medium, tmp_path_factory):
    """Telemetry as a Parquet table, the way a user has it."""
    path = str(tmp_path_factory.mktemp("telemetry"))
    df = events.telemetry(spark, medium)
    replace_table(df, path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


@pytest.mark.parametrize("name", sorted(LAZY))
def test_plan_scales(stored, name, capsys):
    plan = explained(LAZY[name](stored), capsys)
    tree = plan.split("\n\n")[0]
    # the facts are read once, by a columnar scan
    assert tree.count("Scan parquet") == 1
    # no pairs of rows, no Python, and no forced single partition of facts
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Arrow"):
        assert operator not in tree
    # no shuffle of raw readings: aggregation (or a top k) comes first
    operators = [
        re.sub(r"[^A-Za-z]", "", line.split("(")[0]) for line in tree.splitlines() if "(" in line
    ]
    below = operators[: operators.index("Scanparquet")][::-1]
    if name in ROW_LEVEL:
        assert "Exchange" not in below
    elif name != "first_records_by_forklift":
        assert below.index("HashAggregate") < below.index("Exchange")


@pytest.mark.parametrize(
    "name, columns",
    [
        ("zone_counts", {"zone"}),
        ("avg_rssi_by_zone", {"zone", "rssi", "visible"}),
        ("zone_risk", {"zone", "status"}),
        ("composite_risk_zone_shift", {"zone", "shift", "status", "downtime_category"}),
        ("duplicate_keys", {"forklift_id", "timestamp"}),
        ("all_rates", {"forklift_id", "zone", "shift", "status", "downtime_category"}),
        ("summary_document", {"forklift_id", "zone", "status", "downtime_category"}),
    ],
)
def test_only_needed_columns_are_read(stored, name, columns, capsys):
    plan = explained(LAZY[name](stored), capsys)
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("top_unauthorized_forklifts", "EqualTo(downtime_category,unauthorized_operation)"),
        ("unauthorized_by_forklift_flags", "EqualTo(mov,1), EqualTo(occ,0)"),
        ("offline_summary", "EqualTo(status,offline)"),
        ("zone_shift_summary", "EqualTo(visible,1)"),
    ],
)
def test_filters_reach_the_scan(stored, name, pushed, capsys):
    assert pushed in explained(LAZY[name](stored), capsys)


def test_top_k_does_not_sort_everything(stored, capsys):
    for name in ("top_unauthorized_forklifts", "top_forklifts_by_records", "first_records_by_forklift"):
        assert "TakeOrderedAndProject" in explained(LAZY[name](stored), capsys)


def test_summary_ranks_before_it_collects(stored, capsys):
    plan = explained(summary.summary_document(stored), capsys)
    assert plan.split("\n\n")[0].count("WindowGroupLimit") == 2


def test_dimensions_are_broadcast_by_their_known_size(spark, stored, capsys):
    for name in ("derive_zone", "zone_anchor_mismatch", "profile_enriched_counts", "state_mix_drift"):
        assert "BroadcastHashJoin" in explained(LAZY[name](stored), capsys), name
    # nothing forces it: past the threshold the join shuffles
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "SortMergeJoin" in explained(LAZY["derive_zone"](stored), capsys)
    finally:
        spark.conf.set(threshold, before)


def test_days_prune_partitions(spark, stored, tmp_path, capsys):
    path = str(tmp_path / "days")
    stored.select(*TELEMETRY.fieldNames()).write.partitionBy("day_index").parquet(path)
    some = counts.zone_counts(readers.read_parquet(spark, path).filter(F.col("day_index").isin(3, 4)))
    plan = explained(some, capsys)
    assert "PartitionFilters: [day_index" in plan
    assert "day_index" not in re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


# --- relations between queries ----------------------------------------------
def total(df, column="count"):
    return df.agg(F.sum(column)).first()[0]


@pytest.fixture(params=["clean", "damaged"])
def any_telemetry(request, spark, medium):
    source = events.telemetry if request.param == "clean" else events.damaged_telemetry
    return source(spark, medium)


def test_counts_add_up(any_telemetry):
    df = any_telemetry
    records = counts.record_count(df).first()[0]
    assert records == 10_000
    for query in (
        counts.category_counts,
        counts.shift_counts,
        counts.zone_counts,
        counts.status_counts,
    ):
        assert total(query(df)) == records
    assert total(counts.shard_balance(df), "record_count") == records
    assert total(quality.cadence_completeness(df), "record_count") == records


def test_offline_readings_agree(any_telemetry):
    df = any_telemetry
    offline = counts.status_totals(df).first()["offline_count"]
    for query in (rates.zone_risk, rates.shift_risk, rates.predict_offline_risk, counts.offline_summary):
        assert total(query(df), "offline_count") == offline
    assert total(reshape.shift_status_crosstab(df), "offline") == offline


def test_three_spellings_of_the_same_risk(any_telemetry):
    df = any_telemetry
    first = listed(rates.offline_risk_by_forklift_shift(df))
    assert first == listed(rates.predict_offline_risk(df)) == listed(rates.offline_prediction(df))


def test_crosstab_rows_are_shift_counts(any_telemetry):
    df = any_telemetry
    table = reshape.shift_status_crosstab(df).select("shift", (F.col("offline") + F.col("online")))
    assert listed(table) == listed(counts.shift_counts(df))


def test_flags_find_no_less_than_categories(spark, medium):
    # holds wherever the categories follow the rules
    df = events.telemetry(spark, medium)
    flagged = dict(listed(counts.unauthorized_by_forklift_flags(df)))
    for vehicle, n in listed(counts.unauthorized_by_forklift_category(df)):
        assert flagged[vehicle] >= n
    assert flagged["FL_01"] == 188 and total(counts.unauthorized_by_forklift_category(df)) < sum(
        flagged.values()
    )


def test_all_rates_equal_the_single_queries(any_telemetry):
    df = any_telemetry
    everything = rates.all_rates(df).cache()
    slices = {
        rates.predict_offline_risk: ("forklift_id", "shift"),
        rates.predict_unauthorized_risk: ("forklift_id", "shift"),
        rates.composite_risk_zone_shift: ("zone", "shift"),
        rates.downtime_by_forklift: ("forklift_id",),
        rates.zone_risk: ("zone",),
        rates.shift_risk: ("shift",),
    }
    for query, keys in slices.items():
        single = query(df)
        part = rates.rates_of(everything, *keys).select(*single.columns)
        assert sorted(listed(part), key=str) == sorted(listed(single), key=str)
    everything.unpersist()


def test_rollup_gives_what_the_facts_give(any_telemetry):
    df = any_telemetry
    base = rollup(df).cache()
    assert base.count() < df.count() / 4
    others = [
        reshape.shift_status_crosstab,
        reshape.shift_status_crosstab_normalized,
        reshape.composite_risk_matrix,
        counts.unauthorized_spread,
        counts.status_totals,
        counts.record_count,
        counts.flag_counts,
        rates.all_rates,
    ]
    for query in [*results.RESULTS.values(), *others]:
        left, right = listed(query(base)), listed(query(df))
        assert [r[:1] for r in left] == [r[:1] for r in right] or sorted(left, key=str) == sorted(right, key=str)
        for a, b in zip(sorted(left, key=str), sorted(right, key=str)):
            assert a == pytest.approx(b), query.__name__
    base.unpersist()


def test_validation_report_from_the_rollup(any_telemetry):
    df = any_telemetry
    base = rollup(df, quality=True)
    assert listed(quality.validation_report(base)) == listed(quality.validation_report(df))
    assert listed(summary.summary_document(base)) == listed(summary.summary_document(df))


def test_damage_is_what_was_probed(spark, medium):
    df = events.damaged_telemetry(spark, medium)
    logic = dict(listed(quality.logic_checks(df)))
    assert (logic["offline_but_visible"], logic["hidden_with_signal"]) == (52, 59)
    assert dict(listed(quality.null_counts(df)))["downtime_category"] == 435
    domain = dict(listed(quality.domain_violations(df)))
    assert (domain["shift"], domain["forklift_id"]) == (345, 323)
    assert total(quality.zone_anchor_mismatch(df), "mismatches") == 665
