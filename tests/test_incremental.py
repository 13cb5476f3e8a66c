"""The rollup kept by day, against full scans."""

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import quality, summary
from fleetscope.operators.rollup import rollup
from fleetscope.plans import incremental, runs
from fleetscope.schema import TELEMETRY
from fleetscope.sinks import writers
from fleetscope.sources import events, readers
from tests.test_plans import explained


@pytest.fixture(scope="module")
def readings(spark, small):
    """Fit to be loaded: one reading of every vehicle and second."""
    df = events.telemetry(spark, small).select(*TELEMETRY.fieldNames())
    return df.dropDuplicates(["forklift_id", "timestamp"]).cache()


def read_days(monkeypatch):
    """The days whose readings a refresh rolls up, by call."""
    seen, real = [], rollup

    def noted(df, *args, **options):
        seen.append(df)
        return real(df, *args, **options)

    monkeypatch.setattr(incremental, "rollup", noted)
    return seen


def as_of_full_scan(spark, target):
    stored = readers.read_parquet(spark, f"{target}/telemetry")
    base = spark.read.parquet(f"{target}/load_rollup").drop("day_index")
    for made in (quality.validation_report, summary.summary_document):
        assert made(base).collect() == made(stored).collect()
    return stored


def test_a_day_load_reads_that_day_only(spark, readings, tmp_path, monkeypatch, capsys):
    target = str(tmp_path)
    runs.load(readings, target)
    as_of_full_scan(spark, target)
    seen = read_days(monkeypatch)
    changed = readings.filter("day_index = 4").withColumn("mov", F.lit(1)).withColumn("occ", F.lit(0))
    runs.load(changed, target)
    (df,) = seen
    plan = explained(df, capsys)
    assert "PartitionFilters: [isnotnull(day_index" in plan and "= 4)" in plan
    stored = as_of_full_scan(spark, target)
    assert stored.filter("day_index = 4 AND mov = 1").count() == changed.count()


def test_loads_that_left_the_rollup_behind_are_caught_up_with(spark, readings, tmp_path, monkeypatch):
    target = str(tmp_path)
    runs.load(readings.filter("day_index < 20"), target)
    writers.replace_days(readings.filter("day_index IN (3, 25)"), f"{target}/telemetry")  # no refresh
    assert incremental.outdated_days(spark, f"{target}/telemetry", f"{target}/load_rollup") == ([3, 25], False)
    runs.load(readings.filter("day_index = 7"), target)
    as_of_full_scan(spark, target)
    assert incremental.outdated_days(spark, f"{target}/telemetry", f"{target}/load_rollup") == ([], False)
    seen = read_days(monkeypatch)
    stored = spark.read.parquet(f"{target}/telemetry")
    incremental.refresh(stored, f"{target}/telemetry", f"{target}/load_rollup")
    assert not seen  # nothing has changed: nothing is read


def test_a_full_load_and_days_after_it(spark, readings, tmp_path):
    runs.load(readings, str(tmp_path / "a"), by_day=False)
    with pytest.raises(ValueError, match="without partitions"):
        runs.load(readings.filter("day_index = 3"), str(tmp_path / "a"))
    assert readers.read_parquet(spark, str(tmp_path / "a" / "telemetry")).count() == readings.count()


def test_versioned_loads_report_on_their_version(spark, readings, tmp_path):
    for rows in (50, 20):
        receipt = runs.load(readings.limit(rows), str(tmp_path), versioned=True)
        assert receipt.stored == rows
    text = "".join(p.read_text() for p in (tmp_path / "validation_report").glob("part-*"))
    assert "shape | rows | 20" in text
