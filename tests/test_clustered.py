"""Clustered tables: narrow files, few of them read, and never a row too few."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetscope.schema import TELEMETRY
from fleetscope.sinks import clustered, storage, writers
from fleetscope.sources import events
from tests.test_sources_and_sinks import same

FILES = 24


@pytest.fixture(scope="module")
def readings(spark, medium):
    return events.telemetry(spark, medium).select(*TELEMETRY.fieldNames()).repartition(6).cache()


def within(spark, path, **bounds):
    return (
        clustered.files_within(spark, path, bounds),
        clustered.read_within(spark, path, TELEMETRY, bounds),
    )


def test_a_compound_path_skips_files_by_each_column(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    assert clustered.write_clustered(readings, path, "zone", "shift", files=FILES).stored == 10000
    every = [n for n in storage.names(spark, path) if n.endswith(".parquet")]
    assert len(every) == FILES
    files, found = within(spark, path, zone=("WIP", "WIP"), shift=("night", "night"))
    assert 0 < len(files) < FILES / 4
    same(found, readings.filter("zone = 'WIP' AND shift = 'night'"))
    for name, value, share in (("zone", "Maintenance", 2), ("shift", "morning", 1.5)):
        files, found = within(spark, path, **{name: (value, value)})
        assert len(files) < FILES / share, name
        same(found, readings.filter(F.col(name) == value))


@pytest.mark.parametrize("column, least, most", [
    ("timestamp", datetime(2024, 1, 5, 22, 30), datetime(2024, 1, 6, 6, 0)),
    ("rssi", -58, -56), ("forklift_id", "FL_03", "FL_03"), ("date", None, datetime(2024, 1, 2).date()),
    ("day_index", 29, None),
])
def test_any_column_may_be_a_path(spark, readings, tmp_path, column, least, most):
    path = str(tmp_path / "t")
    clustered.write_clustered(readings, path, column, "status", files=FILES)
    files, found = within(spark, path, **{column: (least, most)})
    assert len(files) <= FILES / 3
    wanted = readings if least is None else readings.filter(F.col(column) >= F.lit(least))
    same(found, wanted if most is None else wanted.filter(F.col(column) <= F.lit(most)))


def test_ranges_follow_the_footers(spark, readings, tmp_path):
    import duckdb

    path = str(tmp_path / "t")
    clustered.write_clustered(readings, path, "zone", "rssi", files=6)
    held = {r["file"]: (r["rssi"]["least"], r["rssi"]["most"]) for r in spark.read.parquet(f"{path}/{clustered.RANGES}").collect()}
    footers = duckdb.sql(
        f"""SELECT parse_filename(file_name), min(CAST(stats_min_value AS INT)), max(CAST(stats_max_value AS INT))
        FROM parquet_metadata('{path}/*.parquet') WHERE path_in_schema = 'rssi' GROUP BY 1"""
    ).fetchall()
    assert held == {name: (low, high) for name, low, high in footers}


def test_a_hot_value_is_spread_and_nulls_are_found(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    hot = readings.withColumn("zone", F.when(F.rand(1) < 0.9, "WIP").otherwise(F.lit(None)))
    hot = hot.cache()
    clustered.write_clustered(hot, path, "zone", files=12)
    sizes = [r[1] for r in spark.read.parquet(path).groupBy("_metadata.file_name").count().collect()]
    assert max(sizes) < 10000 / 3
    same(spark.read.schema(TELEMETRY).parquet(path), hot)
    _, found = within(spark, path, zone=("WIP", None))
    assert found.count() == hot.filter("zone = 'WIP'").count()


def test_files_without_ranges_are_read(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    clustered.write_clustered(readings, path, "zone", files=4)
    writers.append_table(readings.limit(500), path)
    files, found = within(spark, path, zone=("WIP", "WIP"))
    wanted = readings.filter("zone = 'WIP'").count() + readings.limit(500).filter("zone = 'WIP'").count()
    assert found.count() == wanted
    storage.delete(spark, f"{path}/{clustered.RANGES}")
    files, found = within(spark, path, zone=("WIP", "WIP"))
    assert len(files) > 4 and found.count() == wanted


def test_an_empty_table_and_wrong_paths(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    clustered.write_clustered(readings.limit(0), path, "zone")
    assert clustered.read_within(spark, path, TELEMETRY, {"zone": ("A", "Z")}).count() == 0
    for columns in ((), ("nothing",)):
        with pytest.raises(ValueError):
            clustered.write_clustered(readings, path, *columns)
