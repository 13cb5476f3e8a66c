"""Parquet of other writers, and CSV files with malformed rows."""

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.plans import quarantine
from fleetscope.schema import TELEMETRY
from fleetscope.sinks import writers
from fleetscope.sources import events, readers, reconcile
from tests.test_plans import explained
from tests.test_sources_and_sinks import same


@pytest.fixture(scope="module")
def readings(spark, small):
    return events.telemetry(spark, small).select(*TELEMETRY.fieldNames()).cache()


def as_pandas(readings):
    frame = readings.withColumns({n: F.col(n).cast("string") for n in ("timestamp", "date")}).toPandas()
    wide = ("day_index", "rssi", "visible", "mov", "occ")
    return frame.astype(dict.fromkeys(wide, "int64"))


def test_the_parquet_of_an_untyped_writer_is_read(spark, readings, tmp_path):
    path = str(tmp_path / "t.parquet")
    as_pandas(readings).to_parquet(path, index=False)
    assert spark.read.parquet(path).schema["timestamp"].dataType == T.StringType()
    same(reconcile.read_any_parquet(spark, path), readings)


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_zoned_times_follow_the_named_zone_and_not_the_session_s(spark, tmp_path, session):
    wanted = [datetime(2024, 3, 31, 1, 30), datetime(2024, 10, 27, 1, 59, 59, 123456), datetime(2024, 7, 1), datetime(2024, 11, 3, 1, 30)]
    frame = pd.DataFrame({"timestamp": pd.to_datetime(wanted).tz_localize("Europe/Berlin")})
    frame.to_parquet(str(tmp_path / "t.parquet"), index=False, coerce_timestamps="us")
    schema = T.StructType([TELEMETRY["timestamp"]])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        found = reconcile.read_any_parquet(spark, str(tmp_path / "t.parquet"), schema, "Europe/Berlin")
        assert [r[0] for r in found.collect()] == wanted
        with pytest.raises(ValueError, match="name the zone"):
            reconcile.read_any_parquet(spark, str(tmp_path / "t.parquet"), schema)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "column, value, kind",
    [
        ("rssi", 1 << 40, "bigint"),
        ("rssi", 1.5, "double"),
        ("rssi", "n/a", "string"),
        ("timestamp", "yesterday", "string"),
        ("date", "2024-13-01", "string"),
    ],
)
def test_values_that_do_not_fit_fail(spark, readings, column, value, kind):
    broken = readings.withColumn(column, F.lit(value).cast(kind))
    for ansi in ("true", "false"):
        before = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match=f"{column}: can't be read"):
                reconcile.reconcile(broken).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)


def test_nulls_whole_doubles_and_flags_pass(spark, readings):
    other = readings.withColumns({
        "rssi": F.when(F.col("rssi") < 0, F.col("rssi").cast("double")), "mov": F.col("mov") == 1,
        "date": F.col("date").cast("timestamp_ntz"), "extra": F.lit(1),
    })
    found = reconcile.reconcile(other)
    assert found.schema.simpleString() == TELEMETRY.simpleString()
    same(found, readings.withColumn("rssi", F.when(F.col("rssi") < 0, F.col("rssi"))))


def test_what_has_no_rule_is_named(spark, readings):
    odd = readings.drop("zone").withColumn("mov", F.array(F.lit(1)))
    with pytest.raises(ValueError, match="zone is missing; mov is array<int>, not int"):
        reconcile.reconcile(odd)


def test_columns_that_agree_keep_their_pushdown(spark, readings, tmp_path, capsys):
    path = str(tmp_path / "t")
    readings.withColumn("rssi", F.col("rssi").cast("bigint")).write.parquet(path)
    found = reconcile.read_any_parquet(spark, path).filter("zone = 'WIP'").select("zone")
    assert "EqualTo(zone,WIP)" in explained(found, capsys)


# --- malformed rows
HEADER = ",".join(TELEMETRY.fieldNames())
GOOD = "2024-01-01 05:00:0{k},2024-01-01,1,FL_01,A1,Production,night,-60,1,1,1,online,active_work"


def csv(tmp_path, *rows):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return str(folder)


def test_malformed_rows_are_kept_apart(spark, tmp_path):
    bad = [GOOD.format(k=7).replace("-60", "n/a"), GOOD.format(k=8) + ",one,too,many", "short,row"]
    path = csv(tmp_path, GOOD.format(k=1), bad[0], GOOD.format(k=2), *bad[1:])
    outcome = quarantine.load_csv(spark, path, str(tmp_path / "t"), str(tmp_path / "r"), most=0.9)
    assert (outcome.receipt.stored, outcome.rejected) == (2, 3)
    stored = readers.read_parquet(spark, str(tmp_path / "t"))
    assert stored.filter("rssi IS NULL OR timestamp IS NULL").count() == 0
    kept = spark.read.parquet(outcome.rejects)
    assert sorted(r[quarantine.RECORD] for r in kept.collect()) == sorted(bad)
    assert all(r[quarantine.FILE].endswith("a.csv") for r in kept.collect())


def test_too_many_malformed_rows_leave_the_table(spark, readings, tmp_path):
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    writers.replace_table(readings, table)
    path = csv(tmp_path, GOOD.format(k=1), GOOD.format(k=2).replace("-60", "x"))
    with pytest.raises(ValueError, match="1 of 2 rows are malformed"):
        quarantine.load_csv(spark, path, table, rejects, most=0.4)
    same(readers.read_parquet(spark, table), readings)
    assert spark.read.parquet(rejects).count() == 1
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "r", "t"]


def test_a_clean_file_has_no_rejects(spark, tmp_path):
    path = csv(tmp_path, *(GOOD.format(k=k) for k in range(5)))
    outcome = quarantine.load_csv(spark, path, str(tmp_path / "t"), str(tmp_path / "r"))
    assert (outcome.receipt.stored, outcome.rejected) == (5, 0)
    assert spark.read.parquet(outcome.rejects).count() == 0
