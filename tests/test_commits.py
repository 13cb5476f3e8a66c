"""Loads that fail or are killed at any step, and readers beside them."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.schema import TELEMETRY
from fleetscope.sinks import commits, pointer, snapshots, storage, writers
from fleetscope.sources import events, readers
from tests.test_sources_and_sinks import same

COLUMNS = TELEMETRY.fieldNames()


class Killed(BaseException):
    """The process ends here: nothing after it runs but what Python unwinds."""


@pytest.fixture(scope="module")
def readings(spark, small):
    return events.telemetry(spark, small).select(*COLUMNS).cache()


def renames_failing(monkeypatch, *numbers, kind=OSError):
    """Make the renames of these numbers fail, counted from 1."""
    real, seen = storage.rename, []

    def rename(*args, **options):
        seen.append(args[1:3])
        if len(seen) in numbers:
            raise kind(f"rename {len(seen)}")
        return real(*args, **options)

    monkeypatch.setattr(storage, "rename", rename)
    return seen


def stays_dead(monkeypatch, number):
    """The load ends before its rename of this number; no step runs any more."""
    real, real_delete, seen = storage.rename, storage.delete, []

    def rename(*args, **options):
        if len(seen) >= number - 1:
            raise Killed
        seen.append(args)
        return real(*args, **options)

    def delete(*args):
        if len(seen) >= number - 1:
            raise Killed
        real_delete(*args)

    monkeypatch.setattr(storage, "rename", rename)
    monkeypatch.setattr(storage, "delete", delete)


# --- full replace
def swap_rename(spark, path, df, monkeypatch):
    """The number of the rename that puts the new table in its place."""
    with monkeypatch.context() as patch:
        seen = renames_failing(patch)
        writers.replace_table(df, path)
    return next(i for i, (_, target) in enumerate(seen, 1) if target == path)


def test_a_failing_swap_leaves_the_old_table(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.replace_table(readings, path)
    swap = swap_rename(spark, path, readings, monkeypatch)
    with monkeypatch.context() as patch, pytest.raises(OSError, match="rename"):
        renames_failing(patch, swap)
        writers.replace_table(readings.limit(3), path)
    same(spark.read.parquet(path), readings)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("after", [0, 1])
def test_a_killed_swap_loses_no_table(spark, readings, tmp_path, monkeypatch, after):
    path = str(tmp_path / "t")
    writers.replace_table(readings, path)
    swap = swap_rename(spark, path, readings, monkeypatch)
    with monkeypatch.context() as patch, pytest.raises(Killed):
        stays_dead(patch, swap + after)  # 0: the old table is aside; 1: both are in place
        writers.replace_table(readings.limit(3), path)
    held = readers.read_parquet(spark, path).count()
    assert held == (3 if after else 1000)  # one of the two, whole
    writers.replace_table(readings.limit(5), path)
    assert spark.read.parquet(path).count() == 5
    assert not [p for p in tmp_path.iterdir() if "replaced" in p.name]


# --- versions
def test_a_failing_pointer_leaves_the_old_version(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.publish(readings, path)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        real = storage.write_file

        def failing(spark, file, lines):
            if file.endswith(pointer.POINTER):
                raise OSError("no pointer")
            real(spark, file, lines)

        patch.setattr(storage, "write_file", failing)
        snapshots.publish(readings.limit(3), path)
    same(readers.read_parquet(spark, path), readings)
    assert len(storage.names(spark, f"{path}/{pointer.VERSIONS}")) == 1


def test_a_publication_killed_at_any_rename_leaves_a_whole_version(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.publish(readings, path)
    number, done = 1, False
    while not done:
        with monkeypatch.context() as patch:
            stays_dead(patch, number)
            try:
                snapshots.publish(readings.limit(7), path)
                done = True
            except Killed:
                assert readers.read_parquet(spark, path).count() in (1000, 7)
        number += 1
    assert number > 3 and readers.read_parquet(spark, path).count() == 7


def test_a_reader_keeps_its_version_while_others_publish(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    snapshots.publish(readings, path)
    reader = readers.read_parquet(spark, path)
    for rows in (10, 20):
        snapshots.publish(readings.limit(rows), path)
        same(reader, readings)
    assert readers.read_parquet(spark, path).count() == 20
    assert [v["rows"] for v in pointer.versions(spark, path)] == [1000, 10, 20]
    old = spark.read.schema(TELEMETRY).parquet(pointer.resolve(spark, path, 2))
    assert old.count() == 10
    with pytest.raises(ValueError, match="no version 9"):
        pointer.resolve(spark, path, 9)


def test_old_versions_go_after_the_grace_period(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    for rows in (10, 20, 30):
        snapshots.publish(readings.limit(rows), path, grace=timedelta(0))
    assert [v["number"] for v in pointer.versions(spark, path)] == [3]
    assert len(storage.names(spark, f"{path}/{pointer.VERSIONS}")) == 1


def test_two_publications_at_once_are_noticed(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.publish(readings, path)
    real = writers.replace_table

    def slower(df, place, fmt, **options):
        monkeypatch.setattr(writers, "replace_table", real)
        snapshots.publish(readings.limit(2), path)  # the other load is first
        return real(df, place, fmt, **options)

    monkeypatch.setattr(writers, "replace_table", slower)
    with pytest.raises(RuntimeError, match="meanwhile"):
        snapshots.publish(readings.limit(5), path)
    assert readers.read_parquet(spark, path).count() == 2


def test_kinds_of_tables_are_not_mixed(spark, readings, tmp_path):
    snapshots.publish(readings, str(tmp_path / "v"))
    for load in (writers.replace_table, writers.append_table, writers.replace_days):
        with pytest.raises(ValueError, match="versioned"):
            load(readings, str(tmp_path / "v"))
    writers.replace_table(readings, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="without versions"):
        snapshots.publish(readings, str(tmp_path / "t"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(str(tmp_path / "v"))  # not a mix of versions


# --- receipts
LOADS = {
    "replace": writers.replace_table,
    "append": writers.append_table,
    "days": lambda df, path: writers.replace_days(df, path, check=False),
}


@pytest.mark.parametrize("mode", LOADS)
def test_lost_rows_fail_a_load_into_a_table_with_rows(spark, readings, tmp_path, monkeypatch, mode):
    path = str(tmp_path / "t")
    LOADS[mode](readings, path)
    before = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    real = commits.file_rows

    def one_file_lost(spark, place, *args):
        lost = next((tmp_path / "t").parent.glob(f"{place.removeprefix(str(tmp_path) + '/')}/**/*.parquet"))
        lost.unlink()
        lost.with_name(f".{lost.name}.crc").unlink(missing_ok=True)
        return real(spark, place, *args)

    monkeypatch.setattr(commits, "file_rows", one_file_lost)
    with pytest.raises(RuntimeError, match="but stored"):
        LOADS[mode](readings.repartition(4), path)
    assert sorted(p.name for p in (tmp_path / "t").rglob("*.parquet")) == before
    assert not [n for n in storage.names(spark, path) if n.startswith(commits.STAGING)]


def test_an_append_counts_its_own_files_only(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.replace_table(readings, path)
    counted, real = [], commits.file_rows
    monkeypatch.setattr(
        commits, "file_rows", lambda spark, place, *args: counted.append(place) or real(spark, place, *args)
    )
    for times in (1, 2):
        receipt = writers.append_table(readings.limit(100), path)
        assert (receipt.written, receipt.stored) == (100, 1000 + 100 * times)
    assert len(counted) == 2 and all(commits.STAGING in place for place in counted)


def test_a_day_load_keeps_the_ledger_of_other_days(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    assert LOADS["days"](readings, path).stored == 1000
    day = readings.filter("day_index = 3")
    receipt = LOADS["days"](day.limit(4), path)
    assert (receipt.written, receipt.stored) == (4, 1000 - day.count() + 4)
    assert receipt.stored == readers.read_parquet(spark, path).count()
    ledger = json.loads(storage.read_file(spark, f"{path}/{commits.LEDGER}"))
    assert ledger["partitions"]["day_index=3"] == 4


def test_manifests_list_every_commit_s_files(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(readings.repartition(3), path)
    writers.append_table(readings.limit(10).repartition(2), path)
    found = commits.manifest(spark, path)
    stored = spark.read.parquet(path).groupBy("_metadata.file_name").count()
    listed = {r["file"]: r["rows"] for r in found.collect()}
    assert listed == {r[0]: r[1] for r in stored.collect()}
    assert found.select("commit").distinct().count() == 2


@pytest.mark.parametrize("fmt", writers.FORMATS)
def test_all_formats_are_counted(spark, readings, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writers.replace_table(readings.repartition(3), path, fmt)
    receipt = writers.append_table(readings.limit(9), path, fmt)
    assert (receipt.written, receipt.stored) == (9, 1009)


def test_a_table_without_a_ledger_is_counted_once(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    readings.write.parquet(path)
    assert writers.append_table(readings.limit(9), path).stored == 1009
    assert writers.append_table(readings.limit(9), path).stored == 1018


# --- several days
def test_days_killed_half_way_are_completed_by_the_next_load(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    LOADS["days"](readings, path)
    three = readings.filter("day_index IN (3, 4, 5)").withColumn("rssi", F.lit(-1))
    with monkeypatch.context() as patch:
        seen = renames_failing(patch)
        LOADS["days"](three, path)
    moves = [i for i, (_, to) in enumerate(seen, 1) if "day_index=" in str(to)]
    assert len(moves) == 6  # each old day aside, each new one in
    for number in moves:
        LOADS["days"](readings, path)
        with monkeypatch.context() as patch, pytest.raises(Killed):
            stays_dead(patch, number)
            LOADS["days"](three, path)
        assert commits.recover(spark, path)  # as the next load does first
        stored = readers.read_parquet(spark, path)
        assert stored.count() == 1000
        assert {r[0] for r in stored.filter("rssi = -1").select("day_index").distinct().collect()} == {3, 4, 5}
        assert [n for n in storage.names(spark, path) if n.startswith("_")] == [commits.COMMITS, commits.LEDGER]
        assert not commits.recover(spark, path)


def test_an_append_killed_half_way_is_completed_once(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.replace_table(readings, path)
    with monkeypatch.context() as patch:
        seen = renames_failing(patch)
        writers.append_table(readings.limit(50).repartition(3), path)
    moves = [i for i, (_, to) in enumerate(seen, 1) if str(to).endswith(".parquet")]
    with monkeypatch.context() as patch, pytest.raises(Killed):
        stays_dead(patch, moves[1])
        writers.append_table(readings.limit(50).repartition(3), path)
    receipt = writers.append_table(readings.limit(1), path)
    assert receipt.stored == 1101 == readers.read_parquet(spark, path).count()
