"""Readers, loads and layouts on real files."""

import json
from datetime import datetime
from types import SimpleNamespace

import duckdb
import pytest
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fleetscope.operators.rollup import rollup
from fleetscope.plans import reports, results, runs
from fleetscope.plans.measure import compare_formats
from fleetscope.schema import DOCUMENT, TELEMETRY, TELEMETRY_V1, require_columns, schema_tree
from fleetscope.sinks import layout, writers
from fleetscope.sources import events, readers
from tests.fixture import READINGS, explained, listed, rows

COLUMNS = TELEMETRY.fieldNames()


@pytest.fixture(scope="module")
def df(spark):
    return rows(spark).cache()


@pytest.fixture(scope="module")
def fit(spark):
    """Readings that pass validation, two days."""
    good = [r for r in READINGS if r[3] in ("FL_01", "FL_02") and r[-1] is not None]
    return rows(spark, good[:4] + good[5:6] + good[7:]).cache()


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def files(path, pattern="*.parquet"):
    return sorted(path.rglob(pattern))


# --- sources ----------------------------------------------------------------
def test_all_formats_give_the_same_rows(spark, df, tmp_path):
    writers.replace_table(df, str(tmp_path / "csv"), "csv")
    writers.replace_table(df, str(tmp_path / "parquet"))
    writers.replace_table(writers.keyed(df), str(tmp_path / "json"), "json")
    same(df, readers.read_csv(spark, str(tmp_path / "csv")))
    same(df, readers.read_parquet(spark, str(tmp_path / "parquet")))
    same(df, readers.read_documents(spark, str(tmp_path / "json")))
    with_key = readers.read_documents(spark, str(tmp_path / "json"), keep_key=True)
    assert with_key.schema == DOCUMENT
    assert with_key.filter("_id = 'FL_01_2026-04-01 06:00:00'").count() == 1


def test_plain_csv_of_either_version(spark, tmp_path):
    (tmp_path / "v1.csv").write_text(
        "timestamp,forklift_id,anchor,zone,shift,rssi,visible,mov,occ,status,downtime_category\n"
        "2026-04-01 00:00:00,FL_01,A1,Production,night,-60,1,1,1,online,active_work\n"
    )
    v1 = readers.read_csv(spark, str(tmp_path / "v1.csv"), TELEMETRY_V1)
    assert str(v1.first()["timestamp"]) == "2026-04-01 00:00:00"
    assert v1.first()["rssi"] == -60
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "v1.csv")).collect()


def test_plain_documents(spark, tmp_path):
    document = {"_id": "x", "timestamp": "2026-04-01 00:00:03", "date": "2026-04-01", "day_index": 1}
    (tmp_path / "d.json").write_text(json.dumps(document) + "\n")
    row = readers.read_documents(spark, str(tmp_path)).first()
    assert (str(row["timestamp"]), str(row["date"]), row["day_index"]) == (
        "2026-04-01 00:00:03", "2026-04-01", 1
    )
    assert row["zone"] is None


def test_absent_input_is_skipped(spark, tmp_path, caplog):
    with caplog.at_level("WARNING"):
        assert readers.read_if_present(readers.read_parquet, spark, str(tmp_path / "no")) is None
    assert "skipped" in caplog.text
    writers.replace_table(rows(spark), str(tmp_path / "yes"))
    assert readers.read_if_present(readers.read_parquet, spark, str(tmp_path / "yes")).count() == 12


def test_other_analysis_errors_are_not_swallowed(spark):
    def broken(spark, path):
        return spark.sql("SELECT nothing FROM range(1)")

    with pytest.raises(AnalysisException):
        readers.read_if_present(broken, spark, "anywhere")


def test_view_sample_and_schema(spark, df):
    readers.register_view(df)
    assert spark.sql("SELECT COUNT(*) FROM forklift_data").first()[0] == 12
    sample, names = readers.sample_document(df)
    assert sample.count() == 1 and names == COLUMNS
    assert readers.sample_rows(df).count() == 5
    assert "timestamp: timestamp_ntz" in schema_tree(df)


def test_missing_columns_are_named(df):
    with pytest.raises(ValueError, match=r"\['date', 'day_index'\]"):
        require_columns(df.drop("date", "day_index"))


# --- loads ------------------------------------------------------------------
def test_full_replace_and_append(spark, df, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        receipt = writers.replace_table(df, path)
        assert (receipt.written, receipt.stored) == (12, 12)
    receipt = writers.append_table(df, path)
    assert (receipt.written, receipt.stored) == (12, 24)
    same(df.unionAll(df), readers.read_parquet(spark, path))


@pytest.mark.parametrize("fmt", writers.FORMATS)
def test_empty_load_leaves_an_empty_table(spark, df, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writers.replace_table(df, path, fmt)
    receipt = writers.replace_table(rows(spark, []), path, fmt)
    assert (receipt.written, receipt.stored) == (0, 0)


def test_unknown_format(df, tmp_path):
    with pytest.raises(ValueError, match="Unknown format"):
        writers.replace_table(df, str(tmp_path), "xml")


def test_a_table_may_be_replaced_from_itself(spark, df, tmp_path):
    for spelled in ("t", "./t", "/t"):
        writers.replace_table(df, str(tmp_path / "t"))
        stored = spark.read.parquet(str(tmp_path / "t"))
        writers.replace_table(stored.limit(7), f"{tmp_path}/{spelled}")
        assert spark.read.parquet(str(tmp_path / "t")).count() == 7
        assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failing_replacement_leaves_the_old_table(spark, df, tmp_path):
    writers.replace_table(df, str(tmp_path / "t"))
    broken = df.withColumn("zone", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        writers.replace_table(broken, str(tmp_path / "t"))
    same(spark.read.parquet(str(tmp_path / "t")).select(*df.columns), df)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_days_are_replaced_and_others_stay(spark, fit, tmp_path):
    path = str(tmp_path / "days")
    first = writers.replace_days(fit, path)
    again = writers.replace_days(fit, path)
    assert first.written == again.written == again.stored == fit.count()

    second_day = fit.filter("day_index = 2").withColumn("rssi", F.lit(-1))
    untouched = files(tmp_path / "days" / "day_index=1")
    writers.replace_days(second_day, path)
    assert files(tmp_path / "days" / "day_index=1") == untouched
    stored = readers.read_parquet(spark, path)
    same(stored, fit.filter("day_index = 1").unionByName(second_day))
    keys = spark.read.schema(DOCUMENT).parquet(path).select("_id")
    assert keys.distinct().count() == keys.count()


def test_a_day_can_be_rewritten_from_its_own_table(spark, fit, tmp_path):
    path = str(tmp_path / "days")
    writers.replace_days(fit, path)
    mended = readers.read_parquet(spark, path).filter("day_index = 2").withColumn("rssi", F.lit(-1))
    writers.replace_days(mended, path)
    stored = readers.read_parquet(spark, path)
    assert stored.count() == fit.count()
    assert stored.filter("day_index = 2 AND rssi <> -1").isEmpty()


def test_invalid_days_replace_nothing(spark, fit, df, tmp_path):
    path = str(tmp_path / "days")
    writers.replace_days(fit, path)
    for bad, message in (
        (df, "null downtime_category"),
        (fit.unionAll(fit), "repeated record keys"),
        (rows(spark, []), "empty"),
    ):
        with pytest.raises(ValueError, match=message):
            writers.replace_days(bad, path)
        same(readers.read_parquet(spark, path), fit)


def test_small_results_become_one_sorted_file(df, tmp_path):
    from fleetscope.operators.counts import zone_counts

    writers.write_result_csv(zone_counts(df), str(tmp_path / "zones"))
    (part,) = files(tmp_path / "zones", "*.csv")
    assert part.read_text().splitlines()[:3] == ["zone,count", "WIP,4", "Charging,2"]


def test_file_size_option(df, tmp_path):
    writers.replace_table(df.coalesce(1), str(tmp_path / "t"), maxRecordsPerFile=5)
    assert len(files(tmp_path / "t")) == 3


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = writers.shared_folder(spark), writers.shared_folder(spark)
    assert first.startswith(root) and first != second


def test_scratch_tables_are_emptied(spark, small, tmp_path, monkeypatch):
    from fleetscope.plans import loads

    monkeypatch.setattr(writers, "shared_folder", lambda _: str(tmp_path))
    assert loads.slice_replace_load(events.telemetry(spark, small)).count() == 30
    assert spark.read.parquet(str(tmp_path / "telemetry")).count() == 0
    assert len(files(tmp_path / "sums")) == 1


def test_days_as_documents(spark, fit, tmp_path):
    path = str(tmp_path / "days")
    for _ in range(2):
        writers.replace_days(fit, path, "json")
    same(readers.read_documents(spark, path), fit)


def test_a_cluster_must_name_its_shared_folder():
    def session(master):
        conf = SimpleNamespace(get=lambda name, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.shared_folder(session("yarn"))
    assert "fleetscope-" in writers.shared_folder(session("local[2]"))


def test_result_threads_keep_the_job_group(spark, fit, tmp_path, monkeypatch):
    def noted(df, *_):
        return spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    monkeypatch.setattr(results, "replace_table", noted)
    spark.sparkContext.setJobGroup("nightly", "all results")
    try:
        seen = results.write_from_rollup(rollup(fit), str(tmp_path), ("zone_counts", "shift_counts"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == {"zone_counts": "nightly", "shift_counts": "nightly"}


def failing_once(df):
    """The same rows, but every task dies at its end on the first attempt."""

    def rows_then_death(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("executor lost")

    return df.mapInArrow(rows_then_death, df.schema)


@pytest.mark.parametrize(
    "load",
    [
        writers.replace_table,
        writers.append_table,
        lambda df, path: writers.replace_days(df, path, unique=False),
        layout.write_by_vehicle,
        layout.write_by_time,
    ],
)
def test_lost_tasks_neither_lose_nor_double_rows(spark, small, tmp_path, load):
    df = events.telemetry(spark, small).select(*COLUMNS).repartition(3)
    receipt = load(failing_once(df), str(tmp_path / "t"))
    assert receipt.written == receipt.stored == 1000
    same(df, spark.read.schema(TELEMETRY).parquet(str(tmp_path / "t")).select(*COLUMNS))


# --- skew and layout --------------------------------------------------------
@pytest.fixture
def tiny_partitions(spark):
    """Treat a few kilobytes as a full partition, so that small data is skewed."""
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def skewed(spark, sf_dir):
    """A third of all readings are copies of one; the rest are as they come."""
    plain = events.telemetry(spark, sf_dir).select(*COLUMNS).repartition(4)
    copies = (
        plain.limit(1)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5000))))
        .drop("copy")
        .repartition(4)
    )
    return plain.unionAll(copies)


def test_a_hot_day_is_split_over_files(spark, medium, tmp_path, tiny_partitions):
    df = skewed(spark, medium)
    hot = df.groupBy("day_index").count().orderBy(F.desc("count")).first()["day_index"]
    receipt = writers.replace_days(df, str(tmp_path / "days"), unique=False)
    assert receipt.stored == df.count()
    assert len(files(tmp_path / "days" / f"day_index={hot}")) > 1


def test_a_day_is_not_scattered_over_tasks(spark, medium, tmp_path):
    df = events.telemetry(spark, medium).select(*COLUMNS).repartition(8)
    writers.replace_days(df, str(tmp_path / "days"), unique=False)
    days = list((tmp_path / "days").glob("day_index=*"))
    assert len(days) == 30
    assert all(len(files(day)) == 1 for day in days)


def test_a_hot_shard_is_split_over_files(spark, medium, tmp_path, tiny_partitions):
    df = skewed(spark, medium)
    receipt = layout.write_by_vehicle(df, str(tmp_path / "v"))
    assert receipt.stored == df.count()
    for shard in (0, 1):
        assert len(files(tmp_path / "v" / "shards=2" / f"shard={shard}")) > 1


def test_a_hot_hour_is_split_over_files(spark, medium, tmp_path, tiny_partitions):
    df = skewed(spark, medium)
    hot = df.groupBy("date").count().orderBy(F.desc("count")).first()["date"]
    receipt = layout.write_by_time(df, str(tmp_path / "t"))
    assert receipt.stored == df.count()
    assert len(files(tmp_path / "t" / f"date={hot}")) > 1


def test_vehicles_keep_together(spark, medium, tmp_path):
    df = events.telemetry(spark, medium).select(*COLUMNS).repartition(8)
    layout.write_by_vehicle(df, str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    held = stored.select("forklift_id", F.input_file_name().alias("file")).distinct()
    per_vehicle = held.groupBy("forklift_id").agg(F.count("file").alias("n"))
    assert per_vehicle.agg(F.max("n")).first()[0] == 1


def test_ungathered_days(spark, fit, tmp_path):
    one_day = fit.filter("day_index = 2")
    receipt = writers.replace_days(one_day, str(tmp_path / "days"), gather=False)
    assert receipt.stored == one_day.count()


def test_a_hot_instant_is_split_over_ranges(spark, medium, tmp_path):
    df = skewed(spark, medium)
    receipt = layout.write_by_time(df, str(tmp_path / "t"), ranges=12)
    assert receipt.stored == df.count()
    largest = (
        spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().agg(F.max("count"))
    ).first()[0]
    assert largest < 5000 / 2


def test_time_ranges_do_not_overlap(spark, medium, tmp_path):
    df = events.telemetry(spark, medium).select(*COLUMNS)
    layout.write_by_time(df, str(tmp_path / "t"), ranges=6)
    spans = sorted(
        (row["low"], row["high"])
        for row in spark.read.parquet(str(tmp_path / "t"))
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
        .collect()
    )
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_a_vehicle_is_found_in_its_shard(spark, medium, tmp_path, capsys):
    df = events.telemetry(spark, medium).select(*COLUMNS)
    for shards in (2, 16):
        layout.write_by_vehicle(df, str(tmp_path / f"v{shards}"), shards=shards)
        stored = spark.read.parquet(str(tmp_path / f"v{shards}"))
        for vehicle in ("FL_01", "FL_07"):
            found = layout.of_vehicle(stored, vehicle)
            same(found.drop("shard", "shards"), df.filter(F.col("forklift_id") == vehicle))
            plan = explained(found, capsys)
            assert found.select("shard").distinct().count() == 1
            assert "PartitionFilters: [isnotnull(shard" in plan
            assert f"EqualTo(forklift_id,{vehicle})" in plan


def test_a_period_is_found_in_its_dates(spark, medium, tmp_path, capsys):
    df = events.telemetry(spark, medium).select(*COLUMNS)
    layout.write_by_time(df, str(tmp_path / "t"))
    stored = spark.read.schema(TELEMETRY).parquet(str(tmp_path / "t"))
    start, end = datetime(2024, 1, 5, 22, 30), datetime(2024, 1, 7, 6, 0)
    found = layout.within(stored, start, end)
    wanted = df.filter("timestamp >= '2024-01-05 22:30:00' AND timestamp < '2024-01-07 06:00:00'")
    same(found, wanted)
    assert wanted.count() > 100
    plan = explained(found, capsys)
    assert "(date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp,2024-01-05T22:30" in plan


def test_sorted_files(spark, medium, tmp_path):
    df = events.telemetry(spark, medium).select(*COLUMNS)
    layout.write_sorted(df, str(tmp_path / "s"), "zone", "shift")
    stored = readers.in_stored_order(spark.read.parquet(str(tmp_path / "s")))
    order = [tuple(row) for row in stored.select("zone", "shift").collect()]
    assert order == sorted(order)
    with pytest.raises(ValueError, match="access path"):
        layout.write_sorted(df, str(tmp_path / "s"), "rssi")


def test_bloom_filters_are_written(fit, tmp_path):
    writers.replace_days(fit, str(tmp_path / "days"), **layout.bloom_filters("_id"))
    found = duckdb.sql(
        f"SELECT path_in_schema, bloom_filter_offset FROM parquet_metadata('{tmp_path}/days/*/*.parquet')"
    ).fetchall()
    assert {column for column, offset in found if offset is not None} == {"_id"}


# --- batches and reports ----------------------------------------------------
def lines(path):
    return [line for part in files(path, "part-*.txt") for line in part.read_text().splitlines()]


@pytest.mark.parametrize("fmt", writers.FORMATS)
def test_result_tables_equal_the_single_queries(spark, small, tmp_path, fmt):
    df = events.telemetry(spark, small).select(*COLUMNS)
    receipts = results.write_results(df, str(tmp_path), results.RESULTS, fmt)
    assert set(receipts) == set(results.RESULTS)
    for name, query in results.RESULTS.items():
        stored = listed(results.read_result(spark, str(tmp_path), name, fmt))
        assert sorted(stored, key=str) == sorted(listed(query(df)), key=str), name


def test_history_grows(spark, fit, tmp_path):
    for run in (1, 2):
        for name, receipt in results.append_history(fit, str(tmp_path)).items():
            assert receipt.stored == run * receipt.written > 0, name
    assert len(results.HISTORY) == 3


def test_csv_results_are_published(spark, df, tmp_path, caplog):
    folder, target = str(tmp_path / "csv"), str(tmp_path / "collections")
    names = ("zone_counts", "predict_shift_risk")
    results.write_csv_results(df, folder, names)
    with caplog.at_level("WARNING"):
        receipts = results.publish_csv_results(spark, folder, target)
    assert set(receipts) == set(names)
    assert caplog.text.count("skipped") == len(results.COLLECTIONS) - len(names)
    for name in names:
        same(results.RESULTS[name](df), results.read_result(spark, target, name))
    again = results.publish_csv_results(spark, folder, target, names, append=True)
    assert all(r.stored == 2 * r.written for r in again.values())


def test_review(spark, fit, tmp_path):
    results.write_results(fit, str(tmp_path))
    review = {row["result"]: tuple(row)[1:] for row in results.review_results(spark, str(tmp_path)).collect()}
    assert len(review) == 9
    assert review["spark_sql_zone_shift_summary"][1] == 4
    first = results.preview_result(spark, str(tmp_path), "zone_counts").first()[0]
    assert set(json.loads(first)) == {"zone", "count"}


@pytest.mark.parametrize("fmt", writers.FORMATS)
def test_preview_follows_the_written_order(spark, tmp_path, fmt, monkeypatch):
    monkeypatch.setitem(results.RESULTS, "numbers", lambda df: spark.range(0).withColumn("n", F.lit("")))
    # later files are larger, so that a plain read would start with them
    sorted_rows = spark.range(0, 4000, 1, 1).withColumn("n", F.repeat(F.lit("x"), (F.col("id") / 100).cast("int")))
    sorted_rows.repartitionByRange(5, "id").sortWithinPartitions("id").write.format(fmt).option(
        "header", True
    ).save(str(tmp_path / "numbers"))
    assert len(files(tmp_path / "numbers", "part-*")) == 5
    shown = results.preview_result(spark, str(tmp_path), "numbers", fmt).collect()
    assert [json.loads(row["row"])["id"] for row in shown] == list(range(10))


def test_runs_end_to_end(spark, fit, tmp_path):
    target = str(tmp_path)
    receipt = runs.load(fit, target)
    assert receipt.written == receipt.stored == fit.count()
    stored = runs.prepare(readers.read_parquet(spark, f"{target}/telemetry"))
    assert spark.sql("SELECT COUNT(*) FROM forklift_data").first()[0] == fit.count()
    assert stored.columns == COLUMNS
    same(stored, fit)

    receipts = runs.analyse(stored, target)
    assert len(receipts) == len(results.RESULTS)
    runs.review(spark, target)

    summary = json.loads("".join(p.read_text() for p in files(tmp_path / "summary", "*.json")))
    assert summary["total_records"] == fit.count()
    assert summary["report_type"] == "mongodb_summary" and summary["generated_at"]
    assert set(summary["zone_counts"][0]) == {"_id", "count"}

    execution = lines(tmp_path / "execution_report")
    assert execution[0] == "=== EXECUTION REPORT ==="
    assert f"totals | records | {fit.count()}" in execution
    assert any(line.startswith("schema | line |  |-- timestamp") for line in execution)
    assert any(line.startswith("timing_seconds | write_results") for line in execution)

    load = lines(tmp_path / "load_report")
    assert f"load | written | {fit.count()}" in load
    assert [line for line in load if line.startswith("access_path")] == [
        "access_path | 1 | day_index",
        "access_path | 2 | timestamp",
    ]
    validation = lines(tmp_path / "validation_report")
    assert f"shape | rows | {fit.count()}" in validation
    assert "shape | columns | 13" in validation
    review = lines(tmp_path / "review_report")
    assert any(line.startswith("zone_counts | preview | {") for line in review)


def test_full_replace_run(spark, df, tmp_path):
    receipt = runs.load(df, str(tmp_path), by_day=False)
    assert receipt.stored == 12
    assert "missing_values | downtime_category | 1" in lines(tmp_path / "validation_report")


def test_cached_scope_releases(spark, df):
    with runs.cached(df.select("zone")) as kept:
        assert kept.is_cached and kept.count() == 12
    assert not kept.is_cached


def test_formats_are_compared_by_actions(spark, df, tmp_path):
    writers.replace_table(df, str(tmp_path / "c"), "csv")
    writers.replace_table(df, str(tmp_path / "p"))
    times = compare_formats(spark, str(tmp_path / "c"), str(tmp_path / "p"), 1)
    assert set(times) == {
        "csv_read_count", "csv_column_scan", "parquet_read_count", "parquet_column_scan"
    }
    assert all(t > 0 for t in times.values())


def test_execution_report_lists_outputs(df):
    report = listed(reports.execution_report(df, 12, {"step": 1.5}, ["a", "b"]))
    assert ("timing_seconds", "step", "1.5000") in report
    assert report[-2:] == [("output", "path", "a"), ("output", "path", "b")]
