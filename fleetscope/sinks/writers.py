"""Loads: full replace, append, and replacement of whole days.

Writes are ordinary distributed file writes: a task that is lost runs again
and the commit makes its output count once. Rows written are counted by an
observation inside the write, and compared with the rows that the load's own
files hold; see ``commits``.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import derive
from fleetscope.operators.quality import validate
from fleetscope.sinks import commits, pointer, storage

log = logging.getLogger(__name__)

FORMATS = ("parquet", "json", "csv")
# text formats would otherwise cut timestamps to milliseconds
_MICROSECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Receipt:
    """What a load wrote, and what its target holds afterwards."""

    path: str
    written: int
    stored: int


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return storage.shared_folder(spark)


def _load(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str,
    partition_by: tuple[str, ...] = (),
    options: dict[str, object] | None = None,
    verify: Callable[[], None] | None = None,
) -> Receipt:
    """``mode``: overwrite (the whole table), append, or days (whole partitions).
    ``verify`` is asked when all is staged; if it raises, nothing has changed."""
    if fmt not in FORMATS:
        raise ValueError(f"Unknown format: {fmt}")
    spark = df.sparkSession
    path = path.rstrip("/")
    if pointer.versions(spark, path):
        raise ValueError(f"{path} is versioned: publish a snapshot instead")
    commits.recover(spark, path)
    # a full replace is written beside its target and takes its place when whole:
    # a failing one leaves the old table as it was, and may read it
    whole = mode == "overwrite"
    place = f"{path}-staging-{uuid.uuid4().hex}" if whole else commits.staging_folder(path)
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt in ("csv", "json"):
        writer = writer.option("timestampNTZFormat", _MICROSECONDS)
    try:
        writer.options(**options or {}).partitionBy(*partition_by).save(place)
        manifest = f"{place}/{commits.COMMITS}/{uuid.uuid4().hex}"
        added = commits.file_rows(spark, place, fmt, df.schema, manifest)
        if added.rows != written.get["rows"]:
            raise RuntimeError(f"{path}: wrote {written.get['rows']} rows, but stored {added.rows}")
        if verify is not None:
            verify()
        if whole:
            storage.write_file(spark, f"{place}/{commits.LEDGER}", [added.text()])
    except BaseException:
        storage.delete(spark, place)
        raise
    # from here on nothing that was staged is deleted but by the swap itself
    if whole:
        try:
            storage.replace(spark, place, path)
        except BaseException:
            if storage.exists(spark, path):  # the old table is back
                storage.delete(spark, place)
            raise
        stored = added
    else:
        try:
            stored = commits.commit(spark, path, place, added, fmt, df.schema, mode == "days")
        except BaseException:
            if not storage.exists(spark, f"{path}/{commits.JOURNAL}"):  # nothing was moved
                storage.delete(spark, place)
            raise
    receipt = Receipt(path, added.rows, stored.rows)
    log.info("%s: wrote %d rows, holds %d", path, receipt.written, receipt.stored)
    return receipt


def replace_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    verify: Callable[[], None] | None = None,
    **options: object,
) -> Receipt:
    """Full replace. No rows leave an empty table behind, not an error. ``df``
    may read the target: the old table goes when the new one is whole."""
    return _load(df, path, fmt, "overwrite", options=options, verify=verify)


def append_table(df: DataFrame, path: str, fmt: str = "parquet", **options: object) -> Receipt:
    """Plain append: running it twice stores the rows twice."""
    return _load(df, path, fmt, "append", options=options)


def replace_parts(
    df: DataFrame, path: str, by: str, whole: bool = False, **options: object
) -> Receipt:
    """Replace the parts (partitions ``by`` a column) that occur in ``df``, or
    with ``whole`` the table."""
    return _load(df, path, "parquet", "overwrite" if whole else "days", (by,), options)


def empty_table(spark: SparkSession, path: str) -> None:
    """Free what a scratch table holds; an empty table stays behind."""
    spark.range(0).write.mode("overwrite").parquet(path)


def write_result_csv(df: DataFrame, path: str) -> Receipt:
    """A sorted result as CSV with a header. Part files follow the sort order;
    small results end up in a single file because small partitions are merged."""
    return replace_table(df, path, "csv")


def keyed(df: DataFrame) -> DataFrame:
    """Telemetry as documents: ``_id`` first."""
    key = derive.record_key(F.col("forklift_id"), F.col("timestamp"))
    return df.select(key.alias("_id"), *df.columns)


def replace_days(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    check: bool = True,
    unique: bool = True,
    gather: bool = True,
    sort_by: tuple[str, ...] = ("timestamp",),
    **options: object,
) -> Receipt:
    """Replace the days that occur in ``df``; other days stay. Repeating the
    load stores nothing twice.

    Rows are gathered by day, so a day is a few files and not one per task; a
    day far larger than the rest is split over several tasks. Input whose tasks
    hold few days each, such as one day's delivery, can save this shuffle with
    ``gather=False``. ``check`` refuses invalid telemetry and ``unique`` repeated
    keys, before anything is replaced.
    """
    if check:
        validate(df, unique)
    documents = keyed(df)
    gathered = documents.hint("rebalance", "day_index") if gather else documents
    arranged = gathered.sortWithinPartitions("day_index", *sort_by)
    return _load(
        arranged,
        path,
        fmt,
        "days",
        ("day_index",),
        options,
    )
