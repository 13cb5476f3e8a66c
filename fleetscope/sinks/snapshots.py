"""Versioned tables: readers see one whole version, whatever a load does.

Each publication writes a version folder of its own, which is checked like any
load before anything refers to it. A small pointer file is then put in place by
one rename; readers resolve it once and go on reading the files they have found.
A load that dies at any point leaves the pointer, and so the table, as it was.
Versions that were superseded stay for a grace period, for readers that still
use them, and can be read by their number until then.

The folders' names begin with an underscore: a reader that does not resolve the
pointer finds no files and fails, instead of mixing versions.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from fleetscope.sinks import storage, writers
from fleetscope.sinks.pointer import POINTER, VERSIONS, versions

log = logging.getLogger(__name__)

GRACE = timedelta(days=1)


def publish(
    df: DataFrame, path: str, fmt: str = "parquet", grace: timedelta = GRACE, **options: object
) -> writers.Receipt:
    """Make ``df`` the table's next version. ``df`` may read the table.

    If another load has published meanwhile, this one fails and changes nothing."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = versions(spark, path)
    if not before and any(not n.startswith(("_", ".")) for n in storage.names(spark, path)):
        raise ValueError(f"{path} holds a table without versions")
    number = before[-1]["number"] + 1 if before else 1
    folder = f"{number}-{uuid.uuid4().hex}"
    place = f"{path}/{VERSIONS}/{folder}"
    receipt = writers.replace_table(df, place, fmt, **options)
    now = time.time()
    kept = [v | {"until": v.get("until", now)} for v in before]
    kept = [v for v in kept if now - v["until"] < grace.total_seconds()]
    if versions(spark, path) != before:
        storage.delete(spark, place)
        raise RuntimeError(f"{path}: another load has published a version meanwhile")
    after = [*kept, {"number": number, "folder": folder, "rows": receipt.stored}]
    try:
        storage.write_file(spark, f"{path}/{POINTER}", [json.dumps({"versions": after})])
    except BaseException:
        if versions(spark, path) == before:  # nobody refers to the new folder
            storage.delete(spark, place)
        raise
    _prune(spark, path, {v["folder"] for v in after}, grace)
    log.info("%s: version %d, %d rows", path, number, receipt.stored)
    return writers.Receipt(path, receipt.written, receipt.stored)


def _prune(spark: SparkSession, path: str, named: set[str], grace: timedelta) -> None:
    """Free versions that nothing refers to. What is younger than the grace
    period may be another load's, which is still being written."""
    for name in storage.names(spark, f"{path}/{VERSIONS}"):
        folder = f"{path}/{VERSIONS}/{name}"
        if name not in named and storage.age_seconds(spark, folder) >= grace.total_seconds():
            storage.delete(spark, folder)
