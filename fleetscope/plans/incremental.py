"""A rollup that is kept up to date day by day.

Rollups merge by putting their rows together, so the table's is kept as one part
per day. After a load only the days whose last commit is not the one their part
was made from are read again: those of this load, and those of any load that
changed the table without refreshing the rollup. Summary and validation report
are made from the parts, whose size depends on labels and days alone.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators.rollup import rollup
from fleetscope.sinks import commits, storage, writers

BASIS = "_basis"  # the commit of every day that its part was made from
DAY = "day_index"


def _day(folder: str) -> int:
    return int(folder.split("/")[0].removeprefix(f"{DAY}="))


def outdated_days(spark: SparkSession, table: str, path: str) -> tuple[list[int], bool]:
    """Days whose parts are to be made anew, and whether that is all of them."""
    ledger = json.loads(storage.read_file(spark, f"{table}/{commits.LEDGER}"))
    basis = json.loads(storage.read_file(spark, f"{path}/{BASIS}") or "{}")
    changed = ledger["changed"]
    if not basis or basis.keys() - ledger["partitions"].keys():
        return sorted({_day(folder) for folder in ledger["partitions"]}), True
    stale = {f for f in ledger["partitions"] if changed.get(f) is None or changed[f] != basis.get(f)}
    return sorted({_day(folder) for folder in stale}), False


def refresh(stored: DataFrame, table: str, path: str) -> DataFrame:
    """The rollup, with quality, of the table ``stored`` at ``table``, kept by
    day at ``path``. Reads the days that have changed since the last refresh."""
    spark = stored.sparkSession
    ledger = storage.read_file(spark, f"{table}/{commits.LEDGER}")
    days, every = outdated_days(spark, table, path)
    if days or every:
        some = stored if every else stored.filter(F.col(DAY).isin(days))
        parts = rollup(some, quality=True, by=(DAY,)).hint("rebalance", DAY)
        writers.replace_parts(parts, path, DAY, whole=every)
        storage.write_file(spark, f"{path}/{BASIS}", [json.dumps(json.loads(ledger)["changed"])])
    return spark.read.parquet(path).drop(DAY)
