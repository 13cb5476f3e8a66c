"""The one-pass rollup that the batch paths build every small result from.

Grouping by all categorical columns at once shrinks the facts, on the map side
already, to one row per observed combination. Counts, averages and rates of
any subset of these columns follow from it exactly, so a batch of results
costs one scan of the facts instead of one scan each.

``rows`` and ``mean_rssi`` let a query accept raw telemetry or the rollup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.predicates import hidden_with_signal
from fleetscope.schema import TELEMETRY

ROLLUP_KEYS = (
    "forklift_id",
    "zone",
    "shift",
    "status",
    "downtime_category",
    "visible",
    "mov",
    "occ",
)
_ROWS, _RSSI_SUM, _RSSI_ROWS = "rollup_rows", "rollup_rssi_sum", "rollup_rssi_rows"
_NULLS, _HIDDEN_SIGNALS = "rollup_nulls_", "rollup_hidden_signals"


def rollup(df: DataFrame, quality: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """The rollup; with ``quality`` also what a validation report needs, for
    which the remaining columns are scanned too. Rollups of parts, such as those
    ``by`` day, merge: their rows together are a rollup of the whole."""
    checks = []
    if quality:
        unkeyed = [name for name in TELEMETRY.fieldNames() if name not in ROLLUP_KEYS]
        checks = [nulls(df, name).alias(_NULLS + name) for name in unkeyed]
        checks.append(hidden_signals(df).alias(_HIDDEN_SIGNALS))
    return df.groupBy(*by, *ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias(_ROWS),
        F.sum(F.col("rssi").cast("bigint")).alias(_RSSI_SUM),
        F.count("rssi").alias(_RSSI_ROWS),
        *checks,
    )


def is_rollup(df: DataFrame) -> bool:
    return _ROWS in df.columns


def rows(df: DataFrame, where: Column | None = None) -> Column:
    """How many readings of ``df`` there are (that satisfy ``where``)."""
    if not is_rollup(df):
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    weight = F.col(_ROWS) if where is None else F.when(where, F.col(_ROWS))
    return F.coalesce(F.sum(weight), F.lit(0))


def nulls(df: DataFrame, name: str) -> Column:
    """How many readings of ``df`` lack a value of this column."""
    if is_rollup(df) and name not in ROLLUP_KEYS:
        return F.coalesce(F.sum(_NULLS + name), F.lit(0))
    return rows(df, F.col(name).isNull())


def hidden_signals(df: DataFrame) -> Column:
    """How many readings of ``df`` have a signal without being visible."""
    if is_rollup(df):
        return F.coalesce(F.sum(_HIDDEN_SIGNALS), F.lit(0))
    return rows(df, hidden_with_signal())


def mean_rssi(df: DataFrame) -> Column:
    if not is_rollup(df):
        return F.avg("rssi")
    return F.try_divide(F.sum(_RSSI_SUM), F.sum(_RSSI_ROWS))
