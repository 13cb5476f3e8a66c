"""Cross tabulations. The columns are given, or those that the data hold: then
the facts are counted once, in long form, into a table of a few rows, which gives
both the labels and the cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import fixed_values as fixed
from fleetscope.operators.rates import composite_scores
from fleetscope.operators.rollup import rows
from fleetscope.sinks.storage import Scratch


MOST_COLUMNS = 1000  # of a cross tabulation; more labels make none that can be read


def with_observed(df: DataFrame, column: str, labels: Sequence[str]) -> list[str]:
    """The labels, then in order any others that the column holds."""
    found = df.filter(df[column].isNotNull() & ~df[column].isin(*labels)).select(column).distinct()
    others = sorted(row[0] for row in found.limit(MOST_COLUMNS + 1).collect())
    if len(others) > MOST_COLUMNS:
        raise ValueError(f"{column} holds more than {MOST_COLUMNS} labels: too many for columns")
    return [*labels, *others]


def _counted(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Readings per shift and status, stored: a rollup of few rows."""
    counts = df.groupBy("shift", "status").agg(rows(df).cast("bigint").alias("rollup_rows"))
    return scratch.save(counts)


def observed_crosstab(df: DataFrame, scratch: Scratch, normalized: bool = False) -> DataFrame:
    """Shift by status, with a column for every status that the data hold."""
    counts = _counted(df, scratch)
    statuses = with_observed(counts, "status", fixed.STATUSES)
    table = shift_status_crosstab_normalized if normalized else shift_status_crosstab
    return table(counts, statuses)


def observed_risk_matrix(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Composite risk as zone by shift, with every shift that the data hold."""
    scores = scratch.save(composite_scores(df))
    return _matrix(scores, with_observed(scores, "shift", fixed.SHIFTS))


def shift_status_crosstab(df: DataFrame, statuses: Sequence[str] = fixed.STATUSES) -> DataFrame:
    """Readings per shift and status; a pair that never occurs counts 0.

    Conditional counts need one shuffle where a pivot needs two."""
    cells = [rows(df, F.col("status") == status).alias(status) for status in statuses]
    return df.groupBy("shift").agg(*cells).orderBy("shift")


def shift_status_crosstab_normalized(
    df: DataFrame, statuses: Sequence[str] = fixed.STATUSES
) -> DataFrame:
    """The same as shares of the shift's readings that have any status."""
    known = rows(df, F.col("status").isNotNull())
    cells = [
        F.try_divide(rows(df, F.col("status") == status), known).alias(status)
        for status in statuses
    ]
    return df.groupBy("shift").agg(*cells).orderBy("shift")


def composite_risk_matrix(df: DataFrame, shifts: Sequence[str] = fixed.SHIFTS) -> DataFrame:
    """Composite risk score as zone by shift; NULL where a pair has no readings.

    Zone and shift are the keys of the scores, so a cell is a single score."""
    return _matrix(composite_scores(df), shifts)


def _matrix(scores: DataFrame, shifts: Sequence[str]) -> DataFrame:
    cells = [
        F.max(F.when(F.col("shift") == shift, F.col("risk_score"))).alias(shift) for shift in shifts
    ]
    return scores.groupBy("zone").agg(*cells).orderBy("zone")
