"""Tables clustered along several columns, read by the files that can match.

Every column of the access path becomes a rank of a few bits, from approximate
quantiles over all rows; the bits of all columns, interleaved, order the rows
along a space-filling curve. Range partitioning by that order gives files that
are narrow in each of the columns, not in the first alone. A table of the least
and greatest value of every column in every file, made by a Spark job when the
load has ended, lets readers choose files before anything of them is opened.

Rows of one rank (a label that a third of all rows have) are spread over several
files by their input split. Rows without a value have the lowest rank. Files
that the table of ranges does not know, of a later append or where a load died
before it was made, are always read, so it never hides a row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.sinks import storage
from fleetscope.sinks.writers import Receipt, _load

RANGES = "_ranges"
BITS = 5  # of each column's rank
_PREFIX = 7  # bytes of a text that order it here: as many as a bigint takes
_ACCURACY = 2000


def _number(df: DataFrame, name: str) -> Column:
    """A bigint or double in the column's order."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        prefix = F.substring(F.rpad(F.hex(value.cast("binary")), 2 * _PREFIX, "0"), 1, 2 * _PREFIX)
        return F.conv(prefix, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        since = value - F.lit("1970-01-01").cast("timestamp_ntz")
        return F.extract(F.lit("DAY"), since) * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    raise ValueError(f"{name}: no order for {kind.simpleString()}")


def _curve(df: DataFrame, columns: tuple[str, ...], bits: int) -> Column:
    """The rows' places on the curve: the ranks' bits, highest first."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = {name: _number(df, name) for name in columns}
    found = df.agg(*(F.percentile_approx(n, shares, _ACCURACY).alias(name) for name, n in numbers.items())).first()
    ranks = []
    for name, number in numbers.items():
        borders = sorted(set(found[name] or []))
        above = [F.when(number >= border, 1).otherwise(0) for border in borders]
        ranks.append(sum(above[1:], above[0]) if above else F.lit(0))
    place = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = place * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return place


def write_clustered(
    df: DataFrame, path: str, *columns: str, files: int | None = None, bits: int = BITS, **options: object
) -> Receipt:
    """Replace the table by ``df``, clustered along ``columns``, any of its own
    that have an order. Costs a pass for the quantiles and one to sample ranges."""
    if not columns or bits * len(columns) > 62:
        raise ValueError(f"One to {62 // bits} columns, not {len(columns)}")
    if unknown := set(columns) - set(df.columns):
        raise ValueError(f"Not in the table: {sorted(unknown)}")
    placed = df.withColumns({"_place": _curve(df, columns, bits), "_split": F.spark_partition_id()})
    count = (files,) if files else ()
    ranged = placed.repartitionByRange(*count, "_place", "_split").sortWithinPartitions("_place", *columns)
    receipt = _load(ranged.drop("_place", "_split"), path, "parquet", "overwrite", options=options)
    _store_ranges(df.sparkSession, path.rstrip("/"), df.schema, columns)
    return receipt


def _store_ranges(spark: SparkSession, path: str, schema: T.StructType, columns: tuple[str, ...]) -> None:
    each = [F.struct(F.min(c).alias("least"), F.max(c).alias("most")).alias(c) for c in columns]
    stored = spark.read.schema(schema).parquet(path)
    ranges = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(*each)
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")


def files_within(spark: SparkSession, path: str, bounds: Mapping[str, tuple[object, object]]) -> list[str]:
    """The files that may hold rows with ``least <= column <= most`` for all of
    ``bounds``; a bound may be None."""
    path = path.rstrip("/")
    every = [n for n in storage.names(spark, path) if not n.startswith(("_", "."))]
    if not storage.exists(spark, f"{path}/{RANGES}"):
        return every
    ranges = spark.read.parquet(f"{path}/{RANGES}")
    apart = F.lit(False)
    for name, (least, most) in bounds.items():
        if name not in ranges.columns:
            continue
        held = F.col(name)
        none_left = held["least"].isNull()  # the file has no value of this column
        below = F.lit(False) if least is None else held["most"] < F.lit(least)
        above = F.lit(False) if most is None else held["least"] > F.lit(most)
        apart = apart | none_left | below | above
    ruled_out = {row["file"] for row in ranges.filter(apart).select("file").toLocalIterator()}
    return [name for name in every if name not in ruled_out]


def read_within(
    spark: SparkSession, path: str, schema: T.StructType, bounds: Mapping[str, tuple[object, object]]
) -> DataFrame:
    """Rows of a clustered table with ``least <= column <= most`` for all bounds."""
    path = path.rstrip("/")
    files = [f"{path}/{name}" for name in files_within(spark, path, bounds)]
    found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for name, (least, most) in bounds.items():
        if least is not None:
            found = found.filter(F.col(name) >= F.lit(least))
        if most is not None:
            found = found.filter(F.col(name) <= F.lit(most))
    return found
