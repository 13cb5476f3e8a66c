"""Stored columns of other types, read as the wanted ones or not at all.

Other writers store timestamps as text or with a zone, flags as 64-bit numbers,
dates as timestamps. The stored schema is read from a footer and compared with
the wanted one; each column that differs gets a cast that fails on the first
value it can't represent, instead of turning it into NULL. Columns that agree are
left alone, so their filters still reach the scan.

A timestamp with a zone becomes the wall-clock time that its instant has in a
named zone, whatever zone the session has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.schema import TELEMETRY
from fleetscope.sinks.pointer import resolve

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT_TIMES = (T.TimestampNTZType, T.DateType)


def _fails(name: str, value: Column, cast: Column) -> Column:
    """``cast``, or an error where it has no value although ``value`` has one."""
    text = F.concat(F.lit(f"{name}: can't be read: "), value.cast("string"))
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(F.raise_error(text))


def _wall_clock(instant: Column, zone: str) -> Column:
    """By way of UTC, in which every wall-clock time is one instant."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(18,0)")).cast("decimal(18,6)")
    in_utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), in_utc)


def _convert(name: str, stored: T.DataType, wanted: T.DataType, zone: str | None) -> Column | None:
    """The wanted column, None if there is no rule for the two types."""
    value = F.col(f"`{name}`")
    if stored == wanted:
        return value
    kind = wanted.simpleString()
    if isinstance(wanted, T.StringType):
        return value.cast("string")
    if isinstance(stored, T.TimestampType) and isinstance(wanted, _TEXT_TIMES):
        if zone is None:
            raise ValueError(f"{name} is stored with a zone: name the zone of the wanted wall-clock times")
        at = _wall_clock(value, zone)
        return at if isinstance(wanted, T.TimestampNTZType) else F.to_date(at)
    if isinstance(stored, T.StringType):
        cast = F.expr(f"try_cast(trim(`{name}`) AS {kind})")
        return _fails(name, value, cast)
    if isinstance(stored, _WHOLE) and isinstance(wanted, _WHOLE):
        return _fails(name, value, F.expr(f"try_cast(`{name}` AS {kind})"))
    if isinstance(stored, (T.FloatType, T.DoubleType, T.DecimalType)) and isinstance(wanted, _WHOLE):
        # as other tools store whole numbers of which some are missing
        whole = F.expr(f"try_cast(`{name}` AS {kind})")
        return _fails(name, value, F.when(whole == value, whole))
    if isinstance(stored, T.BooleanType) and isinstance(wanted, _WHOLE):
        return value.cast(kind)
    if isinstance(stored, T.TimestampNTZType) and isinstance(wanted, T.DateType):
        midnight = value == F.to_date(value).cast("timestamp_ntz")
        return _fails(name, value, F.when(midnight, F.to_date(value)))
    return None


def reconcile(df: DataFrame, schema: T.StructType = TELEMETRY, zone: str | None = None) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order and types. Columns that
    are missing, or whose types have no rule, are named in one ValueError."""
    stored = {field.name: field.dataType for field in df.schema}
    columns, problems = [], []
    for field in schema:
        if field.name not in stored:
            problems.append(f"{field.name} is missing")
            continue
        column = _convert(field.name, stored[field.name], field.dataType, zone)
        if column is None:
            kinds = stored[field.name].simpleString(), field.dataType.simpleString()
            problems.append(f"{field.name} is {kinds[0]}, not {kinds[1]}")
        else:
            columns.append(column.alias(field.name))
    if problems:
        raise ValueError(f"Can't be read as wanted: {'; '.join(problems)}")
    return df.select(*columns)


def read_any_parquet(
    spark: SparkSession, path: str, schema: T.StructType = TELEMETRY, zone: str | None = None
) -> DataFrame:
    """Parquet of any writer as ``schema``; no value is lost unnoticed."""
    return reconcile(spark.read.parquet(resolve(spark, path)), schema, zone)
