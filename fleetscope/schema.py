"""Explicit schemas: no reader in this package runs an inference pass.

Timestamps carry no zone. The readings are wall-clock times of a plant, so an
hour or a date must not move with the session's time zone.
"""

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name, kind in pairs]


_TIME = _fields(("timestamp", T.TimestampNTZType()))
_DAY = _fields(("date", T.DateType()), ("day_index", T.IntegerType()))
_READING = _fields(
    ("forklift_id", T.StringType()),
    ("anchor", T.StringType()),
    ("zone", T.StringType()),
    ("shift", T.StringType()),
    ("rssi", T.IntegerType()),
    ("visible", T.IntegerType()),
    ("mov", T.IntegerType()),
    ("occ", T.IntegerType()),
    ("status", T.StringType()),
    ("downtime_category", T.StringType()),
)

TELEMETRY_V1 = T.StructType(_TIME + _READING)
TELEMETRY = T.StructType(_TIME + _DAY + _READING)
DOCUMENT = T.StructType(_fields(("_id", T.StringType())) + TELEMETRY.fields)

REPORT = T.StructType(
    _fields(
        ("section", T.StringType()),
        ("metric", T.StringType()),
        ("value", T.StringType()),
    )
)


def schema_tree(df: DataFrame) -> str:
    """The printable schema tree of ``df``."""
    return df.schema.treeString()


def require_columns(df: DataFrame, required: T.StructType = TELEMETRY) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks. Runs no job."""
    missing = [name for name in required.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df
