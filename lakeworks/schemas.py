"""Table schemas that can be declared before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**columns: str) -> T.StructType:
    """Nullable columns by simple type name."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])
