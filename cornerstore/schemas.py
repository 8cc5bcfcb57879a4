"""Build schemas without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def kind(name: str) -> T.DataType:
    if name.startswith("decimal("):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _KINDS[name]


def schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, kind(of)) for name, of in fields.items()])
