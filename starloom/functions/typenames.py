"""Type names as users of data frames write them, mapped to Spark's."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted names of column types and the Spark type they stand for.
ALIASES = {
    "int": "bigint",
    "int8": "bigint",
    "int64": "bigint",
    "long": "bigint",
    "bigint": "bigint",
    "int32": "int",
    "float": "double",
    "float64": "double",
    "double": "double",
    "str": "string",
    "object": "string",
    "string": "string",
    "bool": "boolean",
    "boolean": "boolean",
    "timestamp": "timestamp_ntz",
    "datetime64[ns]": "timestamp_ntz",
}


def spark_name(name: str) -> str:
    """Spark's simple name of a type; unknown names are passed on unchanged."""
    return ALIASES.get(name, name)


def name_of(dtype: T.DataType) -> str:
    return dtype.simpleString()


_SPARK_TYPES = {
    t.simpleString(): t
    for t in (
        T.LongType(),
        T.IntegerType(),
        T.DoubleType(),
        T.StringType(),
        T.BooleanType(),
        T.TimestampNTZType(),
    )
}


def type_of(name: str) -> T.DataType:
    """The Spark type of an accepted name."""
    found = _SPARK_TYPES.get(spark_name(name))
    if found is None:
        raise ValueError(f"unknown type {name!r}, expected one of {sorted(_SPARK_TYPES)}")
    return found


def struct(**fields: str | T.DataType) -> T.StructType:
    """Schema from names and types; needs no running session."""
    return T.StructType(
        [T.StructField(n, t if isinstance(t, T.DataType) else type_of(t)) for n, t in fields.items()]
    )
