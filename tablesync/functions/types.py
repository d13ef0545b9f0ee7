"""The source-to-target type map and the typed literals built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# PostgreSQL type names and the Spark type each one lands as.
TYPE_MAP: dict[str, str] = {
    "integer": "int",
    "bigint": "bigint",
    "smallint": "smallint",
    "serial": "int",
    "bigserial": "bigint",
    "boolean": "boolean",
    "text": "string",
    "varchar": "string",
    "character varying": "string",
    "char": "string",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "numeric": "double",
    "decimal": "double",
    "double precision": "double",
    "real": "float",
    "json": "string",
    "jsonb": "string",
    "uuid": "string",
    "bytea": "string",
    "inet": "string",
    "USER-DEFINED": "string",
}

UUID_TYPES = ("uuid", "bytea")

# What a column of an untyped source (files, catalog tables) is called in the map.
SOURCE_NAME_OF_SPARK_TYPE: dict[str, str] = {
    "int": "integer",
    "bigint": "bigint",
    "smallint": "smallint",
    "tinyint": "smallint",
    "boolean": "boolean",
    "string": "text",
    "date": "date",
    "timestamp_ntz": "timestamp without time zone",
    "timestamp": "timestamp with time zone",
    "double": "double precision",
    "float": "real",
    "binary": "bytea",
}


def source_type(field: T.StructField) -> str:
    """The source type text of a field: its `src_type` metadata, else the name of its Spark type."""
    if "src_type" in field.metadata:
        return field.metadata["src_type"]
    if isinstance(field.dataType, T.DecimalType):
        return "numeric"
    if isinstance(field.dataType, T.ArrayType):
        return "ARRAY"
    name = field.dataType.simpleString()
    return SOURCE_NAME_OF_SPARK_TYPE.get(name, name)


def whole_type(low: int | None, high: int | None) -> str:
    """The narrowest source type of whole numbers that holds all from `low` to `high`; without numbers, the narrowest of all."""
    for name, bits in (("smallint", 15), ("integer", 31)):
        if low is None or high is None or (-(1 << bits) <= low and high < 1 << bits):
            return name
    return "bigint"


def type_map_table(spark: SparkSession) -> DataFrame:
    """The map as a table of (src_type, spark_type); its size is fixed."""
    return spark.createDataFrame(list(TYPE_MAP.items()), "src_type string, spark_type string")


def minimum_literal(data_type: T.DataType) -> Column:
    """Where a cursor of this type starts: the epoch for times, the least value otherwise."""
    name = data_type.simpleString()
    starts = {
        "tinyint": "-128",
        "smallint": "-32768",
        "int": "-2147483648",
        "bigint": "-9223372036854775808",
        "float": "-Infinity",
        "double": "-Infinity",
        "date": "1970-01-01",
        "timestamp": "1970-01-01 00:00:00+00:00",
        "timestamp_ntz": "1970-01-01 00:00:00",
        "string": "",
    }
    if isinstance(data_type, T.DecimalType):
        whole = "9" * (data_type.precision - data_type.scale) or "0"
        text = f"-{whole}.{'9' * data_type.scale}" if data_type.scale else f"-{whole}"
    elif name in starts:
        text = starts[name]
    else:
        raise ValueError(f"{name} cannot be a delta column")
    return F.lit(text).cast(data_type)


def cursor_to_text(value: Column, data_type: T.DataType) -> Column:
    """A cursor value as text that `cursor_literal` reads back without loss."""
    if isinstance(data_type, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return value.cast("string")


def cursor_literal(text: str, data_type: T.DataType) -> Column:
    """The typed literal of a stored cursor."""
    return F.lit(text).cast(data_type)
