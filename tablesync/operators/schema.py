"""From source columns to target columns: type mapping, checks, casts and table definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named
from tablesync.functions.text import uuid_text, valid_identifier
from tablesync.functions.types import TYPE_MAP, UUID_TYPES, source_type, type_map_table


def map_types(columns: DataFrame) -> DataFrame:
    """Every catalog column with its target type; columns of unknown type are left out."""
    known = F.broadcast(type_map_table(columns.sparkSession))
    return columns.join(known, columns.data_type == known.src_type).drop("src_type")


def unsupported_columns(columns: DataFrame) -> DataFrame:
    """The catalog columns whose type is not in the map, each with its error."""
    known = F.broadcast(type_map_table(columns.sparkSession))
    unknown = columns.join(known, columns.data_type == known.src_type, "left_anti")
    message = F.format_string("unsupported column type %s for column %s", "data_type", "column_name")
    return unknown.withColumn("error", message)


def build_ddl(columns: DataFrame, specs: DataFrame, keys: DataFrame) -> DataFrame:
    """One `CREATE TABLE` text per table of a catalog, with its kind, key and version column.

    `specs` has `(table_schema, table_name, cdc_enabled, version_column)`, `keys` is the result of
    `primary_key_columns`. A table is versioned only when change capture is on and it has a version
    column; its key is the primary key, else all its columns. A table with a column of unknown type
    gives no row here: `unsupported_columns` reports it.

    The lists gathered per table hold its columns, of which PostgreSQL allows at most 1600.
    """
    table = ["table_schema", "table_name"]
    known = F.broadcast(type_map_table(columns.sparkSession))
    typed = columns.join(known, columns.data_type == known.src_type, "left")
    in_order = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name", "spark_type")))
    tables = typed.groupBy(*table).agg(
        in_order.alias("cols"), F.bool_and(F.col("spark_type").isNotNull()).alias("mapped")
    )
    key_in_order = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    primary = keys.groupBy(*table).agg(key_in_order["column_name"].alias("primary_key"))
    joined = tables.where("mapped").join(specs, table, "left").join(primary, table, "left")

    versioned = F.coalesce(F.col("cdc_enabled") & (F.col("version_column") != ""), F.lit(False))
    definitions = F.transform("cols", lambda c: F.concat_ws(" ", c["column_name"], F.upper(c["spark_type"])))
    key_columns = F.coalesce("primary_key", F.col("cols")["column_name"])
    return joined.select(
        *table,
        F.concat(
            F.lit("CREATE TABLE IF NOT EXISTS "),
            F.concat_ws(".", *table),
            F.lit(" ("),
            F.array_join(definitions, ", "),
            F.lit(") USING parquet"),
        ).alias("ddl"),
        F.when(versioned, "versioned").otherwise("append").alias("kind"),
        F.when(versioned, F.array_join(key_columns, ", ")).alias("key_columns"),
        F.when(versioned, F.col("version_column")).alias("version_column"),
    )


def invalid_names(columns: DataFrame) -> DataFrame:
    """Catalog rows whose table or column name is not a plain identifier."""
    return columns.where(~valid_identifier(F.col("table_name")) | ~valid_identifier(F.col("column_name")))


def target_type(field: T.StructField, numeric: str = "double") -> T.DataType:
    """The Spark type a source field lands as; raises for a type outside the map."""
    name = source_type(field)
    if name not in TYPE_MAP:
        raise ValueError(f"unsupported column type {name} for column {field.name}")
    if numeric == "decimal" and name in ("numeric", "decimal"):
        return field.dataType if isinstance(field.dataType, T.DecimalType) else T.DecimalType(38, 18)
    return T.DataType.fromDDL(TYPE_MAP[name])


@dataclass(frozen=True)
class Conformed:
    rows: DataFrame
    rejects: DataFrame


def conform(table: DataFrame, numeric: str = "double", precision: str = "microsecond") -> DataFrame:
    """The table with every column cast to its target type; a value that does not fit fails the job.

    `precision="second"` cuts times to whole seconds, `numeric="decimal"` keeps exact decimals.
    """
    _check_columns(table)
    return table.select(*[_cast(table, f, numeric, precision, strict=True).alias(f.name) for f in table.schema])


def conform_with(table: DataFrame, column: str, alias: str) -> DataFrame:
    """As `conform`, with one source column once more, uncast, under a name of its own."""
    _check_columns(table)
    cast = [_cast(table, f, "double", "microsecond", strict=True).alias(f.name) for f in table.schema]
    return table.select(*cast, named(column).alias(alias))


def conform_lenient(table: DataFrame, numeric: str = "double", precision: str = "microsecond") -> Conformed:
    """Like `conform`, with the rows that do not fit set aside in their source form."""
    _check_columns(table)
    cast = {f.name: _cast(table, f, numeric, precision, strict=False) for f in table.schema}
    bad = F.lit(False)
    for name, value in cast.items():
        bad = bad | (named(name).isNotNull() & value.isNull())
    rows = table.where(~bad).select(*[value.alias(name) for name, value in cast.items()])
    return Conformed(rows, table.where(bad))


def _check_columns(table: DataFrame) -> None:
    if not table.columns:
        raise ValueError("no valid columns to create table")


def _cast(table: DataFrame, field: T.StructField, numeric: str, precision: str, strict: bool) -> Column:
    value = named(field.name)
    target = target_type(field, numeric)
    if source_type(field) in UUID_TYPES and isinstance(field.dataType, T.BinaryType):
        text = uuid_text(value)
        if not strict:
            return text
        wrong = F.raise_error(F.format_string(f"column {field.name} holds %s bytes, not a uuid", F.octet_length(value)))
        return F.when(value.isNull() | text.isNotNull(), text).otherwise(wrong.cast("string"))
    if source_type(field) == "uuid":
        value = F.lower(value)
    result = value if field.dataType == target else value.try_cast(target)
    if strict and field.dataType != target:
        # Said here and not left to the session's ANSI setting, under which a misfit could become NULL.
        wrong = F.raise_error(F.format_string(f"column {field.name} holds a value that is no {target.simpleString()}"))
        result = F.when(value.isNull() | result.isNotNull(), result).otherwise(wrong.cast(target))
    if precision == "second" and isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        # date_trunc gives a zoned timestamp, so zone-less columns are cast back.
        result = F.date_trunc("second", result).cast(target)
    return result


def schema_diff(source: T.StructType, target: T.StructType) -> dict[str, list[str]]:
    """Columns added, missing and changed in `source` compared with an existing target."""
    wanted = {f.name: f.dataType for f in source}
    present = {f.name: f.dataType for f in target}
    return {
        "added": [name for name in wanted if name not in present],
        "missing": [name for name in present if name not in wanted],
        "changed": [name for name in wanted if name in present and wanted[name] != present[name]],
    }
