"""Catalog lookups as queries on `information_schema`-shaped tables.

The inputs are DataFrames, so the same operators serve a JDBC catalog, the tables of a Spark
catalog, or a catalog that was saved as files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.columns import named
from tablesync.functions.types import source_type

COLUMNS_SCHEMA = (
    "table_schema string, table_name string, column_name string, data_type string, ordinal_position int"
)


def list_tables(tables: DataFrame, schema: str = "public") -> DataFrame:
    """Base tables of one schema, by name."""
    found = tables.where((F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE"))
    return found.select("table_name").orderBy("table_name")


def describe_columns(columns: DataFrame, schema: str = "public", table: str | None = None) -> DataFrame:
    """Column names and source types in ordinal order, of one table or of every table of a schema."""
    found = columns.where(F.col("table_schema") == schema)
    if table is not None:
        found = found.where(F.col("table_name") == table)
    found = found.select("table_name", "column_name", "data_type", "ordinal_position")
    return found.orderBy("table_name", "ordinal_position")


def primary_key_columns(table_constraints: DataFrame, key_column_usage: DataFrame) -> DataFrame:
    """The primary-key columns of every table: `(table_schema, table_name, column_name, ordinal_position)`.

    Neither side has a size bound here, so the join strategy is left to runtime statistics.
    """
    primary = table_constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    usage = key_column_usage.select("constraint_name", "table_schema", "column_name", "ordinal_position")
    return primary.join(usage, ["constraint_name", "table_schema"]).select(
        "table_schema", "table_name", "column_name", "ordinal_position"
    )


def columns_of(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "public") -> DataFrame:
    """The columns catalog of a set of DataFrames; no data is read."""
    rows = [
        (schema, name, field.name, source_type(field), position)
        for name, table in tables.items()
        for position, field in enumerate(table.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def with_source_types(table: DataFrame, columns: DataFrame) -> DataFrame:
    """The table with each field marked by the source type its catalog names, for `conform` to map.

    `columns` is the catalog cut to this one table. A driver may have read a type as something near
    it, such as a uuid as text, so the catalog has the last word.
    """
    return mark_types(table, {r["column_name"]: r["data_type"] for r in columns.select("column_name", "data_type").collect()})


def mark_types(table: DataFrame, known: Mapping[str, str]) -> DataFrame:
    """The table with the source type of each field that is known."""
    return table.select(
        *[
            named(c).alias(c, metadata={"src_type": known[c]}) if c in known else named(c)
            for c in table.columns
        ]
    )


def session_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a Spark catalog database in the shape `list_tables` reads."""
    found = spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary"))
    return found.select(
        F.col("namespace").alias("table_schema"),
        F.col("tableName").alias("table_name"),
        F.lit("BASE TABLE").alias("table_type"),
    )


def table_counts(tables: dict[str, DataFrame], with_size: bool = False) -> DataFrame:
    """Row count of each table, by name; with `with_size` also the bytes of its files.

    Only file metadata is read, and both numbers come from one pass.
    """
    counted = []
    for name, table in tables.items():
        if with_size:
            files = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(
                F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
            )
            counts = [F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")]
            counts.append(F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"))
            row = files.agg(*counts)
        else:
            row = table.agg(F.count("*").alias("row_count"))
        counted.append(row.select(F.lit(name).alias("table_name"), *row.columns))
    result = counted[0]
    for row in counted[1:]:
        result = result.unionByName(row)
    return result.orderBy("table_name")
