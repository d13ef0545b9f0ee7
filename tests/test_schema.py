from datetime import datetime

import pytest
from helpers import rows_of
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import cursor_text, pretty_size, progress_percent, redact_url, uuid_text, valid_identifier
from tablesync.functions.types import TYPE_MAP
from tablesync.operators.schema import build_ddl, conform, conform_lenient, map_types, schema_diff, target_type, unsupported_columns
from tablesync.sources.catalog import (
    COLUMNS_SCHEMA,
    columns_of,
    list_tables,
    primary_key_columns,
    session_tables,
    table_counts,
    with_source_types,
)
from tablesync.sources.tables import (
    CatalogSource,
    FileSource,
    JdbcSource,
    block_slices,
    jdbc_catalog_conf,
    jdbc_sink_options,
)


def values(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def test_uuid_text(spark):
    whole = bytes(range(16))
    found = values(spark, [(whole,), (whole[:15],), (None,)], "b binary", uuid_text(F.col("b")))
    assert found == ["00010203-0405-0607-0809-0a0b0c0d0e0f", None, None]


def test_valid_identifier(spark):
    names = ["a_1", "s.t", "a-b", "a b", "", "a\n", "é", None]
    found = values(spark, [(n,) for n in names], "n string", valid_identifier(F.col("n")))
    assert found == [True, True, False, False, False, False, False, None]


@pytest.mark.parametrize(
    "url, shown",
    [
        ("p://u:s@h/d", "p://u:***@h/d"),
        ("p://u@h", "p://u@h"),
        ("p://u:a@b@h", "p://u:a@b@h"),
        ("p://a:b:c@h", "p://a:b:c@h"),
        ("p://q://u:s@h", "p://q://u:s@h"),
        ("u:s@h", "u:s@h"),
        ("p://:@h", "p://:***@h"),
        ("p://u:s@", "p://u:***@"),
        ("x:://u:p@h", "x:://u:***@h"),
        ("no login", "no login"),
    ],
)
def test_redact_url(spark, url, shown):
    assert values(spark, [(url,)], "u string", redact_url(F.col("u"))) == [shown]


def test_progress_percent(spark):
    rows = [(150, 100), (50, 200), (5, 0), (5, None), (None, 10)]
    found = values(spark, rows, "c bigint, t bigint", progress_percent(F.col("c"), F.col("t")))
    assert found == [100.0, 25.0, 0.0, 0.0, 0.0]


def test_pretty_size(spark):
    sizes = [0, 10239, 10240, 10485247, 10485760, 10**12, 10**15, 10**17]
    found = values(spark, [(s,) for s in sizes], "s bigint", pretty_size(F.col("s")))
    assert found == ["0 bytes", "10239 bytes", "10 kB", "10239 kB", "10 MB", "931 GB", "909 TB", "89 PB"]


def test_cursor_text(spark):
    times = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120000), datetime(2024, 1, 2, 3, 4, 0, 1)]
    found = values(spark, [(t,) for t in times], "t timestamp_ntz", cursor_text(F.col("t"), T.TimestampNTZType()))
    assert found == ["2024-01-02 03:04:05", "2024-01-02 03:04:05.12", "2024-01-02 03:04:00.000001"]
    assert values(spark, [(1.5,)], "d double", cursor_text(F.col("d"), T.DoubleType())) == ["1.500000"]
    assert values(spark, [(7,)], "d int", cursor_text(F.col("d"), T.IntegerType())) == ["7"]


def test_every_type_of_the_map_has_a_target():
    for name, spark_type in TYPE_MAP.items():
        field = T.StructField("c", T.StringType(), True, {"src_type": name})
        assert target_type(field) == T.DataType.fromDDL(spark_type)


@pytest.mark.parametrize("name", ["ARRAY", "character", "interval", "money"])
def test_types_outside_the_map_raise(spark, name):
    table = spark.range(1).select(F.col("id").alias("c", metadata={"src_type": name}))
    with pytest.raises(ValueError, match=f"unsupported column type {name} for column c"):
        conform(table)


def test_an_array_column_and_a_table_without_columns_raise(spark):
    with pytest.raises(ValueError, match="unsupported column type ARRAY for column a"):
        conform(spark.range(1).select(F.array("id").alias("a")))
    with pytest.raises(ValueError, match="no valid columns"):
        conform(spark.range(1).select())


def test_conform_casts_and_keeps_null(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    table = spark.createDataFrame([("7", 1.5, at, bytes(range(16))), (None, None, None, None)],
                                  "i string, r double, t timestamp_ntz, u binary")
    table = table.select(
        F.col("i").alias("i", metadata={"src_type": "smallint"}),
        F.col("r").cast("decimal(10,2)").alias("r"),
        "t",
        F.col("u").alias("u", metadata={"src_type": "uuid"}),
    )
    found = conform(table)
    assert found.schema.simpleString() == "struct<i:smallint,r:double,t:timestamp_ntz,u:string>"
    assert rows_of(found)[0] == (7, 1.5, at, "00010203-0405-0607-0809-0a0b0c0d0e0f")
    assert rows_of(found)[1] == (None, None, None, None)
    assert conform(table, numeric="decimal").schema["r"].dataType == T.DecimalType(10, 2)
    seconds = [r["t"] for r in conform(table, precision="second").collect()]
    assert seconds == [at.replace(microsecond=0), None]
    assert conform(table, precision="second").schema["t"].dataType == T.TimestampNTZType()


def test_bytes_that_are_no_uuid_fail_or_are_set_aside(spark):
    table = spark.createDataFrame([(1, bytes(16)), (2, bytes(15)), (3, None)], "id int, u binary")
    with pytest.raises(SparkRuntimeException, match="15 bytes, not a uuid"):
        conform(table).collect()
    parts = conform_lenient(table)
    assert rows_of(parts.rows, "id") == [(1,), (3,)]
    assert rows_of(parts.rejects, "id") == [(2,)]


def test_schema_diff():
    old = T.StructType.fromDDL("a int, b string, c double")
    new = T.StructType.fromDDL("a bigint, b string, d date")
    assert schema_diff(new, old) == {"added": ["d"], "missing": ["c"], "changed": ["a"]}


CATALOG = [
    ("public", "t", "a", "integer", 1),
    ("public", "t", "b", "text", 2),
    ("audit", "t", "x", "bigint", 1),
    ("public", "bad", "c", "ARRAY", 1),
    ("public", "bad", "d", "date", 2),
]


def test_type_map_and_unsupported(spark):
    columns = spark.createDataFrame(CATALOG, COLUMNS_SCHEMA)
    assert rows_of(map_types(columns), "table_name", "column_name", "spark_type") == [
        ("bad", "d", "date"), ("t", "a", "int"), ("t", "b", "string"), ("t", "x", "bigint")]
    assert rows_of(unsupported_columns(columns), "error") == [("unsupported column type ARRAY for column c",)]


def test_same_named_tables_of_two_schemas_do_not_mix(spark):
    columns = spark.createDataFrame(CATALOG, COLUMNS_SCHEMA)
    specs = spark.createDataFrame(
        [("public", "t", True, "b"), ("audit", "t", True, "")],
        "table_schema string, table_name string, cdc_enabled boolean, version_column string",
    )
    keys = spark.createDataFrame([("public", "t", "a", 1)],
                                 "table_schema string, table_name string, column_name string, ordinal_position int")
    assert rows_of(build_ddl(columns, specs, keys)) == [
        ("audit", "t", "CREATE TABLE IF NOT EXISTS audit.t (x BIGINT) USING parquet", "append", None, None),
        ("public", "t", "CREATE TABLE IF NOT EXISTS public.t (a INT, b STRING) USING parquet", "versioned", "a", "b"),
    ]
    no_key = keys.limit(0)
    assert ("versioned", "a, b") in rows_of(build_ddl(columns, specs, no_key), "kind", "key_columns")


def test_ddl_text_is_understood_by_spark(spark):
    columns = spark.createDataFrame([("tsdb", "made", "a", "integer", 1), ("tsdb", "made", "t", "timestamp", 2)], COLUMNS_SCHEMA)
    specs = spark.createDataFrame([], "table_schema string, table_name string, cdc_enabled boolean, version_column string")
    keys = spark.createDataFrame([], "table_schema string, table_name string, column_name string, ordinal_position int")
    spark.sql("CREATE DATABASE IF NOT EXISTS tsdb")
    for row in build_ddl(columns, specs, keys).collect():
        spark.sql(row["ddl"])
        spark.sql(row["ddl"])
    assert spark.table("tsdb.made").schema.simpleString() == "struct<a:int,t:timestamp_ntz>"
    assert ("made",) in rows_of(list_tables(session_tables(spark, "tsdb"), "tsdb"))
    source = CatalogSource(spark, "tsdb", {"made": ["a"]})
    assert source.table("made").columns == source.table("tsdb.made").columns == ["a", "t"]
    assert source.key("made") == ["a"]
    spark.sql("DROP TABLE tsdb.made")


def test_primary_key_columns_composite_in_order(spark):
    constraints = spark.createDataFrame(
        [("pk", "public", "t", "PRIMARY KEY"), ("pk", "audit", "t", "PRIMARY KEY"), ("u", "public", "t", "UNIQUE")],
        "constraint_name string, table_schema string, table_name string, constraint_type string",
    )
    usage = spark.createDataFrame(
        [("pk", "public", "b", 2), ("pk", "public", "a", 1), ("pk", "audit", "z", 1), ("u", "public", "c", 1)],
        "constraint_name string, table_schema string, column_name string, ordinal_position int",
    )
    found = primary_key_columns(constraints, usage).where("table_schema = 'public'").orderBy("ordinal_position")
    assert [r["column_name"] for r in found.collect()] == ["a", "b"]


def test_columns_of_and_counts_with_size(spark, folder):
    spark.range(100).write.parquet(folder)
    table = spark.read.parquet(folder)
    assert rows_of(columns_of(spark, {"t": table}), "column_name", "data_type") == [("id", "bigint")]
    row = table_counts({"t": table}, with_size=True).first()
    assert row["row_count"] == 100 and row["size_bytes"] > 0


def test_file_source_formats(spark, tmp_path):
    spark.range(3).selectExpr("id", "'x' AS s").write.json(str(tmp_path / "t.json"))
    spark.range(3).selectExpr("id", "'x' AS s").write.option("header", True).csv(str(tmp_path / "t.csv"))
    as_json = FileSource(spark, str(tmp_path), format="json", schemas={"t": "id bigint, s string"})
    as_csv = FileSource(spark, str(tmp_path), format="csv", options={"header": "true"}, schemas={"t": "id bigint, s string"})
    assert rows_of(as_json.table("t")) == rows_of(as_csv.table("t")) == [(0, "x"), (1, "x"), (2, "x")]


def test_jdbc_options(spark):
    source = JdbcSource(spark, "jdbc:postgresql://h/d", slice_column={"t": "id"}, slices=4, properties={"user": "u"})
    options = source.options("t")
    assert options["dbtable"] == "public.t" and options["user"] == "u" and options["preferTimestampNTZ"] == "true"
    assert "partitionColumn" not in options and source.options("audit.t")["dbtable"] == "audit.t"
    assert jdbc_sink_options("u", "t") == {"url": "u", "dbtable": "t", "batchsize": "500", "numPartitions": "4"}


def test_block_slices_cover_every_page_once():
    assert block_slices(0, 4) == ["ctid >= '(0,0)'::tid"]
    slices = block_slices(10, 4)
    assert slices[0] == "ctid >= '(0,0)'::tid AND ctid < '(3,0)'::tid"
    assert slices[-1] == "ctid >= '(9,0)'::tid" and len(slices) == 4


def test_jdbc_catalog_conf():
    conf = jdbc_catalog_conf("src", "jdbc:postgresql://h/d", user="u")
    assert conf["spark.sql.catalog.src.url"] == "jdbc:postgresql://h/d" and conf["spark.sql.catalog.src.user"] == "u"


def test_the_catalog_names_the_source_types(spark):
    table = spark.createDataFrame([("A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", 1, "x")], "u string, n int, s string")
    columns = spark.createDataFrame([("public", "t", "u", "uuid", 1), ("public", "t", "n", "smallint", 2)], COLUMNS_SCHEMA)
    found = conform(with_source_types(table, columns))
    assert found.schema.simpleString() == "struct<u:string,n:smallint,s:string>"
    assert found.first()["u"] == "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    assert "src_type" not in found.schema["n"].metadata
    money = spark.createDataFrame([("public", "t", "s", "money", 3)], COLUMNS_SCHEMA)
    with pytest.raises(ValueError, match="unsupported column type money for column s"):
        conform(with_source_types(table, money))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_value_that_does_not_fit_fails_under_any_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        table = spark.createDataFrame([("1",), ("x",)], "n string").select(
            F.col("n").alias("n", metadata={"src_type": "integer"})
        )
        with pytest.raises(SparkRuntimeException, match="column n holds a value that is no int"):
            conform(table).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
