"""Balanced slices, database targets, incremental layouts, and progress while a copy runs."""

import glob
import os
import random
import re
from datetime import datetime, timedelta

import duckdb
import pytest
from helpers import DATA, rows_of
from pyspark.sql import functions as F

from tablesync.plans import ingest, progress
from tablesync.plans.ingest import RunLog, Target, ingest_table
from tablesync.plans.spec import Polling, TableSpec
from tablesync.sinks import database
from tablesync.sinks.database import DatabaseTable, DatabaseTarget
from tablesync.sinks.layout import DeltaLayout
from tablesync.sources.slices import ColumnStatistics, balanced_slices, statistics_of, statistics_query
from tablesync.sources.tables import CatalogSource, FileSource, JdbcSource
from tablesync.streaming.cdc import poll_once


def slices_hold(values, predicates):
    """How many rows each predicate holds, tried on an embedded engine with a stand-in for the row's place."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (c VARCHAR, row BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(v, i) for i, v in enumerate(values)])
    held = [set(r[0] for r in con.execute(f"SELECT row FROM t WHERE {p}").fetchall()) for p in predicates]
    assert sum(map(len, held)) == len(values) and set().union(*held) == set(range(len(values)))
    return [len(h) for h in held]


def test_slices_are_even_whole_and_disjoint():
    rng = random.Random(1)
    values = ["hot's"] * 4000 + [None] * 2000 + [f"v{rng.randint(0, 10**6):07}" for _ in range(6000)] + ["warm"] * 100
    rest = sorted(v for v in values if v not in (None, "hot's", "warm"))
    quantiles = [rest[min(len(rest) - 1, i * len(rest) // 100)] for i in range(101)]
    known = ColumnStatistics(quantiles, [("hot's", 4000 / len(values)), ("warm", 100 / len(values))], 2000 / len(values))
    sizes = slices_hold(values, balanced_slices("c", known, 12, "row"))
    assert 10 <= len(sizes) <= 14 and max(sizes) < 1.3 * len(values) / 12


@pytest.mark.parametrize("known", [ColumnStatistics(), ColumnStatistics(["a", "m", "z"]), ColumnStatistics(["a"] * 5, [("a", 1.0)]), ColumnStatistics((), [("q", 0.9)], 0.5)])
@pytest.mark.parametrize("slices", [1, 2, 7])
def test_slices_hold_every_row_once_whatever_the_statistics_say(known, slices):
    slices_hold(["a", "b", None, "m", "mm", "z", "zz", "q", "", "a"], balanced_slices("c", known, slices, "row"))


def test_statistics_are_asked_for_by_one_query():
    text = statistics_query("public", "it's", "d")
    assert "tablename = 'it''s'" in text and text.count("FROM pg_stats") == 3 and "FROM public" not in text
    known = statistics_of([("quantile", "b", None, 2), ("null", None, 0.25, 0), ("quantile", "a", None, 1), ("frequent", "x", 0.5, 1)])
    assert known == ColumnStatistics(["a", "b"], [("x", 0.5)], 0.25)


class CountingJdbc(JdbcSource):
    """A source whose reads are noted and answered from here."""

    def _read(self, options):
        asked.append(options["dbtable"])
        spark = self.spark
        if "information_schema.columns" in options["dbtable"]:
            return spark.createDataFrame([("public", "t", "k", "integer", 1), ("public", "t", "d", "integer", 2)], "table_schema string, table_name string, column_name string, data_type string, ordinal_position int")
        return spark.createDataFrame([(1, 1)], "k int, d int")


asked: list[str] = []


def test_polls_ask_no_catalog(spark):
    asked.clear()
    source = CountingJdbc(spark, "jdbc:x")
    source.table("t")
    first = len(asked)
    for _ in range(3):
        assert source.polled("t").schema["k"].metadata == {"src_type": "integer"}
    assert asked[first:] == ["public.t"] * 3


@pytest.fixture
def catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS information_schema")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    tables = {
        "information_schema.columns": ([("shop", "t", "k", "integer"), ("shop", "t", "d", "integer"), ("shop", "t", "u", "uuid")], "table_schema string, table_name string, column_name string, data_type string"),
        "information_schema.table_constraints": ([("pk", "shop", "t", "PRIMARY KEY"), ("u", "shop", "bare", "UNIQUE")], "constraint_name string, table_schema string, table_name string, constraint_type string"),
        "information_schema.key_column_usage": ([("pk", "shop", "t", "k", 1)], "constraint_name string, table_schema string, table_name string, column_name string, ordinal_position int"),
        "shop.t": ([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "k int, d int, u string"),
        "shop.bare": ([(1, 1)], "k int, d int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").saveAsTable(name)
    yield CatalogSource(spark, "shop", lookup=True)
    for name in tables:
        spark.sql(f"DROP TABLE {name}")


def test_a_catalog_tells_keys_and_types_and_is_polled(spark, catalog, folder):
    assert catalog.key("t") == ["k"] and catalog.table("t").schema["u"].metadata == {"src_type": "uuid"}
    target, spec = Target(spark, folder), TableSpec("t", polling=Polling(True, "d", 5))
    assert ingest_table(catalog, spec, target, RunLog("j")).success
    spark.createDataFrame([(2, 9, "x")], "k int, d int, u string").write.insertInto("shop.t")
    log = target.version_log("t", ingest.conform(catalog.table("t")).schema, catalog.key("t"), "d")
    assert poll_once(catalog.table("t"), log).rows == 1
    assert rows_of(log.current(), "k", "d") == [(1, 1), (2, 9), (3, 3)]


def test_a_missing_key_is_an_error_unless_all_columns_are_meant(spark, catalog, folder):
    polling = Polling(True, "d", 5)
    failed = ingest_table(catalog, TableSpec("bare", polling=polling), Target(spark, folder), RunLog("j"))
    assert not failed.success and "no primary key of bare" in failed.error
    assert ingest_table(catalog, TableSpec("bare", polling=polling, key=()), Target(spark, folder), RunLog("j")).success
    assert ingest_table(CatalogSource(spark, "shop", {"bare": ["k"]}, True), TableSpec("bare", polling=polling), Target(spark, f"{folder}2"), RunLog("j")).success


def test_statements_of_a_staged_batch(spark):
    texts = database.merge_statement("public.t", ["k", "a.b"], 7, "done")
    assert texts.startswith('WITH noted AS (INSERT INTO "done" (table_name, batch_id) VALUES (\'public.t\', 7) ON CONFLICT DO NOTHING RETURNING batch_id)')
    assert 'INSERT INTO "public"."t" ("k", "a.b") SELECT "k", "a.b" FROM (SELECT DISTINCT ON (_part, _place) * FROM "public"."t__stage" WHERE _batch_id = 7 AND EXISTS (SELECT 1 FROM noted)' in texts
    assert database.clear_statement("t", 7) == 'DELETE FROM "t__stage" WHERE _batch_id = 7'
    assert "PRIMARY KEY (table_name, batch_id)" in database.ledger_ddl("done") and "LIKE" in database.stage_ddl("t")


def test_repeated_tasks_and_batches_are_stored_once(spark):
    """The steps of a batch, on stand-ins for the stage, the ledger and the table that do what the statements say."""
    stage, ledger, stored, order = [], set(), [], []

    def execute(texts):
        for text in texts:
            order.append(text.split()[0])
            batch = re.search(r"_batch_id = (\d+)", text)
            if text.startswith("DELETE"):
                stage[:] = [r for r in stage if r["_batch_id"] != int(batch[1])]
            elif text.startswith("WITH") and ("t", int(batch[1])) not in ledger:
                ledger.add(("t", int(batch[1])))
                once = {(r["_part"], r["_place"]): r["id"] for r in stage if r["_batch_id"] == int(batch[1])}
                stored.extend(once.values())

    def insert(rows, into):
        assert into == "t__stage"
        held = rows.collect()
        stage.extend(held + [r for r in held if r["_part"] == 1])  # a task whose first attempt got through unnoticed

    table = DatabaseTable("t", "done", execute, insert)
    rows = spark.range(0, 100, 1, 4)
    for batch in (0, 0, 1):
        table.append(rows, batch)
    assert sorted(stored) == sorted(2 * list(range(100))) and stage == []
    assert order[:5] == ["CREATE", "CREATE", "DELETE", "WITH", "DELETE"]


def test_a_run_takes_a_database_as_its_target(spark, monkeypatch):
    ran, written = [], []
    monkeypatch.setattr(database, "run_statements", lambda _s, _u, _p, texts: ran.extend(texts))

    def table(self, name, batch_size=None):
        return DatabaseTable(name, self.ledger, lambda texts: ran.extend(texts), lambda rows, into: written.append((into, rows.count())))

    monkeypatch.setattr(DatabaseTarget, "table", table)
    target = DatabaseTarget(spark, "jdbc:postgresql://nowhere/x")
    source = FileSource(spark, f"{DATA}/sf0.001")
    result = ingest_table(source, TableSpec("orders"), target, RunLog("j"), batch_id=4)
    assert result.success and result.rows == source.table("orders").count() and written == [("orders__stage", result.rows)]
    assert sum(t.startswith("WITH noted") and "_batch_id = 4" in t for t in ran) == 1
    failed = ingest_table(source, TableSpec("orders", polling=Polling(True, "o_orderdate", 5), key=("o_orderkey",)), target, RunLog("j"))
    assert not failed.success and "no polled tables" in failed.error


def files_of(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/rows/**/*.parquet", recursive=True)}


def test_an_increment_rewrites_only_the_ranges_it_touches(spark, folder):
    start = datetime(2024, 1, 1)
    row = lambda i: (i, start + timedelta(minutes=i))
    schema = "k int, d timestamp_ntz"
    make = lambda keys: spark.createDataFrame([row(i) for i in keys], schema)
    layout = DeltaLayout(spark, folder, make([0]).schema, "d", range_rows=100)
    assert layout.rows().count() == 0 and layout.add(make([])) == 0
    layout.add(make(range(0, 1000, 2)).unionByName(spark.createDataFrame([(-1, None)], schema)))
    assert layout.ranges().where("NOT nulls").count() == 5
    first = files_of(folder)
    assert layout.add(make(range(2000, 2050))) == 1  # past the end: the last range
    second = files_of(folder)
    assert len(set(first) & set(second)) >= len(first) - 1 and all(first[f] == second[f] for f in set(first) & set(second))
    assert layout.add(make([1, 3, 5])) == 1
    layout.add(make(range(3000, 3400)))  # the last range grows too large and is split
    assert layout.ranges().where("NOT nulls").count() > 6
    assert layout.ranges().agg(F.max("rows")).first()[0] <= 250
    keys = [-1, 1, 3, 5, *range(0, 1000, 2), *range(2000, 2050), *range(3000, 3400)]
    assert rows_of(layout.rows(), "k") == sorted([(k,) for k in keys], key=repr)
    since = F.lit(str(start + timedelta(minutes=998))).cast("timestamp_ntz")
    assert layout.since(since).count() == 450 and layout.since(None).count() == len(keys) - 1
    opened = [f for f in layout.since(since).inputFiles()]
    assert 0 < len(opened) < len(layout.rows().inputFiles())
    layout.vacuum()
    assert rows_of(layout.rows(), "k") == sorted([(k,) for k in keys], key=repr)
    assert len(files_of(folder)) == len(layout.rows().inputFiles())


def test_a_hot_delta_makes_no_endless_cuts(spark, folder):
    rows = spark.range(900).select(F.col("id").alias("k"), F.when(F.col("id") < 700, 5).otherwise(F.col("id")).cast("int").alias("d"))
    layout = DeltaLayout(spark, folder, rows.schema, "d", range_rows=100)
    layout.add(rows)
    layout.add(rows.where("d = 5"))
    assert layout.rows().count() == 1600 and layout.since(F.lit(5)).count() == 200
    bounds = layout.ranges().orderBy(F.col("low").asc_nulls_first()).collect()
    assert bounds[0]["low"] is None and bounds[-1]["high"] is None
    assert all(a["high"] == b["low"] for a, b in zip(bounds, bounds[1:]))


def test_rows_are_reported_while_they_are_written(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest, "WATCH_SECONDS", 0.02)
    log = RunLog("j")
    source = FileSource(spark, f"{DATA}/sf0.1", {"lineitem": ["l_orderkey", "l_linenumber"]})
    assert ingest_table(source, TableSpec("lineitem"), Target(spark, folder), log).success
    seen = [e["current_rows"] for e in log.events if e["event"] == "inserting"]
    assert seen == sorted(seen) and seen[-1] == 600_000 and all(0 <= n <= 600_000 for n in seen)


def test_the_progress_table_is_packed(spark, folder, monkeypatch):
    monkeypatch.setattr(progress, "PACK", 4)
    log = RunLog("job", path=folder)
    for i in range(23):
        log.add("t", "cdc_update", f"{i}", row_count=i)
        log.flush(spark)
    assert len(glob.glob(f"{folder}/*.parquet")) <= 3 * 3
    assert sorted(r["row_count"] for r in log.table(spark).collect()) == list(range(23))
    assert sorted(r["row_count"] for r in spark.read.parquet(folder).collect()) == list(range(23))
