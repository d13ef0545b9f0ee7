"""Queries on tables that have outgrown the given ones, and jobs that must stay whole."""

import re
from bisect import bisect_left
from dataclasses import replace

from helpers import DATA, plan_of, rows_of
from pyspark.sql import functions as F

from tablesync.functions.types import whole_type
from tablesync.operators import rank, versions
from tablesync.plans.queries import ORACLES, QUERIES
from tablesync.streaming.versionlog import VersionLog

SMALL = f"{DATA}/sf0.001"


def test_customers_beyond_a_smallint_are_conformed(spark, folder):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    wide = orders.withColumn("o_custkey", F.col("o_custkey") + 40_000)
    wide.write.parquet(f"{folder}/orders.parquet")
    found = QUERIES["conform_orders"](spark, folder)
    assert found.schema["customer"].dataType.simpleString() == "int"
    assert rows_of(found, "id", "customer") == rows_of(wide, "o_orderkey", "o_custkey")


def test_whole_type_is_the_narrowest_that_holds_the_values():
    assert [whole_type(*ends) for ends in ((None, None), (-32768, 32767), (0, 32768), (-32769, 0), (0, 1 << 31))] == [
        "smallint", "smallint", "integer", "integer", "bigint"]


def test_inclusive_polls_leave_no_order_behind(spark):
    found = QUERIES["cdc_inclusive_polls"](spark, SMALL)
    assert rows_of(found) == rows_of(spark.read.parquet(f"{SMALL}/orders.parquet").select(*found.columns))
    assert ORACLES["cdc_inclusive_polls"] == "SELECT * FROM orders"


def test_inclusive_polls_store_orders_without_a_date(spark, folder):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    undated = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    undated.write.parquet(f"{folder}/orders.parquet")
    found = QUERIES["cdc_inclusive_polls"](spark, folder)
    assert rows_of(found) == rows_of(undated.select(*found.columns))


def test_updates_reach_every_severity_and_the_given_events(spark):
    after = QUERIES["update_severity"](spark, SMALL)
    given = spark.read.parquet(f"{SMALL}/events.parquet")
    assert after.count() == given.count()
    assert {r[0] for r in after.select("severity").distinct().collect()} == {"info", "warning", "error", "debug", "critical"}
    before = given.select("event_id", F.col("event_type").alias("old"))
    changed = after.join(before, "event_id").where("updated_at = TIMESTAMP_NTZ '2024-06-02 00:00:00'")
    step = {"info": "warning", "warning": "error", "error": "critical"}
    assert changed.count() == 50
    assert all(r["given_type"] == step.get(r["old"], "info") for r in changed.collect())


def test_returned_updates_tell_the_new_severity(spark):
    returned = QUERIES["update_returning"](spark, SMALL)
    columns = ["id", "event_id", "severity", "given_type"]
    after = QUERIES["update_severity"](spark, SMALL).where("updated_at = TIMESTAMP_NTZ '2024-06-02 00:00:00'")
    assert returned.count() == 50 and rows_of(returned, *columns) == rows_of(after, *columns)


def line_log(spark, folder, buckets=4):
    rows = spark.range(0, 4000, 1, 8).selectExpr("CAST(id % 1500 AS INT) AS k", "CAST(id AS INT) AS v", "hex(id) AS p")
    return rows, VersionLog(spark, folder, rows.schema, ["k"], "v", buckets, "t")


def test_many_changed_keys_shuffle_the_base_once(spark, folder, monkeypatch):
    monkeypatch.setattr(versions, "is_small", lambda *_: False)
    rows, log = line_log(spark, folder)
    log.append(rows.where("v < 2500"), 0)
    log.commit(None, 0)
    log.compact()
    log.append(rows.where("v >= 2500"), 1)
    log.commit(None, 1)
    plan = plan_of(log.current())
    assert "Join" not in plan and len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    expected = rows_of(versions.newest(rows, ["k"], ["v"]))
    assert rows_of(log.current()) == expected
    wider = replace(log, buckets=8)
    wider.compact()
    assert rows_of(wider.current()) == expected and {b for b, _, _ in wider.manifest()} == set(range(8))


def test_few_buckets_are_written_without_a_second_shuffle(spark, folder):
    rows, log = line_log(spark, folder)
    shuffled = lambda buckets: "Exchange" in plan_of(log._by_bucket(rows.withColumn("_bucket", F.col("k")), buckets))
    assert not shuffled(4) and not shuffled(16) and shuffled(17)


def test_cells_between_pivots_are_found_by_compiled_steps(spark):
    pivots = [-3, 0, 1, 7, 7_000]
    keys = spark.range(-10, 30).select(F.struct(F.col("id").alias("k0")).alias("key"))
    listed = F.array(*[F.struct(F.lit(p).cast("bigint").alias("k0")) for p in pivots])
    cells = rank._with_cell(keys, listed)
    expected = [2 * bisect_left(pivots, k) + (k in pivots) for k in range(-10, 30)]
    assert [r[0] for r in cells.collect()] == expected
    assert "lambda" not in plan_of(cells)
