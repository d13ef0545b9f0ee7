from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tablesync.plans import samples
from tablesync.sources import scan

NOW, LATER = "2024-06-01 00:00:00", "2024-06-02 00:00:00"


def test_rows_depend_on_their_id_only(spark):
    few = samples.orders(samples.ids(spark, 50), NOW)
    many = samples.orders(samples.ids(spark, 100).repartition(7), NOW).where("id <= 50")
    assert rows_of(few) == rows_of(many)


def test_columns_and_words(spark):
    tables = samples.generate_tables(spark, 1000, NOW)
    assert set(tables) == {"users", "products", "orders", "events"}
    assert set(samples.generate_tables(spark, 10, NOW, "large")) == {"users", "orders", "events"}
    words = {"users.status": samples.USER_STATUS, "products.category": samples.PRODUCT_CATEGORY,
             "orders.order_status": samples.ORDER_STATUS, "events.event_type": samples.EVENT_TYPE,
             "events.severity": samples.SEVERITY}
    for place, expected in words.items():
        table, column = place.split(".")
        counts = {r[column]: r["count"] for r in tables[table].groupBy(column).count().collect()}
        assert set(counts) == set(expected)
        # Rounding gives the first and last word half the weight of the others.
        assert counts[expected[0]] < counts[expected[1]] and counts[expected[-1]] < counts[expected[1]]
    bounds = tables["orders"].agg(F.min("user_id"), F.max("user_id"), F.min("quantity"), F.max("quantity")).first()
    assert bounds[0] >= 1 and bounds[1] <= 1000 and (bounds[2], bounds[3]) == (1, 11)
    assert tables["products"].where("price < 10 OR price > 1010").count() == 0
    assert tables["users"].where(F.col("created_at") > F.lit(NOW).cast("timestamp_ntz")).count() == 0
    assert tables["events"].where(F.get_json_object("event_data", "$.session_id").isNull()).count() == 0
    assert "Python" not in plan_of(tables["events"])


def test_added_rows_come_after_and_are_stamped_now(spark):
    added = samples.add_rows(spark, 1000, 100, 500, LATER)
    assert added["orders"].count() == 100 and added["events"].count() == 500
    assert added["events"].agg(F.min("id"), F.max("user_id")).first()[0] == 1001
    assert added["orders"].where(F.col("updated_at") != F.lit(LATER).cast("timestamp_ntz")).count() == 0


def test_update_severity_changes_so_many_rows_and_no_others(spark):
    before = samples.events(samples.ids(spark, 300), NOW)
    after = samples.update_severity(before, 50, LATER, "s")
    assert after.count() == 300 and after.schema == before.schema
    b = before.select("id", F.col("severity").alias("old"), F.col("updated_at").alias("old_at"))
    both = after.join(b, "id")
    changed = both.where("updated_at <> old_at")
    assert changed.count() == 50
    step = {"info": "warning", "warning": "error", "error": "critical", "debug": "info", "critical": "info"}
    assert all(step[r["old"]] == r["severity"] for r in changed.collect())
    assert both.where("updated_at = old_at AND severity <> old").count() == 0
    assert changed.where(F.get_json_object("event_data", "$.updated") != "true").count() == 0


def test_random_rows_are_repeatable_and_large_numbers_are_not_sorted(spark, monkeypatch):
    ids = samples.ids(spark, 500)
    small = rows_of(samples.random_rows(ids, "id", 120, "s"))
    assert small == rows_of(samples.random_rows(ids.repartition(3), "id", 120, "s"))
    assert small != rows_of(samples.random_rows(ids, "id", 120, "other"))
    monkeypatch.setattr(scan, "TOP_N_ROWS", 0)
    assert small == rows_of(samples.random_rows(ids, "id", 120, "s"))


def test_bench_rows(spark):
    row = samples.bench_rows(samples.ids(spark, 120), NOW).where("id = 105").first()
    assert (row["name"], row["email"], row["age"]) == ("User_105", "user105@example.com", 25)
