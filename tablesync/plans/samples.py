"""Sample tables and their change sets. Every row is a function of its id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.sampling import Draws
from tablesync.operators.update import update_rows
from tablesync.sources.scan import lowest_rows

# The words of the sample tables.
USER_STATUS = ("active", "inactive", "pending", "suspended")
USER_STATUS_LARGE = ("active", "inactive", "pending")
PRODUCT_PREFIX = ("Product_", "Gadget_", "Tool_", "Device_", "Item_", "Thing_")
PRODUCT_CATEGORY = ("Electronics", "Furniture", "Stationery", "Accessories", "Clothing")
ORDER_STATUS = ("pending", "processing", "shipped", "completed", "cancelled")
EVENT_TYPE = ("login", "logout", "purchase", "page_view", "cart_add", "search", "wishlist_add", "profile_update")
SEVERITY = ("info", "warning", "error", "debug", "critical")
SEVERITY_LARGE = ("info", "warning", "error", "debug")
NEXT_SEVERITY = {"info": "warning", "warning": "error", "error": "critical"}

# How far apart user and product numbers lie (sample tables, large tables, added rows).
REFERENCES = {"sample": (999, 999), "large": (100_000, 1000), "added": (15, 12)}

SEEDS = {"users": 1, "products": 2, "orders": 3, "events": 4, "bench": 5}


def ids(spark: SparkSession, n: int, start: int = 1) -> DataFrame:
    """Row ids `start` to `start + n - 1`, made on the executors."""
    return spark.range(start, start + n).toDF("id")


def _anchor(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def users(row_ids: DataFrame, now: str, size: str = "sample") -> DataFrame:
    d = Draws(F.col("id"), SEEDS["users"])
    at = _anchor(now)
    text = F.col("id").cast("string")
    return row_ids.select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("user_"), text).alias("username"),
        F.concat(F.lit("user"), text, F.lit("@example.com")).alias("email"),
        d.pick(*(USER_STATUS_LARGE if size == "large" else USER_STATUS)).alias("status"),
        d.before(at, 365).alias("created_at"),
        d.before(at, 30).alias("updated_at"),
    )


def products(row_ids: DataFrame, now: str) -> DataFrame:
    d = Draws(F.col("id"), SEEDS["products"])
    at = _anchor(now)
    return row_ids.select(
        F.col("id").cast("int").alias("id"),
        F.concat(d.pick(*PRODUCT_PREFIX), F.col("id").cast("string")).alias("name"),
        d.pick(*PRODUCT_CATEGORY).alias("category"),
        d.money(1000, 10).alias("price"),
        d.whole(500).alias("stock"),
        d.before(at, 365).alias("created_at"),
        d.before(at, 30).alias("updated_at"),
    )


def orders(row_ids: DataFrame, now: str, size: str = "sample") -> DataFrame:
    d = Draws(F.col("id"), SEEDS["orders"])
    at = _anchor(now)
    user_span, product_span = REFERENCES[size]
    added = size == "added"
    return row_ids.select(
        F.col("id").cast("int").alias("id"),
        d.whole(user_span, 1).alias("user_id"),
        d.whole(product_span, 1).alias("product_id"),
        d.whole(5 if added else 10, 1).alias("quantity"),
        d.money(1000 if added else 5000, 10).alias("total_amount"),
        d.pick(*ORDER_STATUS).alias("order_status"),
        (at if added else d.before(at, 365 if size == "large" else 180)).alias("created_at"),
        (at if added else d.before(at, 30)).alias("updated_at"),
    )


def _event_data(d: Draws, now: str, size: str) -> Column:
    if size == "large":
        return F.concat(F.lit('{"session": "'), d.hex_text(), F.lit('"}'))
    session, third, fourth = d.hex_text(), d.whole(255), d.whole(255)
    return F.concat(
        F.lit(f'{{"timestamp": "{now}", "session_id": "'),
        session,
        F.lit('", "ip": "192.168.'),
        third.cast("string"),
        F.lit("."),
        fourth.cast("string"),
        F.lit('"}'),
    )


def event_columns(row_id: Column, now: str, size: str = "sample") -> list[Column]:
    """The columns of the sample event of an id."""
    d = Draws(row_id, SEEDS["events"])
    at = _anchor(now)
    added = size == "added"
    created_days, updated_days = (365, 30) if size == "large" else (90, 7)
    return [
        row_id.cast("int").alias("id"),
        d.pick(*EVENT_TYPE).alias("event_type"),
        d.whole(REFERENCES[size][0], 1).alias("user_id"),
        _event_data(d, now, size).alias("event_data"),
        d.pick(*(SEVERITY if size == "sample" else SEVERITY_LARGE)).alias("severity"),
        (at if added else d.before(at, created_days)).alias("created_at"),
        (at if added else d.before(at, updated_days)).alias("updated_at"),
    ]


def events(row_ids: DataFrame, now: str, size: str = "sample") -> DataFrame:
    return row_ids.select(*event_columns(F.col("id"), now, size))


def bench_rows(row_ids: DataFrame, now: str) -> DataFrame:
    """The benchmark table: `User_i`, age 20 to 69, a score below 100."""
    d = Draws(F.col("id"), SEEDS["bench"])
    text = F.col("id").cast("string")
    return row_ids.select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("User_"), text).alias("name"),
        F.concat(F.lit("user"), text, F.lit("@example.com")).alias("email"),
        (F.lit(20) + F.col("id") % 50).cast("int").alias("age"),
        (d.uniform() * 100).alias("score"),
        _anchor(now).alias("created_at"),
        _anchor(now).alias("updated_at"),
    )


def generate_tables(spark: SparkSession, n: int, now: str, size: str = "sample") -> dict[str, DataFrame]:
    """The sample tables with `n` rows each; the large form has no products."""
    rows = ids(spark, n)
    tables = {"users": users(rows, now, size), "orders": orders(rows, now, size), "events": events(rows, now, size)}
    if size != "large":
        tables["products"] = products(rows, now)
    return tables


def add_rows(spark: SparkSession, after: int, n_orders: int, n_events: int, now: str) -> dict[str, DataFrame]:
    """New orders and events with ids past `after`, stamped now, for an incremental poll to find."""
    return {
        "orders": orders(ids(spark, n_orders, after + 1), now, "added"),
        "events": events(ids(spark, n_events, after + 1), now, "added"),
    }


def random_rows(table: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """`n` rows in a random order that the seed fixes."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return lowest_rows(table, number, [digest, F.col(key)], n)


def raised(severity: str) -> Column:
    """The next severity; of the greatest, and of any other word, the least."""
    out = F.lit("info")
    for before, after in NEXT_SEVERITY.items():
        out = F.when(F.col(severity) == before, after).otherwise(out)
    return out


def severity_changes(now: str, severity: str = "severity", data: str = "event_data", at: str = "updated_at") -> dict[str, Column]:
    """The new values of an updated event: one severity up, with new JSON, stamped now."""
    return {data: F.lit(f'{{"updated": true, "timestamp": "{now}"}}'), severity: raised(severity), at: _anchor(now)}


def update_severity(table: DataFrame, n: int, now: str, seed: str) -> DataFrame:
    """The events table after `n` random rows moved one severity up."""
    return update_rows(table, random_rows(table.select("id"), "id", n, seed), "id", severity_changes(now))
