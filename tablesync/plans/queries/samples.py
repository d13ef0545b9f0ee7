"""Sample tables: a row for every key of the given tables, and the changes made to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.update import update_rows, updated_rows
from tablesync.plans import samples as make
from tablesync.plans.inputs import SqlDraws, read
from tablesync.plans.queries.registry import maker, query

NOW, LATER = "2024-06-01 00:00:00", "2024-06-02 00:00:00"
UPDATED_ROWS = 50

# Where the row ids come from, and what is added to the ids of rows made later.
_KEYS = {"users": ("customer", "c_custkey"), "products": ("part", "p_partkey"), "orders": ("orders", "o_orderkey"),
         "events": ("events", "event_id")}
ADDED = 1_000_000_000


def _ids(spark: SparkSession, sf_dir: str, sample: str, after: int = 0) -> DataFrame:
    table, key = _KEYS[sample]
    return read(spark, sf_dir, table).select((F.col(key) + 1 + after).alias("id"))


def _sql_ids(sample: str, after: int = 0) -> str:
    table, key = _KEYS[sample]
    return f"(SELECT CAST({key} + 1 + {after} AS BIGINT) AS id FROM {table})"


def _sql_users(words: tuple[str, ...]) -> str:
    d = SqlDraws("id", make.SEEDS["users"])
    return f"""
        SELECT CAST(id AS INTEGER) AS id, 'user_' || id AS username, 'user' || id || '@example.com' AS email,
               {d.pick(*words)} AS status, {d.before(NOW, 365)} AS created_at, {d.before(NOW, 30)} AS updated_at
        FROM {_sql_ids("users")}
    """


@maker(_sql_users(make.USER_STATUS))
def sample_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.users(_ids(spark, sf_dir, "users"), NOW)


@maker(_sql_users(make.USER_STATUS_LARGE))
def large_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.users(_ids(spark, sf_dir, "users"), NOW, "large")


def _sql_products() -> str:
    d = SqlDraws("id", make.SEEDS["products"])
    return f"""
        SELECT CAST(id AS INTEGER) AS id, ({d.pick(*make.PRODUCT_PREFIX)}) || id AS name,
               {d.pick(*make.PRODUCT_CATEGORY)} AS category, {d.money(1000, 10)} AS price, {d.whole(500)} AS stock,
               {d.before(NOW, 365)} AS created_at, {d.before(NOW, 30)} AS updated_at
        FROM {_sql_ids("products")}
    """


@maker(_sql_products())
def sample_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.products(_ids(spark, sf_dir, "products"), NOW)


def _sql_orders(size: str, after: int, now: str) -> str:
    d = SqlDraws("id", make.SEEDS["orders"])
    users, products = make.REFERENCES[size]
    added = size == "added"
    columns = [
        "CAST(id AS INTEGER) AS id",
        f"{d.whole(users, 1)} AS user_id",
        f"{d.whole(products, 1)} AS product_id",
        f"{d.whole(5 if added else 10, 1)} AS quantity",
        f"{d.money(1000 if added else 5000, 10)} AS total_amount",
        f"{d.pick(*make.ORDER_STATUS)} AS order_status",
    ]
    at = f"TIMESTAMP '{now}'"
    columns.append(f"{at if added else d.before(now, 365 if size == 'large' else 180)} AS created_at")
    columns.append(f"{at if added else d.before(now, 30)} AS updated_at")
    return f"SELECT {', '.join(columns)} FROM {_sql_ids('orders', after)}"


@maker(_sql_orders("sample", 0, NOW))
def sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.orders(_ids(spark, sf_dir, "orders"), NOW)


@maker(_sql_orders("large", 0, NOW))
def large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.orders(_ids(spark, sf_dir, "orders"), NOW, "large")


@maker(_sql_orders("added", ADDED, LATER))
def added_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.orders(_ids(spark, sf_dir, "orders", ADDED), LATER, "added")


def _sql_events(size: str, after: int, now: str) -> str:
    d = SqlDraws("id", make.SEEDS["events"])
    added = size == "added"
    kind, user = d.pick(*make.EVENT_TYPE), d.whole(make.REFERENCES[size][0], 1)
    if size == "large":
        data = f"""'{{"session": "' || {d.hex_text()} || '"}}'"""
    else:
        session, third, fourth = d.hex_text(), d.whole(255), d.whole(255)
        data = (
            f"""'{{"timestamp": "{now}", "session_id": "' || {session} || '", "ip": "192.168.' """
            f"""|| {third} || '.' || {fourth} || '"}}'"""
        )
    severity = d.pick(*(make.SEVERITY if size == "sample" else make.SEVERITY_LARGE))
    at = f"TIMESTAMP '{now}'"
    created_days, updated_days = (365, 30) if size == "large" else (90, 7)
    created = at if added else d.before(now, created_days)
    updated = at if added else d.before(now, updated_days)
    return f"""
        SELECT CAST(id AS INTEGER) AS id, {kind} AS event_type, {user} AS user_id, {data} AS event_data,
               {severity} AS severity, {created} AS created_at, {updated} AS updated_at
        FROM {_sql_ids("events", after)}
    """


@maker(_sql_events("sample", 0, NOW))
def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.events(_ids(spark, sf_dir, "events"), NOW)


@maker(_sql_events("large", 0, NOW))
def large_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.events(_ids(spark, sf_dir, "events"), NOW, "large")


@maker(_sql_events("added", ADDED, LATER))
def added_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.events(_ids(spark, sf_dir, "events", ADDED), LATER, "added")


def _sql_bench() -> str:
    d = SqlDraws("id", make.SEEDS["bench"])
    return f"""
        SELECT CAST(id AS INTEGER) AS id, 'User_' || id AS name, 'user' || id || '@example.com' AS email,
               CAST(20 + id % 50 AS INTEGER) AS age, {d.uniform()} * 100 AS score,
               TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at
        FROM {_sql_ids("orders")}
    """


@maker(_sql_bench())
def bench_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make.bench_rows(_ids(spark, sf_dir, "orders"), NOW)


@query(
    f"SELECT doc_id, lang, source FROM documents ORDER BY md5(doc_id || 'pick'), doc_id LIMIT {UPDATED_ROWS}"
)
def random_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return make.random_rows(documents, "doc_id", UPDATED_ROWS, "pick")


_SQL_RAISED = "CASE {} WHEN 'info' THEN 'warning' WHEN 'warning' THEN 'error' WHEN 'error' THEN 'critical' ELSE 'info' END"
_SQL_PAIRED = f"""
    WITH e AS ({_sql_events("sample", 0, NOW)}),
    hit AS (SELECT id FROM e ORDER BY md5(id || 'update'), id LIMIT {UPDATED_ROWS}),
    paired AS (
        SELECT e.*, g.event_id, g.ts AS given_ts, g.user_id AS given_user, g.event_type AS given_type, g.value, g.props,
               e.id IN (SELECT id FROM hit) AS h
        FROM e JOIN events g ON e.id = g.event_id + 1)
"""


def _paired_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """Every given event with the sample event of its key, the keys that an update picks, and the new values of both."""
    given = [F.col("event_id"), F.col("ts").alias("given_ts"), F.col("user_id").alias("given_user"),
             F.col("event_type").alias("given_type"), F.col("value"), F.col("props")]
    events = read(spark, sf_dir, "events").select(*make.event_columns(F.col("event_id") + 1, NOW), *given)
    picked = make.random_rows(events.select("id"), "id", UPDATED_ROWS, "update")
    return events, picked, make.severity_changes(LATER) | make.severity_changes(LATER, "given_type", "props", "given_ts")


@query(
    f"""
    {_SQL_PAIRED}
    SELECT id, event_type, user_id,
           CASE WHEN h THEN '{{"updated": true, "timestamp": "{LATER}"}}' ELSE event_data END AS event_data,
           CASE WHEN h THEN {_SQL_RAISED.format("severity")} ELSE severity END AS severity,
           created_at, CASE WHEN h THEN TIMESTAMP '{LATER}' ELSE updated_at END AS updated_at,
           event_id, CASE WHEN h THEN TIMESTAMP '{LATER}' ELSE given_ts END AS given_ts, given_user,
           CASE WHEN h THEN {_SQL_RAISED.format("given_type")} ELSE given_type END AS given_type, value,
           CASE WHEN h THEN '{{"updated": true, "timestamp": "{LATER}"}}' ELSE props END AS props
    FROM paired
    """
)
def update_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given events, each with the sample event of its key, after a random set of them moved one step up: the severity
    of the sample event through all its words, the type of the given one, with new data and time on both."""
    events, picked, changes = _paired_events(spark, sf_dir)
    return update_rows(events, picked, "id", changes)


@query(
    f"""
    {_SQL_PAIRED}
    SELECT id, event_type, {_SQL_RAISED.format("severity")} AS severity, event_id, given_user,
           {_SQL_RAISED.format("given_type")} AS given_type
    FROM paired WHERE h
    """
)
def update_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows an update changed."""
    events, picked, changes = _paired_events(spark, sf_dir)
    return updated_rows(events, picked, "id", changes).select("id", "event_type", "severity", "event_id", "given_user", "given_type")
