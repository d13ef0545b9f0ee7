"""Catalogs, specs, jobs and logs derived from the given tables, so that they grow with them.

Each input comes as a DataFrame and as the SQL that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.types import TYPE_MAP

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_VERSION = "l_shipdate"
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

# All types of the map and two it does not know.
CATALOG_TYPES = [*TYPE_MAP, "ARRAY", "character"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def newest_sql(rows: str, keys: list[str], version: str, columns: list[str]) -> str:
    """The newest row per key with ties broken by the remaining columns, as a window query."""
    rest = [c for c in columns if c not in keys and c != version]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [version, *rest])
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn FROM ({rows})) WHERE rn = 1"
    )


# -- catalogs ------------------------------------------------------------------------------------


def _schema_of(key: Column) -> Column:
    return F.when(key % 10 == 0, "audit").otherwise("public")


def _table_of(key: Column) -> Column:
    return F.concat(F.lit("t_"), key.cast("string"))


SQL_SCHEMA_OF = "CASE WHEN {0} % 10 = 0 THEN 'audit' ELSE 'public' END"


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A columns catalog: a table per order, a column per line, and `updated_at` in each."""
    lines = read(spark, sf_dir, "lineitem").groupBy(*LINE_KEY).agg(F.max("l_partkey").alias("p"))
    types = F.array(*[F.lit(t) for t in CATALOG_TYPES])
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    from_lines = lines.select(
        _schema_of(key).alias("table_schema"),
        _table_of(key).alias("table_name"),
        F.concat(F.lit("c"), number.cast("string"), F.lit("_"), F.col("p").cast("string")).alias("column_name"),
        F.element_at(types, (F.col("p") % len(CATALOG_TYPES) + 1).cast("int")).alias("data_type"),
        number.cast("int").alias("ordinal_position"),
    )
    key = F.col("o_orderkey")
    from_orders = read(spark, sf_dir, "orders").select(
        _schema_of(key).alias("table_schema"),
        _table_of(key).alias("table_name"),
        F.lit("updated_at").alias("column_name"),
        F.lit("timestamp").alias("data_type"),
        F.lit(8).alias("ordinal_position"),
    )
    return from_lines.unionByName(from_orders)


_SQL_TYPES = "[" + ", ".join(f"'{t}'" for t in CATALOG_TYPES) + "]"
SQL_CATALOG_COLUMNS = f"""
    SELECT {SQL_SCHEMA_OF.format('l_orderkey')} AS table_schema, 't_' || l_orderkey AS table_name,
           'c' || l_linenumber || '_' || max(l_partkey) AS column_name,
           ({_SQL_TYPES})[CAST(max(l_partkey) % {len(CATALOG_TYPES)} + 1 AS INTEGER)] AS data_type,
           l_linenumber AS ordinal_position
    FROM lineitem GROUP BY l_orderkey, l_linenumber
    UNION ALL
    SELECT {SQL_SCHEMA_OF.format('o_orderkey')}, 't_' || o_orderkey, 'updated_at', 'timestamp', 8 FROM orders
"""
# Fixed values, written out here so that the SQL does not repeat a slip of the code's own map.
SQL_TYPE_MAP = """
    SELECT * FROM (VALUES
    ('integer', 'int'),
    ('bigint', 'bigint'),
    ('smallint', 'smallint'),
    ('serial', 'int'),
    ('bigserial', 'bigint'),
    ('boolean', 'boolean'),
    ('text', 'string'),
    ('varchar', 'string'),
    ('character varying', 'string'),
    ('char', 'string'),
    ('date', 'date'),
    ('timestamp', 'timestamp_ntz'),
    ('timestamp without time zone', 'timestamp_ntz'),
    ('timestamp with time zone', 'timestamp'),
    ('numeric', 'double'),
    ('decimal', 'double'),
    ('double precision', 'double'),
    ('real', 'float'),
    ('json', 'string'),
    ('jsonb', 'string'),
    ('uuid', 'string'),
    ('bytea', 'string'),
    ('inet', 'string'),
    ('USER-DEFINED', 'string')
    ) AS m(src_type, spark_type)
"""


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        _schema_of(key).alias("table_schema"),
        _table_of(key).alias("table_name"),
        F.when(F.col("o_orderstatus") == "O", "VIEW").otherwise("BASE TABLE").alias("table_type"),
    )


def catalog_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("pk_"), key.cast("string")).alias("constraint_name"),
        _schema_of(key).alias("table_schema"),
        _table_of(key).alias("table_name"),
        F.when(F.col("o_orderstatus") == "F", "UNIQUE").otherwise("PRIMARY KEY").alias("constraint_type"),
    )


def catalog_key_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two columns of each table are its key."""
    columns = catalog_columns(spark, sf_dir).where("ordinal_position <= 2")
    return columns.select(
        F.concat(F.lit("pk_"), F.substring("table_name", 3, 100)).alias("constraint_name"),
        "table_schema",
        "column_name",
        "ordinal_position",
    )


SQL_PRIMARY_KEYS = f"""
    SELECT c.table_schema, c.table_name, c.column_name, c.ordinal_position
    FROM ({SQL_CATALOG_COLUMNS}) c JOIN orders ON c.table_name = 't_' || o_orderkey
    WHERE c.ordinal_position <= 2 AND o_orderstatus <> 'F'
"""


def catalog_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent and high orders ask for change capture; the high ones name no version column."""
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    return read(spark, sf_dir, "orders").select(
        _schema_of(key).alias("table_schema"),
        _table_of(key).alias("table_name"),
        priority.isin("1-URGENT", "2-HIGH").alias("cdc_enabled"),
        F.when(priority == "2-HIGH", "").otherwise("updated_at").alias("version_column"),
    )


# -- specs and jobs ------------------------------------------------------------------------------


def table_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec per customer, with fields left out and fields that are wrong."""
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
    polling = F.struct(
        (nation % 2 == 0).alias("enabled"),
        F.when(segment == "FURNITURE", "").otherwise("updated_at").alias("delta_column"),
        (nation - 2).alias("interval_seconds"),
    )
    number = F.col("c_custkey").cast("string")
    return read(spark, sf_dir, "customer").select(
        F.when(nation == 0, " ").when(nation == 1, segment).otherwise(F.concat(F.lit("t_"), number)).alias("name"),
        F.when(nation < 10, nation - 3).alias("limit"),
        F.when(segment == "BUILDING", 1000).when(segment == "MACHINERY", 0).alias("batch_size"),
        F.when(F.col("c_acctbal") >= 0, polling).alias("polling"),
    )


SQL_RESOLVED_SPECS = """
    SELECT CASE WHEN c_nationkey = 0 THEN ' ' WHEN c_nationkey = 1 THEN c_mktsegment
                ELSE 't_' || c_custkey END AS name,
           coalesce(CASE WHEN c_nationkey < 10 THEN c_nationkey - 3 END, 100) AS "limit",
           coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 1000 WHEN 'MACHINERY' THEN 0 END, 500) AS batch_size,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey % 2 = 0 ELSE true END AS enabled,
           CASE WHEN c_acctbal >= 0 AND c_mktsegment = 'FURNITURE' THEN '' ELSE 'updated_at' END AS delta_column,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey - 2 ELSE 60 END AS interval_seconds
    FROM customer
"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job per customer over the same five tables (and a blank name), two of them perhaps polled."""

    def config(name: str, enabled: Column, delta: str, interval: Column) -> Column:
        polling = F.struct(
            enabled.alias("enabled"), F.lit(delta).alias("delta_column"), interval.alias("interval_seconds")
        )
        return F.struct(
            F.lit(name).alias("name"), F.lit(0).alias("limit"), F.lit(500).alias("batch_size"), polling.alias("polling")
        )

    nation = F.col("c_nationkey")
    return read(spark, sf_dir, "customer").select(
        F.concat(F.lit("job_"), F.col("c_custkey").cast("string")).alias("id"),
        F.array(*[F.lit(t) for t in ("t0", "t1", "t2", "t3", "t4", "")]).alias("tables"),
        F.array(
            config("t0", F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "updated_at", nation + 1),
            config("t1", F.col("c_acctbal") < 0, "created_at", F.lit(60)),
        ).alias("table_configs"),
        F.timestamp_add("DAY", nation, instant("2024-01-01 00:00:00")).alias("start_time"),
        F.when(F.col("c_acctbal") < -900, "Failed to connect").alias("error"),
    )


SQL_JOBS = """
    SELECT 'job_' || c_custkey AS id, TIMESTAMP '2024-01-01 00:00:00' + to_days(c_nationkey) AS start_time,
           CASE WHEN c_acctbal < -900 THEN 'Failed to connect' END AS error,
           c_mktsegment IN ('BUILDING', 'MACHINERY') AS polls0, c_nationkey + 1 AS interval0,
           c_acctbal < 0 AS polls1
    FROM customer
"""
SQL_JOB_TABLES = f"SELECT id AS job_id, unnest(['t0', 't1', 't2', 't3', 't4']) AS \"table\" FROM ({SQL_JOBS})"


def _job_and_table() -> list[Column]:
    event = F.col("event_id")
    table = F.when(event % 11 == 0, "").otherwise(F.concat(F.lit("t"), (event % 5).cast("string")))
    return [F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_id"), table.alias("table")]


SQL_JOB_AND_TABLE = """'job_' || user_id AS job_id,
           CASE WHEN event_id % 11 = 0 THEN '' ELSE 't' || (event_id % 5) END AS "table\""""


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A progress event per row of `events`."""
    kind, value = F.col("event_type"), F.col("value")
    event = (
        F.when(kind == "view", "extracting")
        .when(kind == "click", "inserting")
        .when(kind == "error", "error")
        .when(kind == "purchase", "completed")
        .otherwise("started")
    )
    none = F.lit(0).cast("bigint")
    rows = read(spark, sf_dir, "events").select(
        *_job_and_table(),
        event.alias("event"),
        F.col("props").alias("message"),
        F.when(kind == "purchase", F.floor(value * 10).cast("bigint")).otherwise(none).alias("row_count"),
        F.when(kind == "click", F.floor(value).cast("bigint")).otherwise(none).alias("current_rows"),
        F.when(F.col("event_id") % 3 == 0, F.lit(40).cast("bigint")).otherwise(none).alias("total_rows"),
        F.when(kind == "click", "inserting").when(kind == "purchase", "completed").otherwise("").alias("phase"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )
    share = F.least(F.lit(100.0), F.col("current_rows") / F.col("total_rows") * 100)
    return rows.withColumn("percentage", F.when(F.col("total_rows") > 0, share).otherwise(0.0))


SQL_PROGRESS = f"""
    SELECT *, CASE WHEN total_rows > 0
                   THEN least(100.0::DOUBLE, current_rows::DOUBLE / total_rows::DOUBLE * 100) ELSE 0.0::DOUBLE
              END AS percentage
    FROM (SELECT {SQL_JOB_AND_TABLE},
           CASE event_type WHEN 'view' THEN 'extracting' WHEN 'click' THEN 'inserting' WHEN 'error' THEN 'error'
                           WHEN 'purchase' THEN 'completed' ELSE 'started' END AS event,
           props AS message,
           CASE WHEN event_type = 'purchase' THEN CAST(floor(value * 10) AS BIGINT) ELSE 0 END AS row_count,
           CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS current_rows,
           CASE WHEN event_id % 3 = 0 THEN 40::BIGINT ELSE 0 END AS total_rows,
           CASE event_type WHEN 'click' THEN 'inserting' WHEN 'purchase' THEN 'completed' ELSE '' END AS phase,
           ts AS "timestamp", event_id AS seq
    FROM events)
"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table result per purchase (good) and per error (bad)."""
    kind, value = F.col("event_type"), F.col("value")
    ended = read(spark, sf_dir, "events").where(kind.isin("purchase", "error"))
    job_id, table = _job_and_table()
    good = kind == "purchase"
    return ended.select(
        job_id,
        table.alias("name"),
        good.alias("success"),
        F.when(~good, F.col("props")).alias("error"),
        F.when(good, F.floor(value * 10).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("rows"),
        F.when(good, F.round(value * 1_000_000).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("duration"),
        F.col("event_id").alias("seq"),
    )


SQL_RESULTS = f"""
    SELECT job_id, "table" AS name, good AS success, CASE WHEN NOT good THEN props END AS error,
           CASE WHEN good THEN CAST(floor(value * 10) AS BIGINT) ELSE 0 END AS rows,
           CASE WHEN good THEN CAST(round(value * 1000000) AS BIGINT) ELSE 0 END AS duration, event_id AS seq
    FROM (SELECT *, {SQL_JOB_AND_TABLE}, event_type = 'purchase' AS good FROM events
          WHERE event_type IN ('purchase', 'error'))
"""


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A latency sample per event."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", "Extract_view")
        .when(kind == "click", "Insert_click")
        .when(kind == "purchase", "Insert_purchase")
        .when(kind == "error", "CDC_error")
        .otherwise("MultiTable_signup")
    )
    nanos = F.round(F.col("value") * 10_000_000).cast("bigint")
    return read(spark, sf_dir, "events").select(
        name.alias("name"), F.col("event_id").alias("iteration"), nanos.alias("duration_ns")
    )


SQL_DURATIONS = """
    SELECT CASE event_type WHEN 'view' THEN 'Extract_view' WHEN 'click' THEN 'Insert_click'
                           WHEN 'purchase' THEN 'Insert_purchase' WHEN 'error' THEN 'CDC_error'
                           ELSE 'MultiTable_signup' END AS name,
           event_id AS iteration, CAST(round(value * 10000000) AS BIGINT) AS duration_ns
    FROM events
"""


# -- sampling in SQL -----------------------------------------------------------------------------


class SqlDraws:
    """`Draws` as SQL text: the same draws in the same order."""

    def __init__(self, row_id: str, seed: int):
        self._id, self._seed, self._used = row_id, seed, 0

    def bits(self) -> str:
        block, slot = divmod(self._used, 4)
        self._used += 1
        digest = f"md5(({self._id}) || ':{self._seed}:{block}')"
        return f"CAST('0x' || substr({digest}, {1 + 8 * slot}, 8) AS BIGINT)"

    def uniform(self) -> str:
        return f"({self.bits()} / 4294967296.0::DOUBLE)"

    def whole(self, scale: float, start: float = 0) -> str:
        return f"CAST(round_even({self.uniform()} * {scale}::DOUBLE + {start}::DOUBLE, 0) AS INTEGER)"

    def money(self, scale: float, start: float) -> str:
        return f"CAST({self.uniform()} * {scale}::DOUBLE + {start}::DOUBLE AS DECIMAL(10,2))"

    def pick(self, *words: str) -> str:
        index = self.whole(len(words) - 1)
        branches = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words[:-1]))
        return f"CASE {index} {branches} ELSE '{words[-1]}' END"

    def before(self, anchor: str, days: int) -> str:
        micros = f"CAST(floor({self.uniform()} * {days * 86_400_000_000}::DOUBLE) AS BIGINT)"
        return f"(TIMESTAMP '{anchor}' - to_microseconds({micros}))"

    def hex_text(self, size: int = 16) -> str:
        return f"substr(md5(CAST({self.bits()} AS VARCHAR)), 1, {size})"
