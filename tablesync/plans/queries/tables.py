"""Scans, catalogs, types and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.text import cursor_text, pretty_size, progress_percent, redact_url, uuid_text, valid_identifier
from tablesync.functions.types import whole_type
from tablesync.operators.schema import build_ddl, conform, conform_lenient, invalid_names, map_types, unsupported_columns
from tablesync.operators.versions import dedup_key
from tablesync.plans import inputs
from tablesync.plans.inputs import LINE_KEY, TABLES, instant, read
from tablesync.plans.queries.registry import query
from tablesync.session import scratch_dir
from tablesync.sinks.append import append_rows, create_if_absent
from tablesync.sinks.layout import DeltaLayout
from tablesync.sources.catalog import describe_columns, list_tables, primary_key_columns, table_counts
from tablesync.sources.scan import high_watermark, scan_since, scan_table, write_delta_layout

SQL_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""


@query(SQL_ORDERS)
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full copy: create the table if absent, append the conformed rows, read them back."""
    path = scratch_dir(spark, "snapshot")
    rows = conform(scan_table(read(spark, sf_dir, "orders")))
    create_if_absent(spark, path, rows.schema)
    append_rows(rows, path)
    return spark.read.parquet(path)


@query(f"SELECT * FROM ({SQL_ORDERS}) UNION ALL SELECT * FROM ({SQL_ORDERS})")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading a plain table again stores every row again."""
    path = scratch_dir(spark, "append")
    for _ in range(2):
        rows = conform(scan_table(read(spark, sf_dir, "orders")))
        create_if_absent(spark, path, rows.schema)
        append_rows(rows, path, batch_size=5000, writers=4)
    return spark.read.parquet(path)


@query(f"{SQL_ORDERS} UNION ALL {SQL_ORDERS}")
def append_named_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are matched by name: a source with its columns in another order lands in the right ones."""
    path = scratch_dir(spark, "named")
    rows = conform(read(spark, sf_dir, "orders"))
    append_rows(rows, path)
    append_rows(rows.select(*reversed(rows.columns)), path)
    return spark.read.parquet(path)


@query("SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1000)")
def snapshot_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(read(spark, sf_dir, "orders"), 1000).agg(F.count("*").alias("n"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def delta_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_since(read(spark, sf_dir, "events"), "ts", instant("2024-01-20 00:00:00"))


@query("SELECT event_id, ts, value FROM events WHERE ts >= (SELECT ts FROM events WHERE event_id = 100)")
def delta_scan_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-read that starts at the cursor itself; here the cursor is the time of one event."""
    events = read(spark, sf_dir, "events")
    start = events.where("event_id = 100").select("ts").scalar()
    return scan_since(events, "ts", start, inclusive=True).select("event_id", "ts", "value")


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 1000")
def delta_topn_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = instant("1996-01-01 00:00:00")
    return scan_since(read(spark, sf_dir, "orders"), "o_orderdate", start, 1000, ["o_orderkey"], ties="strict")


SQL_ORDERS_TIES = """
    SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01' AND o_orderdate <=
        (SELECT max(o_orderdate) FROM (SELECT o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01'
                                       ORDER BY o_orderdate LIMIT {n}))
"""


@query(SQL_ORDERS_TIES.format(n=1000))
def delta_topn_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = instant("1995-01-01 00:00:00")
    return scan_since(read(spark, sf_dir, "orders"), "o_orderdate", start, 1000)


@query(
    """
    SELECT * FROM lineitem WHERE l_shipdate <=
        (SELECT max(l_shipdate) FROM (SELECT l_shipdate FROM lineitem ORDER BY l_shipdate LIMIT 20000))
    """
)
def delta_large_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit too large for a top-n: the cut is found by rank, without sorting rows."""
    return scan_since(read(spark, sf_dir, "lineitem"), "l_shipdate", None, 20_000)


@query("SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20000")
def delta_large_limit_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly so many of the oldest rows; only the rows at the cut are sorted."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return scan_since(read(spark, sf_dir, "lineitem"), "l_shipdate", None, 20_000, order, ties="strict")


def _sql_large(delta: str) -> str:
    return f"SELECT *, {delta} AS delta FROM lineitem WHERE {delta} <= (SELECT max(d) FROM (SELECT {delta} AS d FROM lineitem ORDER BY d LIMIT 20000))"


def _large(spark: SparkSession, sf_dir: str, delta: str) -> DataFrame:
    return scan_since(read(spark, sf_dir, "lineitem").withColumn("delta", F.expr(delta)), "delta", None, 20_000)


@query(_sql_large("l_extendedprice"))
def delta_large_limit_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large limit on a fractional delta: the cut is found by pivots, in passes that only count."""
    return _large(spark, sf_dir, "l_extendedprice")


_DECIMAL = "CAST(l_partkey AS DECIMAL(25, 2)) * 1000000000000 + l_suppkey"


@query(_sql_large(f"CAST({_DECIMAL} AS DECIMAL(38, 2))"))
def delta_large_limit_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _large(spark, sf_dir, f"CAST({_DECIMAL} AS DECIMAL(38, 2))")


@query(_sql_large("l_returnflag || l_orderkey"))
def delta_large_limit_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _large(spark, sf_dir, "l_returnflag || l_orderkey")


_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_linenumber END"


@query(f"SELECT *, CAST({_HOT} AS BIGINT) AS delta FROM lineitem ORDER BY delta, l_partkey, l_orderkey, l_linenumber, l_extendedprice LIMIT 45000")
def delta_large_limit_hot_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict limit that ends among a third of all rows, which share one delta: a second search goes through the other columns."""
    rows = read(spark, sf_dir, "lineitem").withColumn("delta", F.expr(_HOT).cast("bigint"))
    keys = ["l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return scan_since(rows, "delta", None, 45_000, keys, ties="strict")


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def delta_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta scan over the layout sorted by the delta column."""
    path = scratch_dir(spark, "layout")
    write_delta_layout(read(spark, sf_dir, "events"), "ts", path)
    return scan_since(spark.read.parquet(path), "ts", instant("2024-01-20 00:00:00"))


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def delta_layout_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta scan over a layout that took in two increments after its first rows."""
    events = read(spark, sf_dir, "events")
    layout = DeltaLayout(spark, scratch_dir(spark, "ranges"), events.schema, "ts", range_rows=events.count() // 6 + 1)
    first = (F.col("ts") <= instant("2024-01-15 00:00:00")) & (F.col("event_id") % 7 != 0)
    layout.add(events.where(first))
    layout.add(events.where(F.col("ts") > instant("2024-01-15 00:00:00")))
    layout.add(events.where(~first & (F.col("ts") <= instant("2024-01-15 00:00:00"))))
    return layout.since(instant("2024-01-10 00:00:00"))


_DELTAS = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, coalesce(max({c}), TIMESTAMP '1970-01-01') AS watermark FROM {t}"
        for t, c in [*_DELTAS.items()]
    )
    + " UNION ALL SELECT 'no_rows', coalesce(max(ts), TIMESTAMP '1970-01-01') FROM events WHERE ts IS NULL"
)
def high_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest delta of each table; a table without one starts at the epoch."""
    marks = [
        high_watermark(read(spark, sf_dir, t), c).select(F.lit(t).alias("table_name"), "watermark")
        for t, c in _DELTAS.items()
    ]
    nothing = read(spark, sf_dir, "events").where("ts IS NULL")
    marks.append(high_watermark(nothing, "ts").select(F.lit("no_rows").alias("table_name"), "watermark"))
    return marks[0].unionByName(marks[1]).unionByName(marks[2]).unionByName(marks[3])


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    + " ORDER BY table_name"
)
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({t: read(spark, sf_dir, t) for t in TABLES})


# -- catalogs ------------------------------------------------------------------------------------


@query(
    "SELECT 't_' || o_orderkey AS table_name FROM orders "
    "WHERE o_orderkey % 10 <> 0 AND o_orderstatus <> 'O' ORDER BY table_name"
)
def catalog_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_tables(inputs.catalog_tables(spark, sf_dir))


@query(
    "SELECT table_name, column_name, data_type, ordinal_position "
    f"FROM ({inputs.SQL_CATALOG_COLUMNS}) WHERE table_schema = 'public'"
)
def catalog_describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_columns(inputs.catalog_columns(spark, sf_dir))


@query(inputs.SQL_PRIMARY_KEYS)
def catalog_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_key_columns(inputs.catalog_constraints(spark, sf_dir), inputs.catalog_key_usage(spark, sf_dir))


@query(
    f"SELECT c.*, m.spark_type FROM ({inputs.SQL_CATALOG_COLUMNS}) c "
    f"JOIN ({inputs.SQL_TYPE_MAP}) m ON c.data_type = m.src_type"
)
def type_map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_types(inputs.catalog_columns(spark, sf_dir))


@query(
    "SELECT *, 'unsupported column type ' || data_type || ' for column ' || column_name AS error "
    f"FROM ({inputs.SQL_CATALOG_COLUMNS}) WHERE data_type NOT IN "
    f"(SELECT src_type FROM ({inputs.SQL_TYPE_MAP}))"
)
def unsupported_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unsupported_columns(inputs.catalog_columns(spark, sf_dir))


@query(
    f"""
    WITH cols AS ({inputs.SQL_CATALOG_COLUMNS}),
    tables AS (
        SELECT table_schema, table_name,
               string_agg(column_name || ' ' || upper(spark_type), ', ' ORDER BY ordinal_position) AS defs,
               string_agg(column_name, ', ' ORDER BY ordinal_position) AS all_columns
        FROM cols LEFT JOIN ({inputs.SQL_TYPE_MAP}) m ON data_type = src_type
        GROUP BY ALL HAVING bool_and(spark_type IS NOT NULL)),
    keys AS (
        SELECT table_schema, table_name, string_agg(column_name, ', ' ORDER BY ordinal_position) AS primary_key
        FROM ({inputs.SQL_PRIMARY_KEYS}) GROUP BY ALL)
    SELECT t.table_schema, t.table_name,
           'CREATE TABLE IF NOT EXISTS ' || t.table_schema || '.' || t.table_name || ' (' || defs
               || ') USING parquet' AS ddl,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'versioned' ELSE 'append' END AS kind,
           CASE WHEN o_orderpriority = '1-URGENT' THEN coalesce(primary_key, all_columns) END AS key_columns,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'updated_at' END AS version_column
    FROM tables t LEFT JOIN keys k ON t.table_schema = k.table_schema AND t.table_name = k.table_name
         LEFT JOIN orders ON t.table_name = 't_' || o_orderkey
    """
)
def catalog_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table definition for every table of the catalog; tables with unknown types give none."""
    keys = primary_key_columns(inputs.catalog_constraints(spark, sf_dir), inputs.catalog_key_usage(spark, sf_dir))
    return build_ddl(inputs.catalog_columns(spark, sf_dir), inputs.catalog_specs(spark, sf_dir), keys)


# -- types and scalars ---------------------------------------------------------------------------


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_totalprice AS DOUBLE) AS price,
           date_trunc('second', o_orderdate + to_microseconds(o_orderkey)) AS updated_at,
           lower(substr(md5(o_orderpriority), 1, 8) || '-' || substr(md5(o_orderpriority), 9, 4) || '-'
               || substr(md5(o_orderpriority), 13, 4) || '-' || substr(md5(o_orderpriority), 17, 4) || '-'
               || substr(md5(o_orderpriority), 21, 12)) AS token,
           CAST(o_custkey AS SMALLINT) AS customer, o_orderstatus = 'F' AS done, CAST(o_orderdate AS DATE) AS day
    FROM orders
    """
)
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of several source types cast to their targets, with times cut to seconds."""
    named = lambda name, text: {"metadata": {"src_type": text}}
    orders = read(spark, sf_dir, "orders")
    # A source whose customers have outgrown a smallint holds them in a wider column.
    customers = whole_type(*orders.agg(F.min("o_custkey"), F.max("o_custkey")).first())
    source = orders.select(
        F.col("o_orderkey").cast("string").alias("id", **named("id", "bigint")),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price", **named("price", "numeric")),
        F.timestamp_add("MICROSECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("updated_at"),
        F.unhex(F.md5("o_orderpriority")).alias("token", **named("token", "uuid")),
        F.col("o_custkey").alias("customer", **named("customer", customers)),
        F.when(F.col("o_orderstatus") == "F", "t").otherwise("f").alias("done", **named("done", "boolean")),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day", **named("day", "date")),
    )
    return conform(source, precision="second")


@query(
    """
    SELECT 'kept' AS part, count(*) AS n FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_type = 'error'
    """
)
def conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lenient form sets aside rows whose text is no number."""
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("user_id").cast("string"))
    source = read(spark, sf_dir, "events").select("event_id", text.alias("n", metadata={"src_type": "integer"}))
    parts = conform_lenient(source)
    count = F.count("*").alias("n")
    kept = parts.rows.agg(count).select(F.lit("kept").alias("part"), "n")
    return kept.unionByName(parts.rejects.agg(count).select(F.lit("rejected").alias("part"), "n"))


@query(
    """
    SELECT doc_id, substr(md5(text), 1, 8) || '-' || substr(md5(text), 9, 4) || '-' || substr(md5(text), 13, 4)
           || '-' || substr(md5(text), 17, 4) || '-' || substr(md5(text), 21, 12) AS uuid,
           CAST(NULL AS VARCHAR) AS short_uuid
    FROM documents
    """
)
def uuid_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The md5 bytes of each text as a uuid; 15 of the 16 bytes are none."""
    digest = F.unhex(F.md5("text"))
    return read(spark, sf_dir, "documents").select(
        "doc_id", uuid_text(digest).alias("uuid"), uuid_text(F.substring(digest, 1, 15)).alias("short_uuid")
    )


_NAMES = {"pages": "url", "customer": "c_name", "nation": "n_name", "part": "p_name", "documents": "source",
          "conversations": "text"}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS origin, {c} AS identifier, regexp_full_match({c}, '[a-zA-Z0-9_.]+') AS valid FROM {t}"
        for t, c in _NAMES.items()
    )
)
def valid_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        read(spark, sf_dir, t).select(F.lit(t).alias("origin"), F.col(c).alias("identifier")) for t, c in _NAMES.items()
    ]
    names = parts[0]
    for part in parts[1:]:
        names = names.unionByName(part)
    return names.withColumn("valid", valid_identifier(F.col("identifier")))


@query(
    """
    SELECT 't_' || l_orderkey AS table_name,
           CASE WHEN l_returnflag = 'R' THEN 'c ' || l_linenumber ELSE 'c_' || l_linenumber END AS column_name
    FROM lineitem WHERE l_returnflag = 'R'
    """
)
def catalog_invalid_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.when(F.col("l_returnflag") == "R", " ").otherwise("_")
    columns = read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("t_"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.concat(F.lit("c"), gap, F.col("l_linenumber").cast("string")).alias("column_name"),
    )
    return invalid_names(columns)


_LOGINS = "CASE page_id % 5 WHEN 0 THEN '://user:secret@' WHEN 1 THEN '://user@' WHEN 2 THEN '://a:b:c@' " \
          "WHEN 3 THEN '://user:se@cret@' ELSE '://' END"  # fmt: skip


@query(
    f"""
    WITH urls AS (SELECT page_id, replace(url, '://', {_LOGINS}) AS url FROM pages),
    cut AS (SELECT *, string_split(url, '@') AS cut_url, string_split(string_split(url, '@')[1], '://') AS head FROM urls)
    SELECT page_id, url,
           CASE WHEN len(cut_url) = 2 AND len(head) = 2 AND len(string_split(head[2], ':')) = 2
                THEN head[1] || '://' || string_split(head[2], ':')[1] || ':***@' || cut_url[2] ELSE url END AS redacted
    FROM cut
    """
)
def redact_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses given logins of several shapes, of which only `user:password@` is hidden."""
    urls = read(spark, sf_dir, "pages").select(
        "page_id", F.replace(F.col("url"), F.lit("://"), F.expr(_LOGINS)).alias("url")
    )
    return urls.withColumn("redacted", redact_url(F.col("url")))


@query(
    """
    SELECT event_id, rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS ts_text,
           strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day_text, CAST(user_id AS VARCHAR) AS user_text,
           printf('%.6f', value) AS value_text, event_type AS type_text
    FROM events
    """
)
def cursor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors of each kind as the run log prints them."""
    events = read(spark, sf_dir, "events")
    text = lambda c, of: cursor_text(c, events.schema[of].dataType)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return events.select(
        "event_id",
        text(F.col("ts"), "ts").alias("ts_text"),
        text(day, "ts").alias("day_text"),
        text(F.col("user_id"), "user_id").alias("user_text"),
        text(F.col("value"), "value").alias("value_text"),
        text(F.col("event_type"), "event_type").alias("type_text"),
    )


_UNITS = (("kB", 9), ("MB", 19), ("GB", 29), ("TB", 39), ("PB", 49))


@query(
    "SELECT doc_id, bytes, CASE WHEN bytes < 10240 THEN bytes || ' bytes' "
    + " ".join(
        f"WHEN bytes >> {shift} < 20479 THEN (((bytes >> {shift}) + 1) >> 1) || ' {unit}'" for unit, shift in _UNITS
    )
    + " END AS size FROM (SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) * (doc_id + 1) * (doc_id + 1) "
    "AS bytes FROM documents)"
)
def pretty_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("doc_id") + 1
    sizes = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length("text").cast("bigint") * place * place).alias("bytes")
    )
    return sizes.withColumn("size", pretty_size(F.col("bytes")))


@query(
    "SELECT event_id, least(100.0::DOUBLE, CAST(floor(value) AS BIGINT)::DOUBLE / 40::DOUBLE * 100) AS percentage, "
    "0.0::DOUBLE AS unknown_total FROM events"
)
def progress_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.floor("value").cast("bigint")
    return read(spark, sf_dir, "events").select(
        "event_id",
        progress_percent(rows, F.lit(40)).alias("percentage"),
        progress_percent(rows, F.lit(0)).alias("unknown_total"),
    )


@query(
    "SELECT count(*) AS keys, count(*) AS hashes FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"
)
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many key hashes as keys. Two levels of grouping keep the count of distinct values spread out."""
    keys = read(spark, sf_dir, "lineitem").groupBy(*LINE_KEY).agg(F.lit(1).alias("one"))
    hashes = keys.groupBy(dedup_key(LINE_KEY).alias("h")).agg(F.count("*").alias("n"))
    return hashes.agg(F.sum("n").alias("keys"), F.count("*").alias("hashes"))
