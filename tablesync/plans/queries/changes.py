"""Version logs, change capture and what compares a copy with its source."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators import contents
from tablesync.operators.contents import compare_tables, verify_sync
from tablesync.operators.schema import conform
from tablesync.operators.versions import classify_changes, current_view, join_on_key, late_rows, soft_delete_filter, version_stats
from tablesync.plans.inputs import LINE_COLUMNS, LINE_KEY, LINE_VERSION, instant, newest_sql, read
from tablesync.plans.queries.registry import query
from tablesync.session import scratch_dir
from tablesync.streaming.cdc import file_stream, poll_once
from tablesync.streaming.versionlog import VersionLog

SQL_CURRENT_LINES = newest_sql("SELECT * FROM lineitem", LINE_KEY, LINE_VERSION, LINE_COLUMNS)
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EARLY, LATE = "1998-01-01 00:00:00", "2000-01-01 00:00:00"


def _line_log(spark: SparkSession, sf_dir: str, label: str, buckets: int = 4) -> tuple[DataFrame, VersionLog]:
    lines = conform(read(spark, sf_dir, "lineitem"))
    root = scratch_dir(spark, label)
    return lines, VersionLog(spark, root, lines.schema, LINE_KEY, LINE_VERSION, buckets, "lineitem")


def _store(log: VersionLog, rows: DataFrame, batch_id: int) -> None:
    log.commit(log.append(rows, batch_id).last_seen, batch_id)


@query(SQL_CURRENT_LINES)
def current_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_view(read(spark, sf_dir, "lineitem"), LINE_KEY, LINE_VERSION)


@query(newest_sql("SELECT * FROM events", ["user_id"], "ts", EVENT_COLUMNS))
def current_events_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_view(read(spark, sf_dir, "events"), ["user_id"], "ts")


@query(
    "SELECT DISTINCT text, lang, source FROM "
    "(SELECT text, lang, source FROM documents UNION ALL SELECT text, lang, source || '+' FROM documents "
    "UNION ALL SELECT text, lang, source FROM documents)"
)
def current_no_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a key exact copies collapse and a changed row stays beside its old form."""
    rows = read(spark, sf_dir, "documents").select("text", "lang", "source")
    changed = rows.withColumn("source", F.concat("source", F.lit("+")))
    return current_view(rows.unionByName(changed).unionByName(rows), None)


@query(
    """
    SELECT CAST(sum(n) AS BIGINT) AS stored_versions, count(*) AS current_rows,
           CAST(sum(n - 1) AS BIGINT) AS superseded_versions,
           count(*) FILTER (WHERE n > 1) AS keys_with_versions, max(n) AS most_versions
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    """
)
def lineitem_version_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_stats(read(spark, sf_dir, "lineitem"), LINE_KEY)


@query(SQL_CURRENT_LINES)
def compacted_equals_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest versions first, then the oldest arrive late, and everything is compacted."""
    lines, log = _line_log(spark, sf_dir, "compact")
    version = F.col(LINE_VERSION)
    _store(log, lines.where(version > instant(LATE)), 0)
    _store(log, lines.where(version <= instant(EARLY)), 1)
    log.compact()
    _store(log, lines.where((version > instant(EARLY)) & (version <= instant(LATE))), 2)
    log.compact()
    return log.current()


@query(SQL_CURRENT_LINES)
def current_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted base with a later batch merged in as it is read."""
    lines, log = _line_log(spark, sf_dir, "merge")
    _store(log, lines.where(F.col(LINE_VERSION) <= instant(LATE)), 0)
    log.compact()
    _store(log, lines.where(F.col(LINE_VERSION) > instant(LATE)), 1)
    return log.current()


@query(SQL_CURRENT_LINES)
def current_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the keys, compacted, then the upper half: its compaction adds parts and rewrites nothing. Late
    versions of lower keys are merged as they are read, and the upper parts are read as they are."""
    lines, log = _line_log(spark, sf_dir, "parts")
    half = lines.agg(F.max(LINE_KEY[0])).first()[0]
    lower, late = F.col(LINE_KEY[0]) <= (half or 0) // 2, F.col(LINE_VERSION) > instant(LATE)
    _store(log, lines.where(lower & ~late), 0)
    log.compact()
    _store(log, lines.where(~lower), 1)
    log.compact()
    _store(log, lines.where(lower & late), 2)
    return log.current()


@query(SQL_CURRENT_LINES)
def current_after_bucket_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log written with four buckets and opened with eight: the next compaction deals all rows anew."""
    lines, log = _line_log(spark, sf_dir, "rebucket")
    _store(log, lines.where(F.col(LINE_VERSION) <= instant(LATE)), 0)
    log.compact()
    wider = replace(log, buckets=8)
    _store(wider, lines.where(F.col(LINE_VERSION) > instant(LATE)), 1)
    wider.compact()
    return wider.current()


@query(SQL_CURRENT_LINES)
def stream_after_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the early rows and a stream over the whole table's files after it."""
    lines, log = _line_log(spark, sf_dir, "snapshot-stream")
    _store(log, lines.where(F.col(LINE_VERSION) <= instant(EARLY)), 0)
    file_stream(spark, f"{sf_dir}/lineitem.parque[t]", log, scratch_dir(spark, "stream-checkpoint")).awaitTermination()
    return log.current()


@query(SQL_CURRENT_LINES)
def replay_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that died before its commit: compaction leaves it alone, the retry replaces it whole."""
    lines, log = _line_log(spark, sf_dir, "retry")
    log.append(lines.where(F.col(LINE_VERSION) <= instant(EARLY)), 0)
    log.compact()
    _store(log, lines, 0)
    log.compact()
    return log.current()


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
    "CAST(CAST(9007199254740992 AS DECIMAL(20, 0)) + o_orderkey AS DOUBLE) AS version FROM orders"
)
def cdc_decimal_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls over a decimal delta whose values differ by less than a double can tell: none is lost."""
    orders = read(spark, sf_dir, "orders")
    version = (F.lit(9007199254740992).cast("decimal(20,0)") + F.col("o_orderkey")).cast("decimal(20,0)")
    rows = orders.withColumn("version", version)
    log = VersionLog(spark, scratch_dir(spark, "decimal"), conform(rows).schema, ["o_orderkey"], "version", 1, "orders")
    third = rows.count() // 3 + 1
    while poll_once(rows, log, limit=third).rows:
        pass
    return log.current()


@query("SELECT * FROM orders")
def cdc_inclusive_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limited poll while only the even orders are there, then inclusive ones: they store all rows from the
    cursor on, those at the cursor too, each once. Odd orders before that cursor, and orders without a date, which no
    poll can see, are found against the log and stored as a batch of their own; from the cursor on the polls are left alone."""
    rows = conform(read(spark, sf_dir, "orders"))
    key, date = ["o_orderkey"], "o_orderdate"
    log = VersionLog(spark, scratch_dir(spark, "inclusive"), rows.schema, key, date, 1, "orders")
    third = rows.count() // 3 + 1
    poll_once(rows.where("o_orderkey % 2 = 0"), log, limit=third)
    start = log.cursor().literal(rows.schema[date].dataType)
    while poll_once(rows, log, inclusive=True).rows:
        pass
    unseen = F.col(date).isNull() if start is None else F.col(date).isNull() | (F.col(date) < start)
    stored = log.versions().where(unseen).select(*key, date).distinct()
    _store(log, join_on_key(rows.where(unseen), stored, [*key, date], "left_anti"), log.cursor().batch_id + 1)
    return log.versions().drop("_batch_id")


@query(SQL_CURRENT_LINES)
def cdc_two_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the early rows, and two polls that find the rest as the source grows."""
    lines, log = _line_log(spark, sf_dir, "polls", buckets=1)
    snapshot = log.append(lines.where(F.col(LINE_VERSION) <= instant(EARLY)), 0)
    log.commit(snapshot.last_seen, 0)
    poll_once(lines.where(F.col(LINE_VERSION) <= instant(LATE)), log)
    poll_once(lines, log)
    return log.current()


@query(
    f"""
    SELECT 1::BIGINT AS batch_id, 'cdc_update' AS event, count(*) AS row_count, max(l_shipdate) AS last_seen
    FROM lineitem WHERE l_shipdate > TIMESTAMP '{EARLY}' AND l_shipdate <= TIMESTAMP '{LATE}'
    UNION ALL SELECT 2, 'cdc_update', count(*), max(l_shipdate) FROM lineitem WHERE l_shipdate > TIMESTAMP '{LATE}'
    """
)
def cdc_poll_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event of each poll that found rows: how many, and where the cursor went. An empty poll has none."""
    lines, log = _line_log(spark, sf_dir, "poll-events", buckets=1)
    snapshot = log.append(lines.where(F.col(LINE_VERSION) <= instant(EARLY)), 0)
    log.commit(snapshot.last_seen, 0)
    found: list[tuple[int, str, int, str]] = []
    note = lambda _log, r: found.append((r.batch_id, "cdc_update", r.rows, r.last_seen))
    for limit in (EARLY, LATE, LATE, None):
        seen = lines if limit is None else lines.where(F.col(LINE_VERSION) <= instant(limit))
        poll_once(seen, log, on_poll=note)
    rows = spark.createDataFrame(found, "batch_id bigint, event string, row_count bigint, last_seen string")
    return rows.withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query(newest_sql("SELECT * FROM orders", ["o_orderkey"], "o_orderdate", [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
def cdc_limited_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls that take about a third of the orders each, with ties kept, until nothing is left."""
    rows = conform(read(spark, sf_dir, "orders"))
    log = VersionLog(spark, scratch_dir(spark, "limited"), rows.schema, ["o_orderkey"], "o_orderdate", 1, "orders")
    third = rows.count() // 3 + 1
    while poll_once(rows, log, limit=third).rows:
        pass
    return log.current()


@query(SQL_CURRENT_LINES)
def cdc_stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the table's files, started twice on one checkpoint: the second start adds nothing."""
    _, log = _line_log(spark, sf_dir, "stream")
    checkpoint = scratch_dir(spark, "stream-checkpoint")
    for _ in range(2):
        file_stream(spark, f"{sf_dir}/lineitem.parque[t]", log, checkpoint).awaitTermination()
    return log.current()


@query(
    "SELECT 'events' AS table_name, count(DISTINCT event_id) AS current_rows, count(*) AS stored FROM events "
    "UNION ALL SELECT 'orders', count(DISTINCT o_orderkey), count(*) FROM orders "
    "UNION ALL SELECT 'lineitem', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), "
    "count(*) FROM lineitem"
)
def cdc_streams_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams at once, each with its own log and checkpoint."""
    versions = {"events": (["event_id"], "ts"), "orders": (["o_orderkey"], "o_orderdate"),
                "lineitem": (LINE_KEY, LINE_VERSION)}
    root, checkpoints = scratch_dir(spark, "streams"), scratch_dir(spark, "stream-checkpoints")
    running, logs = [], {}
    for name, (keys, version) in versions.items():
        schema = conform(read(spark, sf_dir, name)).schema
        logs[name] = VersionLog(spark, f"{root}/{name}", schema, keys, version, 1, name)
        running.append(file_stream(spark, f"{sf_dir}/{name}.parque[t]", logs[name], f"{checkpoints}/{name}"))
    for stream in running:
        stream.awaitTermination()
    counts = [
        log.current().agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit("c").alias("kind"), "n")
        for name, log in logs.items()
    ] + [
        log.versions().agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit("s").alias("kind"), "n")
        for name, log in logs.items()
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("n")))
    return rows.groupBy("table_name").agg(of("c").alias("current_rows"), of("s").alias("stored"))


@query("SELECT * FROM lineitem")
def cdc_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is stored twice under one number is stored once."""
    lines, log = _line_log(spark, sf_dir, "replay")
    for batch_id in (0, 1, 1):
        late = F.col(LINE_VERSION) > instant(LATE)
        log.append(lines.where(late if batch_id else ~late), batch_id)
    return log.versions().select(*LINE_COLUMNS)


@query("SELECT * FROM (SELECT *, 0::BIGINT AS batch FROM orders) UNION ALL "
       "SELECT *, 1::BIGINT FROM orders WHERE o_orderstatus = 'P'")  # fmt: skip
def snapshot_with_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored versions of a snapshot and a later batch: the union of both."""
    rows = conform(read(spark, sf_dir, "orders"))
    log = VersionLog(spark, scratch_dir(spark, "union"), rows.schema, ["o_orderkey"], "o_orderdate", 1, "orders")
    log.append(rows, 0)
    log.append(rows.where("o_orderstatus = 'P'"), 1)
    return log.versions().withColumnRenamed("_batch_id", "batch")


_SQL_EARLY = newest_sql(
    f"SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '{EARLY}'", LINE_KEY, LINE_VERSION, LINE_COLUMNS
)


@query(
    f"""
    SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, d.l_shipdate,
           CASE WHEN c.l_orderkey IS NULL THEN 'insert' WHEN d.l_shipdate > c.l_shipdate THEN 'update'
                ELSE 'unchanged' END AS change
    FROM lineitem d LEFT JOIN ({_SQL_EARLY}) c ON d.l_orderkey = c.l_orderkey AND d.l_linenumber = c.l_linenumber
    WHERE d.l_shipdate > TIMESTAMP '1997-01-01'
    """
)
def change_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta that overlaps what is stored, sorted into inserts, updates and rows seen before."""
    lines = read(spark, sf_dir, "lineitem")
    stored = current_view(lines.where(F.col(LINE_VERSION) <= instant(EARLY)), LINE_KEY, LINE_VERSION)
    delta = lines.where(F.col(LINE_VERSION) > instant("1997-01-01 00:00:00"))
    delta = delta.select(*LINE_KEY, "l_partkey", LINE_VERSION)
    return classify_changes(delta, stored, LINE_KEY, LINE_VERSION)


@query(
    f"""
    SELECT * FROM lineitem s WHERE l_shipdate <= TIMESTAMP '{LATE}' AND NOT EXISTS
        (SELECT 1 FROM lineitem t WHERE t.l_returnflag <> 'R' AND t.l_orderkey = s.l_orderkey
           AND t.l_linenumber = s.l_linenumber AND t.l_shipdate = s.l_shipdate)
    """
)
def rows_missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at or before the cursor that the target never got: here the returned ones came too late."""
    lines = read(spark, sf_dir, "lineitem")
    arrived = lines.where("l_returnflag <> 'R'")
    return late_rows(lines, arrived, LINE_KEY, LINE_VERSION, instant(LATE))


_UNLIKE = "l_returnflag = 'A' AND l_linenumber = 3"
_AHEAD = "l_returnflag = 'N' AND l_linenumber = 5"


def _copy_with_faults(lines: DataFrame) -> DataFrame:
    """A target without the late versions, with unlike rows of the same version, newer ones, and keys of its own."""
    own = lines.where("l_linestatus = 'F'").withColumn("l_orderkey", -F.col("l_orderkey") - 1)
    kept = lines.where(F.col(LINE_VERSION) <= instant(LATE))
    quantity = F.when(F.expr(_UNLIKE), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    version = F.when(F.expr(_AHEAD), F.col(LINE_VERSION) + F.expr("INTERVAL 400 DAYS")).otherwise(F.col(LINE_VERSION))
    return kept.withColumns({"l_quantity": quantity, LINE_VERSION: version}).unionByName(own)


_SQL_COMPARED = f"""
    WITH copy AS (
        SELECT * REPLACE (CASE WHEN {_UNLIKE} THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
                          CASE WHEN {_AHEAD} THEN l_shipdate + INTERVAL 400 DAYS ELSE l_shipdate END AS l_shipdate)
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '{LATE}'
        UNION ALL SELECT * REPLACE (-l_orderkey - 1 AS l_orderkey) FROM lineitem WHERE l_linestatus = 'F'),
    s AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS v, list_sort(list(CAST(r AS VARCHAR))) AS held FROM lineitem r GROUP BY ALL),
    t AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS v, list_sort(list(CAST(r AS VARCHAR))) AS held FROM copy r GROUP BY ALL)
    SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
           s.v AS source_version, t.v AS target_version,
           CASE WHEN t.v IS NULL THEN 'missing' WHEN s.v IS NULL THEN 'extra' WHEN t.v < s.v THEN 'stale' WHEN t.v > s.v THEN 'ahead'
                WHEN s.held <> t.held THEN 'differs' ELSE 'same' END AS status
    FROM s FULL JOIN t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber
"""


@query(_SQL_COMPARED)
def compare_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return compare_tables(lines, _copy_with_faults(lines), LINE_KEY, LINE_VERSION)


@query(f"SELECT * FROM ({_SQL_COMPARED}) WHERE status <> 'same'")
def compare_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that are not the same in a copy, found by digests of buckets and, in those that differ, by key."""
    lines = read(spark, sf_dir, "lineitem")
    return contents.compare_contents(lines, _copy_with_faults(lines), LINE_KEY, LINE_VERSION)


_COUNTS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in contents.STATUSES)


@query(f"SELECT * FROM (SELECT count(*) AS source_rows, count(*) FILTER (WHERE l_shipdate <= TIMESTAMP '{LATE}') + "
       f"count(*) FILTER (WHERE l_linestatus = 'F') AS target_rows FROM lineitem), (SELECT {_COUNTS} FROM ({_SQL_COMPARED}))")  # fmt: skip
def content_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return contents.content_report(lines, _copy_with_faults(lines), LINE_KEY, LINE_VERSION)


@query(
    f"""
    SELECT count(*) FILTER (WHERE status <> 'extra') AS source_keys,
           count(*) FILTER (WHERE status <> 'missing') AS target_keys, {_COUNTS} FROM ({_SQL_COMPARED})
    """
)
def sync_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return verify_sync(lines, _copy_with_faults(lines), LINE_KEY, LINE_VERSION)


@query(
    "SELECT * FROM ("
    + newest_sql(
        "SELECT *, CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS deleted_at FROM lineitem",
        LINE_KEY,
        LINE_VERSION,
        [*LINE_COLUMNS, "deleted_at"],
    )
    + ") WHERE deleted_at IS NULL"
)
def soft_delete_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose newest version is not marked deleted."""
    deleted = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    lines = read(spark, sf_dir, "lineitem").withColumn("deleted_at", deleted)
    return soft_delete_filter(current_view(lines, LINE_KEY, LINE_VERSION))
