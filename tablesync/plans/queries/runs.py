"""Runs over many tables, the run log, and latency statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.operators import runlog
from tablesync.operators.latency import latency_mean_std, latency_percentiles, latency_report, tail_flags
from tablesync.plans import inputs
from tablesync.plans.ingest import RunLog, Target, ingest_tables, results_table, run_job
from tablesync.plans.inputs import TABLES
from tablesync.plans.queries.registry import query
from tablesync.plans.spec import Polling, RunConfig, TableConfig, TableSpec, invalid_specs, resolve_spec_table, resolve_specs
from tablesync.session import scratch_dir
from tablesync.sources.tables import FileSource

# -- runs ----------------------------------------------------------------------------------------

_VERSIONED = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "events": ["event_id"]}


def _all_tables() -> RunConfig:
    tables = [
        TableConfig(t, polling=Polling(True, _VERSIONED[t], 60) if t in _VERSIONED else None) for t in TABLES
    ]
    return RunConfig(tables=tables)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = FileSource(spark, sf_dir, _KEYS)
    target = Target(spark, scratch_dir(spark, "run"))
    results = ingest_tables(source, resolve_specs(_all_tables()), target, RunLog("run"))
    return results_table(spark, results)


_SQL_RUN = " UNION ALL ".join(
    f"SELECT '{t}' AS name, false AS success, 'DDL generation failed: unsupported column type ARRAY for column "
    f"embedding' AS error, CAST(0 * count(*) AS BIGINT) AS rows FROM {t}"
    if t == "embeddings"
    else f"SELECT '{t}' AS name, true AS success, CAST(NULL AS VARCHAR) AS error, count(*) AS rows FROM {t}"
    for t in TABLES
)


@query(_SQL_RUN)
def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables copied at once; the one with an array column fails alone."""
    return _run(spark, sf_dir).select("name", "success", "error", "rows")


@query(
    f"""
    SELECT count(*) AS tables, count(*) FILTER (WHERE success) AS succeeded,
           count(*) FILTER (WHERE NOT success) AS failed, CAST(sum(rows) AS BIGINT) AS total_rows FROM ({_SQL_RUN})
    """
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_summary(_run(spark, sf_dir))


@query(
    f"""
    SELECT name AS "table", CASE WHEN success THEN 'completed' ELSE 'failed' END AS status,
           rows AS current_rows, error FROM ({_SQL_RUN})
    """
)
def run_job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table states of a run, read from the job, results and events it logged."""
    source = FileSource(spark, sf_dir, _KEYS)
    run = run_job(source, resolve_specs(_all_tables()), Target(spark, scratch_dir(spark, "job")))
    return runlog.table_status(run.job, run.results, run.progress).select("table", "status", "current_rows", "error")


# -- specs ---------------------------------------------------------------------------------------


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_polling = Polling(True, "updated_at", 60)
    return resolve_spec_table(inputs.table_specs(spark, sf_dir), limit=100, polling=run_polling)


@query(inputs.SQL_RESOLVED_SPECS)
def resolved_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select("name", "limit", "batch_size", "polling.*")


@query(
    f"""
    WITH s AS ({inputs.SQL_RESOLVED_SPECS})
    SELECT name, 'table name is missing' AS error FROM s WHERE trim(name) = ''
    UNION ALL SELECT name, 'batch size must be at least 1' FROM s WHERE batch_size < 1
    UNION ALL SELECT name, 'limit must not be negative' FROM s WHERE "limit" < 0
    UNION ALL SELECT name, 'polling needs a delta column' FROM s WHERE enabled AND delta_column = ''
    UNION ALL SELECT name, 'polling interval must be greater than 0' FROM s WHERE enabled AND interval_seconds <= 0
    UNION ALL SELECT name, 'listed ' || count(*) || ' times' FROM s GROUP BY name HAVING count(*) > 1
    """
)
def spec_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_specs(_resolved(spark, sf_dir))


# -- run log -------------------------------------------------------------------------------------

_SQL_NAMED = f"SELECT * FROM ({inputs.SQL_PROGRESS}) WHERE trim(\"table\") <> ''"
_SQL_LATEST = f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_id, "table"
        ORDER BY "timestamp" DESC, seq DESC) AS rn FROM ({_SQL_NAMED})) WHERE rn = 1
"""


@query(_SQL_NAMED)
def progress_percent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.progress_events(inputs.progress(spark, sf_dir))


@query(_SQL_LATEST)
def latest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.latest_progress(inputs.progress(spark, sf_dir))


_SQL_LAST_RESULT = f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_id, name ORDER BY seq DESC) AS rn
        FROM ({inputs.SQL_RESULTS}) WHERE name <> '') WHERE rn = 1
"""
_SQL_STATUS = f"""
    SELECT k.job_id, k."table",
           CASE WHEN r.name IS NOT NULL THEN CASE WHEN coalesce(r.error, '') <> '' THEN 'failed' ELSE 'completed' END
                WHEN u.event IS NULL THEN 'pending' WHEN u.event = 'error' THEN 'failed'
                WHEN u.phase <> '' THEN u.phase ELSE 'extracting' END AS status,
           CASE WHEN r.name IS NOT NULL THEN r.rows
                ELSE coalesce(nullif(u.current_rows, 0), nullif(u.row_count, 0), 0) END AS current_rows,
           CASE WHEN r.name IS NOT NULL THEN 100.0::DOUBLE ELSE coalesce(u.percentage, 0.0::DOUBLE) END AS percentage,
           CASE WHEN r.name IS NOT NULL THEN r.error WHEN u.event = 'error' THEN u.message END AS error
    FROM (SELECT job_id, "table" FROM ({inputs.SQL_JOB_TABLES})
          UNION SELECT job_id, name FROM ({_SQL_LAST_RESULT})) k
         LEFT JOIN ({_SQL_LAST_RESULT}) r ON k.job_id = r.job_id AND k."table" = r.name
         LEFT JOIN ({_SQL_LATEST}) u ON k.job_id = u.job_id AND k."table" = u."table"
"""


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = (f(spark, sf_dir) for f in (inputs.jobs, inputs.results, inputs.progress))
    return runlog.table_status(*log)


@query(_SQL_STATUS)
def table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir)


@query(
    f"""
    SELECT id, 6 AS total_tables, coalesce(c, 0) AS completed_tables, coalesce(f, 0) AS failed_tables,
           coalesce(c, 0) / 6 * 100 AS percentage, coalesce(n, 0) AS total_rows
    FROM ({inputs.SQL_JOBS}) LEFT JOIN (
        SELECT job_id, count(*) FILTER (WHERE status = 'completed') AS c,
               count(*) FILTER (WHERE status = 'failed') AS f, CAST(sum(current_rows) AS BIGINT) AS n
        FROM ({_SQL_STATUS}) GROUP BY job_id) ON id = job_id
    """
)
def job_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.job_rollup(inputs.jobs(spark, sf_dir), _status(spark, sf_dir))


_SQL_JOB_STATUS = f"""
    SELECT id, start_time,
           CASE WHEN error IS NOT NULL THEN 'failed' WHEN ended >= 5 AND bad > 0 THEN 'failed'
                WHEN ended >= 5 THEN 'completed' WHEN ended IS NOT NULL OR events IS NOT NULL THEN 'running'
                ELSE 'pending' END AS status
    FROM ({inputs.SQL_JOBS}) j
         LEFT JOIN (SELECT job_id, count(*) AS ended, count(*) FILTER (WHERE NOT success) AS bad
                    FROM ({_SQL_LAST_RESULT}) GROUP BY job_id) r ON j.id = r.job_id
         LEFT JOIN (SELECT job_id, count(*) AS events FROM ({inputs.SQL_PROGRESS}) GROUP BY job_id) p
              ON j.id = p.job_id
"""


def _job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = (f(spark, sf_dir) for f in (inputs.jobs, inputs.results, inputs.progress))
    return runlog.job_status(*log)


@query(_SQL_JOB_STATUS)
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_status(spark, sf_dir)


@query(
    f"""
    SELECT count(*) AS all_jobs, count(*) FILTER (WHERE status IN ('running', 'pending')) AS running,
           count(*) FILTER (WHERE status = 'completed') AS completed,
           count(*) FILTER (WHERE status = 'failed') AS failed FROM ({_SQL_JOB_STATUS})
    """
)
def jobs_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.jobs_by_state(_job_status(spark, sf_dir))


@query(f"SELECT id, start_time FROM ({inputs.SQL_JOBS}) ORDER BY start_time DESC, id LIMIT 50")
def latest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.latest_jobs(inputs.jobs(spark, sf_dir).select("id", "start_time"), 50)


def _sql_last(value: str, name: str) -> str:
    return f'arg_max({value}, struct_pack(t := "timestamp", s := seq)) FILTER (WHERE ({value}) IS NOT NULL) AS {name}'


@query(
    f"""
    SELECT job_id, "table", coalesce(current_rows, 0) AS current_rows, coalesce(total_rows, 0) AS total_rows,
           coalesce(percentage, 0.0::DOUBLE) AS percentage, coalesce(status, 'pending') AS status, error, updated_at
    FROM (SELECT job_id, "table",
                 {_sql_last("coalesce(nullif(current_rows, 0), nullif(row_count, 0))", "current_rows")},
                 {_sql_last("nullif(total_rows, 0)", "total_rows")},
                 {_sql_last("nullif(percentage, 0.0::DOUBLE)", "percentage")},
                 {_sql_last("CASE event WHEN 'completed' THEN 'completed' WHEN 'error' THEN 'failed' "
                            "ELSE nullif(phase, '') END", "status")},
                 max("timestamp") AS updated_at FROM ({_SQL_NAMED}) GROUP BY job_id, "table") f
         JOIN (SELECT job_id, "table", CASE WHEN event = 'error' THEN message END AS error FROM ({_SQL_LATEST})) l
              USING (job_id, "table")
    """
)
def progress_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.progress_fold(inputs.progress(spark, sf_dir))


@query(
    f"""
    SELECT id AS job_id, 't0' AS "table", 'updated_at' AS delta_column, interval0 AS interval_seconds
    FROM ({inputs.SQL_JOBS}) WHERE polls0
    UNION ALL SELECT id, 't1', 'created_at', 60 FROM ({inputs.SQL_JOBS}) WHERE polls1
    """
)
def cdc_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.cdc_badges(inputs.jobs(spark, sf_dir))


@query(
    f"""
    SELECT s.id AS job_id, 'job_completed' AS event,
           'Job ended: ' || status || ', polls active' AS message
    FROM ({_SQL_JOB_STATUS}) s JOIN ({inputs.SQL_JOBS}) j ON s.id = j.id
    WHERE status IN ('completed', 'failed') AND (polls0 OR polls1)
    """
)
def job_completed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.job_completed_events(inputs.jobs(spark, sf_dir), _job_status(spark, sf_dir))


@query(
    f"""
    SELECT count(*) AS tables, count(*) FILTER (WHERE success) AS succeeded,
           count(*) FILTER (WHERE NOT success) AS failed,
           CAST(coalesce(sum(rows) FILTER (WHERE success), 0) AS BIGINT) AS total_rows FROM ({inputs.SQL_RESULTS})
    """
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_summary(inputs.results(spark, sf_dir))


@query(
    f"""
    SELECT total_rows, seconds, total_rows / seconds AS rows_per_sec
    FROM (SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(duration) AS BIGINT) / 1e9::DOUBLE AS seconds
          FROM ({inputs.SQL_RESULTS}) WHERE success)
    """
)
def run_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_throughput(inputs.results(spark, sf_dir))


# -- latency -------------------------------------------------------------------------------------

_SQL_PERCENTILES = f"""
    SELECT name, max(n) AS n, min(duration_ns) AS min_ns,
           max(duration_ns) FILTER (WHERE rn = least(floor(n * 0.50::DOUBLE) + 1, n)) AS p50_ns,
           max(duration_ns) FILTER (WHERE rn = least(floor(n * 0.95::DOUBLE) + 1, n)) AS p95_ns,
           max(duration_ns) FILTER (WHERE rn = least(floor(n * 0.99::DOUBLE) + 1, n)) AS p99_ns,
           max(duration_ns) FILTER (WHERE rn = least(floor(n * 0.999::DOUBLE) + 1, n)) AS p999_ns,
           max(duration_ns) AS max_ns
    FROM (SELECT name, duration_ns, row_number() OVER (PARTITION BY name ORDER BY duration_ns) AS rn,
                 count(*) OVER (PARTITION BY name) AS n FROM ({inputs.SQL_DURATIONS})) GROUP BY name
"""
_SQL_MEAN = f"""
    SELECT name, n, mean_ns, CAST(floor(sqrt(var + (avg - mean_ns) * (avg - mean_ns))) AS BIGINT) AS stddev_ns,
           1e9::DOUBLE / mean_ns AS ops_per_sec
    FROM (SELECT name, count(*) AS n, CAST(sum(duration_ns) // count(*) AS BIGINT) AS mean_ns,
                 avg(duration_ns) AS avg, var_pop(duration_ns) AS var FROM ({inputs.SQL_DURATIONS}) GROUP BY name)
"""


@query(_SQL_PERCENTILES)
def latency_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_percentiles(inputs.durations(spark, sf_dir))


@query(_SQL_MEAN)
def latency_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_mean_std(inputs.durations(spark, sf_dir))


@query(
    f"""
    SELECT * FROM (
        SELECT name, p99_ns > p95_ns * 2 AS high_tail, p99_ns / p95_ns AS p99_p95_ratio,
               contains(name, 'Insert') AND ops_per_sec < 10 AS slow_insert,
               contains(name, 'Extract') AND p50_ns / 1e9 > 0.5 AS slow_extract, p95_ns < p50_ns * 2 AS healthy
        FROM ({_SQL_PERCENTILES}) JOIN ({_SQL_MEAN}) USING (name))
    WHERE high_tail OR slow_insert OR slow_extract
    """
)
def latency_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tail_flags(latency_report(inputs.durations(spark, sf_dir)))


_COPIED = ("events", "lineitem", "orders")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS rising FROM {t}" for t in _COPIED))
def progress_while_copying(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows reported while tables are copied, kept in a progress table: they rise, up to all rows of each table."""
    path = scratch_dir(spark, "progress")
    specs = [TableSpec(t) for t in _COPIED]
    run = run_job(FileSource(spark, sf_dir), specs, Target(spark, scratch_dir(spark, "watched")), "watched", progress=path)
    told = run.progress.where("event = 'inserting' AND phase = 'inserting'")
    before = F.lag("current_rows", 1, 0).over(Window.partitionBy("table").orderBy("seq"))
    told = told.withColumn("rising", F.col("current_rows") >= before)
    return told.groupBy(F.col("table").alias("table_name")).agg(F.max("current_rows").alias("row_count"), F.bool_and("rising").alias("rising"))
