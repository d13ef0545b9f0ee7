"""Queries on the run log: jobs, the results of their tables, and the events on the way.

The three inputs are flat tables, so that a job with a third of all events is spread over tasks:

* jobs `(id, tables array, table_configs array, start_time, error, …)`
* results `(job_id, name, success, error, rows, duration, seq)`
* progress `(job_id, table, event, message, row_count, current_rows, total_rows, percentage, phase, timestamp, seq)`

Everything per table or per job is a grouping whose aggregates combine on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import progress_percent
from tablesync.operators.versions import newest

# Fixed value: an event without a phase counts as this one.
DEFAULT_PHASE = "extracting"


def _named(table: Column) -> Column:
    return F.trim(table) != ""


def _if_set(value: Column) -> Column:
    """The value, or NULL when it is 0, blank or missing: a report that leaves a field out."""
    return F.when(value != 0, value)


def _if_text(value: Column) -> Column:
    return F.when(value != "", value)


def progress_events(progress: DataFrame) -> DataFrame:
    """The events of named tables with the percentage of their rows worked out from the counts."""
    share = progress_percent(F.col("current_rows"), F.col("total_rows"))
    return progress.where(_named(F.col("table"))).withColumn("percentage", share)


def latest_progress(progress: DataFrame) -> DataFrame:
    """The last event of every table of every job, in log order; blank table names are skipped."""
    return newest(progress.where(_named(F.col("table"))), ["job_id", "table"], ["timestamp", "seq"])


def table_status(jobs: DataFrame, results: DataFrame, progress: DataFrame) -> DataFrame:
    """Where every table of every job stands.

    A result beats events: `failed` when it has an error, else `completed`. Without one, the last
    event decides: `failed` for an error, else its phase, `extracting` when it names none. A listed
    table with neither is `pending`. Events of a table that was never listed do not count.
    """
    key = ["job_id", "table"]
    listed = jobs.select(F.col("id").alias("job_id"), F.explode("tables").alias("table"))
    last_event = F.struct("timestamp", "seq", "event", "message", "row_count", "current_rows", "total_rows",
                          "percentage", "phase")
    last_result = F.struct("seq", "error", "rows")
    event_type = progress.select(last_event.alias("x")).schema["x"].dataType
    result_type = results.select(last_result.alias("x")).schema["x"].dataType
    parts = [
        listed.select(*key, F.lit(True).alias("known"), F.lit(None).cast(result_type).alias("result"),
                      F.lit(None).cast(event_type).alias("update")),
        results.select("job_id", F.col("name").alias("table"), F.lit(True), last_result,
                       F.lit(None).cast(event_type)).toDF(*key, "known", "result", "update"),
        progress.select(*key, F.lit(False), F.lit(None).cast(result_type), last_event).toDF(
            *key, "known", "result", "update"
        ),
    ]
    merged = parts[0].union(parts[1]).union(parts[2]).where(_named(F.col("table")))
    tables = merged.groupBy(*key).agg(
        F.bool_or("known").alias("known"), F.max("result").alias("r"), F.max("update").alias("u")
    )
    r, u = F.col("r"), F.col("u")
    is_error = u["event"] == "error"
    result_error = _if_text(r["error"])
    status = (
        F.when(r.isNotNull(), F.when(result_error.isNotNull(), "failed").otherwise("completed"))
        .when(u.isNull(), "pending")
        .when(is_error, "failed")
        .otherwise(F.coalesce(_if_text(u["phase"]), F.lit(DEFAULT_PHASE)))
    )
    event_rows = F.coalesce(_if_set(u["current_rows"]), _if_set(u["row_count"]), F.lit(0).cast("bigint"))
    return tables.where("known").select(
        *key,
        status.alias("status"),
        F.when(r.isNotNull(), F.coalesce(r["rows"], F.lit(0))).otherwise(event_rows).alias("current_rows"),
        F.when(r.isNotNull(), F.lit(100.0))
        .otherwise(F.coalesce(u["percentage"], F.lit(0.0)))
        .alias("percentage"),
        F.when(r.isNotNull(), result_error).when(is_error, u["message"]).alias("error"),
    )


def job_rollup(jobs: DataFrame, status: DataFrame) -> DataFrame:
    """Per job: tables listed, completed and failed, the share completed, rows of all its tables."""
    per_job = status.groupBy(F.col("job_id").alias("id")).agg(
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("current_rows").alias("rows"),
    )
    total = F.coalesce(F.size("tables"), F.lit(0))
    zero = F.lit(0).cast("bigint")
    completed = F.coalesce("completed", zero)
    return jobs.join(per_job, "id", "left").select(
        "id",
        total.alias("total_tables"),
        completed.alias("completed_tables"),
        F.coalesce("failed", zero).alias("failed_tables"),
        F.when(total > 0, completed / total * 100).otherwise(0.0).alias("percentage"),
        F.coalesce("rows", zero).alias("total_rows"),
    )


def job_status(jobs: DataFrame, results: DataFrame, progress: DataFrame) -> DataFrame:
    """The state of each job, derived from its log.

    `failed` on a job error, or when all its tables have a result and one of them failed; `completed`
    when all succeeded; `running` once anything was logged; else `pending`.
    """
    ended = results.where(_named(F.col("name"))).groupBy("job_id", "name").agg(F.max_by("success", "seq").alias("ok"))
    ended = ended.groupBy(F.col("job_id").alias("id")).agg(
        F.count("*").alias("ended"), F.count_if(~F.col("ok")).alias("bad")
    )
    logged = progress.groupBy(F.col("job_id").alias("id")).agg(F.count("*").alias("events"))
    names = F.size(F.array_distinct(F.filter("tables", _named)))
    all_ended = F.coalesce("ended", F.lit(0)) >= names
    status = (
        F.when(_if_text(F.col("error")).isNotNull(), "failed")
        .when(all_ended & (F.coalesce("bad", F.lit(0)) > 0), "failed")
        .when(all_ended, "completed")
        .when(F.col("ended").isNotNull() | F.col("events").isNotNull(), "running")
        .otherwise("pending")
    )
    joined = jobs.join(ended, "id", "left").join(logged, "id", "left")
    return joined.select("id", "start_time", status.alias("status"))


def jobs_by_state(status: DataFrame) -> DataFrame:
    """How many jobs there are, run (or wait to), completed and failed."""
    state = F.col("status")
    return status.agg(
        F.count("*").alias("all_jobs"),
        F.count_if(state.isin("running", "pending")).alias("running"),
        F.count_if(state == "completed").alias("completed"),
        F.count_if(state == "failed").alias("failed"),
    )


def latest_jobs(jobs: DataFrame, n: int | None = None) -> DataFrame:
    """Jobs newest first."""
    ordered = jobs.orderBy(F.desc("start_time"), "id")
    return ordered.limit(n) if n else ordered


def progress_fold(progress: DataFrame) -> DataFrame:
    """The state of each table after its events in order, each changing only the fields it reports.

    A field that is 0, blank or missing keeps its old value; an error text lasts until the next
    event. The plan is a grouping without a window, so it also runs on a stream in update mode.
    """
    at = F.struct("timestamp", "seq")
    rows = F.coalesce(_if_set(F.col("current_rows")), _if_set(F.col("row_count")))
    state = (
        F.when(F.col("event") == "completed", "completed")
        .when(F.col("event") == "error", "failed")
        .otherwise(_if_text(F.col("phase")))
    )

    def last(value: Column) -> Column:
        return F.max_by(value, F.when(value.isNotNull(), at))

    zero = F.lit(0).cast("bigint")
    error = F.when(F.col("event") == "error", F.col("message"))
    return (
        progress.where(_named(F.col("table")))
        .groupBy("job_id", "table")
        .agg(
            F.coalesce(last(rows), zero).alias("current_rows"),
            F.coalesce(last(_if_set(F.col("total_rows"))), zero).alias("total_rows"),
            F.coalesce(last(_if_set(F.col("percentage"))), F.lit(0.0)).alias("percentage"),
            F.coalesce(last(state), F.lit("pending")).alias("status"),
            F.max_by(error, at).alias("error"),
            F.max("timestamp").alias("updated_at"),
        )
    )


def cdc_badges(jobs: DataFrame) -> DataFrame:
    """The polled tables of each job with their delta column and interval."""
    configs = F.filter("table_configs", lambda c: c["polling"]["enabled"])
    rows = jobs.select(F.col("id").alias("job_id"), F.explode(configs).alias("c"))
    return rows.select(
        "job_id",
        F.col("c")["name"].alias("table"),
        F.col("c")["polling"]["delta_column"].alias("delta_column"),
        F.col("c")["polling"]["interval_seconds"].alias("interval_seconds"),
    )


def job_completed_events(jobs: DataFrame, status: DataFrame) -> DataFrame:
    """The closing event of every finished job that polls a table."""
    polled = jobs.where(F.exists("table_configs", lambda c: c["polling"]["enabled"])).select("id")
    done = status.where(F.col("status").isin("completed", "failed")).join(polled, "id", "left_semi")
    return done.select(
        F.col("id").alias("job_id"),
        F.lit("job_completed").alias("event"),
        F.format_string("Job ended: %s, polls active", "status").alias("message"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Tables, succeeded, failed, and the rows of the succeeded ones."""
    return results.agg(
        F.count("*").alias("tables"),
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("rows"))), F.lit(0)).alias("total_rows"),
    )


def run_throughput(results: DataFrame) -> DataFrame:
    """Rows, seconds and rows per second over all succeeded results; no time gives no rate."""
    totals = results.where("success").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        (F.coalesce(F.sum("duration"), F.lit(0)) / F.lit(1e9)).alias("seconds"),
    )
    rate = F.col("total_rows") / F.when(F.col("seconds") > 0, F.col("seconds"))
    return totals.withColumn("rows_per_sec", rate)
