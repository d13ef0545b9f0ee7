"""Copying tables: one table from scan to result row, and many at once."""

from __future__ import annotations

import re
import time
import uuid
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Lock

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablesync.functions.columns import named
from tablesync.functions.text import IDENTIFIER_PATTERN
from tablesync.functions.types import cursor_to_text
from tablesync.operators.schema import conform, conform_with
from tablesync.plans.spec import TableSpec, validate_specs
from tablesync.plans.progress import put_packed, watched
from tablesync.sinks.append import append_rows, create_if_absent
from tablesync.sinks.database import DatabaseTarget
from tablesync.sources.scan import scan_since, scan_table
from tablesync.sources.tables import Source
from tablesync.streaming.cdc import SEEN, PollResult, poll_stream
from tablesync.streaming.versionlog import VersionLog

RESULT_SCHEMA = "name string, success boolean, error string, rows bigint, duration bigint"
PROGRESS_SCHEMA = (
    "job_id string, table string, event string, message string, row_count bigint, current_rows bigint, "
    "total_rows bigint, percentage double, phase string, duration string, timestamp timestamp, seq bigint"
)
POLLING_TYPE = "struct<enabled: boolean, delta_column: string, interval_seconds: int>"
JOB_SCHEMA = (
    "id string, status string, tables array<string>, "
    f"table_configs array<struct<name: string, limit: int, batch_size: int, polling: {POLLING_TYPE}>>, "
    "results array<struct<name: string, success: boolean, error: string, rows: bigint, duration: bigint>>, "
    "start_time timestamp, end_time timestamp, error string"
)

OnEvent = Callable[[dict], None]


@dataclass(frozen=True)
class TableResult:
    """What became of one table; a failed one has no rows and no duration."""

    name: str
    success: bool
    error: str | None = None
    rows: int = 0
    duration: int = 0


class StageFailed(Exception):
    """A stage of a copy failed; the text is what the result row shows."""


class _Stage:
    """Names the stage in the error of whatever fails inside the block."""

    def __init__(self, name: str):
        self.name = name

    def __enter__(self):
        return self

    def __exit__(self, _kind, error, _trace):
        if isinstance(error, Exception):
            raise StageFailed(f"{self.name}: {error}") from error
        return False


class RunLog:
    """Numbers the events of a job and hands them to a callback.

    A callback that fails is warned about and never breaks a copy. With a `path`, events are also appended to a
    progress table there, which outlives the driver; polls then keep nothing in its memory.
    """

    def __init__(self, job_id: str, on_event: OnEvent | None = None, path: str | None = None):
        self.job_id = job_id
        self.path = path
        self.events: list[dict] = []
        self._seq = 0
        self._on_event = on_event
        self._lock = Lock()

    def add(self, table: str, event: str, message: str, **fields) -> None:
        with self._lock:
            row = {
                "job_id": self.job_id,
                "table": table,
                "event": event,
                "message": message,
                "row_count": 0,
                "current_rows": 0,
                "total_rows": 0,
                "percentage": 0.0,
                "phase": "",
                "duration": "",
                "timestamp": datetime.now(timezone.utc),
                "seq": self._seq,
                **fields,
            }
            self._seq += 1
            self.events.append(row)
        if self._on_event is not None:
            try:
                self._on_event(row)
            except Exception as error:
                warnings.warn(f"event callback failed: {error!r}", stacklevel=2)

    def flush(self, spark: SparkSession) -> None:
        """Append the events held to the progress table. Without a path they stay in memory."""
        if self.path is None:
            return
        with self._lock:
            held, self.events = self.events, []
        if held:
            with self._lock:  # one file after the other, packed as they add up
                put_packed(self._rows(spark, held), self.path, self.job_id)

    def _rows(self, spark: SparkSession, events: list[dict]) -> DataFrame:
        schema = T.StructType.fromDDL(PROGRESS_SCHEMA)
        return spark.createDataFrame([tuple(e[name] for name in schema.fieldNames()) for e in events], schema)

    def table(self, spark: SparkSession) -> DataFrame:
        """All events of the job: those of the progress table, or those held in memory."""
        if self.path is None:
            with self._lock:
                return self._rows(spark, self.events)
        self.flush(spark)
        stored = spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
        # a packing that died may have left events twice
        return stored.where(F.col("job_id") == self.job_id).dropDuplicates(["job_id", "seq"])


@dataclass(frozen=True)
class Target:
    """Where copies are kept: `<root>/<table>` for plain tables and version logs alike."""

    spark: SparkSession
    root: str
    buckets: int = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def version_log(self, name: str, schema: T.StructType, key: Sequence[str], version: str) -> VersionLog:
        return VersionLog(self.spark, self.path(name), schema, list(key), version, self.buckets, name)


def _check_names(table: str, schema: T.StructType) -> None:
    # The schema of one table is a short list on the driver, so the pattern is applied there.
    for name in (table, *schema.fieldNames()):
        if not re.fullmatch(IDENTIFIER_PATTERN, name) or name.endswith("\n"):
            raise ValueError(f"invalid identifier {name!r}")


#: How often rows are reported while they are written.
WATCH_SECONDS = 2.0


def _report(log: RunLog, spec: TableSpec, rows: int, text: str) -> None:
    """An `inserting` event; the total is known only from a limit."""
    percentage = min(100.0, rows / spec.limit * 100) if spec.limit else 0.0
    log.add(spec.name, "inserting", f"{rows} {text}", current_rows=rows, total_rows=spec.limit, percentage=percentage, phase="inserting")


def ingest_table(
    source: Source,
    spec: TableSpec,
    target: Target | DatabaseTarget,
    log: RunLog,
    cursor_from: str = "snapshot",
    batch_id: int = 0,
) -> TableResult:
    """Copy one table and, when it is polled, set its cursor.

    All checks on names, types and keys come before the first write. The row count and, for a polled
    table, the cursor are observed while the snapshot is written: the source is read once. A limited snapshot of a
    polled table holds the oldest rows and all rows without a delta, which no poll would find. An error of any kind
    becomes the table's result. While rows are written, those that tasks have handed over are reported every `WATCH_SECONDS`.
    A database as the target takes the rows as the batch `batch_id`, once however often it is run; there nothing is polled.
    `cursor_from="source"` takes the source's maximum after the load, which skips rows that
    arrived in between or lie past the limit.
    """
    started = time.monotonic_ns()
    versioned = spec.polling.enabled and spec.polling.delta_column != ""
    log.add(spec.name, "started", "Reading the table")
    try:
        with _Stage("extraction failed"):
            table = scan_table(source.table(spec.name), spec.limit)
        log.add(spec.name, "extracting", f"{len(table.columns)} columns to copy")
        with _Stage("DDL generation failed"):
            rows = conform(table)
            _check_names(spec.name, rows.schema)
            key = list(spec.key) if spec.key is not None else source.key(spec.name) if versioned else []
            missing = [c for c in (*key, *([spec.polling.delta_column] if versioned else [])) if c not in rows.columns]
            if missing:
                raise ValueError(f"no such columns: {', '.join(missing)}")
        with _Stage("table creation failed"):
            if isinstance(target, DatabaseTarget):
                if versioned:
                    raise ValueError("a database takes no polled tables")
            elif versioned:
                versions = target.version_log(spec.name, rows.schema, key, spec.polling.delta_column)
            else:
                create_if_absent(target.spark, target.path(spec.name), rows.schema)
        log.add(spec.name, "inserting", "Writing rows")
        with _Stage("insertion failed"), watched(target.spark, lambda rows: _report(log, spec, rows, "rows written so far"), WATCH_SECONDS):
            if isinstance(target, DatabaseTarget):
                seen = Observation()
                target.table(spec.name, spec.batch_size).append(rows, batch_id, seen)
                count = int(seen.get["rows"])
            elif versioned:
                full, delta = source.table(spec.name), spec.polling.delta_column
                kind = full.schema[delta].dataType
                taken = full
                if spec.limit:
                    # Any `limit` rows may be loaded; the oldest leave nothing behind the cursor.
                    without = full.where(named(delta).isNull())
                    taken = scan_since(full, delta, None, spec.limit).unionByName(without)
                next_batch = versions.cursor().batch_id + 1
                stored = versions.append(conform_with(taken, delta, SEEN), next_batch, batch_size=spec.batch_size, seen=SEEN)
                count, last_seen = stored.rows, stored.last_seen
                if cursor_from == "source":
                    last_seen = full.agg(cursor_to_text(F.max(named(delta)), kind)).first()[0]
                versions.commit(last_seen, next_batch, kind)
            else:
                seen = Observation()
                append_rows(rows, target.path(spec.name), spec.batch_size, observation=seen)
                count = int(seen.get["rows"])
    except Exception as failure:
        log.add(spec.name, "error", str(failure))
        return TableResult(spec.name, False, str(failure))
    duration = time.monotonic_ns() - started
    if count:
        _report(log, spec, count, "rows written")
    log.add(
        spec.name,
        "completed",
        "Table copied",
        row_count=count,
        current_rows=count,
        percentage=100.0,
        phase="completed",
        duration=f"{duration / 1e9:.3f}s",
    )
    return TableResult(spec.name, True, None, count, duration)


def _in_pool(spark: SparkSession, pool: str, work: Callable[[], TableResult]) -> TableResult:
    """Run work in its own thread, whose Spark jobs share the cluster fairly with the other tables'."""
    out: list[TableResult] = []

    def run() -> None:
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            out.append(work())
        except Exception as error:
            out.append(TableResult(pool, False, str(error)))

    thread = InheritableThread(target=run, session=spark)
    thread.start()
    thread.join()
    return out[0]


def ingest_tables(
    source: Source,
    specs: Sequence[TableSpec],
    target: Target,
    log: RunLog,
    at_once: int = 16,
    cursor_from: str = "snapshot",
) -> list[TableResult]:
    """Copy many tables at a time; results come in finishing order and a failure stops only its table.

    Polled tables are ready for `start_polling` afterwards; nothing is polled by this call.
    """
    validate_specs(specs)
    spark = target.spark
    with ThreadPoolExecutor(max_workers=min(at_once, len(specs))) as pool:
        running = [
            pool.submit(_in_pool, spark, s.name, lambda s=s: ingest_table(source, s, target, log, cursor_from))
            for s in specs
        ]
        return [done.result() for done in as_completed(running)]


def results_table(spark: SparkSession, results: Sequence[TableResult]) -> DataFrame:
    rows = [(r.name, r.success, r.error, r.rows, r.duration) for r in results]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


@dataclass(frozen=True)
class JobRun:
    """A finished run: its job row, its results and its events, as tables for the run-log queries."""

    job: DataFrame
    results: DataFrame
    progress: DataFrame
    streams: list[StreamingQuery] = field(default_factory=list)


def run_job(
    source: Source,
    specs: Sequence[TableSpec],
    target: Target,
    job_id: str | None = None,
    on_event: OnEvent | None = None,
    checkpoints: str | None = None,
    progress: str | None = None,
) -> JobRun:
    """`ingest_tables` with the log rows of a job around it.

    With `checkpoints` the polls of the copied tables are started and handed back. `progress` is the path of a table that
    takes the events, of this run and its polls. What fails outside of a table, as a source that cannot be
    reached, is the job's error.
    """
    spark = target.spark
    validate_specs(specs)
    log = RunLog(job_id or uuid.uuid4().hex, on_event, progress)
    log.add("", "started", f"{len(specs)} tables to copy")
    start = datetime.now(timezone.utc)
    results: list[TableResult] = []
    streams: list[StreamingQuery] = []
    error = None
    try:
        results = ingest_tables(source, specs, target, log)
        if checkpoints is not None:
            copied = {r.name for r in results if r.success}
            streams = start_polling(source, [s for s in specs if s.name in copied], target, checkpoints, log)
    except Exception as failure:
        error = str(failure)
        log.add("", "error", error)
    status = "completed" if error is None and all(r.success for r in results) else "failed"
    if any(s.polling.enabled for s in specs):
        log.add("", "job_completed", f"Job ended: {status}" + (f", {len(streams)} tables polled" if streams else ""))
    configs = [
        (s.name, s.limit, s.batch_size, (s.polling.enabled, s.polling.delta_column, s.polling.interval_seconds))
        for s in specs
    ]
    result_rows = [(r.name, r.success, r.error, r.rows, r.duration) for r in results]
    job = (log.job_id, status, [s.name for s in specs], configs, result_rows, start, datetime.now(timezone.utc), error)
    return JobRun(
        spark.createDataFrame([job], JOB_SCHEMA),
        results_table(spark, results).select(
            F.lit(log.job_id).alias("job_id"), "*", F.monotonically_increasing_id().alias("seq")
        ),
        log.table(spark),
        streams,
    )


def start_polling(
    source: Source,
    specs: Sequence[TableSpec],
    target: Target,
    checkpoints: str,
    log: RunLog | None = None,
) -> list[StreamingQuery]:
    """One stream per polled table, each with its own interval, delta column and checkpoint."""
    queries = []
    for spec in specs:
        if not spec.polling.enabled:
            continue
        schema = conform(source.table(spec.name)).schema
        key = list(spec.key) if spec.key is not None else source.key(spec.name)
        versions = target.version_log(spec.name, schema, key, spec.polling.delta_column)

        def report(_log: VersionLog, result: PollResult, name: str = spec.name) -> None:
            if log is not None:
                log.add(name, "cdc_update", f"{result.rows} changed rows stored", row_count=result.rows)
                log.flush(target.spark)

        def report_error(_log: VersionLog, error: Exception, name: str = spec.name) -> None:
            if log is not None:
                log.add(name, "error", f"poll failed: {error}")
                log.flush(target.spark)

        queries.append(
            poll_stream(
                lambda name=spec.name: getattr(source, "polled", source.table)(name),
                versions,
                spec.polling.interval_seconds,
                f"{checkpoints}/{spec.name}",
                spec.poll_limit,
                on_poll=report,
                on_error=report_error,
            )
        )
    return queries
