"""Change capture by polling: one poll, a clock that repeats it, and a stream over arriving files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.functions.columns import named, named_all
from tablesync.operators.schema import conform, conform_with
from tablesync.operators.versions import join_on_key
from tablesync.sources.scan import scan_since
from tablesync.streaming.versionlog import VersionLog


@dataclass(frozen=True)
class PollResult:
    rows: int
    batch_id: int
    last_seen: str | None


OnPoll = Callable[[VersionLog, PollResult], None]
OnError = Callable[[VersionLog, Exception], None]


#: The source's own version column on its way to the cursor.
SEEN = "_seen_version"


def _fresh(table: DataFrame, log: VersionLog, last_seen: Column) -> DataFrame:
    """Cast rows from the cursor on, without those at the cursor that are stored. Only rows at the cursor are compared."""
    rows = conform_with(table.where(named(log.version) >= last_seen), log.version, SEEN)
    columns = list(dict.fromkeys([*log.row_key, log.version]))
    held = log.versions().where(named(log.version) == last_seen.cast(log.schema[log.version].dataType))
    at_cursor = join_on_key(rows.where(F.col(SEEN) == last_seen), held.select(*named_all(columns)).distinct(), columns, "left_anti")
    return rows.where(F.col(SEEN) > last_seen).unionByName(at_cursor)


def poll_once(
    table: DataFrame,
    log: VersionLog,
    limit: int = 0,
    ties: str = "keep",
    inclusive: bool = False,
    on_poll: OnPoll | None = None,
) -> PollResult:
    """Store what changed since the cursor as the next batch, then move the cursor.

    Rows are counted and the new cursor found while the batch is written, so the delta is read once.
    The cursor is kept and compared in the source's own type, before columns are cast: the filter reaches the scan,
    and versions that only a cast makes equal stay apart. `inclusive` also takes rows at the cursor that
    are not stored yet, before any limit; what is stored is not taken again. A failed write leaves the cursor
    where it was; the next poll writes the same batch again.
    """
    cursor = log.cursor()
    kind = table.schema[log.version].dataType
    last_seen = cursor.literal(kind)
    if inclusive and last_seen is not None:
        delta = scan_since(_fresh(table, log, last_seen), SEEN, None, limit, log.row_key, ties)
    else:
        delta = conform_with(scan_since(table, log.version, last_seen, limit, log.row_key, ties), log.version, SEEN)
    batch_id = cursor.batch_id + 1
    stored = log.append(delta, batch_id, few=True, seen=SEEN)
    if stored.rows == 0:
        return PollResult(0, batch_id, cursor.last_seen)
    log.commit(stored.last_seen, batch_id, kind)
    result = PollResult(stored.rows, batch_id, stored.last_seen)
    if on_poll is not None:
        on_poll(log, result)
    return result


def poll_stream(
    read_table: Callable[[], DataFrame],
    log: VersionLog,
    interval_seconds: int,
    checkpoint: str,
    limit: int = 0,
    ties: str = "keep",
    on_poll: OnPoll | None = None,
    on_error: OnError | None = None,
) -> StreamingQuery:
    """`poll_once` every interval, until the returned query is stopped.

    The stream is only a clock; the cursor lives in the log, so a restart goes on where the last
    stored batch ended. A failed poll is reported to `on_error` and tried again at the next tick; if
    there is no `on_error`, it ends the stream.
    """
    if interval_seconds <= 0:
        raise ValueError("polling interval must be greater than 0")

    def tick(_clock: DataFrame, _tick: int) -> None:
        try:
            poll_once(read_table(), log, limit, ties, on_poll=on_poll)
        except Exception as error:
            if on_error is None:
                raise
            on_error(log, error)

    clock = log.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        clock.writeStream.queryName(f"poll-{log.name}")
        .foreachBatch(tick)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{interval_seconds} seconds")
        .start()
    )


def _first_batch(spark: SparkSession, log: VersionLog, checkpoint: str, wanted: int | None) -> int:
    path = f"{checkpoint.rstrip('/')}/first_batch"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema("batch bigint").parquet(path).first()["batch"]
    after = log.cursor().batch_id + 1
    if wanted is not None and wanted < after:
        raise ValueError(f"batch {wanted} of {log.name} is stored already; the next is {after}")
    first = after if wanted is None else wanted
    spark.createDataFrame([(first,)], "batch bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return first


def file_stream(
    spark: SparkSession,
    path: str,
    log: VersionLog,
    checkpoint: str,
    interval_seconds: int | None = None,
    max_files: int = 1000,
    first_batch: int | None = None,
    on_poll: OnPoll | None = None,
) -> StreamingQuery:
    """Store the rows of files as they arrive below a folder or a glob.

    Without an interval it takes what is there and ends. The checkpoint remembers the files taken,
    and a batch that is replayed after a crash overwrites itself. The stream's batches are numbered from
    `first_batch` on, by default the one after the cursor, so they keep clear of what is stored; the number is kept
    beside the checkpoint at the first start and holds for every later one. A number in use is refused.
    """
    first_batch = _first_batch(spark, log, checkpoint, first_batch)

    def store(batch: DataFrame, stream_batch: int) -> None:
        batch_id = first_batch + stream_batch
        stored = log.append(conform(batch), batch_id)
        log.commit(stored.last_seen, batch_id)
        if on_poll is not None:
            on_poll(log, PollResult(stored.rows, batch_id, stored.last_seen))

    rows = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", max_files).parquet(path)
    writer = (
        rows.writeStream.queryName(f"files-{log.name}").foreachBatch(store).option("checkpointLocation", checkpoint)
    )
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()
