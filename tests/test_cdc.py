import time

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tablesync.plans.ingest import RunLog, Target, start_polling
from tablesync.plans.spec import Polling, TableSpec
from tablesync.sources.tables import FileSource
from tablesync.streaming.cdc import file_stream, poll_once, poll_stream
from tablesync.streaming.versionlog import VersionLog

DDL = "id int, s string, d timestamp_ntz"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, s string, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))


@pytest.fixture
def log(spark, folder):
    return VersionLog(spark, folder, table(spark).schema, ["id"], "d", 1, "t")


def test_polls_take_inserts_and_updates_once(spark, log):
    first = [(1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-01 11:00:00.000001"), (3, "null", None)]
    assert poll_once(table(spark, *first), log).rows == 2
    assert poll_once(table(spark, *first), log).rows == 0
    assert log.cursor().batch_id == 0
    later = [*first, (1, "a2", "2024-01-01 12:00:00"), (4, "late", "2024-01-01 09:00:00")]
    result = poll_once(table(spark, *later), log)
    assert (result.rows, result.batch_id, result.last_seen) == (1, 1, "2024-01-01 12:00:00")
    assert rows_of(log.current(), "id", "s") == [(1, "a2"), (2, "b")]


def test_limit_with_ties_kept_loses_nothing_and_strict_does(spark, folder):
    rows = [(i, "x", f"2024-01-01 10:00:0{d}") for i, d in enumerate([1, 2, 2, 3, 3, 3])]
    left = {}
    for ties in ("keep", "strict"):
        log = VersionLog(spark, f"{folder}/{ties}", table(spark).schema, ["id"], "d", 1, ties)
        sizes = []
        while taken := poll_once(table(spark, *rows), log, limit=2, ties=ties).rows:
            sizes.append(taken)
        left[ties] = (sizes, log.current().count())
    assert left == {"keep": ([3, 3], 6), "strict": ([2, 2], 4)}


def test_a_failed_write_leaves_the_cursor(spark, log, monkeypatch):
    rows = table(spark, (1, "a", "2024-01-01 10:00:00"))
    monkeypatch.setattr(VersionLog, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        poll_once(rows, log)
    monkeypatch.undo()
    assert log.cursor().batch_id == -1
    poll_once(rows, log)
    assert rows_of(log.versions(), "id", "_batch_id") == [(1, 0)]


def test_inclusive_reread_changes_nothing(spark, log):
    rows = table(spark, (1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-01 10:00:00"))
    poll_once(rows.limit(1), log)
    poll_once(rows, log, inclusive=True)
    assert rows_of(log.current(), "id", "s") == [(1, "a"), (2, "b")]


def test_file_stream_restarts_where_it_ended(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    log = VersionLog(spark, str(tmp_path / "out"), table(spark).schema, ["id"], "d", 2, "t")
    seen = []
    run = lambda: file_stream(spark, source, log, checkpoint, max_files=1,
                              on_poll=lambda _l, r: seen.append((r.batch_id, r.rows))).awaitTermination()
    table(spark, (1, "a", "2024-01-01 10:00:00")).coalesce(1).write.parquet(source)
    run()
    assert seen == [(0, 1)]
    table(spark, (1, "b", "2024-01-01 11:00:00"), (2, "c", "2024-01-01 11:00:00")).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert seen == [(0, 1), (1, 2)]
    assert rows_of(log.current(), "id", "s") == [(1, "b"), (2, "c")]


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.3)
    return False


def test_poll_stream_follows_a_growing_table_and_outlives_errors(spark, tmp_path):
    source, log = str(tmp_path / "in"), VersionLog(spark, str(tmp_path / "out"), table(spark).schema, ["id"], "d", 1, "p")
    polls, errors = [], []
    query = poll_stream(
        lambda: spark.read.parquet(source), log, 1, str(tmp_path / "checkpoint"),
        on_poll=lambda _l, r: polls.append(r.rows), on_error=lambda _l, e: errors.append(e),
    )
    try:
        assert wait_for(lambda: errors)
        table(spark, (1, "a", "2024-01-01 10:00:00")).write.parquet(source)
        assert wait_for(lambda: polls == [1])
        table(spark, (1, "b", "2024-01-01 11:00:00")).write.mode("append").parquet(source)
        assert wait_for(lambda: polls == [1, 1])
    finally:
        query.stop()
    assert rows_of(log.current(), "id", "s") == [(1, "b")]


def test_many_tables_are_polled_with_their_own_streams(spark, tmp_path):
    for name in ("a", "b", "c"):
        table(spark, (1, name, "2024-01-01 10:00:00")).write.parquet(str(tmp_path / f"{name}.parquet"))
    specs = [TableSpec(n, polling=Polling(n != "c", "d", 1), key=("id",)) for n in ("a", "b", "c")]
    target, log = Target(spark, str(tmp_path / "out")), RunLog("job")
    queries = start_polling(FileSource(spark, str(tmp_path)), specs, target, str(tmp_path / "checkpoints"), log)
    try:
        assert len(queries) == 2
        assert wait_for(lambda: {e["table"] for e in log.events} == {"a", "b"})
        # Read before the streams stop: stopping may break off a poll, which is reported as failed.
        events = [(e["event"], e["row_count"]) for e in log.events]
    finally:
        for query in queries:
            query.stop()
    assert events == [("cdc_update", 1)] * 2


def test_interval_must_be_positive(spark, log):
    with pytest.raises(ValueError):
        poll_stream(lambda: None, log, 0, "unused")
