"""Paths on which rows could be lost, doubled or overwritten."""

from dataclasses import replace

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tablesync.operators.schema import conform
from tablesync.plans.ingest import RunLog, Target, ingest_table, ingest_tables, run_job
from tablesync.plans.spec import Polling, TableSpec
from tablesync.sinks import append
from tablesync.sources.scan import scan_since, scan_table
from tablesync.sources.tables import FileSource
from tablesync.streaming.cdc import file_stream, poll_once
from tablesync.streaming.versionlog import VersionLog


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v int, p string")


def store(log, rows, batch_id):
    log.commit(log.append(rows, batch_id).last_seen, batch_id)


@pytest.fixture
def log(spark, folder):
    return VersionLog(spark, folder, batch(spark).schema, ["k"], "v", 4, "t")


def test_another_bucket_number_doubles_no_key(spark, log):
    store(log, batch(spark, *[(i, 1, "a") for i in range(200)]), 0)
    log.compact()
    wider = replace(log, buckets=8)
    store(wider, batch(spark, (1, 2, "b"), (2, 2, "b"), (300, 1, "new")), 1)
    wider.compact()
    assert len({b for b, _, _ in wider.manifest()}) == 8
    for reader in (wider, log, replace(log, buckets=0)):
        assert reader.current().count() == reader.current().select("k").distinct().count() == 201
        assert (1, 2, "b") in rows_of(reader.current())


def test_uncommitted_batches_are_not_compacted_and_compacted_numbers_not_taken(spark, log):
    log.append(batch(spark, (1, 1, "half")), 0)
    assert log.compact() == -1 and log.manifest() == []
    store(log, batch(spark, (1, 2, "whole"), (2, 1, "x")), 0)
    log.compact()
    with pytest.raises(ValueError, match="compacted"):
        log.append(batch(spark, (1, 3, "lost")), 0)
    assert rows_of(log.current()) == [(1, 2, "whole"), (2, 1, "x")]


def test_a_small_poll_rewrites_no_large_bucket(spark, log):
    store(log, batch(spark, *[(i, 1, "a") for i in range(400)]), 0)
    log.compact()
    store(log, batch(spark, (1, 2, "b")), 1)
    store(log, batch(spark, *[(i, 3, "c") for i in range(400, 500)]), 2)
    assert log.compact(least_share=0.5) == 0
    assert {g for _, g, _ in log.manifest()} == {0}
    store(log, batch(spark, *[(i, 4, "d") for i in range(500, 600)]), 3)
    log.compact(least_share=0.5)
    assert log.current().count() == 600 and (1, 2, "b") in rows_of(log.current())
    log.vacuum()
    assert log.current().count() == 600 and (1, 2, "b") in rows_of(log.current())


def test_the_cursor_never_falls(spark, log):
    store(log, batch(spark, (1, 10, "a")), 0)
    for batch_id, rows in enumerate([[(2, 9, "older")], [], [(3, None, "none")]], 1):
        store(log, batch(spark, *rows), batch_id)
        assert (log.cursor().batch_id, log.cursor().last_seen) == (batch_id, "10")


def test_reading_writes_nothing(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "absent"), batch(spark).schema, ["k"], "v")
    assert log.current().count() == log.versions().count() == 0 and log.cursor().batch_id == -1
    assert not (tmp_path / "absent").exists()


def test_missing_batches_read_the_same_by_path_and_by_listing(spark, log, monkeypatch):
    log.commit("5", 3)
    for most in (1000, 0):
        monkeypatch.setattr("tablesync.streaming.versionlog.BATCHES_BY_PATH", most)
        assert log.current().count() == 0


def test_a_stream_begins_after_the_snapshot_and_keeps_its_numbers(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    log = VersionLog(spark, str(tmp_path / "out"), batch(spark).schema, ["k"], "v", 1)
    store(log, batch(spark, *[(i, 1, "a") for i in range(100)]), 0)
    for n in (1, 2):
        batch(spark, (n, n + 1, "s")).coalesce(1).write.mode("append").parquet(source)
        file_stream(spark, source, log, checkpoint).awaitTermination()
    assert log.current().count() == 100 and rows_of(log.versions().groupBy("_batch_id").count()) == [(0, 100), (1, 1), (2, 1)]
    with pytest.raises(ValueError, match="stored already"):
        file_stream(spark, source, log, str(tmp_path / "other"), first_batch=1)


def test_decimal_deltas_keep_their_type(spark, tmp_path):
    path, big = str(tmp_path / "d"), 2**53
    spark.createDataFrame([(1, str(big)), (2, str(big + 1))], "k int, v string").withColumn("v", F.col("v").cast("decimal(20,0)")).write.parquet(path)
    rows = spark.read.parquet(path)
    log = VersionLog(spark, str(tmp_path / "log"), conform(rows).schema, ["k"], "v", 1)
    assert poll_once(rows.where("k = 1"), log).rows == 1
    assert poll_once(rows, log).rows == 1 and log.cursor().last_seen == str(big + 1)
    assert poll_once(rows, log).rows == 0
    assert f"GreaterThan(v,{big})" in plan_of(scan_since(rows, "v", F.lit(str(big)).cast("decimal(20,0)")))


def test_inclusive_polls_end_and_store_once(spark, log):
    rows = batch(spark, *[(i, 1, "a") for i in range(10)], (20, 2, "b"), (21, 2, "b"))
    assert poll_once(rows.where("k < 4"), log).rows == 4
    taken = []
    while n := poll_once(rows, log, limit=3, ties="strict", inclusive=True).rows:
        taken.append(n)
    assert taken == [3, 3, 2] and rows_of(log.versions(), "k") == rows_of(rows, "k")


@pytest.fixture
def source(spark, tmp_path):
    rows = spark.range(100).selectExpr("CAST(id AS INT) AS k", "CAST(IF(id % 10 = 0, NULL, id) AS INT) AS d", "'x' AS s")
    rows.write.parquet(str(tmp_path / "in" / "t.parquet"))
    rows.write.parquet(str(tmp_path / "in" / "u.parquet"))
    return FileSource(spark, str(tmp_path / "in"), keys={"t": ["k"]})


@pytest.mark.parametrize("limit", [0, 30, 1000])
def test_limited_snapshots_keep_rows_without_a_delta(spark, source, folder, limit):
    target, spec = Target(spark, folder), TableSpec("t", limit=limit, polling=Polling(True, "d", 5))
    assert ingest_table(source, spec, target, RunLog("j")).success
    log = target.version_log("t", source.table("t").schema, ["k"], "d")
    while poll_once(source.table("t"), log).rows:
        pass
    assert log.current().count() == 100


def test_batches_are_packed_whole_into_files(spark, source, folder, monkeypatch):
    monkeypatch.setattr(append, "FILE_ROWS", 20)
    target = Target(spark, folder)
    for spec in (TableSpec("t", batch_size=7, polling=Polling(True, "d", 5)), TableSpec("u", batch_size=7)):
        assert ingest_table(source, spec, target, RunLog("j")).success
    for path in (f"{folder}/t/log", f"{folder}/u"):
        held = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
        assert max(held) <= 21 and len(held) < sum(held) / 7


def test_a_failing_callback_costs_no_table(spark, source, folder):
    def fails(_event):
        raise RuntimeError("no listener")

    with pytest.warns(UserWarning, match="callback"):
        results = ingest_tables(source, [TableSpec("t"), TableSpec("u"), TableSpec("gone")], Target(spark, folder), RunLog("j", fails))
    assert {(r.name, r.success) for r in results} == {("t", True), ("u", True), ("gone", False)}


def test_events_outlive_the_driver(spark, source, folder, tmp_path):
    run = run_job(source, [TableSpec("t", polling=Polling(True, "d", 1))], Target(spark, folder), "job-1", checkpoints=str(tmp_path / "c"), progress=f"{folder}-events")
    try:
        assert len(run.streams) == 1
    finally:
        for stream in run.streams:
            stream.stop()
    stored = spark.read.parquet(f"{folder}-events").where("job_id = 'job-1'")
    assert {"started", "completed", "job_completed"} <= {r[0] for r in stored.select("event").collect()}
    assert run.job.first()["error"] is None


def test_large_limits_use_no_single_task(spark, tmp_path):
    spark.range(0, 60_000, 1, 8).write.parquet(str(tmp_path / "n"))
    rows = spark.read.parquet(str(tmp_path / "n"))
    for limit in (20_000, 60_000, 70_000):
        taken = scan_table(rows, limit)
        assert taken.count() == min(limit, 60_000)
        assert "SinglePartition" not in plan_of(taken)
