import glob
from datetime import datetime

import pytest
from helpers import DATA, rows_of
from pyarrow import parquet
from pyspark.sql import functions as F

from tablesync.operators import runlog
from tablesync.operators.latency import latency_mean_std, latency_percentiles, latency_report, tail_flags
from tablesync.plans import ingest
from tablesync.plans.ingest import PROGRESS_SCHEMA, RunLog, Target, ingest_table, ingest_tables, results_table, run_job
from tablesync.plans.spec import Polling, RunConfig, TableConfig, TableSpec, resolve_specs, validate_specs
from tablesync.session import scratch_dir
from tablesync.sinks import append
from tablesync.sinks.append import append_rows, create_if_absent
from tablesync.sources.tables import FileSource

# -- specs -----------------------------------------------------------------------------------------


def test_fields_fall_back_to_the_run_and_then_to_defaults():
    run = RunConfig(limit=7, polling=Polling(True, "t", 5), tables=[
        TableConfig("a"), TableConfig("b", limit=0, batch_size=9, polling=Polling(), poll_limit=3)])
    a, b = resolve_specs(run)
    assert (a.limit, a.batch_size, a.polling, a.poll_limit) == (7, 500, Polling(True, "t", 5), 7)
    assert (b.limit, b.batch_size, b.polling, b.poll_limit) == (0, 9, Polling(), 3)


def test_the_list_of_tables_wins_over_the_single_one():
    assert [s.name for s in resolve_specs(RunConfig(table="x"))] == ["x"]
    assert [s.name for s in resolve_specs(RunConfig(table="x", tables=[TableConfig("y")]))] == ["y"]
    assert resolve_specs(RunConfig()) == []


@pytest.mark.parametrize(
    "specs, error",
    [
        ([], "no table"),
        ([TableSpec(" ")], "name is missing"),
        ([TableSpec("a", batch_size=0)], "batch size"),
        ([TableSpec("a", limit=-1)], "limit"),
        ([TableSpec("a", polling=Polling(True, ""))], "delta column"),
        ([TableSpec("a", polling=Polling(True, "d", 0))], "interval"),
        ([TableSpec("a"), TableSpec("a")], "listed 2 times"),
    ],
)
def test_bad_specs_raise(specs, error):
    with pytest.raises(ValueError, match=error):
        validate_specs(specs)
    validate_specs([TableSpec("a", polling=Polling(False, "", 0))])


# -- appending -------------------------------------------------------------------------------------


def test_create_if_absent_and_append_by_name(spark, folder):
    rows = spark.createDataFrame([(1, "a")], "i int, s string")
    create_if_absent(spark, folder, rows.schema)
    append_rows(rows, folder)
    create_if_absent(spark, folder, rows.schema)
    append_rows(rows.select("s", "i"), folder)
    assert rows_of(spark.read.parquet(folder)) == [(1, "a"), (1, "a")]
    with pytest.raises(ValueError, match="added.*x"):
        append_rows(rows.withColumn("x", F.lit(1)), folder)
    append_rows(rows.withColumn("x", F.lit(1)), folder, merge_schema=True)
    merged = spark.read.option("mergeSchema", "true").parquet(folder)
    assert rows_of(merged, "x") == [(1,), (None,), (None,)]


def test_batches_are_packed_into_files_and_row_groups(spark, folder, monkeypatch):
    monkeypatch.setattr(append, "FILE_ROWS", 400)
    monkeypatch.setattr(append, "GROUP_ROWS", 150)
    append_rows(spark.range(0, 1000, 1, 2), folder, batch_size=100, writers=1)
    files = [parquet.ParquetFile(f) for f in sorted(glob.glob(f"{folder}/*.parquet"))]
    groups = [[f.metadata.row_group(i).num_rows for i in range(f.num_row_groups)] for f in files]
    assert sorted(groups) == [[200], [200, 200], [200, 200]]
    append_rows(spark.range(0, 1000, 1, 2), f"{folder}-large", batch_size=600, writers=1)
    assert sorted(parquet.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{folder}-large/*.parquet")) == [400, 600]


@pytest.mark.parametrize(("batch", "least", "rows"), [(500, 1000, 1000), (7, 1000, 1001), (5000, 1000, 5000), (1, 1, 1)])
def test_files_hold_whole_batches(batch, least, rows):
    assert append.whole_batches(batch, least) == rows


def test_a_default_copy_of_many_rows_is_few_files(spark, folder):
    target, source = Target(spark, folder), FileSource(spark, f"{DATA}/sf0.1", {"lineitem": ["l_orderkey", "l_linenumber"]})
    specs = resolve_specs(RunConfig(tables=[TableConfig("lineitem")]))
    assert [r.rows for r in ingest_tables(source, specs, target, RunLog("j"))] == [600_000]
    assert len(glob.glob(f"{folder}/lineitem/*.parquet")) <= 16
    with pytest.raises(ValueError, match="negative"):
        append_rows(spark.range(3), f"{folder}/x", batch_size=-1)


def test_scratch_dir_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{shared}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


# -- ingest ----------------------------------------------------------------------------------------


@pytest.fixture
def source(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (3, "d", None)], "k int, s string, d int").write.parquet(
        str(tmp_path / "good.parquet"))
    spark.range(3).select(F.array("id").alias("a")).write.parquet(str(tmp_path / "bad_type.parquet"))
    spark.range(3).select(F.col("id").alias("bad name")).write.parquet(str(tmp_path / "bad_name.parquet"))
    spark.range(2).select(F.unhex(F.lit("00")).alias("b")).write.parquet(str(tmp_path / "bad_rows.parquet"))
    return FileSource(spark, str(tmp_path), {"good": ["k"]})


def test_a_failure_stops_only_its_table(spark, source, folder):
    names = ["good", "bad_type", "bad_name", "bad_rows", "absent"]
    log = RunLog("j")
    found = {r.name: r for r in ingest_tables(source, [TableSpec(n) for n in names], Target(spark, folder), log)}
    assert found["good"].success and found["good"].rows == 4 and found["good"].duration > 0 and found["good"].error is None
    prefix = {"bad_type": "DDL generation failed: unsupported column type ARRAY for column a",
              "bad_name": "DDL generation failed: invalid identifier 'bad name'",
              "bad_rows": "insertion failed: ", "absent": "extraction failed: "}
    for name, text in prefix.items():
        assert not found[name].success and found[name].error.startswith(text)
        assert (found[name].rows, found[name].duration) == (0, 0)
    assert rows_of(runlog.run_summary(results_table(spark, list(found.values())))) == [(5, 1, 4, 4)]
    assert spark.read.parquet(f"{folder}/good").count() == 4
    assert [e["event"] for e in log.events if e["table"] == "good"] == [
        "started", "extracting", "inserting", "inserting", "completed"]
    assert [e["event"] for e in log.events if e["table"] == "bad_type"] == ["started", "extracting", "error"]


def test_a_polled_table_becomes_a_version_log_with_a_cursor(spark, source, folder):
    target = Target(spark, folder)
    spec = TableSpec("good", polling=Polling(True, "d", 5))
    result = ingest_table(source, spec, target, RunLog("j"))
    log = target.version_log("good", source.table("good").schema, ["k"], "d")
    assert result.rows == 4 and log.cursor().last_seen == "2"
    assert rows_of(log.current(), "k", "s") == [(1, "b"), (2, "c"), (3, "d")]
    # Without a delta column the flag alone makes no version log.
    plain = ingest_table(source, TableSpec("good", polling=Polling(True, "", 5)), Target(spark, f"{folder}2"), RunLog("j"))
    assert plain.success and spark.read.parquet(f"{folder}2/good").count() == 4


def test_a_limited_snapshot_leaves_nothing_behind_the_cursor(spark, source, folder):
    target = Target(spark, folder)
    spec = TableSpec("good", limit=1, polling=Polling(True, "d", 5))
    ingest_table(source, spec, target, RunLog("j"))
    log = target.version_log("good", source.table("good").schema, ["k"], "d")
    assert log.cursor().last_seen == "1" and rows_of(log.versions(), "k", "s") == [(1, "a"), (2, "c"), (3, "d")]
    other = Target(spark, f"{folder}2")
    ingest_table(source, spec, other, RunLog("j"), cursor_from="source")
    assert other.version_log("good", source.table("good").schema, ["k"], "d").cursor().last_seen == "2"


def test_a_wrong_key_or_delta_column_raises_before_writing(spark, source, folder):
    spec = TableSpec("good", polling=Polling(True, "nope", 5), key=("zip",))
    result = ingest_table(source, spec, Target(spark, folder), RunLog("j"))
    assert result.error == "DDL generation failed: no such columns: zip, nope"


def test_job_log(spark, source, folder):
    specs = [TableSpec("good", limit=3), TableSpec("bad_type", polling=Polling(True, "d", 5))]
    seen = []
    run = run_job(source, specs, Target(spark, folder), "job-1", seen.append)
    assert rows_of(run.job, "id", "status") == [("job-1", "failed")]
    status = runlog.table_status(run.job, run.results, run.progress)
    assert rows_of(status, "table", "status", "current_rows") == [("bad_type", "failed", 0), ("good", "completed", 3)]
    assert rows_of(runlog.job_status(run.job, run.results, run.progress), "status") == [("failed",)]
    assert rows_of(runlog.cdc_badges(run.job), "table", "delta_column") == [("bad_type", "d")]
    assert seen[0]["event"] == "started" and seen[-1]["event"] == "job_completed"
    percent = runlog.progress_events(run.progress).where("phase = 'inserting'")
    assert rows_of(percent, "percentage") == [(100.0,)]
    assert [e["seq"] for e in seen] == list(range(len(seen)))


def test_all_given_tables_are_copied_whole(spark, folder):
    names = ["region", "nation", "supplier", "customer"]
    source = FileSource(spark, f"{DATA}/sf0.001")
    ingest_tables(source, [TableSpec(n) for n in names], Target(spark, folder), RunLog("j"), at_once=2)
    for name in names:
        assert rows_of(spark.read.parquet(f"{folder}/{name}")) == rows_of(source.table(name))


# -- run log ---------------------------------------------------------------------------------------


def progress(spark, *events):
    """Events as (table, event, message, row_count, current_rows, total_rows, percentage, phase)."""
    start = datetime(2024, 1, 1)
    rows = [("j", t, e, m, n, c, total, p, phase, "", start, i) for i, (t, e, m, n, c, total, p, phase) in enumerate(events)]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def jobs(spark, *tables):
    return spark.createDataFrame([("j", list(tables), None)], "id string, tables array<string>, error string")


def results(spark, *rows):
    data = [("j", n, e is None, e, r, 0, i) for i, (n, e, r) in enumerate(rows)]
    return spark.createDataFrame(data, "job_id string, name string, success boolean, error string, rows bigint, duration bigint, seq bigint")


def test_table_status(spark):
    log = progress(
        spark,
        ("a", "completed", "", 9, 9, 0, 100.0, "completed"),
        ("b", "extracting", "", 0, 0, 0, 0.0, ""),
        ("c", "inserting", "", 5, 0, 50, 10.0, "inserting"),
        ("d", "inserting", "", 0, 3, 0, 0.0, "inserting"),
        ("d", "error", "boom", 0, 0, 0, 0.0, ""),
        ("stranger", "inserting", "", 1, 1, 0, 0.0, "inserting"),
        ("", "started", "", 0, 0, 0, 0.0, ""),
    )
    done = results(spark, ("a", "first", 1), ("a", None, 7), ("f", "bad", 0), ("g", "", 2))
    status = runlog.table_status(jobs(spark, "a", "b", "c", "d", "e", " "), done, log)
    assert rows_of(status, "table", "status", "current_rows", "percentage", "error") == [
        ("a", "completed", 7, 100.0, None),
        ("b", "extracting", 0, 0.0, None),
        ("c", "inserting", 5, 10.0, None),
        ("d", "failed", 0, 0.0, "boom"),
        ("e", "pending", 0, 0.0, None),
        ("f", "failed", 0, 100.0, "bad"),
        ("g", "completed", 2, 100.0, None),
    ]
    rollup = runlog.job_rollup(jobs(spark, "a", "b", "c", "d", "e", " "), status)
    assert rows_of(rollup) == [("j", 6, 2, 2, 2 / 6 * 100, 14)]


def test_rollup_of_a_job_without_tables(spark):
    empty = jobs(spark).where("true")
    status = runlog.table_status(empty, results(spark).limit(0), progress(spark).limit(0))
    assert rows_of(runlog.job_rollup(empty, status)) == [("j", 0, 0, 0, 0.0, 0)]


def test_fold_keeps_what_an_event_leaves_out(spark):
    log = progress(
        spark,
        ("a", "started", "", 0, 0, 0, 0.0, ""),
        ("a", "inserting", "", 0, 40, 100, 40.0, "inserting"),
        ("a", "error", "boom", 0, 0, 0, 0.0, ""),
        ("b", "error", "bad", 0, 0, 0, 0.0, ""),
        ("b", "extracting", "", 8, 0, 0, 0.0, ""),
        ("c", "started", "", 0, 0, 0, 0.0, ""),
    )
    assert rows_of(runlog.progress_fold(log).drop("updated_at", "job_id")) == [
        ("a", 40, 100, 40.0, "failed", "boom"),
        ("b", 8, 0, 0.0, "failed", None),
        ("c", 0, 0, 0.0, "pending", None),
    ]


def test_fold_runs_as_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    log = progress(spark, ("a", "inserting", "", 0, 40, 100, 40.0, "inserting"), ("a", "error", "boom", 0, 0, 0, 0.0, ""))
    for seq in (0, 1):
        log.where(F.col("seq") == seq).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    states = []
    query = (
        runlog.progress_fold(stream).writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: states.append(rows_of(batch, "table", "current_rows", "status")))
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert states[-1] == [("a", 40, "failed")]


def test_latest_jobs(spark):
    rows = [("b", 1), ("a", 1), ("c", 2)]
    found = runlog.latest_jobs(spark.createDataFrame(rows, "id string, start_time int"), 2)
    assert [r["id"] for r in found.collect()] == ["c", "a"]
    assert runlog.latest_jobs(spark.createDataFrame(rows, "id string, start_time int")).count() == 3


def test_throughput(spark):
    done = results_table(spark, [ingest.TableResult("a", True, None, 30_013_000, 206 * 10**9), ingest.TableResult("b", False, "x")])
    row = runlog.run_throughput(done).first()
    assert (row["total_rows"], row["seconds"], int(row["rows_per_sec"])) == (30_013_000, 206.0, 145_694)
    assert runlog.run_throughput(done.limit(0)).first()["rows_per_sec"] is None


# -- latency ---------------------------------------------------------------------------------------


def durations(spark, **samples):
    rows = [(n, i, d) for n, values in samples.items() for i, d in enumerate(values)]
    return spark.createDataFrame(rows, "name string, iteration int, duration_ns bigint")


def test_percentile_index(spark):
    found = latency_percentiles(durations(spark, a=range(20, 0, -1), b=[5], c=[3, 3, 3, 9]))
    assert rows_of(found) == [
        ("a", 20, 1, 11, 20, 20, 20, 20),
        ("b", 1, 5, 5, 5, 5, 5, 5),
        ("c", 4, 3, 3, 9, 9, 9, 9),
    ]


def test_mean_is_cut_and_deviation_is_taken_around_it(spark):
    found = rows_of(latency_mean_std(durations(spark, a=[1, 2, 2], z=[0, 0])))
    # The mean of 1, 2, 2 is cut to 1; the deviation around 1 is sqrt(2 / 3).
    assert found == [("a", 3, 1, 0, 1e9), ("z", 2, 0, 0, 0.0)]


def test_tail_flags(spark):
    second = 10**9
    report = latency_report(
        durations(
            spark,
            Insert_slow=[second // 5] * 10,
            Extract_slow=[second] * 10,
            Steady=[10] * 10,
            # 96 fast samples put p95 on a fast one and p99 on a slow one.
            Tail=[10] * 96 + [100] * 4,
        )
    )
    found = {r["name"]: r for r in tail_flags(report).collect()}
    assert set(found) == {"Insert_slow", "Extract_slow", "Tail"}
    assert found["Insert_slow"]["slow_insert"] and found["Extract_slow"]["slow_extract"]
    assert found["Tail"]["high_tail"] and found["Tail"]["p99_p95_ratio"] == 10.0
