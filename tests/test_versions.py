from datetime import datetime

import pytest
from helpers import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.operators import versions
from tablesync.operators import contents
from tablesync.operators.contents import compare_contents, compare_tables, content_report, verify_sync
from tablesync.operators.versions import (
    classify_changes,
    current_view,
    late_rows,
    soft_delete_filter,
    split_current,
    version_stats,
)
from tablesync.sinks.append import append_rows
from tablesync.streaming.cdc import poll_once
from tablesync.streaming.versionlog import VersionLog


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def brute_force(rows):
    """Newest (key, version, payload) per key; NULL loses, and the greater payload wins a tie."""
    best = {}
    for row in rows:
        order = tuple((c is not None, c if c is not None else 0) for c in row[1:])
        if row[0] not in best or order > best[row[0]][0]:
            best[row[0]] = (order, row)
    return sorted((r for _, r in best.values()), key=repr)


def test_the_greatest_version_wins_and_null_loses(spark):
    rows = [(5, at(10), "warning"), (5, at(10, 5), "critical"), (5, None, "x"), (6, None, "only"), (None, at(1), "n"), (None, at(2), "m")]
    table = spark.createDataFrame(rows, "k int, v timestamp_ntz, s string")
    assert rows_of(current_view(table, ["k"], "v"), "k", "s") == [(5, "critical"), (6, "only"), (None, "m")]


def test_version_ties_go_to_the_later_batch(spark):
    table = spark.createDataFrame([(1, 7, "z", 1), (1, 7, "a", 2)], "k int, v int, s string, _batch_id bigint")
    assert rows_of(current_view(table, ["k"], "v", "_batch_id"), "s") == [("a",)]
    assert rows_of(current_view(table.drop("_batch_id"), ["k"], "v"), "s") == [("z",)]


def test_composite_key_and_no_key(spark):
    table = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (1, 2, 5), (1, 2, 5)], "a int, b int, v int")
    assert rows_of(current_view(table, ["a", "b"], "v")) == [(1, 1, 6), (1, 2, 5)]
    assert rows_of(current_view(table, None)) == [(1, 1, 5), (1, 1, 6), (1, 2, 5)]
    with pytest.raises(ValueError):
        current_view(table, ["a"])


ROWS = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)), min_size=1, max_size=25
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, cut=st.integers(0, 25))
def test_laws_of_the_current_view(spark, rows, cut):
    table = spark.createDataFrame(rows, "k int, v int, p int")
    expected = brute_force(rows)
    view = current_view(table, ["k"], "v")
    assert rows_of(view) == expected
    # It does not depend on row order or partitioning, and applying it again changes nothing.
    assert rows_of(current_view(table.orderBy(F.desc("p")).repartition(3), ["k"], "v")) == expected
    assert rows_of(current_view(view, ["k"], "v")) == expected
    # Merging later rows into a compacted base gives what one grouping of all rows gives.
    base = current_view(spark.createDataFrame(rows[:cut], "k int, v int, p int"), ["k"], "v")
    pending = spark.createDataFrame(rows[cut:], "k int, v int, p int")
    untouched, changed = split_current(base, pending, ["k"], ["v"])
    assert rows_of(untouched.unionByName(changed)) == expected


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    table = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    view = current_view(table, ["k"], "v")
    plan = plan_of(view)
    assert "Partial" in plan and "Python" not in plan
    assert view.count() == 2001 and view.where("k = -1").first()["v"] == 2997


def test_soft_delete_looks_at_the_newest_version_only(spark):
    rows = [(1, 1, None), (1, 2, at(5)), (2, 1, at(4)), (2, 2, None)]
    table = spark.createDataFrame(rows, "k int, v int, deleted_at timestamp_ntz")
    assert rows_of(soft_delete_filter(current_view(table, ["k"], "v")), "k") == [(2,)]


def test_version_stats(spark):
    table = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows_of(version_stats(table, ["k"])) == [(6, 3, 3, 2, 3)]
    assert rows_of(version_stats(table.limit(0), ["k"])) == [(0, 0, 0, 0, 0)]


def test_classify_changes(spark):
    current = spark.createDataFrame([(1, 5), (2, 5), (None, 1)], "k int, v int")
    delta = spark.createDataFrame([(1, 6), (1, 5), (2, 4), (3, 1), (None, 2)], "k int, v int")
    found = rows_of(classify_changes(delta, current, ["k"], "v"))
    assert found == [(1, 5, "unchanged"), (1, 6, "update"), (2, 4, "unchanged"), (3, 1, "insert"), (None, 2, "update")]


def test_late_rows(spark):
    source = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (None, 1), (4, None)], "k int, d int")
    target = spark.createDataFrame([(1, 1), (2, 1)], "k int, d int")
    assert rows_of(late_rows(source, target, ["k"], "d", F.lit(5))) == [(2, 2), (None, 1)]


def test_compare_and_verify(spark):
    source = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (5, None)], "k int, v int")
    target = spark.createDataFrame([(1, 5), (2, 4), (4, 1), (5, None)], "k int, v int")
    found = dict(rows_of(compare_tables(source, target, ["k"], "v"), "k", "status"))
    assert found == {1: "same", 2: "stale", 3: "missing", 4: "extra", 5: "same"}
    assert rows_of(verify_sync(source, target, ["k"], "v")) == [(4, 4, 1, 1, 1, 0, 0)]


CONTENTS = "k int, v int, a string, b string, m map<string,int>"


def test_contents_are_compared_beyond_versions(spark):
    source = spark.createDataFrame(
        [(1, 5, "x", None, {"a": 1, "b": 2}), (2, 5, "x", None, None), (3, 5, "x", "y", None), (4, 5, "x", "y", None), (5, None, "x", "y", None),
         (6, 1, "x", "y", None), (7, 1, "p", "p", None), (7, 1, "q", "q", None), (None, 1, "n", "n", None), (8, 1, "c", "c", None), (8, 1, "c", "c", None)], CONTENTS)
    target = spark.createDataFrame(
        [(1, 5, "x", None, {"b": 2, "a": 1}), (2, 5, None, "x", None), (3, 6, "x", "y", None), (4, 5, "x", "z", None), (5, 1, "x", "y", None),
         (7, 1, "q", "q", None), (7, 1, "p", "p", None), (None, 1, "n", "m", None), (8, 1, "c", "c", None), (9, 1, "e", "e", None)], CONTENTS)
    want = {2: "differs", 3: "ahead", 4: "differs", 5: "ahead", 6: "missing", None: "differs", 8: "differs", 9: "extra"}
    for buckets in (1, 3, 1 << 16):
        assert dict(rows_of(compare_contents(source, target, ["k"], "v", buckets), "k", "status")) == want
    assert dict(rows_of(compare_tables(source, target, ["k"], "v"), "k", "status")) == want | {1: "same", 7: "same"}
    assert rows_of(content_report(source, target, ["k"], "v")) == [(11, 10, 1, 1, 0, 2, 4)]
    assert rows_of(content_report(source, source.repartition(3), ["k"])) == [(11, 11, 0, 0, 0, 0, 0)]
    plain = [t.select("k", "v", "a", "b") for t in (source, target)]
    assert dict(rows_of(compare_contents(*plain, []), "k", "status"))[8] == "differs"
    with pytest.raises(ValueError, match="columns"):
        compare_contents(source, target.drop("a"), ["k"], "v")


def test_only_differing_buckets_are_looked_into(spark):
    source = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    target = source.withColumn("v", F.when(F.col("k") == 77, 2).otherwise(F.col("v")))
    assert rows_of(contents.differing_buckets(source, target, ["k"], 1000)) == rows_of(source.where("k = 77").select(contents.bucket_of(["k"], 1000)))
    assert rows_of(compare_contents(source, target, ["k"], "v", 1000)) == [(77, 1, 2, "ahead")]


# -- version log -------------------------------------------------------------------------------


@pytest.fixture(params=[1, 4])
def log(spark, folder, request):
    schema = spark.createDataFrame([], "k int, v int, p string").schema
    return VersionLog(spark, folder, schema, ["k"], "v", request.param, "t")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v int, p string")


def test_log_append_counts_and_finds_the_cursor(spark, log):
    stored = log.append(batch(spark, (1, 1, "a"), (2, 3, "b"), (3, None, "c")), 0)
    assert (stored.rows, stored.last_seen) == (3, "3")
    assert log.append(batch(spark), 1).rows == 0
    assert rows_of(log.versions(), "k", "_batch_id") == [(1, 0), (2, 0), (3, 0)]


def test_log_replay_replaces_the_whole_batch(spark, log):
    log.append(batch(spark, *[(i, 1, "a") for i in range(20)]), 0)
    log.append(batch(spark, *[(i, 1, "b") for i in range(5)]), 0)
    assert rows_of(log.versions(), "k", "p") == [(i, "b") for i in range(5)]


def test_log_is_empty_before_the_first_batch(log):
    assert log.versions().count() == log.current().count() == 0
    assert log.manifest() == [] and log.cursor().batch_id == -1 and log.cursor().last_seen is None


def test_cursor_slots(log):
    for batch_id in range(5):
        log.commit(str(batch_id), batch_id)
        assert (log.cursor().batch_id, log.cursor().last_seen) == (batch_id, str(batch_id))
    stored = log.spark.read.parquet(f"{log.root}/cursor")
    assert stored.count() == 2


def test_compaction_keeps_the_view_and_rewrites_changed_buckets_only(spark, log):
    log.append(batch(spark, *[(i, 1, "a") for i in range(40)]), 0)
    log.commit(None, 0)
    log.append(batch(spark, (1, 2, "b"), (2, 0, "late")), 1)
    log.commit(None, 1)
    before = rows_of(log.current())
    assert log.compact() == 0
    assert rows_of(log.current()) == before
    assert log.compact() == 0
    log.append(batch(spark, (1, 3, "c"), (100, 1, "new")), 2)
    log.commit(None, 2)
    log.append(batch(spark, (3, 1, "tie")), 3)
    log.commit(None, 3)
    before = rows_of(log.current())
    assert (1, 3, "c") in before and (100, 1, "new") in before and (3, 1, "tie") in before and (2, 1, "a") in before
    assert log.compact() == 1
    assert rows_of(log.current()) == before
    manifest = log.manifest()
    assert len(manifest) == log.buckets and all(through == 3 for _, _, through in manifest)
    if log.buckets > 1:
        assert {g for _, g, _ in manifest} == {0, 1}


def parts_of(log):
    return sorted((r["bucket"], r["generation"]) for r in log._entries())


def test_new_keys_beyond_the_old_ones_rewrite_nothing(spark, log):
    expected = {}
    for batch_id in range(3):
        rows = [(batch_id * 100 + i, 1, "a") for i in range(40)]
        expected |= {r[0]: r for r in rows}
        log.append(batch(spark, *rows), batch_id)
        log.commit(None, batch_id)
        assert log.compact() == batch_id
        assert parts_of(log) == [(b, g) for b in range(log.buckets) for g in range(batch_id + 1)]
        assert len(log.manifest()) == log.buckets and rows_of(log.current()) == sorted(expected.values(), key=repr)
    # a change of a middle key rewrites the one part that may hold it, and what is read before that is the same
    log.append(batch(spark, (105, 2, "b")), 3)
    log.commit(None, 3)
    expected[105] = (105, 2, "b")
    assert rows_of(log.current()) == sorted(expected.values(), key=repr)
    before = set(parts_of(log))
    log.compact()
    assert {g for _, g in before - set(parts_of(log))} == {1} and len(before - set(parts_of(log))) == 1
    assert rows_of(log.current()) == sorted(expected.values(), key=repr)
    log.vacuum()
    assert rows_of(log.current()) == sorted(expected.values(), key=repr)
    # a key without a value may be anywhere
    log.append(batch(spark, (None, 1, "none"), (None, 2, "none")), 4)
    log.commit(None, 4)
    log.compact()
    assert rows_of(log.current()) == sorted([*expected.values(), (None, 2, "none")], key=repr)


def test_many_parts_become_one(spark, log):
    parts = 9 * log.buckets
    for batch_id in range(9):
        log.append(batch(spark, *[(batch_id * 100 + i, 1, "a") for i in range(20)]), batch_id)
        log.commit(None, batch_id)
        log.compact()
        parts = len(parts_of(log))
        assert parts == (log.buckets if batch_id == 8 else log.buckets * (batch_id + 1))
    assert log.current().count() == 180


@pytest.mark.parametrize(("kind", "keys", "skips"), [
    ("string", ["a", "b\U0001F600", "\uffff", "z"], True), ("decimal(20,0)", [-5, 3, 10**19, 7], True), ("bigint", [-9, 10, 9, 100], True),
    ("double", [1.0, float("nan"), 10.0, 9.0], False), ("decimal(9,2)", [1, 2, 10, 9], False),
])
def test_ranges_of_keys_of_every_type(spark, folder, kind, keys, skips):
    rows = spark.createDataFrame([(str(k), n) for n, k in enumerate(keys)], "k string, v int").select(F.col("k").cast(kind).alias("k"), "v")
    log = VersionLog(spark, folder, rows.schema, ["k"], "v", 1, "t")
    for batch_id in range(len(keys)):
        log.append(rows.where(F.col("v") == batch_id), batch_id)
        log.commit(None, batch_id)
        log.compact()
    assert len(parts_of(log)) == (len(keys) if skips else 1)
    log.append(rows.withColumn("v", F.col("v") + 10), len(keys))
    log.commit(None, len(keys))
    assert log.current().count() == len(keys)
    log.compact()
    assert rows_of(log.current(), "v") == sorted([(n + 10,) for n in range(len(keys))], key=repr)


def test_log_without_a_key(spark, folder):
    schema = batch(spark).schema
    log = VersionLog(spark, folder, schema, [], "v", 4, "t")
    log.append(batch(spark, (1, 1, "a"), (1, 1, "a"), (1, 2, "a"), (None, 1, None)), 0)
    log.commit(None, 0)
    expected = [(1, 1, "a"), (1, 2, "a"), (None, 1, None)]
    assert rows_of(log.current()) == expected
    log.compact()
    log.append(batch(spark, (1, 2, "a"), (None, 1, None), (2, 1, "b")), 1)
    log.commit(None, 1)
    assert rows_of(log.current()) == sorted([*expected, (2, 1, "b")], key=repr)
    log.compact()
    assert rows_of(log.current()) == sorted([*expected, (2, 1, "b")], key=repr)


def test_log_refuses_a_changed_schema(spark, log):
    with pytest.raises(ValueError, match="differ"):
        log.append(spark.createDataFrame([(1, 2)], "k int, v int"), 0)


def test_readers_see_batches_up_to_the_cursor(spark, log):
    log.append(batch(spark, (1, 1, "a")), 0)
    log.commit("1", 0)
    log.append(batch(spark, (1, 2, "b")), 1)
    assert rows_of(log.current()) == [(1, 1, "a")]
    log.compact()
    assert log.manifest()[0][2] == 0
    log.commit("2", 1)
    assert rows_of(log.current()) == [(1, 2, "b")]
    log.compact()
    assert rows_of(log.current()) == [(1, 2, "b")]


def test_the_base_is_not_shuffled_to_meet_a_few_changes(spark, folder):
    rows = spark.range(0, 50_000, 1, 4).selectExpr("CAST(id AS INT) AS k", "CAST(id AS INT) AS v", "repeat('x', 50) AS p")
    log = VersionLog(spark, folder, rows.schema, ["k"], "v", 4, "t")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log.append(rows, 0)
        log.commit("1", 0)
        log.compact()
        log.append(rows.where("k < 10"), 1)
        log.commit("2", 1)
        plan = plan_of(log.current())
        assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
        # Beyond the bound the joins shuffle, with the same rows.
        touched = versions.broadcast_if_small(rows.select("k"), most_bytes=100)
        assert "SortMergeJoin" in plan_of(rows.join(touched, "k", "left_semi"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert log.current().count() == 50_000


def test_a_snapshot_is_written_as_read_and_a_poll_in_few_files(spark, folder):
    rows = spark.range(0, 8000, 1, 8).selectExpr("CAST(id AS INT) AS k", "CAST(id AS INT) AS v", "'x' AS p")
    log = VersionLog(spark, folder, rows.schema, ["k"], "v", 4, "t")
    log.append(rows, 0)
    log.append(rows.where("k % 100 = 0"), 1, few=True)
    files = log.versions().groupBy("_batch_id", F.input_file_name().alias("f")).count().groupBy("_batch_id").count()
    assert rows_of(files) == [(0, 8), (1, 1)]


def test_a_large_bucket_is_spread_over_write_tasks(spark, folder):
    rows = spark.range(0, 100_000, 1, 8).select(
        F.col("id").cast("int").alias("k"), F.col("id").cast("int").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("p"),
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        log = VersionLog(spark, folder, rows.schema, ["k"], "v", 2, "t")
        log.append(rows, 0)
        log.commit(None, 0)
        log.compact()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = spark.read.parquet(f"{folder}/base").groupBy("_bucket", F.input_file_name()).count()
    per_bucket = rows_of(files.groupBy("_bucket").count())
    assert len(per_bucket) == 2 and all(n > 1 for _, n in per_bucket)
    assert log.current().count() == 100_000


def test_vacuum_deletes_only_what_no_reader_needs(spark, log):
    assert log.vacuum() == 0
    log.append(batch(spark, *[(i, 1, "a") for i in range(40)]), 0)
    log.commit(None, 0)
    log.compact()
    log.append(batch(spark, (1, 2, "b")), 1)
    log.commit(None, 1)
    log.compact()
    log.append(batch(spark, (2, 2, "c")), 2)
    log.commit(None, 2)
    before = rows_of(log.current())
    # Two batches, one manifest, and the one bucket that was rewritten.
    assert log.vacuum() == 4
    assert rows_of(log.current()) == before and (2, 2, "c") in before
    assert rows_of(log.versions(), "k", "_batch_id") == [(2, 2)]
    assert log.vacuum() == 0
    log.compact()
    assert rows_of(log.current()) == before


def test_dots_are_part_of_column_names(spark, folder):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, p string")
    rows = rows.toDF("a.k", "a.v", "a.p")
    log = VersionLog(spark, folder, rows.schema, ["a.k"], "a.v", 2, "t")
    assert poll_once(rows.limit(1), log).rows == 1
    log.compact()
    assert poll_once(rows, log, limit=5).rows == 1
    assert rows_of(log.current()) == [(1, 2, "b")]
    assert rows_of(classify_changes(rows, rows.limit(1), ["a.k"], "a.v")) == [
        (1, 1, "a", "unchanged"), (1, 2, "b", "update"), (2, 1, "c", "insert")]
    assert rows_of(verify_sync(rows, rows, ["a.k"], "a.v")) == [(2, 2, 0, 0, 0, 0, 0)]
    append_rows(rows, f"{folder}/plain")
    append_rows(rows, f"{folder}/plain")
    assert spark.read.parquet(f"{folder}/plain").count() == 6
