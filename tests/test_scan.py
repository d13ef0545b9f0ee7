import random
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from helpers import DATA, plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.types import cursor_literal, cursor_to_text
from tablesync.operators import rank as ranks
from tablesync.operators.rank import values_at_ranks
from tablesync.operators.schema import conform
from tablesync.sources import scan
from tablesync.sources.scan import high_watermark, scan_since, scan_table, write_delta_layout


@pytest.fixture
def deltas(spark):
    return spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 3), (5, None)], "id int, d int")


def test_no_limit_for_zero_and_none(deltas):
    assert scan_table(deltas, 0).count() == scan_table(deltas, None).count() == 5
    assert scan_table(deltas, 2).count() == 2


def test_delta_is_strictly_after_the_cursor_and_null_never_matches(deltas):
    assert rows_of(scan_since(deltas, "d", F.lit(2)), "id") == [(4,)]
    assert rows_of(scan_since(deltas, "d", F.lit(2), inclusive=True), "id") == [(2,), (3,), (4,)]
    assert rows_of(scan_since(deltas, "d", None), "id") == [(1,), (2,), (3,), (4,)]


def test_ties_at_the_limit(deltas):
    assert rows_of(scan_since(deltas, "d", None, 2), "id") == [(1,), (2,), (3,)]
    assert rows_of(scan_since(deltas, "d", None, 2, ["id"], ties="strict"), "id") == [(1,), (2,)]
    assert scan_since(deltas, "d", F.lit(3), 2).count() == 0
    with pytest.raises(ValueError):
        scan_since(deltas, "d", None, 2, ties="some")


@pytest.mark.parametrize(
    "kind, limit",
    [(k, 7) for k in ("date", "timestamp", "timestamp_ntz", "double", "string", "decimal(12,3)")]
    + [("bigint", n) for n in (1, 40, 99, 1000)],
)
def test_large_limits_give_what_a_top_n_gives(spark, monkeypatch, kind, limit):
    base = F.col("id") - 50
    made = {
        "bigint": (base * 3_000_000_017).cast("bigint"),
        "date": F.date_add(F.lit(date(1970, 1, 1)), (base * 41).cast("int")),
        "timestamp": F.timestamp_micros((base * 86_400_123_457).cast("bigint")),
        "timestamp_ntz": F.timestamp_add("MICROSECOND", base * 86_400_123_457, F.lit("1970-01-01").cast("timestamp_ntz")),
        "double": base / 7,
        "string": F.lpad(F.col("id").cast("string"), 5, "0"),
        "decimal(12,3)": (base / 4).cast("decimal(12,3)"),
    }[kind]
    # Every value is there twice, so an odd limit cuts a tie.
    rows = spark.range(50).union(spark.range(50)).withColumn("v", made).withColumn("k", F.monotonically_increasing_id())
    expected = {t: rows_of(scan_since(rows, "v", None, limit, ["k"], t)) for t in ("keep", "strict")}
    monkeypatch.setattr(scan, "TOP_N_ROWS", 0)
    for ties, found in expected.items():
        assert rows_of(scan_since(rows, "v", None, limit, ["k"], ties)) == found


def test_values_at_ranks_with_a_group_of_most_rows(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("g"),
        ((F.col("id") * 7919) % 1009 * F.lit(10).cast("bigint") ** 9 - 10**11).cast("bigint").alias("v"),
    )
    ends = [F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
    ranks = rows.groupBy("g").agg(*ends).select(
        "g", "low", "high", F.inline(F.array(*[
            F.struct(F.lit(n).alias("name"), F.floor(F.col("n") * F.lit(p)).cast("bigint").alias("rank"))
            for n, p in (("first", 0.0), ("mid", 0.5), ("last", 0.9999))
        ]))
    )
    found = {(r["g"], r["name"]): r["v"] for r in values_at_ranks(rows, ["g"], "v", ranks).collect()}
    for g in ("rare", "hot"):
        values = sorted(r["v"] for r in rows.where(F.col("g") == g).collect())
        n = len(values)
        assert [found[g, x] for x in ("first", "mid", "last")] == [values[0], values[n // 2], values[int(n * 0.9999)]]


def test_zone_less_times_around_the_hour_that_comes_twice(spark, monkeypatch):
    start = F.lit("2024-10-27 00:00:00").cast("timestamp_ntz")
    rows = spark.range(300).select("id", F.timestamp_add("MINUTE", F.col("id"), start).alias("d"))
    monkeypatch.setattr(scan, "TOP_N_ROWS", 0)
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session_zone in ("Europe/Berlin", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            assert rows_of(scan_since(rows, "d", None, 150), "id") == sorted(((i,) for i in range(150)), key=repr)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("values", [[5], [3, 3, 3], [-(2**63), -1, 0, 2**63 - 1], [0, 2**62], [-(2**40), 7, 2**40], []])
def test_ranks_over_any_range(spark, values):
    rows = spark.createDataFrame([(1, v) for v in values], "g int, v bigint")
    ends = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranks = ends.select("g", "low", "high", F.posexplode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("name", "r"))
    ranks = ranks.select("g", "low", "high", F.col("name").cast("string").alias("name"), F.col("r").cast("bigint").alias("rank"))
    found = sorted((int(r["name"]), r["v"]) for r in values_at_ranks(rows, ["g"], "v", ranks).collect())
    assert found == list(enumerate(sorted(values)))


def test_high_watermark_starts_at_the_epoch_or_least_value(spark):
    def mark(ddl, rows):
        return high_watermark(spark.createDataFrame(rows, ddl), "d").first()[0]

    assert mark("d timestamp_ntz", [(None,)]) == datetime(1970, 1, 1)
    assert mark("d date", []) == date(1970, 1, 1)
    assert mark("d int", [(None,)]) == -(2**31)
    assert mark("d string", []) == ""
    assert mark("d int", [(3,), (None,), (7,)]) == 7
    with pytest.raises(ValueError):
        mark("d array<int>", [])


@pytest.mark.parametrize(
    "kind, value",
    [
        ("bigint", 2**53 + 1),
        ("double", 0.1 + 0.2),
        ("timestamp_ntz", datetime(2024, 3, 31, 2, 30, 0, 123456)),
        ("timestamp", datetime(2024, 10, 27, 1, 30, 0, 654321, tzinfo=timezone.utc)),
        ("date", date(2024, 2, 29)),
        ("string", "a'b\\c"),
    ],
)
def test_cursor_text_is_read_back_without_loss(spark, kind, value):
    rows = spark.createDataFrame([(value,)], f"d {kind}")
    data_type = rows.schema["d"].dataType
    text = rows.select(cursor_to_text(F.max("d"), data_type)).first()[0]
    assert rows.where(F.col("d") == cursor_literal(text, data_type)).count() == 1


def test_zoned_cursor_survives_the_hour_that_comes_twice(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        twice = [datetime(2024, 10, 27, h, 30, tzinfo=timezone.utc) for h in (0, 1)]
        rows = spark.createDataFrame([(t,) for t in twice], "d timestamp")
        texts = {r[0] for r in rows.groupBy("d").agg(cursor_to_text(F.max("d"), T.TimestampType()).alias("t")).select("t").collect()}
        assert len(texts) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_delta_filter_and_cut_reach_the_scan(spark):
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet")
    start = F.lit("2024-01-20").cast("timestamp_ntz")
    plan = plan_of(scan_since(events, "ts", start, 10).select("event_id"))
    assert "GreaterThan(ts,2024-01-20T00:00)" in plan
    assert "LessThanOrEqual(ts,ScalarSubquery" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    assert "Python" not in plan


def test_the_delta_filter_passes_the_casts_of_conform(spark):
    events = conform(spark.read.parquet(f"{DATA}/sf0.001/events.parquet"))
    plan = plan_of(scan_since(events, "ts", F.lit("2024-01-20").cast("timestamp_ntz")))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-20T00:00)]" in plan


def test_delta_layout_skips_files_and_splits_a_hot_delta(spark, folder):
    rows = spark.range(0, 4000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id")).cast("bigint").alias("d")
    )
    write_delta_layout(rows, "d", folder, 8)
    laid_out = spark.read.parquet(folder)
    assert laid_out.count() == 4000
    per_file = laid_out.groupBy(F.col("_metadata.file_path").alias("f"))
    spans = per_file.agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n")).collect()
    assert len(spans) == 8
    # A third of the rows share one delta; they do not end up in one file.
    assert len([s for s in spans if s["low"] <= 1000 <= s["high"]]) > 1
    assert max(s["n"] for s in spans) < 1000
    # A scan after the cursor needs few of the files.
    assert len([s for s in spans if s["high"] > 3500]) <= 2


ORDERED = "d double, m decimal(30,4), s string, k int, t struct<a:int,b:string>"


def ordered_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        x = rng.choice([5.0, 5.0, rng.uniform(-1e9, 1e9), float("nan"), -0.0, rng.choice([1e-300, 2.5, float("inf")])])
        m = None if i % 50 == 0 else Decimal(rng.randint(-(10**25), 10**25)) / 10000 if i % 3 else Decimal(7)
        rows.append((x, m, rng.choice(["", "ä", "same", "same", str(rng.random())]), rng.choice([None, 1, rng.randint(0, 50)]), (rng.randint(0, 3), None)))
    return spark.createDataFrame(rows, ORDERED).repartition(4)


@pytest.mark.parametrize("order", [["d"], ["m"], ["s"], ["t"], ["s", "k", "d"], ["k", "m", "s", "d"]])
def test_row_at_rank_of_any_type(spark, monkeypatch, folder, order):
    monkeypatch.setattr(ranks, "PIVOTS", 4)
    ordered_rows(spark).write.parquet(folder)
    rows = spark.read.parquet(folder)
    names = [f"k{i}" for i in range(len(order))]
    keys = [tuple(r) for r in rows.orderBy(*order).select(*order).collect()]
    for rank in (0, 1, 333, 450, 899, 5000):
        key, place = ranks.row_at_rank(rows, [F.col(c) for c in order], rank, 3)
        at = min(rank, 899)
        assert repr(tuple(key.select("key.*").select(*names).first())).replace("-0.0", "0.0") == repr(keys[at]).replace("-0.0", "0.0")
        same = [i for i, k in enumerate(keys) if repr(k).replace("-0.0", "0.0") == repr(keys[at]).replace("-0.0", "0.0")]
        assert place == at - same[0]
    assert ranks.row_at_rank(rows.limit(0), [F.col("d")], 0, 3) is None


@pytest.mark.parametrize(("delta", "keys"), [("d", ["s", "k"]), ("m", ["k"]), ("s", ["d"]), ("k", ["s", "d", "m"]), ("s", [])])
def test_large_limits_of_any_type(spark, monkeypatch, folder, delta, keys):
    ordered_rows(spark).write.parquet(folder)
    rows = spark.read.parquet(folder).where(F.col(delta).isNotNull())
    count = rows.count()
    sort = lambda t: sorted(map(repr, t.select(delta, *keys).collect()))
    for limit in (1, 250, 600, 2000):
        strict = sort(rows.orderBy(delta, *keys).limit(limit))
        kept = sort(scan_since(rows, delta, None, limit))
        with monkeypatch.context() as m:
            m.setattr(scan, "TOP_N_ROWS", 5)
            m.setattr(ranks, "PIVOTS", 8)
            assert sort(scan_since(rows, delta, None, limit)) == kept
            found = sort(scan_since(rows, delta, None, limit, keys, "strict"))
            assert len(found) == min(limit, count) and (found == strict or not keys)


def test_a_search_by_pivots_sorts_no_large_part(spark, folder):
    spark.range(0, 60_000, 1, 8).select((F.col("id") % 3 / 2).alias("d"), "id").write.parquet(folder)
    rows = spark.read.parquet(folder)
    taken = scan_since(rows, "d", None, 30_000, ["id"], "strict")
    assert taken.count() == 30_000 and taken.where("d < 0.5").count() == 20_000
    assert taken.where("d = 0.5").agg(F.max("id")).first()[0] < 30_001
    assert "Sort" not in plan_of(taken) and "TakeOrdered" not in plan_of(taken)  # equal rows are only counted off
