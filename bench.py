"""Times the headline work at $BENCH_SF_DIR and prints one JSON line.

Scans are written to Spark's `noop` sink, which computes every row and stores none. Each entry is the
median of a few runs after a warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tablesync import build_session, scratch_dir  # noqa: E402
from tablesync.operators.latency import latency_report  # noqa: E402
from tablesync.operators.schema import conform  # noqa: E402
from tablesync.plans.ingest import RunLog, Target, ingest_tables  # noqa: E402
from tablesync.plans.inputs import TABLES, instant, read  # noqa: E402
from tablesync.plans.queries import QUERIES  # noqa: E402
from tablesync.plans.spec import Polling, RunConfig, TableConfig, resolve_specs  # noqa: E402
from tablesync.sinks.append import append_rows  # noqa: E402
from tablesync.sources.scan import scan_since, scan_table  # noqa: E402
from tablesync.sources.tables import FileSource  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(table: DataFrame) -> None:
    table.write.format("noop").mode("overwrite").save()


def extract(spark: SparkSession, rows: int):
    return lambda: drain(conform(scan_table(read(spark, SF_DIR, "lineitem"), rows)))


def insert(spark: SparkSession, rows: int, batch: int):
    source = conform(scan_table(read(spark, SF_DIR, "lineitem"), rows))
    return lambda: append_rows(source, scratch_dir(spark, "bench"), batch_size=batch)


def cdc_read(spark: SparkSession, rows: int):
    start = instant("2024-01-01 00:00:00")
    return lambda: drain(scan_since(read(spark, SF_DIR, "events"), "ts", start, rows))


def sync(spark: SparkSession, tables: tuple[str, ...], polled: dict[str, str], limit: int = 0):
    config = RunConfig(
        limit=limit,
        tables=[TableConfig(t, polling=Polling(True, polled[t], 60) if t in polled else None) for t in tables]
    )
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "events": ["event_id"]}

    def run() -> None:
        target = Target(spark, scratch_dir(spark, "bench"))
        results = ingest_tables(FileSource(spark, SF_DIR, keys), resolve_specs(config), target, RunLog("bench"))
        failed = [r for r in results if not r.success]
        if failed:
            raise RuntimeError(str(failed))

    return run


def registered(spark: SparkSession, name: str):
    return lambda: drain(QUERIES[name](spark, SF_DIR))


def main() -> None:
    spark = build_session(
        "tablesync-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    three = ("orders", "lineitem", "events")
    polled = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
    copied = tuple(t for t in TABLES if t != "embeddings")
    work = {
        "extract_1k": extract(spark, 1_000),
        "extract_10k": extract(spark, 10_000),
        "extract_100k": extract(spark, 100_000),
        "extract_all": extract(spark, 0),
        "insert_1k": insert(spark, 1_000, 500),
        "insert_10k_500": insert(spark, 10_000, 500),
        "insert_10k": insert(spark, 10_000, 1_000),
        "insert_50k": insert(spark, 50_000, 2_000),
        "insert_all": insert(spark, 0, 0),
        "cdc_1k": cdc_read(spark, 1_000),
        "cdc_10k": cdc_read(spark, 10_000),
        "multi_table_3x10k": sync(spark, three, {}, 10_000),
        "sync_3_tables": sync(spark, three, {}),
        "sync_3_tables_versioned": sync(spark, three, polled),
        "sync_all_tables": sync(spark, copied, polled),
    }
    names = [
        "current_lineitem", "current_events_by_user", "current_no_key", "lineitem_version_stats",
        "compacted_equals_current", "current_after_compaction", "cdc_two_polls", "cdc_stream_available_now",
        "change_kinds", "rows_missed", "sync_report", "soft_delete_active", "delta_topn_ties", "delta_large_limit",
        "delta_layout_scan", "high_watermarks", "table_row_counts", "catalog_primary_key", "catalog_ddl",
        "conform_orders", "latest_progress", "table_status", "job_rollup", "progress_fold", "latency_ranks",
        "latency_flags", "update_severity",
    ]
    work |= {name: registered(spark, name) for name in names}
    only = sys.argv[1:]
    seconds = {}
    samples = []
    for name, run in work.items():
        if only and name not in only:
            continue
        run()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
        samples += [(name, i, int(t * 1e9)) for i, t in enumerate(times)]
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    durations = spark.createDataFrame(samples, "name string, iteration int, duration_ns bigint")
    latency = {
        r["name"]: {"p50_ms": round(r["p50_ns"] / 1e6, 1), "p95_ms": round(r["p95_ns"] / 1e6, 1),
                    "ops_per_sec": round(r["ops_per_sec"], 2)}
        for r in latency_report(durations).collect()
    }

    def rate(tables: tuple[str, ...], name: str) -> float | None:
        if name not in seconds:
            return None
        rows = sum(read(spark, SF_DIR, t).agg(F.count("*")).first()[0] for t in tables)
        return round(rows / seconds[name])

    line = {
        "metric": "total_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "latency": latency,
        "rows_per_sec": {
            "sync_3_tables": rate(three, "sync_3_tables"),
            "sync_3_tables_versioned": rate(three, "sync_3_tables_versioned"),
            "sync_all_tables": rate(copied, "sync_all_tables"),
        },
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
