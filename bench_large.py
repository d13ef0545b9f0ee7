"""The large run: three generated tables of $BENCH_ROWS rows each, copied whole and then followed.

Writes below a new folder of $BENCH_DIR and prints one JSON line with rows per second.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablesync import build_session  # noqa: E402
from tablesync.operators.schema import conform  # noqa: E402
from tablesync.operators.contents import verify_sync  # noqa: E402
from tablesync.plans import samples  # noqa: E402
from tablesync.plans.ingest import RunLog, Target, ingest_tables  # noqa: E402
from tablesync.plans.spec import Polling, TableSpec  # noqa: E402
from tablesync.sources.tables import FileSource  # noqa: E402
from tablesync.streaming.cdc import poll_once  # noqa: E402

ROWS = int(os.environ.get("BENCH_ROWS", "10000000"))
CPUS = os.environ.get("BENCH_CPUS", "8")
CHANGED = 3_333, 6_667
NOW, LATER = "2024-06-01 00:00:00", "2024-06-02 00:00:00"


def main() -> None:
    root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_DIR", "/tmp"))
    spark = build_session(
        "tablesync-large",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(4 * int(CPUS)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"{root}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        out = work()
        seconds[name] = round(time.perf_counter() - start, 2)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        return out

    tables = samples.generate_tables(spark, ROWS, NOW, "large")
    source = FileSource(spark, f"{root}/source", {t: ["id"] for t in tables})

    def generate() -> None:
        for name, table in tables.items():
            table.write.parquet(f"{root}/source/{name}.parquet")

    timed("generate", generate)
    plain = [TableSpec(t) for t in tables]
    versioned = [TableSpec(t, polling=Polling(True, "updated_at", 3)) for t in tables]
    timed("sync_plain", lambda: ingest_tables(source, plain, Target(spark, f"{root}/plain"), RunLog("plain")))
    target = Target(spark, f"{root}/versioned", buckets=16)
    timed("sync_versioned", lambda: ingest_tables(source, versioned, target, RunLog("versioned")))

    logs = {
        t: target.version_log(t, conform(source.table(t)).schema, ["id"], "updated_at")
        for t in tables
    }
    timed("compact", lambda: logs["events"].compact())
    for name, added in samples.add_rows(spark, ROWS, *CHANGED, LATER).items():
        added.write.mode("append").parquet(f"{root}/source/{name}.parquet")
    found = timed("poll_changes", lambda: {t: poll_once(source.table(t), logs[t]).rows for t in ("orders", "events")})
    counts = timed("current_events", lambda: logs["events"].current().count())
    report = timed(
        "verify_events",
        lambda: verify_sync(source.table("events"), logs["events"].current(), ["id"], "updated_at").first().asDict(),
    )
    timed("compact_again", lambda: logs["events"].compact())
    spark.stop()
    rows = ROWS * len(tables)
    rates = {s: round(rows / seconds[s]) for s in ("generate", "sync_plain", "sync_versioned")}
    print(json.dumps({"metric": "rows_per_sec", "value": rates["sync_plain"], "unit": "rows/sec", "rows": rows,
                      "seconds": seconds, "rates": rates, "changes": found, "current": counts, "verify": report}))


if __name__ == "__main__":
    main()
