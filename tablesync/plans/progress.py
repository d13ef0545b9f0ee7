"""Progress of a copy while it runs, and the table that keeps it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import DataFrame, SparkSession

#: Files of one level that are packed into one file of the next.
PACK = 16


def rows_written(spark: SparkSession, tag: str) -> int:
    """Rows that the tasks of the tagged jobs have written so far, as their executors have reported."""
    context = spark.sparkContext._jsc.sc()
    store, total = context.statusStore(), 0
    for job in context.statusTracker().getJobIdsForTag(tag):
        stages = store.job(job).stageIds()
        for i in range(stages.size()):
            try:
                total += store.lastStageAttempt(stages.apply(i)).outputRecords()
            except Exception:  # a stage that is not planned yet has no attempt
                continue
    return total


@contextmanager
def watched(spark: SparkSession, report: Callable[[int], None], seconds: float) -> Iterator[None]:
    """Reports the rows written by the jobs of this thread, every so many seconds if there are more of them."""
    tag, done = f"copy-{uuid.uuid4().hex}", Event()

    def look() -> None:
        shown = 0
        while not done.wait(seconds):
            rows = rows_written(spark, tag)
            if rows > shown:
                shown = rows
                report(rows)

    spark.sparkContext.addJobTag(tag)
    watcher = Thread(target=look, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        done.set()
        watcher.join()
        spark.sparkContext.removeJobTag(tag)


def put_packed(rows: DataFrame, path: str, owner: str) -> None:
    """Add rows to a table of files as one file, and pack the owner's files once `PACK` of a level have come together.

    So the files of an owner grow with the logarithm of their number. A file is moved in when it is whole, and the files it was
    packed from are deleted after that: a reader, or a packing that died, may meet rows twice and never misses one. An
    owner has one writer at a time.
    """
    spark = rows.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    prefix = f"events-{owner}-"

    def move_in(table: DataFrame, level: int) -> None:
        folder = f"{path.rstrip('/')}/_new-{uuid.uuid4().hex}"
        table.coalesce(1).write.parquet(folder)
        new = spark._jvm.org.apache.hadoop.fs.Path(folder)
        for status in files.listStatus(new):
            if status.getPath().getName().startswith("part-"):
                files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(where, f"{prefix}{level}-{uuid.uuid4().hex}.parquet"))
        files.delete(new, True)

    move_in(rows, 0)
    level = 0
    while True:
        held = [s.getPath() for s in files.listStatus(where) if s.getPath().getName().startswith(f"{prefix}{level}-")]
        if len(held) < PACK:
            return
        move_in(spark.read.schema(rows.schema).parquet(*[p.toString() for p in held]), level + 1)
        for one in held:
            files.delete(one, False)
        level += 1
