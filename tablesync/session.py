"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tablesync", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package is tuned for; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        "spark.sql.session.timeZone": "UTC",
        "spark.scheduler.mode": "FAIR",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, in the folder all executors share.

    The cluster names that folder in `spark.checkpoint.dir`. Only a local master may go without
    it: there the driver's temporary folder is the folder of every task.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tablesync-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_folders: ContextVar[list[str] | None] = ContextVar("settled_folders", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the folders that `settle` wrote inside, but for those it was asked to keep.

    What is kept must have been written, and nothing that is read later may still depend on a deleted folder.
    """
    token = _folders.set([])
    try:
        yield
    finally:
        written = _folders.get() or []
        _folders.reset(token)
        for path in written:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle(table: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The table written to the shared folder and read back.

    What comes after starts from the written rows: they are not worked out again, survive lost
    executors, and have a file size by which Spark picks its joins. `keep` spares the folder from `temporary`.
    """
    path = scratch_dir(table.sparkSession, label)
    table.write.parquet(path)
    written = _folders.get()
    if written is not None and not keep:
        written.append(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
