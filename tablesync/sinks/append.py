"""Plain append tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named_all
from tablesync.operators.schema import schema_diff


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, partitioned_by: Sequence[str] = ()
) -> None:
    """An empty table of this schema; a table that is already there is left untouched."""
    empty = spark.createDataFrame([], nullable(schema)).coalesce(1)
    empty.write.mode("ignore").partitionBy(*partitioned_by).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def check_schema(source: T.StructType, target: T.StructType, allow_added: bool = False) -> None:
    """Fail before writing when a source no longer fits its table."""
    diff = schema_diff(source, target)
    if allow_added:
        diff["added"] = []
    if any(diff.values()):
        raise ValueError(f"source and table differ: {diff}")


#: Files and row groups are not ended below these numbers of rows for the sake of a batch size.
FILE_ROWS = 1_000_000
GROUP_ROWS = 100_000


def whole_batches(batch_size: int, least: int) -> int:
    """The least whole number of batches that holds `least` rows, in rows."""
    return -(-least // batch_size) * batch_size


def batch_options(batch_size: int) -> dict[str, str]:
    """Writer options that pack batches into files and their row groups.

    A batch is what a database takes as one statement; on files its size must not set the number of files. So files and
    row groups end after a whole number of batches, as soon as they are large enough to read well: no
    batch lies in two of them.
    """
    if batch_size < 0:
        raise ValueError("batch size must not be negative")
    if not batch_size:
        return {}
    return {
        "maxRecordsPerFile": str(whole_batches(batch_size, FILE_ROWS)),
        "parquet.block.row.count.limit": str(whole_batches(batch_size, GROUP_ROWS)),
    }


def append_rows(
    table: DataFrame,
    path: str,
    batch_size: int = 0,
    writers: int = 0,
    observation: Observation | None = None,
    merge_schema: bool = False,
) -> None:
    """Append all rows; columns go by name. Running it twice stores every row twice.

    Files and row groups hold whole batches of `batch_size` rows, and `writers` is the number of tasks that write; both are
    left to Spark when 0, which keeps the write free of a shuffle. With `writers` the rows are dealt out to that many tasks
    and the scan keeps its own. `merge_schema` lets a source add columns, which older rows read as NULL.
    A new table takes the rows' schema from the write itself.
    """
    spark = table.sparkSession
    columns = table.columns
    if _exists(spark, path):
        reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
        target = reader.parquet(path)
        check_schema(table.schema, target.schema, merge_schema)
        columns = table.columns if merge_schema else target.columns
    rows = table.select(*named_all(columns))
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
    if writers:
        rows = rows.repartition(writers)
    rows.write.mode("append").options(**batch_options(batch_size)).parquet(path)
