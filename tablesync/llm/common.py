"""What the operators of this folder share: reading tables, small Arrow helpers, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; a null has none."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; one longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(text_bytes(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def array_chunks(column: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """As `chunks`, for one column."""
    for batch in chunks(iter([pa.RecordBatch.from_arrays([column], ["t"])]), "t", limit):
        yield batch.column(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: 64-bit values to well spread 64-bit values, one to one."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
