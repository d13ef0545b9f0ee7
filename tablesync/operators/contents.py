"""Comparing the contents of two tables by digests of key buckets, and key by key where these differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named, named_all
from tablesync.operators.schema import schema_diff
from tablesync.operators.versions import bucket_of
from tablesync.session import settle

#: Key buckets of a comparison: the digests of both sides are this many rows, whatever the tables hold.
DIGEST_BUCKETS = 1 << 16

STATUSES = ("missing", "extra", "stale", "ahead", "differs")


def row_hashes(schema: T.StructType) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. A NULL counts with its place, and the entries of a map in their order by key."""
    values = [F.array_sort(F.map_entries(named(f.name))) if isinstance(f.dataType, T.MapType) else named(f.name) for f in schema]
    nulls = F.concat(*[F.when(named(f.name).isNull(), "1").otherwise("0") for f in schema])
    return F.xxhash64(F.lit(1), nulls, *values), F.xxhash64(F.lit(2), nulls, *values)


def _sides(source: DataFrame, target: DataFrame, columns: list[Column]) -> DataFrame:
    """Both tables under each other with `_sign`, 1 for the source and -1 for the target, and the hashes of their rows."""
    diff = schema_diff(source.schema, target.schema)
    if any(diff.values()):
        raise ValueError(f"tables differ in their columns: {diff}")
    sum_hash, xor_hash = row_hashes(source.schema)
    parts = [
        table.select(*columns, F.lit(sign).alias("_sign"), sum_hash.alias("_sum"), xor_hash.alias("_xor"))
        for table, sign in ((source, 1), (target.select(*named_all(source.columns)), -1))
    ]
    return parts[0].unionByName(parts[1])


def unlike() -> Column:
    """Whether the rows of a group are not the same on both sides, as multisets: their number, the sum of one hash or the
    exclusive or of another is left over. All three combine before the shuffle, so a hot key costs as little as any."""
    over = F.sum(F.col("_sign") * F.col("_sum").cast("decimal(20,0)"))
    return (F.sum("_sign") != 0) | (over != 0) | (F.bit_xor("_xor") != 0)


def differing_buckets(source: DataFrame, target: DataFrame, keys: list[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """`_bucket` of every key bucket that does not hold the same rows on both sides. Only digests are shuffled."""
    rows = _sides(source, target, [bucket_of(keys, buckets).alias("_bucket")])
    return rows.groupBy("_bucket").agg(unlike().alias("_unlike")).where("_unlike").select("_bucket")


def _per_key(rows: DataFrame, keys: list[str], names: list[str], version: str | None) -> DataFrame:
    """`(*keys, source_version, target_version, status, _unlike)` of the rows of `_sides`, grouped by key on the map side first."""
    on = lambda sign, column: F.max(F.when(F.col("_sign") == sign, F.col(column)))
    per_key = rows.groupBy(*names).agg(
        on(1, "_sign").alias("_in_source"),
        on(-1, "_sign").alias("_in_target"),
        on(1, "_version").alias("source_version"),
        on(-1, "_version").alias("target_version"),
        unlike().alias("_unlike"),
    )
    here, there = F.col("source_version"), F.col("target_version")
    status = (
        F.when(F.col("_in_target").isNull(), "missing")
        .when(F.col("_in_source").isNull(), "extra")
        .when((there < here) | (there.isNull() & here.isNotNull()), "stale")
        .when((there > here) | (here.isNull() & there.isNotNull()), "ahead")
        .when(F.col("_unlike"), "differs")
        .otherwise("same")
    )
    versions = [here, there] if version is not None else []
    return per_key.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], *versions, status.alias("status"), "_unlike")


def _keyed(source: DataFrame, target: DataFrame, keys: list[str], version: str | None) -> DataFrame:
    value = named(version) if version is not None else F.lit(None).cast("int")
    names = [f"_key{i}" for i in range(len(keys))]
    rows = _sides(source, target, [*[named(k).alias(n) for k, n in zip(keys, names)], value.alias("_version")])
    return _per_key(rows, keys, names, version)


def compare_contents(
    source: DataFrame, target: DataFrame, keys: list[str], version: str | None = None, buckets: int = DIGEST_BUCKETS
) -> DataFrame:
    """`(*keys, source_version, target_version, status)` of every key whose rows are not the same on both sides.

    The status is `missing` in the target or `extra` there; `stale` or `ahead` if the target's greatest version is
    older or newer (NULL is older than all); `differs` if the versions agree and the contents do not. Buckets of equal digests are not
    looked into: of a copy with few faults only the rows that share a bucket with one are grouped by key. The
    numbers of the other buckets are written down, `buckets` whole numbers at most, and sent to every task. Without keys all columns are
    the key, and a row that is held in different numbers `differs`.
    """
    keys = keys or source.columns
    open_ = F.broadcast(settle(differing_buckets(source, target, keys, buckets), "differing-buckets"))
    near = [table.withColumn("_bucket", bucket_of(keys, buckets)).join(open_, "_bucket", "left_semi").drop("_bucket") for table in (source, target)]
    return _keyed(*near, keys, version).where("_unlike").drop("_unlike")


def content_report(
    source: DataFrame, target: DataFrame, keys: list[str], version: str | None = None, buckets: int = DIGEST_BUCKETS
) -> DataFrame:
    """One row that says whether a copy holds what its source holds: rows on each side, and keys of each status."""
    counts = [table.agg(F.count("*").alias("n")).scalar() for table in (source, target)]
    of = lambda status: F.count_if(F.col("status") == status)
    faults = compare_contents(source, target, keys, version, buckets).agg(*[of(s).alias(s) for s in STATUSES])
    return faults.select(counts[0].alias("source_rows"), counts[1].alias("target_rows"), *STATUSES)


def compare_tables(source: DataFrame, target: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Every key of both tables with its status: those of `compare_contents`, or `same`.

    Contents are compared in the columns that both have. Both sides go through one grouping by key that combines on
    the map side, in place of two joins.
    """
    common = [c for c in source.columns if c in target.columns]
    return _keyed(*[t.select(*named_all(common)) for t in (source, target)], keys, version).drop("_unlike")


def verify_sync(source: DataFrame, target: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row that says whether a copy is complete: keys on each side and what differs, by status."""
    compared = compare_tables(source, target, keys, version)
    of = lambda status: F.count_if(F.col("status") == status)
    return compared.agg(
        F.count_if(F.col("status") != "extra").alias("source_keys"),
        F.count_if(F.col("status") != "missing").alias("target_keys"),
        *[of(s).alias(s) for s in STATUSES],
    )
