"""Queries on version logs: tables that hold several versions of a key until they are compacted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named, named_all
from tablesync.session import settle

# The most bytes of key values that are sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def dedup_key(keys: list[str]) -> Column:
    """A 64-bit hash of the key. It places rows in buckets; it never decides which rows are equal."""
    return F.xxhash64(*named_all(keys))


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key, 0 to `buckets - 1`."""
    return F.pmod(dedup_key(keys), F.lit(buckets)).cast("int")


def join_on_key(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which NULL keys are equal, as grouping sees it; the right side's keys are dropped."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[named(c).alias(names.get(c, c)) for c in right.columns])
    match = reduce(lambda a, b: a & b, (named(k).eqNullSafe(F.col(names[k])) for k in keys))
    joined = left.join(renamed, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def is_small(table: DataFrame, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table's values, which are measured, fit into so many bytes."""
    width = F.lit(0).cast("bigint")
    for field in table.schema:
        varies = isinstance(field.dataType, (T.StringType, T.BinaryType))
        width = width + (F.coalesce(F.octet_length(named(field.name)), F.lit(0)) if varies else F.lit(16))
    measured = table.agg(F.sum(width)).first()[0] or 0
    return measured <= most_bytes


def broadcast_if_small(table: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table marked for broadcast if its measured values fit, else as it is.

    Spark's own estimate of what is left after a filter is the size of the whole input, so it would
    shuffle a large table to meet a few rows.
    """
    return F.broadcast(table) if is_small(table, most_bytes) else table


def newest(table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by `order`, then by all remaining columns, so that ties are fixed.

    Spark cuts each key to its first row before the shuffle as well as after it, so a key with a third
    of all rows leaves each task as one row.
    """
    rest = [c for c in table.columns if c not in keys and c not in order]
    if not [*order, *rest]:
        return table.dropDuplicates()
    first = Window.partitionBy(*named_all(keys)).orderBy(*[named(c).desc_nulls_last() for c in (*order, *rest)])
    ranked = table.withColumn("_version_rank", F.row_number().over(first))
    return ranked.where(F.col("_version_rank") == 1).drop("_version_rank")


def current_view(
    table: DataFrame,
    keys: list[str] | None,
    version: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """The newest version of every key.

    Versions that tie go to the later batch, if the log has a batch column, and then to the greatest
    remaining columns. A NULL version loses to every other. Without a key, all columns are the key:
    exact copies collapse and a changed row stays beside its old form.
    """
    if not keys:
        return table.dropDuplicates()
    if version is None:
        raise ValueError("a keyed current view needs a version column")
    order = [c for c in (version, batch) if c is not None and c not in keys]
    return newest(table, keys, order)


def split_current(
    base: DataFrame, pending: DataFrame, keys: list[str], order: list[str], changed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The newest rows of a base with one row per key and of later versions, in two parts.

    The first part is the base without the changed keys, the second the newest row of each changed
    key. The base is not shuffled as long as the changed keys are few: only rows with such a key are
    compared. The keys are written down once and measured. If they are too many to broadcast, all rows are compared and the first part
    is empty: that shuffles the base once, where two joins on the keys and the comparison would shuffle it up to three times.
    `changed` are the distinct changed keys, where they are written down already.
    """
    touched = settle(pending.select(*named_all(keys)).distinct(), "changed-keys") if changed is None else changed
    if not is_small(touched):
        return base.limit(0), newest(base.unionByName(pending), keys, order)
    touched = F.broadcast(touched)
    untouched = join_on_key(base, touched, keys, "left_anti")
    contested = join_on_key(base, touched, keys, "left_semi")
    return untouched, newest(contested.unionByName(pending), keys, order)


def version_stats(table: DataFrame, keys: list[str]) -> DataFrame:
    """Stored versions, keys, superseded versions, keys with several versions, most versions of a key."""
    per_key = table.groupBy(*named_all(keys)).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("stored_versions"),
        F.count("*").alias("current_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("superseded_versions"),
        F.count_if(F.col("n") > 1).alias("keys_with_versions"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most_versions"),
    )


def soft_delete_filter(current: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    """Active rows. The input is a current view: an old version that was not deleted must not return."""
    return current.where(F.col(deleted_at).isNull())


def classify_changes(delta: DataFrame, current: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The delta with a `change` column: `insert`, `update`, or `unchanged` when it is not newer.

    The current table is first cut to the keys of the delta, which are measured, so it is only
    shuffled when those keys are too many to broadcast.
    """
    touched = broadcast_if_small(delta.select(*named_all(keys)).distinct())
    known = current.select(*named_all(keys), named(version).alias("_known"), F.lit(True).alias("_found"))
    known = join_on_key(known, touched, keys, "left_semi")
    joined = join_on_key(delta, known, keys, "left")
    is_newer = named(version) > F.col("_known")
    change = F.when(F.col("_found").isNull(), "insert").when(is_newer, "update").otherwise("unchanged")
    return joined.select(*named_all(delta.columns), change.alias("change"))


def late_rows(source: DataFrame, target: DataFrame, keys: list[str], delta: str, cursor: Column) -> DataFrame:
    """Source rows at or before the cursor whose version never reached the target.

    The target's versions are made distinct first: copies combine on the map side, so that many
    copies of one version do not meet in one task of the join.
    """
    passed = source.where(named(delta) <= cursor)
    seen = target.where(named(delta) <= cursor).select(*named_all([*keys, delta])).distinct()
    return join_on_key(passed, seen, [*keys, delta], "left_anti")
