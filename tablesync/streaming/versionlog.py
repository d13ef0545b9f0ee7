"""A version log on files: replay-safe batches, a cursor, compaction, and the current view."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named, named_all
from tablesync.functions.types import cursor_literal, cursor_to_text
from tablesync.operators.versions import bucket_of, newest, split_current
from tablesync.session import settle
from tablesync.sinks.append import batch_options, check_schema, nullable

CURSOR_SCHEMA = (
    "table string, delta_column string, last_seen string, last_seen_type string, "
    "batch_id bigint, committed_at timestamp"
)
MANIFEST_SCHEMA = "bucket int, generation bigint, through_batch bigint, buckets int, rows bigint, low string, high string"
#: Where the number of buckets is left open, about so many rows go into one.
ROWS_PER_BUCKET = 2_000_000
#: Up to this many pending batches are read by their paths, which spares the listing of their files one folder at a time.
BATCHES_BY_PATH = 1000
#: Up to so many buckets are written by the tasks that compared the rows, each with a file per bucket; the rows of more are brought together first.
FEW_BUCKETS = 16
#: A bucket of so many parts is made one again by the next compaction that meets it.
MOST_PARTS = 8


class KeyRange:
    """The least and the greatest first key column of some rows: what lies outside another range holds none of its keys.

    It is kept as text. Types whose texts do not lead back to their order, and rows with a NULL there, have no range.
    """

    def __init__(self, data_type: T.DataType):
        whole = isinstance(data_type, T.IntegralType) or (isinstance(data_type, T.DecimalType) and data_type.scale == 0)
        self.read = int if whole else str if data_type == T.StringType() else None

    def columns(self, key: str) -> list[Column]:
        """Aggregates `low` and `high`; NULL where there is no range."""
        value = named(key) if self.read else F.lit(None)
        known = F.count_if(value.isNull()) == 0
        return [F.when(known, end(value)).cast("string").alias(name) for end, name in ((F.min, "low"), (F.max, "high"))]

    def apart(self, one: Row, other: Row) -> bool:
        """Whether two ranges are known and share no value. Texts compare by code point, which is their order in UTF-8."""
        if None in (one["low"], other["low"]):
            return False
        low, high, least, greatest = (self.read(x) for x in (one["low"], one["high"], other["low"], other["high"]))
        return high < least or greatest < low


@dataclass(frozen=True)
class Cursor:
    """Where the next poll starts. `last_seen` is None before the first row with a delta."""

    last_seen: str | None = None
    batch_id: int = -1

    def literal(self, data_type: T.DataType) -> Column | None:
        return None if self.last_seen is None else cursor_literal(self.last_seen, data_type)


@dataclass(frozen=True)
class Appended:
    rows: int
    last_seen: str | None


@dataclass(frozen=True)
class VersionLog:
    """The stored versions of one table.

        <root>/log/_batch_id=<b>                   every batch as it came
        <root>/base/_generation=<g>/_bucket=<k>    one row per key, written by compaction
        <root>/manifest/_generation=<g>            which generations hold each bucket, and the range of their keys
        <root>/cursor/slot=<0|1>                   the last two cursors

    A batch is written with overwrite to its own path, so a replayed batch replaces itself whole. Once
    a cursor is committed, readers see the batches up to it and no half-written one, and compaction takes committed batches
    only. The bucket is a hash of the key, by which compaction rewrites only what changed. A bucket is made of parts, which
    share no key; a part whose range holds none of the changed keys is neither rewritten nor compared. The manifest keeps the
    number of buckets: 0 takes that or, at the first compaction, one by the number of rows; another number than
    the stored one makes the next compaction rewrite all buckets. A log has one writer at a time. Reading writes nothing to it.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: list[str]
    version: str
    buckets: int = 0
    name: str = "table"

    def __post_init__(self):
        reserved = {"_batch_id", "_bucket", "_generation"} & set(self.schema.fieldNames())
        if reserved:
            raise ValueError(f"column names kept for the log: {', '.join(sorted(reserved))}")

    @property
    def row_key(self) -> list[str]:
        """The key, or all columns when the table has none."""
        return self.keys or self.schema.fieldNames()

    @property
    def _order(self) -> list[str]:
        """Versions that tie go to the later batch."""
        return [c for c in (self.version, "_batch_id") if c not in self.row_key]

    @property
    def _version_type(self) -> T.DataType:
        return self.schema[self.version].dataType

    # -- writing ---------------------------------------------------------------------------------

    def append(
        self,
        rows: DataFrame,
        batch_id: int,
        few: bool = False,
        batch_size: int = 0,
        seen: str | None = None,
    ) -> Appended:
        """Store one batch and tell, from the same pass, its row count and greatest version.

        A snapshot is written as it is read, without a shuffle. `few` says that few of the rows read
        are left, as in a poll: they are brought together first, or every task would write a tiny
        file. What is observed comes after that step, in the stage that writes, whose tasks count once
        even when an executor is lost. `seen` names a further column that holds the version as the source
        has it; it is observed in place of the stored one and not stored. Files hold whole batches of `batch_size` rows.
        A number that a compaction has taken in is refused: nobody would read the batch.
        """
        through = max((last for _, _, last in self.manifest()), default=-1)
        if batch_id <= through:
            raise ValueError(f"batch {batch_id} of {self.name} is compacted already (through {through})")
        names = self.schema.fieldNames()
        stored = rows.drop(named(seen)) if seen else rows
        check_schema(stored.schema, self.schema)
        batch = rows.select(*named_all([*names, *([seen] if seen else [])]))
        if few:
            batch = batch.hint("rebalance")
        counted = Observation()
        version = seen or self.version
        greatest = cursor_to_text(F.max(named(version)), batch.schema[version].dataType).alias("last_seen")
        observed = batch.observe(counted, F.count(F.lit(1)).alias("rows"), greatest)
        writer = observed.select(*named_all(names)).write.mode("overwrite").options(**batch_options(batch_size))
        writer.parquet(f"{self.root}/log/_batch_id={batch_id}")
        return Appended(int(counted.get["rows"]), counted.get["last_seen"])

    # -- cursor ----------------------------------------------------------------------------------

    def cursor(self) -> Cursor:
        """The last committed cursor."""
        latest = self._control("cursor", CURSOR_SCHEMA, "slot").orderBy(F.desc("batch_id")).first()
        return Cursor() if latest is None else Cursor(latest["last_seen"], latest["batch_id"])

    def commit(self, last_seen: str | None, batch_id: int, data_type: T.DataType | None = None) -> None:
        """Move the cursor, never back: a batch of older rows, or of none, leaves the place it has. It is
        called after the batch is stored, so a crash repeats a batch and never skips one. Two slots take
        turns: while one is rewritten the other still holds the cursor before it, and the table of
        cursors stays at two rows. `data_type` is the version's type in the source if it is not the stored one.
        """
        kind = data_type or self._version_type
        before = self.cursor()
        places = [cursor_literal(p, kind) for p in (before.last_seen, last_seen) if p is not None]
        place = F.lit(None) if not places else places[0] if len(places) == 1 else F.greatest(*places)
        values = {
            "table": F.lit(self.name),
            "delta_column": F.lit(self.version),
            "last_seen": cursor_to_text(place, kind).cast("string"),
            "last_seen_type": F.lit(kind.simpleString()),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "committed_at": F.current_timestamp(),
        }
        row = self.spark.range(0, 1, 1, 1).select(*[value.alias(name) for name, value in values.items()])
        row.write.mode("overwrite").parquet(f"{self.root}/cursor/slot={batch_id % 2}")

    # -- reading ---------------------------------------------------------------------------------

    @property
    def _stored_schema(self) -> T.StructType:
        return nullable(self.schema).add("_batch_id", T.LongType())

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        """A stored table, or none of its rows before it is first written."""
        where = self._hadoop_path(path)
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _control(self, name: str, columns: str, part: str) -> DataFrame:
        """A control table: a few rows under one partition column."""
        return self._read(f"{self.root}/{name}", T.StructType.fromDDL(f"{columns}, {part} bigint"))

    def versions(self) -> DataFrame:
        """Every stored version, with its `_batch_id`."""
        return self._read(f"{self.root}/log", self._stored_schema)

    def _pending(self, through: int, committed: int | None = None) -> DataFrame:
        """Versions of the batches after `through`, up to the cursor if there is one. Missing batches have no rows."""
        last = self.cursor().batch_id if committed is None else committed
        found = [(p, b) for p, b in self._folders("log", "_batch_id") if b > through and (last < 0 or b <= last)]
        if not found:
            return self.spark.createDataFrame([], self._stored_schema)
        if len(found) <= BATCHES_BY_PATH:
            reader = self.spark.read.schema(self._stored_schema).option("basePath", f"{self.root}/log")
            return reader.parquet(*[path for path, _ in found])
        versions = self.versions().where(F.col("_batch_id") > through)
        return versions if last < 0 else versions.where(F.col("_batch_id") <= last)

    def _entries(self) -> list[Row]:
        """The newest generation of the manifest: one row per part of a bucket."""
        generations = self._folders("manifest", "_generation")
        if not generations:
            return []
        path, _ = max(generations, key=lambda g: g[1])
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(path).orderBy("bucket", "generation").collect()

    def manifest(self) -> list[tuple[int, int, int]]:
        """`(bucket, newest generation, through_batch)`: one entry per bucket."""
        return [(b, g, through) for b, (g, through) in {r["bucket"]: (r["generation"], r["through_batch"]) for r in self._entries()}.items()]

    @property
    def _range(self) -> KeyRange:
        return KeyRange(self.schema[self.row_key[0]].dataType)

    def _changes(self, pending: DataFrame) -> dict[int, Row]:
        """For each bucket with pending rows their number and the range of their keys. At most one row per bucket comes back."""
        told = pending.groupBy("_bucket").agg(F.count("*").alias("n"), *self._range.columns(self.row_key[0]))
        return {r["_bucket"]: r for r in told.collect()}

    def _met(self, entries: list[Row], changes: dict[int, Row]) -> list[Row]:
        """The parts that may hold a changed key."""
        reach = self._range
        return [r for r in entries if r["bucket"] in changes and not reach.apart(r, changes[r["bucket"]])]

    def _after(self, pending: DataFrame, entries: list[Row]) -> DataFrame:
        """The pending versions that their bucket's compacted rows do not hold yet."""
        through = {r["bucket"]: r["through_batch"] for r in entries}
        if len(set(through.values())) < 2:
            return pending
        buckets = entries[0]["buckets"]
        taken = F.array(*[F.lit(through.get(b, -1)) for b in range(buckets)])
        return pending.where(F.col("_batch_id") > F.get(taken, bucket_of(self.row_key, buckets)))

    def _base(self, parts: list[Row]) -> DataFrame:
        """The compacted rows of some parts with their `_bucket`."""
        schema = self._stored_schema.add("_bucket", T.IntegerType())
        base = f"{self.root}/base"
        paths = [f"{base}/_generation={r['generation']}/_bucket={r['bucket']}" for r in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        files = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return files.select(*named_all(schema.fieldNames()))

    def current(self) -> DataFrame:
        """The newest version of every key: the compacted base with the batches since merged in.

        Parts that hold no changed key by their range are read as they are.
        """
        names = named_all(self.schema.fieldNames())
        entries = self._entries()
        if not entries:
            return newest(self._pending(-1), self.row_key, self._order).select(*names)
        pending = self._after(self._pending(min(r["through_batch"] for r in entries)), entries)
        keys = settle(pending.select(*named_all(self.row_key)).distinct(), "changed-keys")
        met = self._met(entries, self._changes(keys.withColumn("_bucket", bucket_of(self.row_key, entries[0]["buckets"]))))
        unmet = [*{*entries} - {*met}]
        untouched, changed = split_current(self._base(met).drop("_bucket"), pending, self.row_key, self._order, keys)
        whole = self._base(unmet).drop("_bucket")
        parts = [whole] * bool(unmet) + [untouched] * bool(met) + [changed]
        return reduce(DataFrame.unionByName, parts).select(*names)

    # -- compaction ------------------------------------------------------------------------------

    def compact(self, least_share: float = 0.0) -> int:
        """Write one row per key for the buckets that changed, then switch readers to them.

        Only committed batches are taken. Of a bucket that changed the parts are rewritten whose range holds a changed key; if there
        is none, as when new keys lie above all old ones, the new rows become one more part. A bucket waits until its pending
        versions are at least `least_share` of its rows, so that a few changed keys need not rewrite a table. Gives the generation now
        current. Readers follow the manifest, which is written last; a compaction that dies before that leaves the
        old generation in place and is simply run again.
        """
        entries = self._entries()
        generation = max((r["generation"] for r in entries), default=-1) + 1
        committed = self.cursor().batch_id
        if committed < 0:
            return generation - 1
        stored = entries[0]["buckets"] if entries else None
        pending = self._pending(min((r["through_batch"] for r in entries), default=-1), committed)
        pending = self._after(pending, entries)
        buckets = self.buckets or stored or -(-max(1, pending.count()) // ROWS_PER_BUCKET)
        dealt_anew = bool(entries) and buckets != stored
        pending = pending.withColumn("_bucket", bucket_of(self.row_key, buckets))
        changes = self._changes(pending)
        held: dict[int, list[Row]] = {}
        for r in entries:
            held.setdefault(r["bucket"], []).append(r)
        if dealt_anew:
            changed = set(range(buckets))
        else:
            changed = {b for b, r in changes.items() if r["n"] >= least_share * sum(p["rows"] or 0 for p in held.get(b, []))}
        if not changed:
            return generation - 1
        pending = pending.where(F.col("_bucket").isin(*changed)) if len(changed) < len(changes) else pending

        many = {b for b, parts in held.items() if len(parts) >= MOST_PARTS}
        met = self._met(entries, {b: r for b, r in changes.items() if b in changed})
        rewritten = entries if dealt_anew else [*{*met, *(r for r in entries if r["bucket"] in changed & many)}]
        if rewritten:
            untouched, resolved = split_current(self._base(rewritten), pending, self.row_key, self._order)
            # Rows read from one bucket's files go back to that bucket.
            if dealt_anew:
                untouched = self._by_bucket(untouched.withColumn("_bucket", bucket_of(self.row_key, buckets)), buckets)
                resolved = resolved.withColumn("_bucket", bucket_of(self.row_key, buckets))
            rows = untouched.unionByName(self._by_bucket(resolved, buckets))
        else:
            rows = self._by_bucket(newest(pending, self.row_key, self._order), buckets)
        done = set(rewritten)
        path = f"{self.root}/base/_generation={generation}"
        if buckets == 1:
            rows.drop("_bucket").write.mode("overwrite").parquet(f"{path}/_bucket=0")
        else:
            rows.write.mode("overwrite").partitionBy("_bucket").parquet(path)

        written = self._changes(self.spark.read.schema(self._stored_schema.add("_bucket", T.IntegerType())).parquet(path))
        new = [(b, generation, committed, buckets, r["n"], r["low"], r["high"]) for b, r in written.items()]
        # A bucket without pending versions is as new as the others; one that waits keeps its place.
        kept = [
            (b, r["generation"], committed if b in changed or b not in changes else r["through_batch"], buckets, r["rows"], r["low"], r["high"])
            for b, parts in held.items()
            for r in parts
            if r not in done
        ]
        # No two parts are of one bucket and generation, so the texts of a range never take part in the order.
        entry_table = self.spark.createDataFrame(sorted(new + kept, key=lambda e: e[:2]), MANIFEST_SCHEMA).coalesce(1)
        entry_table.write.mode("overwrite").parquet(f"{self.root}/manifest/_generation={generation}")
        return generation

    def _by_bucket(self, rows: DataFrame, buckets: int) -> DataFrame:
        """Bring the rows of many buckets together, so that few files are written. At run time large
        buckets are split over tasks and small ones merged. For few buckets a second shuffle of all rows would cost more than it saves."""
        return rows.hint("rebalance", F.col("_bucket")) if buckets > FEW_BUCKETS else rows

    def vacuum(self) -> int:
        """Delete the batches and bucket folders that the current generation has made needless.

        Run it when no reader of an older generation is left. Gives the number of folders deleted.
        """
        entries = self._entries()
        if not entries:
            return 0
        held = {(r["generation"], r["bucket"]) for r in entries}
        current, through = max(g for _, g in self._folders("manifest", "_generation")), min(r["through_batch"] for r in entries)
        old = [path for path, batch in self._folders("log", "_batch_id") if batch <= through]
        old += [path for path, generation in self._folders("manifest", "_generation") if generation < current]
        for path, generation in self._folders("base", "_generation"):
            buckets = self._folders(path.removeprefix(f"{self.root}/"), "_bucket")
            # A generation past the current one is a compaction at work.
            dead = [p for p, bucket in buckets if (generation, bucket) not in held and generation <= current]
            old += [path] if dead and len(dead) == len(buckets) else dead
        for path in old:
            where = self._hadoop_path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        return len(old)

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _folders(self, parent: str, part: str) -> list[tuple[str, int]]:
        """The partition folders below a folder, with their values."""
        where = self._hadoop_path(f"{self.root}/{parent}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        names = [status.getPath().getName() for status in files.listStatus(where)]
        cut = f"{part}="
        return [(f"{self.root}/{parent}/{n}", int(n.removeprefix(cut))) for n in names if n.startswith(cut)]
