"""A table laid out by ranges of its delta column, kept so by increments that rewrite only the ranges they touch."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named, named_all
from tablesync.sinks.append import check_schema, nullable

#: Rows that a range is meant to hold; one that has grown to twice as many is split.
RANGE_ROWS = 2_000_000
#: How exactly quantiles are found: a range may be off by so many thousandths of all rows.
ACCURACY = 10_000


@dataclass(frozen=True)
class DeltaLayout:
    """Rows in folders by range of the delta, sorted by it inside their files.

        <root>/rows/<folder>       the rows of one range, all above `low` (if there is one) and up to `high` (if there is one)
        <root>/manifest/<number>   one row for every range: where it is and what it holds

    A range keeps its bounds from one increment to the next. New rows are dealt to the ranges by their delta; a range that
    gets some is written anew, all others stay as they are, file for file. A range that has grown to twice `range_rows` is cut at the quantiles
    of its own rows. Readers follow the newest manifest, which is written last, so an increment that dies leaves the old state. Rows
    without a delta are in a range of their own. Deltas are numbers, dates or times. The layout has one writer at a time.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    delta: str
    range_rows: int = RANGE_ROWS

    @property
    def _kind(self) -> T.DataType:
        return self.schema[self.delta].dataType

    @property
    def _manifest_schema(self) -> T.StructType:
        bound = lambda name: T.StructField(name, self._kind)
        numbers = [T.StructField("folder", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("nulls", T.BooleanType())]
        return T.StructType([*numbers, bound("low"), bound("high"), bound("least"), bound("greatest")])

    # -- reading -----------------------------------------------------------------------------------

    def _files(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _newest(self) -> int:
        where, files = self._files()
        return max((int(s.getPath().getName()) for s in files.listStatus(where)), default=-1) if files.exists(where) else -1

    def ranges(self) -> DataFrame | None:
        """The newest manifest."""
        number = self._newest()
        return None if number < 0 else self.spark.read.schema(self._manifest_schema).parquet(f"{self.root}/manifest/{number}")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], nullable(self.schema))
        return self.spark.read.schema(nullable(self.schema)).parquet(*[f"{self.root}/rows/{f}" for f in folders])

    def rows(self) -> DataFrame:
        """All rows."""
        found = self.ranges()
        return self._read([] if found is None else [r["folder"] for r in found.select("folder").collect()])

    def since(self, last_seen: Column | None) -> DataFrame:
        """Rows whose delta lies after `last_seen`: of the ranges only those are opened that reach beyond it."""
        found = self.ranges()
        if found is None:
            return self._read([])
        beyond = F.lit(True) if last_seen is None else F.col("greatest") > last_seen
        folders = [r["folder"] for r in found.where(~F.col("nulls") & beyond).select("folder").collect()]
        rows = self._read(folders)
        return rows if last_seen is None else rows.where(named(self.delta) > last_seen)

    # -- writing -----------------------------------------------------------------------------------

    def add(self, rows: DataFrame) -> int:
        """Take in new rows; gives the number of ranges that were written anew."""
        check_schema(rows.schema, self.schema)
        rows = rows.select(*named_all(self.schema.fieldNames()))
        before = self.ranges()
        known = before.collect() if before is not None else []  # a row a range
        known.sort(key=lambda r: (r["nulls"], r["low"] is not None, r["low"] if r["low"] is not None else 0))
        new = self._dealt(rows, [r["high"] for r in known if not r["nulls"]][:-1] if known else None)
        counts = {(r["_nulls"], r["_range"]): r["n"] for r in new.groupBy("_nulls", "_range").agg(F.count("*").alias("n")).collect()}
        if not counts:
            return 0
        ranges = [r for r in known if not r["nulls"]]
        without = [r for r in known if r["nulls"]]
        kept, written = [], []
        # ranges without a manifest yet: one, open at both ends
        for i, held in enumerate(ranges or [None]):
            if (False, i) not in counts:
                kept += [held] if held is not None else []
                continue
            old = [] if held is None else [held["folder"]]
            low, high = (None, None) if held is None else (held["low"], held["high"])
            fresh = new.where(~F.col("_nulls") & (F.col("_range") == i)).drop("_nulls", "_range")
            total = counts[False, i] + (0 if held is None else held["rows"])
            written += self._write(self._read(old).unionByName(fresh), total, low, high)
        if any(nulls for nulls, _ in counts):
            folder = uuid.uuid4().hex
            stored = self._read([r["folder"] for r in without]).unionByName(new.where("_nulls").drop("_nulls", "_range"))
            stored.write.parquet(f"{self.root}/rows/{folder}")
            written.append((folder, counts[True, 0] + sum(r["rows"] for r in without), True, None, None, None, None))
        else:
            kept += without
        entries = [tuple(r) for r in kept] + written
        order = lambda e: (e[2], e[3] is not None, e[3] if e[3] is not None else 0)
        table = self.spark.createDataFrame(sorted(entries, key=order), self._manifest_schema).coalesce(1)
        table.write.parquet(f"{self.root}/manifest/{self._newest() + 1}")
        return len(written)

    def _dealt(self, rows: DataFrame, highs: Sequence | None) -> DataFrame:
        """The rows with `_nulls` and the number `_range` of their range: how many upper bounds lie below the delta."""
        value = named(self.delta)
        exact = lambda h: F.lit(str(h) if isinstance(self._kind, T.TimestampNTZType) else h).cast(self._kind)
        bounds = F.array(*[exact(h) for h in highs]) if highs else None
        place = F.lit(0) if bounds is None else F.size(F.filter(bounds, lambda b: b < value))
        return rows.withColumns({"_nulls": value.isNull(), "_range": F.when(value.isNull(), 0).otherwise(place)})

    def _write(self, rows: DataFrame, total: int, low, high) -> list[tuple]:
        """Write one range, or the parts of one that has grown too large, and their manifest rows."""
        value, cuts = named(self.delta), []
        if total > 2 * self.range_rows or (low is None and high is None and total > self.range_rows):
            parts = -(-total // self.range_rows)
            numeric = self._as_number(value)
            shares = [i / parts for i in range(1, parts)]
            found = rows.agg(F.percentile_approx(numeric, shares, ACCURACY).alias("q"), F.max(value).alias("most"))
            found = found.select(F.transform("q", self._from_number).alias("q"), "most").first()
            # cuts are values of rows below the greatest one, so no part is empty
            cuts = [c for c in dict.fromkeys(found["q"]) if (low is None or c > low) and c < found["most"]]
        folder = uuid.uuid4().hex
        dealt = self._dealt(rows, cuts).drop("_nulls").withColumn("_row", F.monotonically_increasing_id())
        # a delta that many rows share is spread over tasks by the row's number
        ordered = dealt.repartitionByRange("_range", value, "_row").sortWithinPartitions("_range", value).drop("_row")
        ordered.write.partitionBy("_range").parquet(f"{self.root}/rows/{folder}")
        stored = self.spark.read.schema(nullable(self.schema).add("_range", T.IntegerType())).parquet(f"{self.root}/rows/{folder}")
        sizes = stored.groupBy("_range").agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest")).collect()
        lows, highs = [low, *cuts], [*cuts, high]
        return [(f"{folder}/_range={r['_range']}", r["n"], False, lows[r["_range"]], highs[r["_range"]], r["least"], r["greatest"]) for r in sizes]

    def _as_number(self, value: Column) -> Column:
        if isinstance(self._kind, T.TimestampNTZType):
            return F.unix_micros(value.cast("timestamp"))
        if isinstance(self._kind, T.TimestampType):
            return F.unix_micros(value)
        return F.unix_date(value) if isinstance(self._kind, T.DateType) else value

    def _from_number(self, number: Column) -> Column:
        if isinstance(self._kind, (T.TimestampType, T.TimestampNTZType)):
            return F.timestamp_micros(number).cast(self._kind)
        return F.date_from_unix_date(number) if isinstance(self._kind, T.DateType) else number.cast(self._kind)

    def vacuum(self) -> int:
        """Delete the folders that the newest manifest does not name, and older manifests. Gives their number."""
        found = self.ranges()
        if found is None:
            return 0
        held = {r["folder"] for r in found.select("folder").collect()}
        newest, gone = self._newest(), 0
        where, files = self._files()
        rows = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/rows")
        for path in [s.getPath() for s in files.listStatus(rows)]:
            name = path.getName()
            inner = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("_range=")]
            dead = [p for p in inner if f"{name}/{p.getName()}" not in held]
            for one in [path] if name not in held and len(dead) == len(inner) else dead:
                files.delete(one, True)
                gone += 1
        for path in [s.getPath() for s in files.listStatus(where)]:
            if int(path.getName()) < newest:
                files.delete(path, True)
        return gone
