"""Full and incremental scans of one table, and the layout that makes the latter cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import named, named_all
from tablesync.functions.types import minimum_literal
from tablesync.operators.rank import row_at_rank, values_at_ranks

# Up to this limit rows are found with a top-n, for which every task hands at most as many rows to one
# last task. Above it the cut is found by rank: by the digits of whole numbers, dates and times, by pivots of other types.
TOP_N_ROWS = 10_000

NTZ_EPOCH_TEXT = "1970-01-01 00:00:00"


def scan_table(table: DataFrame, limit: int | None = 0) -> DataFrame:
    """The whole table, or any `limit` rows of it; 0 and None mean no limit.

    A large limit gives every input partition a quota, in the order of the partitions, from one count of their
    rows; no task then gathers what the others read. The input must read the same way twice, as files do.
    """
    if not limit:
        return table
    if limit <= TOP_N_ROWS:
        return table.limit(limit)
    part, place = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    counts = table.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # one row a partition
    left, quotas = limit, {}
    for row in sorted(counts):
        quotas[row["part"]] = min(left, row["n"])
        left -= quotas[row["part"]]
    if not quotas:
        return table
    quota = F.array(*[F.lit(quotas.get(p, 0)).cast("bigint") for p in range(max(quotas) + 1)])
    numbered = table.withColumns({"_part": part, "_place": place})
    return numbered.where(F.col("_place") < F.get(quota, F.col("_part"))).drop("_part", "_place")


def scan_since(
    table: DataFrame,
    delta: str,
    last_seen: Column | None,
    limit: int | None = 0,
    keys: list[str] | None = None,
    ties: str = "keep",
    inclusive: bool = False,
) -> DataFrame:
    """Rows whose delta lies after `last_seen`; with a limit, the oldest of them.

    `ties="keep"` also takes the rows that share the delta of the last row taken, so that no row is
    lost when the cursor moves there. `ties="strict"` stops at exactly `limit` rows, in the order of
    the delta and then of `keys`. A NULL delta never matches; without a cursor all others do.
    """
    if ties not in ("keep", "strict"):
        raise ValueError("ties must be 'keep' or 'strict'")
    value = named(delta)
    if last_seen is None:
        rows = table.where(value.isNotNull())
    else:
        rows = table.where(value >= last_seen if inclusive else value > last_seen)
    if not limit:
        return rows
    data_type = rows.schema[delta].dataType
    number = _as_bigint(value, data_type)
    if ties == "strict":
        return lowest_rows(rows, number, named_all([delta, *(keys or [])]), limit)
    if limit <= TOP_N_ROWS:
        cut = rows.select(value.alias("_delta")).orderBy("_delta").limit(limit).agg(F.max("_delta"))
    elif number is None:
        found = row_at_rank(rows, [value], limit - 1, TOP_N_ROWS)
        if found is None:
            return rows
        cut = found[0].select("key.k0")
    else:
        cut = _rank_cut(rows, number, limit).select(_from_bigint(F.col("_number"), data_type))
    return rows.where(value <= cut.scalar())


def lowest_rows(rows: DataFrame, number: Column | None, order: list[Column], limit: int) -> DataFrame:
    """Exactly the first `limit` rows by `order`, whose first column rises with the BIGINT `number` if there is one.

    A large limit is not sorted: the cut is found by rank, rows below it are taken as they are, and of those at the cut the
    first by the remaining columns, again by rank if they are many. Rows that agree in all of `order` are
    dealt out by their place in the input.
    """
    if limit <= TOP_N_ROWS:
        return rows.orderBy(*order).limit(limit)
    if number is None:
        found = row_at_rank(rows, order, limit - 1, TOP_N_ROWS)
        if found is None:
            return rows
        cut, values = found[0].scalar(), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
        return rows.where(values < cut).unionByName(scan_table(rows.where(values == cut), found[1] + 1))
    cut = _rank_cut(rows, number, limit).first()
    if cut is None:
        return rows.limit(0)
    at_cut, left = rows.where(number == cut["_number"]), cut["rank"] + 1
    rest = lowest_rows(at_cut, None, order[1:], left) if order[1:] else scan_table(at_cut, left)
    return rows.where(number < cut["_number"]).unionByName(rest)


def _rank_cut(rows: DataFrame, number: Column, limit: int) -> DataFrame:
    """One row: the number of the `limit`-th lowest row, or of the last, and its place among its equals."""
    numbers = rows.select(F.lit(0).alias("_all"), number.alias("_number"))
    last = F.least(F.count("_number"), F.lit(limit).cast("bigint")) - 1
    ranks = numbers.groupBy("_all").agg(
        F.lit("cut").alias("name"), last.alias("rank"), F.min("_number").alias("low"), F.max("_number").alias("high")
    )
    return values_at_ranks(numbers, ["_all"], "_number", ranks)


def _ntz_epoch() -> Column:
    return F.lit(NTZ_EPOCH_TEXT).cast("timestamp_ntz")


def _as_bigint(value: Column, data_type: T.DataType) -> Column | None:
    if isinstance(data_type, T.IntegralType):
        return value.cast("bigint")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(data_type, T.TimestampNTZType):
        zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
        if zone in ("UTC", "Etc/UTC", "GMT", "Z"):
            return F.unix_micros(value.cast("timestamp"))
        # Other zones have hours that come twice, so there the way leads through an interval.
        since = value - _ntz_epoch()
        day, hour, minute = (F.extract(F.lit(part), since).cast("bigint") for part in ("DAY", "HOUR", "MINUTE"))
        micros = (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("bigint")
        return ((day * 24 + hour) * 60 + minute) * 60_000_000 + micros
    return None


def _from_bigint(number: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(number)
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", number, _ntz_epoch())
    return number.cast(data_type)


def high_watermark(table: DataFrame, delta: str) -> DataFrame:
    """One row: the greatest delta, or the start of its type when there is none."""
    start = minimum_literal(table.schema[delta].dataType)
    return table.agg(F.coalesce(F.max(named(delta)), start).alias("watermark"))


def write_delta_layout(table: DataFrame, delta: str, path: str, partitions: int | None = None) -> None:
    """Rewrite a table sorted by its delta column, so that delta scans skip files and row groups.

    The range partitioning has the row number as a second key: rows that share one delta may be a
    third of the table and must not all go to one task.
    """
    numbered = table.withColumn("_row", F.monotonically_increasing_id())
    ranges = [partitions] if partitions else []
    laid_out = numbered.repartitionByRange(*ranges, named(delta), F.col("_row")).sortWithinPartitions(named(delta))
    laid_out.drop("_row").write.mode("overwrite").parquet(path)
