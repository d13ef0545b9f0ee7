"""Exact order statistics without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.session import settle

# A value is found 20 bits at a time. A prefix then has at most 2^20 cells (2^24 at the top of the
# widest range), so the running counts of one prefix fit a task, however many rows the group holds.
DIGIT_BITS = 20


def values_at_ranks(values: DataFrame, by: list[str], value: str, ranks: DataFrame) -> DataFrame:
    """The value at each 0-based rank in ascending order, per group.

    `values` has the `by` columns and a BIGINT `value`; `ranks` has the `by` columns, a `name`, a
    BIGINT `rank` below the group's row count, and the group's least and greatest value as `low` and
    `high`. Gives `(*by, name, <value>, rank)`, where the rank is now the place among the rows of
    that value.

    Every level counts rows per digit, which combines on the map side, and keeps only the digit that
    holds the wanted rank. Two or three passes over two columns replace a shuffle and sort of all
    rows, and a group with a third of the rows costs its tasks no more than any other. What a level
    found is written down, a row per wanted rank, so that the next one reads the values once and is
    joined with a table of known size.
    """
    start = ranks.select(*by, "name", "rank", F.lit(0).cast("bigint").alias("_prefix"), "low", "high")
    wanted = settle(start, "ranks")
    least, shifts = _levels(*wanted.agg(F.min("low"), F.max("high")).first())
    # No NULL ever enters a count, because a rank counts only values.
    rows = values.where(F.col(value).isNotNull()).select(*by, (F.col(value) - F.lit(least)).alias(value))
    previous = None
    for shift in shifts:
        prefix = F.lit(0).cast("bigint") if previous is None else F.shiftright(value, previous)
        cells = rows.select(*by, prefix.alias("_prefix"), F.shiftright(value, shift).alias("_digit"))
        if previous is not None:
            prefixes = wanted.select(*by, "_prefix").distinct()
            cells = cells.join(prefixes, [*by, "_prefix"], "left_semi")
        cells = cells.groupBy(*by, "_prefix", "_digit").agg(F.count("*").alias("_rows"))
        order = Window.partitionBy(*by, "_prefix").orderBy("_digit")
        cells = cells.withColumn("_end", F.sum("_rows").over(order))
        before = F.col("_end") - F.col("_rows")
        found = wanted.join(cells, [*by, "_prefix"]).where((F.col("rank") < F.col("_end")) & (F.col("rank") >= before))
        found = found.select(*by, "name", (F.col("rank") - before).alias("rank"), F.col("_digit").alias("_prefix"))
        wanted = settle(found, "ranks")
        previous = shift
    return wanted.select(*by, "name", (F.col("_prefix") + F.lit(least)).alias(value), "rank")


def _levels(low: int | None, high: int | None) -> tuple[int, list[int]]:
    """What to subtract from every value, and how far each level shifts the rest."""
    if low is None or high is None:
        return 0, [0]
    bits = (high - low).bit_length()
    if bits > 62:
        # The difference would not fit; signed values are shifted as they are.
        return 0, [2 * DIGIT_BITS, DIGIT_BITS, 0]
    levels = max(1, -(-bits // DIGIT_BITS))
    return low, [DIGIT_BITS * i for i in reversed(range(min(levels, 3)))]


#: Pivots of one pass of `row_at_rank`; each pass leaves about a thousandth of the rows.
PIVOTS = 1024


def _with_cell(keys: DataFrame, pivots: Column) -> DataFrame:
    """A column `cell`: twice the number of pivots below the key, and one more if the key is a pivot; found by bisection.

    Every step is a projection of its own, which Spark compiles; a lambda over the steps would be interpreted for every row.
    """
    found = keys.withColumns({"all": pivots, "below": F.lit(0)})
    for bit in reversed(range((4 * PIVOTS).bit_length())):
        step = 1 << bit
        higher = F.get("all", F.col("below") + (step - 1)) < F.col("key")
        found = found.withColumn("below", F.col("below") + F.when(higher, step).otherwise(0))
    is_pivot = F.coalesce(F.get("all", "below") == F.col("key"), F.lit(False)).cast("int")
    return found.select((2 * F.col("below") + is_pivot).alias("cell"))


def row_at_rank(rows: DataFrame, order: list[Column], rank: int, few: int) -> tuple[DataFrame, int] | None:
    """The values of `order` in the row at a 0-based rank, or in the last row, as a one-row table with the struct `key`,
    and the row's place among its equals. None without rows.

    Any types that Spark orders will do, also several columns at once; NULLs come first. Each pass counts the rows between
    and at some pivots, which are drawn from the rows still in question, and goes on in the cell that holds the rank.
    A frequent value is soon drawn itself and then has a cell of its own. Counts combine on the map side and at most
    `few` rows are ever sorted in one task, so neither many rows nor a hot value land in one.
    """
    keys = rows.select(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("key"))
    held = keys.count()
    if not held:
        return None
    rank, low, high, turn = min(rank, held - 1), None, None, 0
    while held > few:
        turn += 1
        share = min(1.0, 2 * PIVOTS / held)
        pivots = settle(keys.sample(share, seed=turn).limit(4 * PIVOTS).distinct(), "pivots")
        listed = pivots.agg(F.array_sort(F.collect_list("key")).alias("all"))
        at = lambda i, listed=listed: listed.select(F.get("all", F.lit(i)).alias("key"))
        counts = _with_cell(keys, listed.scalar()).groupBy("cell").agg(F.count("*").alias("n"))
        for cell, n in sorted(map(tuple, counts.collect())):  # at most two a pivot, and one more
            if rank < n:
                break
            rank -= n
        if cell % 2:
            return settle(at(cell // 2), "rank-key"), rank
        low = at(cell // 2 - 1).scalar() if cell else low
        high = at(cell // 2).scalar() if cell < 2 * pivots.count() else high
        held = n
        keys = rows.select(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("key"))
        keys = keys if low is None else keys.where(F.col("key") > low)
        keys = keys if high is None else keys.where(F.col("key") < high)
    first = settle(keys.orderBy("key").limit(rank + 1), "rank-rows")
    key = settle(first.agg(F.max("key").alias("key")), "rank-key")
    return key, rank - first.where(F.col("key") < key.scalar()).count()
