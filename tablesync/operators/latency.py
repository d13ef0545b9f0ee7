"""Latency statistics over a `(name, iteration, duration_ns)` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.rank import values_at_ranks
from tablesync.session import settle

# The reported percentiles.
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99, "p999": 0.999}

# When a latency row is worth a warning.
HIGH_TAIL_RATIO = 2
SLOW_INSERT_PER_SECOND = 10
SLOW_EXTRACT_SECONDS = 0.5
HEALTHY_RATIO = 2


def latency_mean_std(durations: DataFrame) -> DataFrame:
    """Count, mean, population deviation and operations per second, per name.

    The mean is cut to whole nanoseconds and the deviation is taken around that mean.
    """
    stats = durations.groupBy("name").agg(
        F.count("duration_ns").alias("n"),
        F.sum(F.col("duration_ns").cast("decimal(20,0)")).alias("_sum"),
        F.avg("duration_ns").alias("_avg"),
        F.var_pop("duration_ns").alias("_var"),
    )
    stats = stats.withColumn("mean_ns", F.coalesce(F.expr("_sum div n"), F.lit(0)))
    off = F.col("_avg") - F.col("mean_ns")
    deviation = F.floor(F.sqrt(F.col("_var") + off * off)).cast("bigint")
    return stats.select(
        "name",
        "n",
        "mean_ns",
        F.coalesce(deviation, F.lit(0).cast("bigint")).alias("stddev_ns"),
        F.coalesce(F.lit(1e9) / F.when(F.col("mean_ns") != 0, F.col("mean_ns")), F.lit(0.0)).alias("ops_per_sec"),
    )


def latency_percentiles(durations: DataFrame) -> DataFrame:
    """Least, greatest and percentile durations per name; the p-th is at index `floor(n * p)`, at most n - 1."""
    ends = durations.groupBy("name").agg(
        F.count("duration_ns").alias("n"),
        F.min("duration_ns").alias("min_ns"),
        F.max("duration_ns").alias("max_ns"),
    )
    ends = settle(ends.where("n > 0"), "latency")
    index = [
        F.struct(
            F.lit(label).alias("name"),
            F.least(F.floor(F.col("n") * F.lit(p)), F.col("n") - 1).cast("bigint").alias("rank"),
        )
        for label, p in PERCENTILES.items()
    ]
    group = "_group"
    ends_of = [F.col("min_ns").cast("bigint").alias("low"), F.col("max_ns").cast("bigint").alias("high")]
    ranks = ends.select(F.col("name").alias(group), *ends_of, F.inline(F.array(*index)))
    values = durations.select(F.col("name").alias(group), F.col("duration_ns").cast("bigint").alias("duration_ns"))
    found = values_at_ranks(values, [group], "duration_ns", ranks)
    wide = found.groupBy(group).agg(
        *[F.max(F.when(F.col("name") == label, F.col("duration_ns"))).alias(f"{label}_ns") for label in PERCENTILES]
    )
    joined = ends.join(wide.withColumnRenamed(group, "name"), "name")
    return joined.select("name", "n", "min_ns", *[f"{label}_ns" for label in PERCENTILES], "max_ns")


def latency_report(durations: DataFrame) -> DataFrame:
    """Percentiles, mean, deviation and throughput of every name in one row."""
    return latency_percentiles(durations).join(latency_mean_std(durations).drop("n"), "name")


def tail_flags(report: DataFrame) -> DataFrame:
    """The names of a latency report that deserve a look, and why."""
    p50, p95, p99 = (F.col(f"{p}_ns") for p in ("p50", "p95", "p99"))
    flagged = report.select(
        "name",
        (p99 > p95 * HIGH_TAIL_RATIO).alias("high_tail"),
        F.when(p95 != 0, p99 / p95).alias("p99_p95_ratio"),
        (F.contains("name", F.lit("Insert")) & (F.col("ops_per_sec") < SLOW_INSERT_PER_SECOND)).alias("slow_insert"),
        (F.contains("name", F.lit("Extract")) & (p50 / 1e9 > SLOW_EXTRACT_SECONDS)).alias("slow_extract"),
        (p95 < p50 * HEALTHY_RATIO).alias("healthy"),
    )
    return flagged.where(F.col("high_tail") | F.col("slow_insert") | F.col("slow_extract"))
