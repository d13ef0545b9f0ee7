"""What to copy: table specs, how run-wide defaults fill them, and their checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 0
DEFAULT_BATCH_SIZE = 500
DEFAULT_INTERVAL_SECONDS = 60


@dataclass(frozen=True)
class Polling:
    enabled: bool = False
    delta_column: str = ""
    interval_seconds: int = DEFAULT_INTERVAL_SECONDS


@dataclass(frozen=True)
class TableConfig:
    """A table as the user lists it; what is None comes from the run."""

    name: str
    limit: int | None = None
    batch_size: int | None = None
    polling: Polling | None = None
    key: tuple[str, ...] | None = None
    poll_limit: int | None = None


@dataclass(frozen=True)
class RunConfig:
    """Several tables, or one by `table`, with defaults for all of them."""

    table: str = ""
    tables: Sequence[TableConfig] = ()
    limit: int | None = None
    batch_size: int | None = None
    polling: Polling = field(default_factory=Polling)


@dataclass(frozen=True)
class TableSpec:
    """A table with every field settled. `key=None` asks the source for its primary key."""

    name: str
    limit: int = DEFAULT_LIMIT
    batch_size: int = DEFAULT_BATCH_SIZE
    polling: Polling = field(default_factory=Polling)
    key: tuple[str, ...] | None = None
    poll_limit: int = DEFAULT_LIMIT


def _first(*values):
    return next(v for v in values if v is not None)


def resolve_specs(config: RunConfig) -> list[TableSpec]:
    """Table value, else run value, else default. Polling is taken whole from one of the two."""
    listed = list(config.tables) or ([TableConfig(config.table)] if config.table else [])
    specs = []
    for t in listed:
        limit = _first(t.limit, config.limit, DEFAULT_LIMIT)
        specs.append(
            TableSpec(
                name=t.name,
                limit=limit,
                batch_size=_first(t.batch_size, config.batch_size, DEFAULT_BATCH_SIZE),
                polling=_first(t.polling, config.polling),
                key=t.key,
                poll_limit=_first(t.poll_limit, limit),
            )
        )
    return specs


def validate_specs(specs: Sequence[TableSpec]) -> None:
    """Raise before any job starts when a spec cannot run."""
    errors = []
    if not specs:
        errors.append("no table given")
    for s in specs:
        if not s.name.strip():
            errors.append("table name is missing")
        if s.batch_size < 1:
            errors.append(f"{s.name}: batch size must be at least 1")
        if s.limit < 0 or s.poll_limit < 0:
            errors.append(f"{s.name}: limit must not be negative")
        if s.polling.enabled and not s.polling.delta_column:
            errors.append(f"{s.name}: polling needs a delta column")
        if s.polling.enabled and s.polling.interval_seconds <= 0:
            errors.append(f"{s.name}: polling interval must be greater than 0")
    errors += [f"{name}: listed {n} times" for name, n in Counter(s.name for s in specs).items() if n > 1]
    if errors:
        raise ValueError("; ".join(errors))


def resolve_spec_table(
    specs: DataFrame,
    limit: int | None = None,
    batch_size: int | None = None,
    polling: Polling | None = None,
) -> DataFrame:
    """`resolve_specs` for specs kept as a table `(name, limit, batch_size, polling struct)`."""
    default = polling or Polling()
    run_polling = F.struct(
        F.lit(default.enabled).alias("enabled"),
        F.lit(default.delta_column).alias("delta_column"),
        F.lit(default.interval_seconds).alias("interval_seconds"),
    )
    return specs.select(
        "name",
        F.coalesce("limit", F.lit(limit).cast("int"), F.lit(DEFAULT_LIMIT)).alias("limit"),
        F.coalesce("batch_size", F.lit(batch_size).cast("int"), F.lit(DEFAULT_BATCH_SIZE)).alias("batch_size"),
        F.coalesce("polling", run_polling).alias("polling"),
    )


def invalid_specs(specs: DataFrame) -> DataFrame:
    """`(name, error)` for each fault of a resolved spec table."""
    polling = F.col("polling")
    faults = F.filter(
        F.array(
            F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "table name is missing"),
            F.when(F.col("batch_size") < 1, "batch size must be at least 1"),
            F.when(F.col("limit") < 0, "limit must not be negative"),
            F.when(
                polling["enabled"] & (F.coalesce(polling["delta_column"], F.lit("")) == ""),
                "polling needs a delta column",
            ),
            F.when(
                polling["enabled"] & (F.coalesce(polling["interval_seconds"], F.lit(0)) <= 0),
                "polling interval must be greater than 0",
            ),
        ),
        lambda fault: fault.isNotNull(),
    )
    per_row = specs.select("name", F.explode(faults).alias("error"))
    twice = specs.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
    listed = F.format_string("listed %s times", F.col("n"))
    return per_row.unionByName(twice.select("name", listed.alias("error")))
