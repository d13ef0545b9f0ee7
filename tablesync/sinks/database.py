"""Copies kept in a database: batches that are staged by many tasks and merged by one statement each.

Spark repeats a task that was lost, and a repeated task inserts its rows again. So tasks insert into a stage table, every row with
the number of its batch and its place in the input, and one statement moves each place once into the target and notes
the batch in a ledger. A batch that is in the ledger is not moved again. Whatever dies in between is mended by running the batch again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.columns import named_all
from tablesync.sources.slices import identifier, quoted
from tablesync.sources.tables import jdbc_sink_options

BATCH, PART, PLACE = "_batch_id", "_part", "_place"
PLACE_BITS = 33  # of a monotonically increasing id, for the row within its partition


def stage_table(table: str) -> str:
    return f"{table}__stage"


def ledger_ddl(ledger: str) -> str:
    return f"CREATE TABLE IF NOT EXISTS {identifier(ledger)} (table_name text, batch_id bigint, PRIMARY KEY (table_name, batch_id))"


def stage_ddl(table: str) -> str:
    """A stage table with the target's columns, without its constraints."""
    numbers = f"{BATCH} bigint, {PART} int, {PLACE} bigint"
    return f"CREATE TABLE IF NOT EXISTS {identifier(stage_table(table))} (LIKE {identifier(table)}, {numbers})"


def merge_statement(table: str, columns: Sequence[str], batch_id: int, ledger: str) -> str:
    """Notes the batch and moves its rows, each place once, unless it is noted already: all or nothing, being one statement."""
    names = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    stage = identifier(stage_table(table))
    return (
        f"WITH noted AS (INSERT INTO {identifier(ledger)} (table_name, batch_id) VALUES ({quoted(table)}, {batch_id}) "
        "ON CONFLICT DO NOTHING RETURNING batch_id) "
        f"INSERT INTO {identifier(table)} ({names}) "
        f"SELECT {names} FROM (SELECT DISTINCT ON ({PART}, {PLACE}) * FROM {stage} "
        f"WHERE {BATCH} = {batch_id} AND EXISTS (SELECT 1 FROM noted) ORDER BY {PART}, {PLACE}) once"
    )


def clear_statement(table: str, batch_id: int) -> str:
    return f"DELETE FROM {identifier(stage_table(table))} WHERE {BATCH} = {batch_id}"


def numbered(rows: DataFrame, batch_id: int) -> DataFrame:
    """The rows with their batch and their place in the input, which a repeated task gives them again."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumns({BATCH: F.lit(batch_id).cast("bigint"), PART: F.spark_partition_id(), PLACE: place})


def run_statements(spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]) -> None:
    """Runs statements on one connection from the driver, each on its own."""
    options = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        options.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, options)
    try:
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
    finally:
        connection.close()


@dataclass(frozen=True)
class DatabaseTable:
    """One table of a database as the place of a copy. `execute` runs statements, `insert` appends rows to a table; both are
    parameters, so that a test needs no database."""

    table: str
    ledger: str
    execute: Callable[[Sequence[str]], None]
    insert: Callable[[DataFrame, str], None]

    def append(self, rows: DataFrame, batch_id: int, observation: Observation | None = None) -> None:
        """Stage the rows of a batch and merge them. Run again, it stores the batch once."""
        self.execute([ledger_ddl(self.ledger), stage_ddl(self.table), clear_statement(self.table, batch_id)])
        staged = numbered(rows.select(*named_all(rows.columns)), batch_id)
        if observation is not None:
            staged = staged.observe(observation, F.count(F.lit(1)).alias("rows"))
        self.insert(staged, stage_table(self.table))
        self.execute([merge_statement(self.table, rows.columns, batch_id, self.ledger), clear_statement(self.table, batch_id)])


@dataclass(frozen=True)
class DatabaseTarget:
    """A database as the target of a run. Tables must be there; their rows are appended. Never executed against a database
    here: the statements and the order in which they run are tested."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    ledger: str = "tablesync_batches"
    batch_size: int = 500
    writers: int = 4

    def table(self, name: str, batch_size: int | None = None) -> DatabaseTable:
        def insert(rows: DataFrame, into: str) -> None:
            options = jdbc_sink_options(self.url, into, batch_size or self.batch_size, self.writers) | dict(self.properties)
            rows.write.format("jdbc").options(**options).mode("append").save()

        return DatabaseTable(name, self.ledger, lambda texts: run_statements(self.spark, self.url, self.properties, texts), insert)
