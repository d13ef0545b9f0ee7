"""Where tables are read from: files, a Spark catalog, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.columns import named_all
from tablesync.sources.catalog import mark_types, primary_key_columns
from tablesync.sources.slices import balanced_slices, statistics_of, statistics_query


class Source(Protocol):
    """Tables by name, with the key columns of each."""

    def table(self, name: str) -> DataFrame: ...

    def key(self, name: str) -> list[str]: ...


@dataclass(frozen=True)
class FileSource:
    """Tables stored as `<folder>/<name>.<format>`, in any format Spark reads."""

    spark: SparkSession
    folder: str
    keys: Mapping[str, list[str]] = field(default_factory=dict)
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.format).options(**self.options)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.load(f"{self.folder}/{name}.{self.format}")

    def key(self, name: str) -> list[str]:
        return list(self.keys.get(name, []))


@dataclass(frozen=True)
class CatalogSource:
    """Tables of a Spark catalog; `catalog.schema.table` names are read as separate parts.

    Over a database (`jdbc_catalog_conf`) filters, limits, top-n and MAX are pushed down, and with `lookup` the catalog's
    `information_schema` tells the primary keys and the source types, asked for once a table. A key that is neither given nor found is an
    error: a polled table must not fall back to all its columns unnoticed. An empty tuple as its key in the spec, or an empty list
    in `keys`, says that all columns are meant.
    """

    spark: SparkSession
    database: str = ""
    keys: Mapping[str, list[str]] = field(default_factory=dict)
    lookup: bool = False
    _known: dict[tuple[str, str], list] = field(default_factory=dict, compare=False, repr=False)

    def _parts(self, name: str) -> list[str]:
        parts = [*self.database.split("."), *name.split(".")] if "." not in name else name.split(".")
        return [p for p in parts if p]

    def _open(self, parts: list[str]) -> DataFrame:
        return self.spark.table(".".join(f"`{p}`" for p in parts))

    def _information(self, name: str, view: str) -> DataFrame:
        """A view of the information schema beside the table's schema, cut to the table."""
        *above, schema, table = self._parts(name)
        rows = self._open([*above, "information_schema", view])
        return rows.where((F.col("table_schema") == schema) & (F.col("table_name") == table))

    def table(self, name: str) -> DataFrame:
        rows = self._open(self._parts(name))
        if not self.lookup:
            return rows
        if ("types", name) not in self._known:
            found = self._information(name, "columns").select("column_name", "data_type").collect()  # a row a column
            self._known["types", name] = [tuple(r) for r in found]
        return mark_types(rows, dict(self._known["types", name]))

    def key(self, name: str) -> list[str]:
        if name in self.keys:
            return list(self.keys[name])
        if ("key", name) not in self._known and self.lookup:
            found = primary_key_columns(self._information(name, "table_constraints"), self._information(name, "key_column_usage"))
            self._known["key", name] = [r["column_name"] for r in found.orderBy("ordinal_position").collect()]
        if not self._known.get(("key", name)):
            raise LookupError(f"no primary key of {name} found; give one, or () to take all columns")
        return self._known["key", name]


def jdbc_catalog_conf(name: str, url: str, **options: str) -> dict[str, str]:
    """Session settings that make a database a Spark catalog.

    Tables read as `<name>.<schema>.<table>` through `CatalogSource` have filters, limits, top-n and
    MAX computed by the database.
    """
    prefix = f"spark.sql.catalog.{name}"
    settings = {prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog", f"{prefix}.url": url}
    pushed = {"pushDownAggregate": "true", "pushDownLimit": "true", "preferTimestampNTZ": "true"}
    return settings | {f"{prefix}.{k}": v for k, v in {**pushed, **options}.items()}


def block_slices(pages: int, slices: int) -> list[str]:
    """Predicates that cut a PostgreSQL table into runs of disk pages, one task each.

    Pages hold about equally many bytes whatever the values in the table are, so no value can make a
    slice large. The page count may be out of date: the last slice is open.
    """
    step = max(1, -(-pages // slices))
    starts = list(range(0, max(pages, 1), step))
    lower = [f"ctid >= '({start},0)'::tid" for start in starts]
    upper = [f" AND ctid < '({start},0)'::tid" for start in starts[1:]] + [""]
    return [low + up for low, up in zip(lower, upper)]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database, read by many connections at once.

    A table is cut by its `slice_column`, at the quantiles and frequent values that the database keeps of it (`balanced_slices`), or, if it
    is named in `block_tables`, by runs of disk pages. Without either it is read by one connection, so a large table should
    have one. Statistics and the catalog are asked once a snapshot (`table`). A poll (`polled`) reads few rows: it takes one connection, the
    source's own filter and what the snapshot learnt, and asks nothing else.
    """

    spark: SparkSession
    url: str
    schema: str = "public"
    slice_column: Mapping[str, str] = field(default_factory=dict)
    block_tables: frozenset[str] = frozenset()
    slices: int = 16
    fetch_size: int = 10_000
    properties: Mapping[str, str] = field(default_factory=dict)
    _types: dict[str, dict[str, str]] = field(default_factory=dict, compare=False, repr=False)

    def options(self, name: str) -> dict[str, str]:
        table = name if "." in name else f"{self.schema}.{name}"
        options = {
            "url": self.url,
            "dbtable": table,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
            **self.properties,
        }
        return options

    def _read(self, options: dict[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()

    def _pages(self, options: dict[str, str]) -> int:
        query = f"SELECT relpages FROM pg_class WHERE oid = '{options['dbtable']}'::regclass"
        return self._read({**options, "dbtable": f"({query}) p"}).first()[0]

    def table(self, name: str) -> DataFrame:
        """The whole table, in slices."""
        schema, _, table = name.rpartition(".")
        mine = (F.col("table_schema") == (schema or self.schema)) & (F.col("table_name") == table)
        found = self.columns().where(mine).select("column_name", "data_type").collect()  # a row a column
        self._types[name] = {r[0]: r[1] for r in found}
        return mark_types(self._rows(name), self._types[name])

    def polled(self, name: str) -> DataFrame:
        """The table as a poll reads it, whose delta filter the database works out."""
        return mark_types(self._read(self.options(name)), self._types[name]) if name in self._types else self.table(name)

    def _rows(self, name: str) -> DataFrame:
        options = self.options(name)
        if name in self.block_tables:
            slices = block_slices(self._pages(options), self.slices)
        elif name in self.slice_column:
            slices = self._balanced(name, options)
        else:
            return self._read(options)
        table = options.pop("dbtable")
        return self.spark.read.jdbc(options.pop("url"), table, predicates=slices, properties=options)

    def _balanced(self, name: str, options: dict[str, str]) -> list[str]:
        schema, table = options["dbtable"].split(".", 1)
        query = statistics_query(schema, table, self.slice_column[name])
        known = self._read({**options, "dbtable": f"({query}) s"}).collect()  # some hundred rows
        return balanced_slices(self.slice_column[name], statistics_of([tuple(r) for r in known]), self.slices)

    def columns(self) -> DataFrame:
        """The columns catalog of the database."""
        query = (
            "SELECT table_schema, table_name, column_name, data_type, ordinal_position "
            "FROM information_schema.columns"
        )
        return self._read({**self.options("columns"), "dbtable": f"({query}) c"})

    def key(self, name: str) -> list[str]:
        """Key columns in ordinal order; a failed lookup raises, it does not mean `no key`."""
        constraints = (
            "SELECT constraint_name, table_schema, table_name, constraint_type "
            "FROM information_schema.table_constraints"
        )
        usage = (
            "SELECT constraint_name, table_schema, column_name, ordinal_position "
            "FROM information_schema.key_column_usage"
        )
        schema, _, table = name.rpartition(".")
        keys = primary_key_columns(
            self._read({**self.options(name), "dbtable": f"({constraints}) t"}),
            self._read({**self.options(name), "dbtable": f"({usage}) k"}),
        )
        mine = keys.where((F.col("table_schema") == (schema or self.schema)) & (F.col("table_name") == table))
        return [row["column_name"] for row in mine.orderBy("ordinal_position").collect()]


def jdbc_sink_options(url: str, table: str, batch_size: int = 500, writers: int = 4) -> dict[str, str]:
    """Options of a JDBC append: rows per statement batch and connections at a time."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(writers)}


def append_jdbc(table: DataFrame, columns: list[str], options: Mapping[str, str]) -> None:
    """Append to a database table, columns by name. A retried task may insert its rows again, so a
    keyed target should be a version table that is read through its current view."""
    table.select(*named_all(columns)).write.format("jdbc").options(**options).mode("append").save()
