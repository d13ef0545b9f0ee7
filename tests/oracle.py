"""Runs a registered query beside its SQL and compares names, types, row counts and values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from tablesync.plans.inputs import TABLES
from tablesync.plans.queries import ORACLES, QUERIES
from tablesync.plans.queries.registry import MAKER_SQL, MAKERS


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# The names of one type on either side.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs; an empty list when nothing does."""
    table = {**QUERIES, **MAKERS}[name](spark, sf_dir)
    sql = {**ORACLES, **MAKER_SQL}[name]
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    mine = {f.name: f.dataType.simpleString() for f in table.schema}
    if set(types) != set(mine):
        return [f"columns {sorted(mine)} against {sorted(types)}"]
    for column, kind in mine.items():
        expected = SAME_TYPE.get(kind, kind.upper())
        if types[column] != expected:
            problems.append(f"type of {column}: {kind} against {types[column]}")
    names = sorted(mine)
    rows = Counter(tuple(_value(r[c]) for c in names) for r in table.collect())
    quoted = ", ".join(f'"{c}"' for c in names)
    theirs = Counter(tuple(map(_value, r)) for r in con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if rows != theirs:
        problems.append(f"rows {sum(rows.values())} against {sum(theirs.values())}")
        problems += [f"only here: {r}" for r in list((rows - theirs))[:3]]
        problems += [f"only in SQL: {r}" for r in list((theirs - rows))[:3]]
    return problems
