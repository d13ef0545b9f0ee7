"""New values for some rows of a table, picked by their key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import named
from tablesync.operators.versions import broadcast_if_small


def _hit(table: DataFrame, picked: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """The picked keys, each once, and the condition that meets them; NULL is no key."""
    return broadcast_if_small(picked.select(named(key).alias("_picked")).distinct()), named(key) == F.col("_picked")


def updated_rows(table: DataFrame, picked: DataFrame, key: str, changes: Mapping[str, Column]) -> DataFrame:
    """The rows whose key is among the picked ones, with their new values."""
    keys, same = _hit(table, picked, key)
    return table.join(keys, same, "left_semi").withColumns(dict(changes))


def update_rows(table: DataFrame, picked: DataFrame, key: str, changes: Mapping[str, Column]) -> DataFrame:
    """The table after the rows with a picked key got their new values; all other rows are as they were."""
    keys, same = _hit(table, picked, key)
    joined = table.join(keys, same, "left")
    hit = F.col("_picked").isNotNull()
    return joined.select(*[F.when(hit, changes[c]).otherwise(named(c)).alias(c) if c in changes else named(c) for c in table.columns])
