"""Columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of this name, in which a dot is part of the name and no access to a field."""
    return F.col("`" + name.replace("`", "``") + "`")


def named_all(names: list[str]) -> list[Column]:
    return [named(name) for name in names]
