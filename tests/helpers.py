"""Helpers of the core tests. They live outside of conftest, a name that every test folder may have."""

DATA = "/root/testdata"


def plan_of(table) -> str:
    """The formatted physical plan as text."""
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows_of(table, *columns):
    """All rows as sorted tuples."""
    selected = table.select(*columns) if columns else table
    return sorted((tuple(r) for r in selected.collect()), key=repr)
