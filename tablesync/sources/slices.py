"""Balanced slices of a database table: predicates from the quantiles and frequent values that the database keeps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def identifier(name: str) -> str:
    """A name as an SQL identifier; dots part a schema from a table."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


@dataclass(frozen=True)
class ColumnStatistics:
    """What a database knows of a column: values that part its rows into equal shares, frequent values with their
    share of the rows, and the share of NULLs. Frequent values are not counted in the quantiles."""

    quantiles: Sequence[str] = ()
    frequent: Sequence[tuple[str, float]] = ()
    nulls: float = 0.0


def statistics_query(schema: str, table: str, column: str) -> str:
    """One query for the statistics of a column: rows `(kind, value, share)` in their order.

    PostgreSQL keeps them since the table was last analysed, so no row of the table is read. They may be out of date: slices
    made from them are then less even, and still hold every row once.
    """
    mine = f"schemaname = {quoted(schema)} AND tablename = {quoted(table)} AND attname = {quoted(column)}"
    return (
        "SELECT 'quantile' AS kind, q.value AS value, CAST(NULL AS double precision) AS share, q.place AS place "
        f"FROM pg_stats, unnest(histogram_bounds::text::text[]) WITH ORDINALITY AS q(value, place) WHERE {mine} "
        "UNION ALL SELECT 'frequent', f.value, f.share, f.place "
        f"FROM pg_stats, unnest(most_common_vals::text::text[], most_common_freqs::double precision[]) WITH ORDINALITY AS f(value, share, place) WHERE {mine} "
        f"UNION ALL SELECT 'null', NULL, null_frac, 0 FROM pg_stats WHERE {mine}"
    )


def statistics_of(rows: Sequence[tuple[str, str | None, float | None, int]]) -> ColumnStatistics:
    """The statistics from the rows of `statistics_query`."""
    ordered = sorted(rows, key=lambda r: r[3])
    return ColumnStatistics(
        [r[1] for r in ordered if r[0] == "quantile"],
        [(r[1], float(r[2])) for r in ordered if r[0] == "frequent"],
        sum(float(r[2] or 0) for r in ordered if r[0] == "null"),
    )


def _parts(condition: str, share: float, slices: int, row_hash: str) -> list[str]:
    """The rows of a condition in as many slices as their share is worth, dealt by a hash of the row's place."""
    count = max(1, round(share * slices))
    if count == 1:
        return [condition]
    return [f"{condition} AND {row_hash} % {count} = {part}" for part in range(count)]


#: A number of 0 or more for every row of a PostgreSQL table, the same as long as the row is not rewritten.
ROW_HASH = "(hashtext(ctid::text) & 2147483647)"


def balanced_slices(column: str, statistics: ColumnStatistics, slices: int, row_hash: str = ROW_HASH) -> list[str]:
    """Predicates that part the rows of a table into about `slices` slices of equal size, each row in exactly one.

    Ranges lie between quantiles and are open at both ends of the table. A value with more than half a slice of the rows has slices of
    its own, as many as it is worth, and is left out of its range; so have NULLs. However the values are spread, no slice holds much
    more than its share.
    """
    if slices < 1:
        raise ValueError("a table is read in one slice at least")
    name = identifier(column)
    own = [(value, share) for value, share in statistics.frequent if share * slices > 0.5]
    rest = max(0.0, 1 - statistics.nulls - sum(share for _, share in own))
    ranges = max(1, round(rest * slices))
    inner = list(statistics.quantiles)[1:-1]
    cuts: list[str] = []
    for i in range(1, min(ranges, len(inner) + 1)):
        cut = inner[i * (len(inner) + 1) // min(ranges, len(inner) + 1) - 1]
        if not cuts or cut != cuts[-1]:
            cuts.append(cut)
    but = "".join(f" AND {name} <> {quoted(value)}" for value, _ in own)
    lows = [f"{name} IS NOT NULL" if not cuts else f"{name} <= {quoted(cuts[0])}"]
    lows += [f"{name} > {quoted(a)} AND {name} <= {quoted(b)}" for a, b in zip(cuts, cuts[1:])]
    lows += [f"{name} > {quoted(cuts[-1])}"] if cuts else []
    predicates = [f"{low}{but}" for low in lows]
    for value, share in own:
        predicates += _parts(f"{name} = {quoted(value)}", share, slices, row_hash)
    return predicates + _parts(f"{name} IS NULL", statistics.nulls, slices, row_hash)
