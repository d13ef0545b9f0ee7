"""Scalar functions as column expressions; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDENTIFIER_PATTERN = r"^[a-zA-Z0-9_\.]+$"


def valid_identifier(name: Column) -> Column:
    """True when a table or column name holds only letters, digits, `_` and `.`."""
    # `$` also matches before a last line break in Java, so line breaks are ruled out apart.
    return name.rlike(IDENTIFIER_PATTERN) & ~F.contains(name, F.lit("\n"))


def uuid_text(value: Column) -> Column:
    """16 bytes as lower-case `8-4-4-4-12`; any other length gives NULL."""
    digits = F.lower(F.hex(value))
    parts = [F.substring(digits, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.octet_length(value) == 16, F.concat_ws("-", *parts))


def redact_url(url: Column) -> Column:
    """Hide the password of `scheme://user:password@host`; every other shape is kept as it is."""
    one_login = r"^((?:(?!://)[^@])*)://([^:@]*):(?!//)([^:@]*)@([^@]*)$"
    return F.regexp_replace(url, one_login, "$1://$2:***@$4")


def cursor_text(value: Column, data_type: T.DataType) -> Column:
    """A cursor as the run log prints it: no trailing zeros in times, six places in floats."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return _drop_zero_fraction(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.format_string("%.6f", value)
    return value.cast("string")


def _drop_zero_fraction(padded: Column) -> Column:
    seconds = F.substring(padded, 1, 19)
    fraction = F.regexp_replace(F.substring(padded, 21, 6), "0+$", "")
    return F.when(fraction == "", seconds).otherwise(F.concat_ws(".", seconds, fraction))


def progress_percent(current: Column, total: Column) -> Column:
    """`current / total` in percent, at most 100; 0 while the total is unknown (0 or NULL)."""
    # `least` passes over NULL, so an unknown total is handled by its own branch.
    share = current.cast("double") / total.cast("double") * F.lit(100.0)
    return F.when((total > 0) & current.isNotNull(), F.least(F.lit(100.0), share)).otherwise(0.0)


def pretty_size(size: Column) -> Column:
    """Bytes for reading, as PostgreSQL prints them: a unit is used below 10240 (half-way rounded) of it."""
    size = size.cast("bigint")
    label = F.concat(size.cast("string"), F.lit(" bytes"))
    ladder = F.when(F.abs(size) < 10 * 1024, label)
    # One binary digit below the unit is kept for rounding, so kB starts from size / 512.
    for unit, shift in (("kB", 9), ("MB", 19), ("GB", 29), ("TB", 39), ("PB", 49)):
        halves = F.shiftright(size, shift)
        text = F.concat(F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        ladder = ladder.when((halves < 20 * 1024 - 1) | F.lit(unit == "PB"), text)
    return ladder
