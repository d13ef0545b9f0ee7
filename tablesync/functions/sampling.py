"""Repeatable random columns: the same row id and seed give the same value under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS_PER_DIGEST = 4


class Draws:
    """Uniform draws in [0, 1) for each row, read off md5 digests of (id, seed, block).

    One digest gives four draws, so a row costs one hash per four random columns.
    """

    def __init__(self, row_id: Column, seed: int):
        self._text = row_id.cast("string")
        self._seed = seed
        self._used = 0

    def bits(self) -> Column:
        """The next 32 random bits as a BIGINT."""
        block, slot = divmod(self._used, DRAWS_PER_DIGEST)
        self._used += 1
        digest = F.md5(F.concat(self._text, F.lit(f":{self._seed}:{block}")))
        return F.conv(F.substring(digest, 1 + 8 * slot, 8), 16, 10).cast("bigint")

    def uniform(self) -> Column:
        return self.bits() / F.lit(4294967296.0)

    def whole(self, scale: float, start: float = 0) -> Column:
        """`(random() * scale + start)::int`, which rounds, so the end values get half the weight."""
        return F.rint(self.uniform() * F.lit(float(scale)) + F.lit(float(start))).cast("int")

    def money(self, scale: float, start: float) -> Column:
        """`(random() * scale + start)::decimal(10,2)`."""
        return (self.uniform() * F.lit(float(scale)) + F.lit(float(start))).cast("decimal(10,2)")

    def pick(self, *words: str) -> Column:
        """One of the words, chosen by the rounded draw.

        A lookup in a constant array, in which the draw is worked out once; as a CASE it would be
        worked out again in every branch.
        """
        return F.element_at(F.array(*[F.lit(w) for w in words]), self.whole(len(words) - 1) + 1)

    def before(self, anchor: Column, days: int) -> Column:
        """A time up to `days` days before the anchor."""
        micros = F.floor(self.uniform() * F.lit(days * 86_400_000_000.0)).cast("bigint")
        return F.timestamp_add("MICROSECOND", -micros, anchor)

    def hex_text(self, size: int = 16) -> Column:
        """`substr(md5(random), 1, size)`: a session id."""
        return F.substring(F.md5(self.bits().cast("string")), 1, size)
