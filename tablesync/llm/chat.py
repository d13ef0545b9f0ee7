"""Chat formatting by columnar byte assembly, and reading the result back.

A turn becomes `<|im_start|>role\\ntext<|im_end|>\\n`. Control strings inside of texts and roles get a backslash after
their first character, and those that have backslashes there already get one more, so escaping can be undone and no text can open or
close a turn. In roles, line ends and backslashes are escaped too.

For a batch of turns the lengths of all segments are computed, summed to offsets, and headers and contents are copied to their
places in one preallocated buffer, which becomes the Arrow column. The loss mask holds byte offsets and lengths of the assistant texts.

A conversation's turns are brought together sorted and are processed as a stream: a batch that ends inside a
conversation ends a *part* of it, so one with a third of all rows needs no more memory than others.

Nulls and edges: a null text or role counts as empty; turns are ordered by turn (nulls first), then role and text, so
ties and repeated rows have one order, and all of them are turns. Rows with a null conversation id are one conversation. An empty
table gives no rows. Only the four named columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import chunks

OPEN, END, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
# Strings that common chat templates treat as controls.
CONTROLS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]"
ESCAPE = rf"([<\[])(\\*)({CONTROLS})"
UNESCAPE = re.compile(rf"([<\[])\\(\\*)({CONTROLS})")
TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
LEARNED = "assistant"


def escape_texts(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(texts, ""), ESCAPE, r"\1\\\2\3")


def escape_roles(roles: pa.Array) -> pa.Array:
    lines = pc.replace_substring(pc.replace_substring(pc.fill_null(roles, ""), "\\", "\\\\"), "\n", "\\n")
    return escape_texts(lines)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or text column, and the length of each value."""
    column = pa.concat_arrays([column.cast(pa.large_binary())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns one after the other; where each begins, with the end last; where its text begins, and its length."""
    n = len(roles)
    (role_bytes, role_sizes), (text_bytes, text_sizes) = flat(escape_roles(roles)), flat(escape_texts(texts))
    sizes = np.stack([np.full(n, len(OPEN)), role_sizes, np.full(n, len(END)), text_sizes, np.full(n, len(CLOSE))], 1)
    starts = np.concatenate([[0], np.cumsum(sizes.ravel())])
    out = np.empty(starts[-1], np.uint8)
    at = starts[:-1].reshape(n, 5)
    for column, content in ((0, OPEN), (2, END), (4, CLOSE)):
        out[at[:, column, None] + np.arange(len(content))] = np.frombuffer(content, np.uint8)
    for column, content, lengths in ((1, role_bytes, role_sizes), (3, text_bytes, text_sizes)):
        source = np.cumsum(lengths) - lengths
        out[np.arange(len(content)) + np.repeat(at[:, column] - source, lengths)] = content
    return out, np.concatenate([at[:, 0], starts[-1:]]), at[:, 3], text_sizes


def format_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation to rows (conv_id, part, n_turns, formatted, mask_starts, mask_lengths)."""
    last, part = object(), 0
    for batch in chunks(batches, "text"):
        ids = batch.column("conv_id").to_pylist()
        out, starts, text_at, text_sizes = assemble(batch.column("role"), batch.column("text"))
        first = np.array([i == 0 or ids[i] != ids[i - 1] for i in range(len(ids))])
        rows = np.flatnonzero(first)
        ends = np.append(rows[1:], len(ids))
        parts = []
        for r in rows:
            part = part + 1 if ids[r] == last else 0
            last = ids[r]
            parts.append(part)
        learned = np.flatnonzero(np.asarray(pc.equal(pc.fill_null(batch.column("role"), ""), LEARNED)))
        owner = np.searchsorted(rows, learned, side="right") - 1
        masks = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))])
        offsets = pa.array(masks, pa.int32())
        formatted = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(np.append(starts[rows], starts[-1]).astype(np.int64).tobytes()), pa.py_buffer(out))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id").take(pa.array(rows)),
                pa.array(parts, pa.int64()),
                pa.array(ends - rows, pa.int64()),
                formatted.cast(pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(text_at[learned] - starts[rows][owner], pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(text_sizes[learned], pa.int64())),
            ],
            ["conv_id", "part", "n_turns", "formatted", "mask_starts", "mask_lengths"],
        )


class Digest:
    """What is read back of one conversation, part by part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.formatted = conv_id, 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: list[int], lengths: list[int]) -> None:
        self.formatted += len(formatted)
        for turn in TURN.finditer(formatted):
            self.turns += 1
            self.all.update(f"{unescape_role(turn[1])}\n{unescape(turn[2])}\n".encode())
        whole = formatted.encode()
        for start, length in zip(starts, lengths, strict=True):
            text = unescape(whole[start : start + length].decode())
            self.chars += len(text)
            self.learned.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.chars, self.learned.hexdigest(), self.formatted


def read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order to one row a conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current = None

    def table(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)], names)

    for batch in batches:
        done = []
        for i in range(batch.num_rows):
            conv_id = batch.column("conv_id")[i].as_py()
            if current is None or current.conv_id != conv_id or batch.column("part")[i].as_py() == 0:
                if current is not None:
                    done.append(current.row())
                current = Digest(conv_id)
            current.add(*(batch.column(c)[i].as_py() for c in ("formatted", "mask_starts", "mask_lengths")))
        yield table(done)
    if current is not None:
        yield table([current.row()])


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, formatted, mask_starts, mask_lengths): the parts of a conversation joined in order are its text."""
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    together = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, part long, n_turns long, formatted string, mask_starts array<long>, mask_lengths array<long>"
    return together.mapInArrow(format_parts, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations as `format_conversations` returns them, which leaves the parts of one in order in one task."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(read_parts, schema)
