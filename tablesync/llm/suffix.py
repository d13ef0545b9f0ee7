"""Repeated substrings removed by suffix sorting in shards: external induced sorting with common-prefix values.

A byte goes if it lies in a string of `LENGTH` bytes that also starts anywhere else, in the same document or another.

*Shards.* Every window of `LENGTH` bytes has an anchor, its least k-gram by a hash. Neighbouring windows with
one anchor form a segment; equal windows have equal anchors, so all starts of a string meet in the shard of their anchor's
hash. Anchors that occur once are dropped by a count over the corpus, equal segments are sorted once with their
number, and no more of the text than that moves.

*Sorting.* A shard's segments are one byte string with separators. Its suffixes are sorted by induction: the leftmost-S
suffixes are ranked first, then all L suffixes are induced from left to right and all S suffixes from right
to left. The suffixes wait in one first-in first-out queue for each byte, which is a priority queue here, since buckets are emptied
in order; a queue holds arrays of suffixes, not single ones. The reduced string, a third of the text, is ranked by doubling up
to `LENGTH` bytes. Common-prefix values are carried on from byte to byte, less one each, where a suffix and its
neighbour follow a neighbouring pair by one byte, and compared elsewhere. Arrays above `IN_MEMORY` bytes live in unlinked files of the task and are mapped, so a shard may exceed memory; no other task reads them.

Nulls and edges: a null text has no bytes. Documents under `LENGTH` bytes stay whole. Rows are told apart by id and text; repeated rows are documents of their own, so their texts repeat. Null ids stay
null. An empty table gives no rows. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import chunks, mix
from tablesync.session import settle, temporary

LENGTH = 200
GRAM = 32  # long enough that few texts share one by chance
SEPARATOR = 0xFF  # never a byte of UTF-8
SHARD_BYTES = 4 << 20
IN_MEMORY = 16 << 20
#: Keys (16 bytes each) up to which documents are picked by a broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def array(n: int, kind: type) -> np.ndarray:
    """An empty array, in an unlinked file if it is large."""
    if n * np.dtype(kind).itemsize <= IN_MEMORY:
        return np.empty(n, kind)
    with tempfile.TemporaryFile() as file:
        file.truncate(n * np.dtype(kind).itemsize)
        return np.memmap(file, kind, "r+", shape=(n,))


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every start of a window the place of its anchor, and the hash of every k-gram."""
    with np.errstate(over="ignore"):
        h = mix(np.arange(1, 257, dtype=np.uint64))[text]
        for i, factor in enumerate(MULTIPLIERS):
            step = 1 << i
            h = h[:-step] * factor + h[step:]
    h = mix(h)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if rest := width - span:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64), h


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, start, windows, anchor, content) of all segments of the texts."""
    for batch in chunks(batches, "text", 2 << 20):
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        whole = b"".join(texts)
        if len(whole) < LENGTH:
            continue
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        place, h = anchors(np.frombuffer(whole, np.uint8))
        owner = np.repeat(np.arange(len(sizes)), sizes)[: len(place)]
        valid = np.arange(len(place)) + LENGTH <= ends[owner]
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        runs = np.add.reduceat(valid, starts)  # windows after an invalid one begin a run of their own
        content = np.fromiter((int.from_bytes(hashlib.blake2b(whole[a : a + n + LENGTH - 1], digest_size=8).digest(), "little", signed=True) for a, n in zip(starts.tolist(), runs.tolist(), strict=True)), np.int64, len(starts))
        own = owner[starts]
        rows = pa.array(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("row").take(rows), pa.array((starts - (ends - sizes)[own]).astype(np.int64)), pa.array(runs.astype(np.int32)), pa.array(h[place[starts]].view(np.int64)), pa.array(content)],
            ["doc_id", "row", "start", "windows", "anchor", "content"],
        )


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, n, windows, bytes) of the segments listed with each text."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_py().encode()
            wanted = batch.column("wanted")[i].values
            start, windows = (wanted.field(f).to_pylist() for f in ("start", "windows"))
            pieces = [text[a : a + n + LENGTH - 1] for a, n in zip(start, windows, strict=True)]
            yield pa.RecordBatch.from_arrays([wanted.field("anchor"), wanted.field("content"), wanted.field("n"), wanted.field("windows"), pa.array(pieces, pa.binary())], ["anchor", "content", "n", "windows", "bytes"])


def types(t: np.ndarray) -> np.ndarray:
    """True for suffixes of type S: less than the suffix that begins one byte later. The end of the string is the least suffix."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = (t[1:] > t[:-1]).view(np.int8) - (t[1:] < t[:-1]).view(np.int8)
    step[-1] = -1
    at = np.where(step != 0, np.arange(n, dtype=index_kind(n)), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return step[nxt] > 0


def index_kind(n: int) -> type:
    return np.int32 if n < 2**31 - 1 else np.int64


class Queues:
    """One first-in first-out queue of suffix arrays for each byte."""

    def __init__(self) -> None:
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(self, t: np.ndarray, kind: np.ndarray, of_s: bool, suffixes: np.ndarray) -> None:
        """Queues what precedes the suffixes by one byte and has the type asked for, in their order."""
        before = suffixes[suffixes > 0] - 1
        before = before[kind[before] == of_s]
        if not len(before):
            return
        byte = t[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, cuts):
            kept = array(len(part), index_kind(len(t)))
            kept[:] = part
            self.waiting[t[part[0]]].append(kept)

    def drain(self, byte: int) -> Iterator[np.ndarray]:
        """What waits for the byte, and again what has come to wait meanwhile, each time as one array."""
        waiting, at = self.waiting[byte], 0
        while at < len(waiting):
            joined = array(sum(map(len, waiting[at:])), waiting[at].dtype)
            np.concatenate(waiting[at:], out=joined)
            waiting[at:] = [joined]
            at += 1
            yield joined


def induced(t: np.ndarray, kind: np.ndarray, seeds: np.ndarray) -> list[np.ndarray]:
    """All suffixes in order, a list of arrays, from the leftmost-S suffixes in theirs."""
    byte = t[seeds]
    seed_cuts = np.searchsorted(byte, np.arange(257))
    low, high = Queues(), Queues()
    low.induce(t, kind, False, np.array([len(t)], index_kind(len(t))))
    for c in range(256):
        for part in low.drain(c):
            low.induce(t, kind, False, part)
        low.induce(t, kind, False, seeds[seed_cuts[c] : seed_cuts[c + 1]])
    for c in range(255, -1, -1):
        for part in high.drain(c):
            high.induce(t, kind, True, part)
        for part in reversed(low.waiting[c]):
            high.induce(t, kind, True, part[::-1])
    out: list[np.ndarray] = []
    for c in range(256):
        out += low.waiting[c] + [part[::-1] for part in reversed(high.waiting[c])]
    return out


def seed_order(t: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The leftmost-S suffixes, sorted by their first LENGTH bytes."""
    lms = (np.flatnonzero(kind[1:] & ~kind[:-1]) + 1).astype(index_kind(len(t)))
    m = len(lms)
    if m < 2:
        return lms
    # rank the substrings between neighbouring ones: induction from unsorted seeds sorts them
    order = np.concatenate(induced(t, kind, lms[np.argsort(t[lms], kind="stable")]))
    is_lms = np.zeros(len(t) + 1, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    number = array(len(t), index_kind(len(t)))
    number[lms] = np.arange(m)
    place = number[order]
    stop = np.append(lms[1:], len(t) - 1)
    size = (stop - lms + 1)[place]
    same = np.zeros(m, bool)
    same[1:] = size[1:] == size[:-1]
    live, depth = np.flatnonzero(same), 0
    while len(live):
        a, b = order[live] + depth, order[live - 1] + depth
        equal = (t[a] == t[b]) & (kind[a] == kind[b])
        same[live[~equal]] = False
        live = live[equal & (depth + 1 < size[live])]
        depth += 1
    rank = np.empty(m, np.int64)
    rank[place] = np.cumsum(~same) - 1
    # names that are still shared are ranked by doubling; every name covers a byte or more
    many = np.bincount(rank)
    slot = (np.cumsum(many) - many)[rank]  # a name's first place among all
    reach, open_ = 1, np.arange(m)
    while reach < LENGTH:
        open_ = open_[np.bincount(slot[open_], minlength=m)[slot[open_]] > 1]
        if not len(open_):
            break
        far = open_ + reach
        second = np.where(far < m, slot[np.minimum(far, m - 1)] + 1, 0)
        key = slot[open_] * (m + 1) + second
        by = np.argsort(key)
        one, key = slot[open_][by], key[by]
        at = np.arange(len(by))
        begin = np.maximum.accumulate(np.where(np.append(True, one[1:] != one[:-1]), at, 0))
        inner = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
        slot[open_[by]] = one + (inner - begin)
        reach *= 2
    return lms[np.argsort(slot, kind="stable")]


def repeated(t: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For a string of segments, each ended by a separator, which places begin LENGTH bytes that begin elsewhere too."""
    n = len(t)
    kind = types(t)
    before = array(n, index_kind(n))  # the suffix that sorts right before each suffix
    last = np.zeros(0, index_kind(n))
    for part in induced(t, kind, seed_order(t, kind)):
        if len(part):
            joined = np.concatenate([last, part])
            before[joined[1:]] = joined[:-1]
            if not len(last):
                before[part[0]] = -1
            last = part[-1:]
    has = before >= 0
    fresh = np.ones(n, bool)
    at = np.arange(1, n)
    other = before[1:]
    fresh[1:] = (other != before[:-1] + 1) | (t[at - 1] != t[before[:-1]])
    fresh[starts] = True
    common = np.zeros(n, np.int32)
    words = np.ndarray((n,), "<u8", np.concatenate([t, np.zeros(8, np.uint8)]), strides=(1,))
    live = np.flatnonzero(fresh & has)
    limit, depth = int(np.diff(np.append(starts, n)).max()), 0
    while len(live) and depth < limit:
        a, b = live + depth, before[live] + depth
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs tells the byte
        common[live] = depth + np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(float)).astype(np.int64) // 8)
        live = live[differ == 0]
        depth += 8
    every = np.arange(n, dtype=index_kind(n))
    source = np.maximum.accumulate(np.where(fresh, every, 0))
    carried = common[source] - (every - source)
    found = has & (carried >= LENGTH)
    out = found.copy()
    out[before[found]] = True
    return out


def sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, runs) of the segments with repeated windows; a run is the first and last repeated start."""
    parts, anchor, content, n, windows = [], [], [], [], []
    for batch in batches:
        lengths = np.fromiter((len(x) for x in batch.column("bytes").to_pylist()), np.int64, batch.num_rows)
        flat = np.full(int(lengths.sum()) + batch.num_rows, SEPARATOR, np.uint8)
        at = 0
        for x in batch.column("bytes").to_pylist():
            flat[at : at + len(x)] = np.frombuffer(x, np.uint8)
            at += len(x) + 1
        kept = array(len(flat), np.uint8)
        kept[:] = flat
        parts.append(kept)
        for column, name in ((anchor, "anchor"), (content, "content"), (n, "n"), (windows, "windows")):
            column.append(batch.column(name).to_numpy())
    if not parts:
        return
    anchor, content, n, windows = (np.concatenate(x) for x in (anchor, content, n, windows))
    t = array(sum(map(len, parts)), np.uint8)
    np.concatenate(parts, out=t)
    sizes = windows.astype(np.int64) + LENGTH
    starts = np.cumsum(sizes) - sizes
    marked = repeated(t, starts)
    lead = np.zeros(len(t) + 1, np.int32)  # windows of segments that occur twice repeat
    many = n > 1
    np.add.at(lead, starts[many], 1)
    np.add.at(lead, (starts + windows)[many], -1)
    marked |= np.cumsum(lead[:-1]) > 0
    owner = np.repeat(np.arange(len(starts)), sizes)
    marked &= np.arange(len(t)) - starts[owner] < windows[owner]  # later ones run into a separator
    edge = np.flatnonzero(marked & ~np.append(False, marked[:-1] & (owner[1:] == owner[:-1])))
    close = np.flatnonzero(marked & ~np.append(marked[1:] & (owner[1:] == owner[:-1]), False))
    own = owner[edge]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(starts)))])
    runs = pa.StructArray.from_arrays([pa.array((edge - starts[own]).astype(np.int32)), pa.array((close - starts[own]).astype(np.int32))], ["low", "high"])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
    some = pa.array(np.flatnonzero(np.diff(offsets)))
    yield pa.RecordBatch.from_arrays([pa.array(anchor).take(some), pa.array(content).take(some), lists.take(some)], ["anchor", "content", "runs"])


def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each text with its ranges of repeated starts."""
    for batch in chunks(batches, "text"):
        rows = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            data = (text or "").encode()
            kept, at, spans, low, high = [], 0, 0, None, None
            for a, b in sorted((r["low"], r["high"] + LENGTH) for r in ranges or []):
                if high is not None and a <= high:
                    high = max(high, b)
                    continue
                if high is not None:
                    kept.append(data[at:low])
                    at, spans = high, spans + 1
                low, high = a, b
            if high is not None:
                kept.append(data[at:low])
                at, spans = high, spans + 1
            left = b"".join([*kept, data[at:]])
            rows.append((len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def same_row(other: DataFrame) -> Column:
    return (F.col("row") == other["of_row"]) & F.col("doc_id").eqNullSafe(other["of_doc"])


def picked(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts with a key in `keys`, by a broadcast if their counted number allows."""
    keys = settle(keys.select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row")).distinct(), "keys")
    few = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    return texts.join(few, same_row(few), "left_semi")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, row, text), and (doc_id, row, ranges): the first and last starts of their repeated strings."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), F.coalesce(text, F.lit(""))).alias("row"), text.alias("text"))
    with temporary(docs.sparkSession):
        schema = "doc_id long, row long, start long, windows int, anchor long, content long"
        found = settle(texts.mapInArrow(segments, schema), "segments")
        shared = settle(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
        candidates = settle(found.join(shared, "anchor", "left_semi"), "candidates")
        one = F.min(F.struct("doc_id", "row", "start", "windows")).alias("at")
        distinct = settle(candidates.groupBy("anchor", "content").agg(F.count("*").alias("n"), one), "distinct-segments")
        total = distinct.agg(F.sum(F.col("at.windows") + LENGTH)).collect()[0][0] or 0
        wanted = distinct.select(F.col("at.doc_id").alias("of_doc"), F.col("at.row").alias("of_row"), F.struct("at.start", "at.windows", "anchor", "content", "n").alias("w"))
        lists = wanted.groupBy("of_doc", "of_row").agg(F.collect_list("w").alias("wanted"))
        holders = picked(texts, distinct.select("at.doc_id", "at.row")).join(lists, same_row(lists))
        pieces = holders.select("text", "wanted").mapInArrow(cut_out, "anchor long, content long, n long, windows int, bytes binary").dropDuplicates(["anchor", "content"])
        shards = pieces.repartition(max(1, -(-int(total) // SHARD_BYTES)), "anchor")
        sorted_ = settle(shards.mapInArrow(sort_shard, "anchor long, content long, runs array<struct<low:int,high:int>>"), "repeated-segments")
        spread = candidates.join(sorted_, ["anchor", "content"]).select("doc_id", "row", "start", F.explode("runs").alias("run"))
        span = F.struct((F.col("start") + F.col("run.low")).alias("low"), (F.col("start") + F.col("run.high")).alias("high"))
        return texts, settle(spread.groupBy("doc_id", "row").agg(F.collect_set(span).alias("ranges")), "ranges", keep=True)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, and with `with_text` the bytes kept."""
    texts, ranges = repeats(docs, id_col, text_col)
    keyed = ranges.select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row"), "ranges")
    joined = texts.join(keyed, same_row(keyed), "left").select("doc_id", "text", "ranges")
    done = joined.mapInArrow(removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done if with_text else done.drop("kept")
