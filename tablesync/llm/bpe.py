"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary file.

A text is cut into words by the tokenizer's pattern. A word is a row of byte pieces; a higher-order fold joins, again and
again, the neighbouring pair whose bytes have the least rank in a rank map, until no pair has one. The
map is an array of small maps, entered by the CRC-32 of the bytes, because a lookup walks through its map. Pieces and pairs
are written as one character each, by their rank.

Words are folded once where that pays: the most frequent words, at most `FREQUENT` of them, are folded first and
sent to every task; the others are folded once for every block of `CHUNK` bytes of text in which they occur. Which words are frequent is read off
a share of the texts (`SHARE`); it steers what is folded ahead, never a result. So no text is shuffled and nothing
grows with the corpus. A fold copies its word at each merge, so words over `LONG` bytes are merged by a heap.

Decoding concatenates the pieces of the ids.

Nulls and edges: a null text counts as empty: no ids, the hash of nothing. Rows are encoded one by one, so repeated rows
and null ids stay. An empty table gives no rows. Only id and text are read, so other columns never clash. Special tokens are
not recognised.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.session import settle, temporary

BUCKETS = 32768  # a power of two
FREQUENT = 1 << 19
#: One in so many texts is looked at for frequent words.
SHARE = 4
LONG = 256
#: Ranks are written as the characters from here on; `NONE` comes after them all, `EDGE` before.
FIRST, NONE, EDGE = 0xE000, "\U0010ffff", "\x00"
CHUNK = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def java_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode has it; Java's `\\s` is that of ASCII."""
    return pattern.replace(r"[^\s", r"[^\p{IsWhite_Space}").replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def sign(rank: int) -> str:
    """The character that stands for a rank; lesser ranks come first in the order of strings."""
    if rank >= ord(NONE) - FIRST:
        raise ValueError(f"no character for rank {rank}")
    return chr(FIRST + rank)


def rank_tables(spark: SparkSession, ranks: dict[bytes, int]) -> tuple[Column, Column]:
    """Subqueries: the pieces of each bucket with the signs of their ranks, and the piece of every rank. A piece is a string with a character a byte.

    They are no literals, because Spark keeps the text of each plan it has run, literals and all, in the driver.
    """
    buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    pieces: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        text = piece.decode("latin-1")
        buckets[zlib.crc32(text.encode()) % BUCKETS][text] = sign(rank)
        pieces[rank] = text
    by_piece = pa.array([[list(b.items()) for b in buckets]], pa.list_(pa.map_(pa.string(), pa.string())))
    row = spark.createDataFrame(pa.table({"by_piece": by_piece, "by_rank": pa.array([pieces], pa.list_(pa.string()))}))
    return row.select("by_piece").scalar(), row.select("by_rank").scalar()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_tables(rows: DataFrame, tables: tuple[Column, Column], name: str, body: Callable[[Column, Column], Column]) -> DataFrame:
    """The rows and, as column `name`, `body` of the tables of ranks.

    Functions with lambdas take no subqueries, so the tables are columns first. Each is named once: Spark then makes one projection of the two, and no row carries a table.
    """
    told = let(F.col("by_piece"), lambda by_piece: let(F.col("by_rank"), lambda by_rank: body(by_piece, by_rank)))
    return rows.select("*", tables[0].alias("by_piece"), tables[1].alias("by_rank")).select(*rows.columns, told.alias(name))


def encode_word(word: Column, by_piece: Column, by_rank: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a binary word of one byte or more.

    The state of the fold is two short strings, because Spark copies and cuts these faster than arrays: the signs of the pieces, with an
    edge at either end, and for each neighbouring pair the sign of the rank that the two have as one piece, or
    `NONE`. The least sign of a pair is the sign of the piece that a merge puts in its place; only the two pairs beside it are looked up.
    """
    none = F.lit(NONE)
    size = F.length(word)
    found = lambda piece: F.try_element_at(F.get(by_piece, F.crc32(piece).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint"))), piece)
    number = lambda one: F.ascii(one) - FIRST
    piece_of = lambda one: F.get(by_rank, number(one))  # noqa: E731  null for an edge
    pair = lambda a, b: F.coalesce(found(F.concat(a, b)), none)
    at = lambda signs, k: F.substring(signs, k, F.lit(1))
    every_byte = "".join(map(chr, range(256)))
    every_sign = "".join(sign(ranks[bytes([b])]) for b in range(256))

    def begin(text: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.coalesce(found(F.substring(text, i, F.lit(2))), none))
        inner = F.when(size > 1, F.array_join(pairs, "")).otherwise("")
        pieces = F.concat(F.lit(EDGE), F.translate(text, every_byte, every_sign), F.lit(EDGE))
        return F.struct(pieces.alias("pieces"), F.concat(none, inner, none).alias("pairs"))

    def merge(state: Column, least: Column) -> Column:
        k = F.instr(state.pairs, least)
        left = pair(piece_of(at(state.pieces, k - 1)), piece_of(least))
        right = pair(piece_of(least), piece_of(at(state.pieces, k + 2)))
        return F.struct(
            F.overlay(state.pieces, least, k, F.lit(2)).alias("pieces"),
            F.overlay(state.pairs, F.concat(left, right), k - 1, F.lit(3)).alias("pairs"),
        )

    def step(state: Column, _: Column) -> Column:
        return let(F.array_min(F.split(state.pairs, "")), lambda least: F.when(least == none, state).otherwise(merge(state, least)))

    def fold(text: Column) -> Column:
        ids = lambda s: F.transform(F.split(F.substring(s.pieces, F.lit(2), F.length(s.pieces) - 2), ""), number)
        folded = F.aggregate(F.sequence(F.lit(2), F.greatest(size, F.lit(2))), begin(text), step, ids)
        return let(number(found(text)), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded))

    return let(F.decode(word, "ISO-8859-1"), fold)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As `encode_word`, in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that begins here; 0 if none does
    before = list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if end[i] != middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, i, stop))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """Words (column word) that occur more than a bound, which is set so that there are at most `most` of them."""
    counted = settle(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "word-counts")
    steps = counted.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("step")).agg(F.count("*").alias("words"))
    total, bound = 0, None  # at most a thousand steps
    for row in sorted(steps.collect(), reverse=True):
        total += row["words"]
        if total > most:
            break
        bound = row["step"]
    return counted.where(F.lit(False) if bound is None else F.floor(F.log2("n") * 16) >= bound).select("word")


def pack(known: pa.Array) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns documents into blocks: their word codes, and the words among them that are not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().cast(pa.string())
            byte_at = np.concatenate([[0], np.cumsum(pc.binary_length(flat).to_numpy(), dtype=np.int64)])
            ends = byte_at[np.concatenate([[0], np.cumsum(sizes)])]
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CHUNK, side="right")) - 1)
                coded = lists.slice(start, stop - start).flatten().dictionary_encode()
                place = pc.index_in(coded.dictionary, value_set=known)
                unknown = np.asarray(pc.is_null(place))
                code = pc.fill_null(place, 0).to_numpy().astype(np.int64)
                code[unknown] = len(known) + np.arange(unknown.sum())
                codes = code[coded.indices.to_numpy()].astype(np.int32)
                rare = coded.dictionary.filter(pa.array(unknown)).cast(pa.binary())
                one = lambda values, kind: pa.array([values], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, stop - start], pa.int32()), batch.column("doc_id").slice(start, stop - start)),
                        one(sizes[start:stop].astype(np.int32), pa.int32()),
                        one(codes, pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), rare),
                    ],
                    ["docs", "sizes", "codes", "rare"],
                )
                start = stop
                pa.default_memory_pool().release_unused()  # a worker serves many tasks, and Arrow keeps what was freed

    return run


def spell(ids: pa.ListArray, pieces: list[bytes]) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """For words: their ids as text, the bytes that the ids stand for, and how many ids there are."""
    counts = np.diff(ids.offsets.to_numpy())
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())  # a slice's own begin later
    flat = ids.flatten()
    text = pc.binary_join(pa.ListArray.from_arrays(offsets, flat.cast(pa.string())), " ")
    decoded = pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(pieces, pa.binary()).take(flat)), b"")
    return text, decoded, counts


def assemble(ranks: dict[bytes, int], known_ids: pa.Array, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns blocks into documents: hashes of their ids and of the bytes these stand for, and the ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        known = spell(known_ids, pieces)
        for batch in batches:
            for b in range(batch.num_rows):
                rare = batch.column("rare")[b].values
                found = batch.column("ids")[b].values
                long = np.flatnonzero(pc.binary_length(rare).to_numpy(zero_copy_only=False) > LONG)
                if len(long):
                    lists = found.to_pylist()
                    for i in long:
                        lists[i] = merge_long(rare[int(i)].as_py(), ranks)
                    found = pa.array(lists, pa.list_(pa.int32()))
                own = spell(found, pieces) if len(rare) else (pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, int))
                text, decoded = (pa.concat_arrays([known[i], own[i]]) for i in (0, 1))
                counts = np.concatenate([known[2], own[2]])
                sizes = batch.column("sizes")[b].values.to_numpy()
                codes = batch.column("codes")[b].values
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                places = pa.array(offsets, pa.int32())
                each = np.concatenate([[0], np.cumsum(counts[codes.to_numpy()])])
                encoded = pc.binary_join(pa.ListArray.from_arrays(places, text.take(codes)), " ")
                bytes_ = pc.binary_join(pa.ListArray.from_arrays(places, decoded.take(codes)), b"")
                ids = []
                if with_ids:
                    values = pa.concat_arrays([known_ids, found]).take(codes).flatten()
                    ids = [pa.ListArray.from_arrays(pa.array(each[offsets], pa.int32()), values)]
                sha = lambda x: hashlib.sha256(x.as_buffer()).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("docs")[b].values,
                        pa.array(each[offsets[1:]] - each[offsets[:-1]], pa.int64()),
                        pa.array([sha(x) for x in encoded], pa.string()),
                        pa.array([sha(x) for x in bytes_], pa.string()),
                        *ids,
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + with_ids],
                )
                pa.default_memory_pool().release_unused()

    return run


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, and with `with_ids` the array ids."""
    ranks = read_ranks(vocabulary_path)
    tables = rank_tables(docs.sparkSession, ranks)
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), words_of(F.col(text_col), pattern).alias("words"))
    with temporary(docs.sparkSession):
        some = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(SHARE)) == 0)
        often = frequent_words(some.select(F.explode(words_of(F.col(text_col), pattern)).alias("word")), frequent).where(F.octet_length("word") <= LONG)
        folded = settle(with_tables(often, tables, "ids", lambda p, b: encode_word(F.encode("word", "utf-8"), p, b, ranks)), "frequent-words")
        table = folded.toArrow().combine_chunks()  # at most `frequent` rows of LONG bytes
    words = pa.array([], pa.string()) if not len(table) else table.column("word").combine_chunks().cast(pa.string())
    ids = pa.array([], pa.list_(pa.int32())) if not len(table) else table.column("ids").combine_chunks()
    words, ids = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (words, ids))
    # Written, so that no executor holds the Python workers of both steps at once.
    blocks = settle(split.mapInArrow(pack(words), "docs array<long>, sizes array<int>, codes array<int>, rare array<binary>"), "word-codes")
    no_ids = F.array().cast("array<int>")
    each = lambda p, b: F.transform("rare", lambda w: F.when(F.length(w) <= LONG, encode_word(w, p, b, ranks)).otherwise(no_ids))
    done = with_tables(blocks, tables, "ids", each)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return done.mapInArrow(assemble(ranks, ids, with_ids), schema + ", ids array<int>" * with_ids)


def decode(ids: Column, vocabulary_path: str) -> Column:
    """The bytes of an array of ids: the pieces, looked up in a literal array and concatenated. A null or unknown id gives null."""
    pieces = {rank: piece.hex() for piece, rank in read_ranks(vocabulary_path).items()}
    table = F.split(F.lit(",".join(pieces.get(i, "") for i in range(max(pieces) + 1))), ",")
    texts = F.transform(ids, lambda i: F.get(table, i))
    return F.when(F.exists(texts, lambda t: t.isNull()), F.lit(None)).otherwise(F.unhex(F.array_join(texts, "")))
