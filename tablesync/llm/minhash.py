"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set: its shingles of five words, each weighing as often as it occurs. A shingle of weight w
covers w unit strips. Darts are thrown into a strip by hashing, as a Poisson process in *rank*: the first darts of a
strip are the same in every document that covers it. Each dart falls on one of `k` coordinates, and a coordinate keeps
the earliest dart that the document covers, so two documents agree on a coordinate with probability equal to their
weighted Jaccard similarity. Only darts up to rank t/weight are thrown (t = k ln k + 2k of them in all), and further
ones only while a coordinate is empty.

Signatures are cut into bands. Documents with a band in common are compared with the least document of that bucket;
pairs whose signatures agree on enough coordinates are compared exactly on their strips. Buckets that still hold
several classes afterwards are compared between the classes. Documents with equal shingles are one document throughout.

Nulls and edges: a null text, an empty one and one without words is in a class of its own, as is a text whose
shingles nobody shares. Texts of one to four words are one shingle. A null id gives a null class. Rows with one id are
taken as one document. Only id and text are read, so other columns never clash. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import chunks, mix
from tablesync.llm.components import components
from tablesync.session import settle, temporary

WORDS = 5
BANDS, ROWS = 25, 5
K = BANDS * ROWS
DARTS = K * math.log(K) + 2 * K
SIMILARITY = 0.8
#: Coordinates two signatures must share before an exact comparison: five and a half deviations below what 0.8 gives.
AGREE = int(K * SIMILARITY - 5.5 * math.sqrt(K * SIMILARITY * (1 - SIMILARITY)))

#: Members of a bucket that are compared in one block.
BLOCK = 512
#: Ids (8 bytes each) up to which the documents of the pairs are picked by a broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 4_000_000

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (runs of letters and digits, lower case) and the number of words of each text."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}\p{N}]+", " ")
    lists = pc.split_pattern(pc.utf8_trim(spaced, " "), " ")
    counts = np.diff(lists.offsets.to_numpy())
    coded = lists.flatten().dictionary_encode()
    if not len(coded):
        return np.zeros(0, np.uint64), counts
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    counts = np.where((counts == 1) & (pc.utf8_length(pc.utf8_trim(spaced, " ")).to_numpy() == 0), 0, counts)
    words = table[coded.indices.to_numpy()]
    if counts.sum() != len(words):  # an empty text splits into one empty word
        full = np.diff(lists.offsets.to_numpy())
        words = words[np.repeat(counts > 0, full)]
    return words, counts


def strips(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(owner, strip) of every unit strip, sorted by owner and shingle: the n-th copy of a shingle is a strip of its own."""
    words, counts = word_hashes(texts)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)[owner]
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    shingle = np.zeros(n, np.uint64)
    at = np.arange(n)
    with np.errstate(over="ignore"):
        for j in range(WORDS):
            shingle += np.where(at + j < ends, padded[j : n + j] * ODD[j], np.uint64(0))
    first = at == ends - counts[owner]
    kept = (at + WORDS <= ends) | (first & (counts[owner] < WORDS))
    owner, shingle = owner[kept], mix(shingle[kept])
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    place = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    with np.errstate(over="ignore"):
        return owner, mix(shingle + place.astype(np.uint64) * ODD[0])


def throw(owner: np.ndarray, strip: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, coordinate, rank, dart) of all darts up to the rank `limit` of their owner, one round a yield."""
    rank, n = np.zeros(len(strip)), 0
    while len(strip):
        n += 1
        with np.errstate(over="ignore"):
            dart = mix(strip + np.uint64(n) * ODD[1])
        rank = rank - np.log(((dart >> np.uint64(11)).astype(float) + 1) / 2.0**53)
        live = rank <= limit[owner]
        owner, strip, rank, dart = owner[live], strip[live], rank[live], mix(dart[live])
        yield owner, (dart % np.uint64(K)).astype(np.int64), rank, (dart >> np.uint64(32)).astype(np.uint32)


def signatures(owner: np.ndarray, strip: np.ndarray, docs: int) -> np.ndarray:
    """The earliest dart of each coordinate, documents by K. Documents without strips keep zeros."""
    weight = np.bincount(owner, minlength=docs)
    best = np.full((docs, K), np.inf)
    dart = np.zeros((docs, K), np.uint32)
    limit = DARTS / np.maximum(weight, 1)
    todo = np.flatnonzero(weight)
    while len(todo):
        mine = np.isin(owner, todo)
        for o, c, r, d in throw(owner[mine], strip[mine], limit):
            order = np.argsort(-r, kind="stable")  # the earliest is written last
            o, c, r, d = o[order], c[order], r[order], d[order]
            better = r < best[o, c]
            o, c, r, d = o[better], c[better], r[better], d[better]
            best[o, c] = r
            dart[o, c] = d
        todo = todo[np.isinf(best[todo]).any(1)]
        limit[todo] *= 2
    return dart


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text"):
        n = part.num_rows
        owner, strip = strips(part.column("text"))
        weight = np.bincount(owner, minlength=n)
        sums = np.zeros((2, n), np.uint64)
        with np.errstate(over="ignore"):
            for i, seed in enumerate((ODD[2], ODD[3])):
                starts = np.flatnonzero(weight)
                if len(starts):
                    sums[i, starts] = np.add.reduceat(mix(strip ^ seed), np.concatenate([[0], np.cumsum(weight[starts])[:-1]]))
            darts = signatures(owner, strip, n)
            bands = np.zeros((n, BANDS), np.uint64)
            for b in range(BANDS):
                key = np.full(n, b + 1, np.uint64)
                for j in range(ROWS):
                    key = mix(key + darts[:, b * ROWS + j].astype(np.uint64) * ODD[4])
                bands[:, b] = key
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array(weight.astype(np.int32)),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.FixedSizeListArray.from_arrays(pa.array(darts.view(np.int32).ravel()), K).cast(pa.list_(pa.int32())),
                pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64())),
            ],
            ["id", "weight", "c1", "c2", "darts", "bands"],
        )


def strip_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text"):
        owner, strip = strips(part.column("text"))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(strip.view(np.int64)))
        yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "strips"])


def members_of(batch: pa.RecordBatch, row: int) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's members with their ids and labels, and the places of its probes and of its own members."""
    members = batch.column("members")[row].values
    ids, labels, probe = (members.field(f).to_numpy(zero_copy_only=False) for f in ("id", "label", "probe"))
    return members, ids, labels, np.flatnonzero(probe), np.flatnonzero(~probe)


def close_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each block whose signature agrees with that of a probe, or an own member, of another label."""
    for batch in batches:
        for row in range(batch.num_rows):
            members, _, labels, x, y = members_of(batch, row)
            darts = members.field("darts").flatten().to_numpy().reshape(len(labels), K)
            same = np.zeros((len(x), len(y)), np.int16)
            for k in range(K):
                same += darts[x, k][:, None] == darts[y, k][None]
            close = (same >= AGREE) & (labels[x][:, None] != labels[y][None])
            kept = pa.array(np.concatenate([x[close.any(1)], y[close.any(0)]]))
            key = [pa.array(np.repeat(batch.column(c)[row].as_py(), len(kept)), kind) for c, kind in (("band", pa.int64()), ("block", pa.int32()), ("of", pa.int32()))]
            yield pa.RecordBatch.from_arrays([*key, *(members.field(f).take(kept) for f in ("id", "label", "probe"))], ["band", "block", "of", "id", "label", "probe"])


def links_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of each block by exact comparison, enough of them to connect every two labels that have one."""
    for batch in batches:
        for row in range(batch.num_rows):
            members, ids, labels, x, y = members_of(batch, row)
            lists = members.field("strips")
            sizes = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(ids)), sizes)
            _, code, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
            shared = times[code] > 1
            owner, code = owner[shared], np.unique(code[shared], return_inverse=True)[1]
            common = np.zeros((len(x), len(y)), np.float32)
            for low in range(0, int(code.max(initial=-1)) + 1, 4096):
                part = (code >= low) & (code < low + 4096)
                held = np.zeros((len(ids), 4096), np.float32)
                held[owner[part], code[part] - low] = 1
                common += held[x] @ held[y].T
            similarity = common / np.maximum(sizes[x][:, None] + sizes[y][None] - common, 1)
            i, j = np.nonzero((similarity >= SIMILARITY) & (labels[x][:, None] != labels[y][None]))
            pairs = np.stack([labels[x[i]], labels[y[j]]], 1)
            _, first = np.unique(pairs, axis=0, return_index=True) if len(pairs) else (None, np.zeros(0, np.int64))
            root: dict[int, int] = {}

            def find(label: int, root: dict[int, int] = root) -> int:
                while root.get(label, label) != label:
                    label = root[label]
                return label

            found = []
            for n in first:
                one, two = sorted((find(int(pairs[n, 0])), find(int(pairs[n, 1]))))
                if one != two:
                    root[two] = one
                    found.append((int(ids[x[i[n]]]), int(ids[y[j[n]]])))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])


def crossing(shared: DataFrame, labels: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Verified links (a, b) between the classes of buckets that hold several.

    Members outside a bucket's least class are probes and meet all its members, in blocks of a bounded size. First the
    blocks name the members whose signatures agree, then they compare the strips of these. What leaves a block are
    members and links that connect classes, never its pairs.
    """
    named = settle(shared.join(labels, "id", "left").select("band", "id", F.coalesce("label", "id").alias("label")), "named")
    mixed = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    mixed = mixed.where("low < high").select("band", "low", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_ = settle(named.join(mixed, "band"), "open").join(signed.select("id", "darts"), "id")
    open_ = open_.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    probes = open_.where("label <> low").select("band", others.alias("block"), F.col("mine").alias("of"), "id", "label", "darts", F.lit(True).alias("probe"))
    own = open_.select("band", F.col("mine").alias("block"), others.alias("of"), "id", "label", "darts", F.lit(False).alias("probe"))
    blocks = probes.union(own).groupBy("band", "block", "of").agg(F.collect_list(F.struct("id", "label", "probe", "darts")).alias("members"))
    close = settle(blocks.mapInArrow(close_members, "band long, block int, of int, id long, label long, probe boolean"), "close-members")
    held = strips_of(close.select("id").distinct(), docs)
    again = close.join(held, "id").groupBy("band", "block", "of").agg(F.collect_list(F.struct("id", "label", "probe", "strips")).alias("members"))
    return settle(again.select("members").mapInArrow(links_in_blocks, "a long, b long"), "crossing-links")


def agreeing(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree on enough coordinates for an exact comparison."""
    darts = signed.select("id", "darts")
    left = darts.select(F.col("id").alias("a"), F.col("darts").alias("left"))
    right = darts.select(F.col("id").alias("b"), F.col("darts").alias("right"))
    same = F.size(F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda x: x))
    return pairs.join(right, "b").join(left, "a").where(same >= AGREE).select("a", "b")


def strips_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, strips) of the documents named."""
    ids = settle(ids, "close-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    return settle(docs.join(wanted, "id", "left_semi").select("id", "text").mapInArrow(strip_lists, "id long, strips array<long>"), "strips")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose strips have a Jaccard similarity of SIMILARITY or more."""
    close = settle(pairs, "close")
    held = strips_of(close.select(F.col("a").alias("id")).union(close.select(F.col("b").alias("id"))).distinct(), docs)
    one = held.select(F.col("id").alias("b"), F.col("strips").alias("right"))
    two = held.select(F.col("id").alias("a"), F.col("strips").alias("left"))
    common = F.size(F.array_intersect("left", "right"))
    similarity = common / (F.size("left") + F.size("right") - common)
    return settle(close.join(one, "b").join(two, "a").where(similarity >= SIMILARITY).select("a", "b"), "links")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, copy_of) of every row.

    `copy_of` is the least id with the same shingles, `class_id` the least id of the class.
    """
    with temporary(docs.sparkSession):
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        schema = "id long, weight int, c1 long, c2 long, darts array<int>, bands array<long>"
        signed = settle(texts.mapInArrow(sketch, schema), "signatures")
        some = signed.where("weight > 0 and id is not null")
        firsts = settle(some.groupBy("c1", "c2", "weight").agg(F.min("id").alias("first")), "firsts")
        distinct = signed.join(firsts.select(F.col("first").alias("id")), "id", "left_semi")
        members = settle(distinct.select("id", F.explode("bands").alias("band")), "bands")
        buckets = settle(members.groupBy("band").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "buckets")
        shared = settle(members.join(buckets, "band").select("band", "id", "pivot"), "shared")
        pairs = settle(shared.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        links = verified(agreeing(pairs, distinct), texts)
        links = links.union(crossing(shared, components(links), distinct, texts))
        labels = components(links).select(F.col("id").alias("first"), "label")
        by_first = firsts.join(labels, "first", "left")
        found = signed.select("id", "c1", "c2", "weight").join(by_first, ["c1", "c2", "weight"], "left")
        none = F.col("id").isNull()
        told = found.select(
            F.col("id").alias("doc_id"),
            F.when(~none, F.coalesce("label", "first", "id")).alias("class_id"),
            F.when(~none, F.coalesce("first", "id")).alias("copy_of"),
        )
        return settle(told, "classes", keep=True)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the least id of every class, with the columns it had. Rows without an id all stay.

    Rows are classed by numbers of their own, so that unlike texts of one id are told apart and copies of one id are not kept twice.
    """
    number = "__number"
    while number in docs.columns:
        number += "_"
    rows = settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered", keep=True)
    known = rows.where(F.col(id_col).isNotNull())
    told = classes(known, number, text_col).select(F.col("doc_id").alias(number), "class_id")
    best = known.select(number, F.col(id_col).alias("_id")).join(told, number).groupBy("class_id").agg(F.min(F.struct("_id", number)).alias("best"))
    kept = known.join(best.select(F.col("best")[number].alias(number)), number, "left_semi")
    return kept.unionByName(rows.where(F.col(id_col).isNull())).select(docs.columns)
