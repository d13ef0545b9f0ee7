"""Near duplicates, decontamination, repeated strings, shards and top-k against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from fixtures import documents, texts
from pyspark.sql import functions as F

from tablesync.llm import decontaminate, minhash, sharding, suffix, topk
from tablesync.llm.components import components


def shingles(text):
    words = re.findall(r"[^\W_]+(?:́)?", (text or "").lower())
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def plain_classes(rows):
    """Least id of every class by comparing all pairs."""
    sets = {i: shingles(t) for i, t, _, _ in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = sum((sets[a] & sets[b]).values())
            if common / (sum(sets[a].values()) + sum(sets[b].values()) - common) >= minhash.SIMILARITY:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def test_near_duplicate_classes(spark):
    rows = [r for r in texts() if r[0] not in (112,)]
    base = rows[40][1].split() * 1 + rows[41][1].split() + rows[43][1].split()
    for k in range(40):  # a bucket with many members
        words = base.copy()
        words[k % len(words)] = f"edit{k}"
        rows.append((500 + k, " ".join(words), "en", "s0"))
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert got.pop(None) is None
    assert got == plain_classes(rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").where("doc_id is not null").collect()) == sorted(set(plain_classes(rows).values()))
    assert kept.where("doc_id is null").count() == 1
    assert minhash.classes(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    common, one, two = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    owner = np.repeat([0, 1], 900)
    darts = minhash.signatures(owner, np.concatenate([common, one, common, two]), 2)
    assert abs((darts[0] == darts[1]).mean() - 0.8) < 0.12


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (2, 1)], "a long, b long")
    assert {(r[0], r[1]) for r in components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (8, 8), (9, 8)}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("size", range(1, 9))
def test_runs_of_hashes_tell_windows_apart(spark, size):
    rows = [[1, 2, 3, 4, 5, 6, 7, 8, 9, 1, 2, 3, 4, 5, 6, 7, 8], [9, 8, 7, 6, 5, 4, 3, 2, 1], [5] * 12, [1] * size, list(range(size - 1)), []]
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h array<bigint>")
    windows, found = {}, {r["i"]: r["k"] for r in table.select("i", decontaminate.runs(F.col("h"), size).alias("k")).collect()}
    for i, row in enumerate(rows):
        own = [tuple(row[j : j + size]) for j in range(len(row) - size + 1)]
        assert len(found[i]) == len(own)
        for window, key in zip(own, found[i]):
            assert windows.setdefault(window, key) == key
    assert len(set(windows.values())) == len(windows)


def test_unlike_texts_of_one_id_both_stay(spark):
    rows = texts()
    rows = [(300, rows[3][1], "en", "a"), (300, rows[7][1], "en", "a"), (300, rows[7][1], "en", "b"), (301, rows[3][1], "en", "c"), (None, rows[3][1], "en", "c"), (302, None, "en", "c"), (302, None, "en", "c")]
    kept = minhash.keep_one(documents(spark, rows))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(300, rows[0][1]), (300, rows[1][1]), (0, rows[0][1]), (302, ""), (302, "")])
    assert kept.columns == documents(spark, []).columns


def test_decontamination(spark):
    question = "a train with Anna left the old town and went 120 km in 3 hours before Anna met her friend who had walked 7 miles along the river"
    items = spark.createDataFrame(
        [(1, question), (2, "plain words that nobody else would ever put together in such a long row today"), (3, None), (4, ""), (5, "too short"), (6, "exactly six words are here now"), (2, "another text of the second item word for word")],
        "item_id long, text string",
    ).withColumn("doc_id", F.lit("clash"))
    changed = question.replace("Anna", "Bertha").replace("120", "95").replace("3 hours", "2 hours")
    broken = question.replace("Anna left", "Carla left").replace("120", "95")
    rows = texts() + [
        (600, "start. " + question + ". end", "en", "s"),
        (601, "start and " + changed, "en", "s"),
        (602, "start and " + broken + " more", "en", "s"),
        (603, "PLAIN words, that nobody else would ever put together in such a long row today!", "en", "s"),
        (604, "so exactly six words are here now then", "en", "s"),
        (605, "Too short!", "en", "s"),
        (606, "too short indeed", "en", "s"),
        (607, "it held another text of the second item word for word and nothing else", "en", "s"),
    ]
    docs = documents(spark, rows)
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(600, 1): "verbatim", (601, 1): "reparameterised", (603, 2): "verbatim", (604, 6): "verbatim", (605, 5): "verbatim", (607, 2): "verbatim"}
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(rows) - 6
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_repeated_strings(spark):
    rows = texts()
    data = [(i, (t or "").encode()) for i, t, _, _ in rows]
    counts = collections.Counter(t[k : k + 200] for _, t in data for k in range(len(t) - 199))
    want = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if counts[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    got = suffix.remove_repeats(documents(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 3000
    assert suffix.remove_repeats(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_induced_order_is_the_suffix_order(seed, monkeypatch):
    monkeypatch.setattr(suffix, "LENGTH", 6)
    monkeypatch.setattr(suffix, "IN_MEMORY", 64 if seed % 2 else 1 << 20)  # mapped files too
    rng = np.random.default_rng(seed)
    t = rng.integers(97, 99 + seed % 5, 300).astype(np.uint8)
    starts = np.concatenate([[0], np.sort(rng.choice(np.arange(1, 299), 6, replace=False)) + 1])
    t[starts[1:] - 1] = suffix.SEPARATOR
    t[-1] = suffix.SEPARATOR
    whole = t.tobytes()
    kind = suffix.types(t)
    order = np.concatenate(suffix.induced(t, kind, suffix.seed_order(t, kind)))
    assert sorted(order) == list(range(300))
    assert [whole[i : i + 6] for i in order] == sorted(whole[i : i + 6] for i in range(300))
    counts = collections.Counter(whole[i : i + 6] for i in range(295))
    marked = suffix.repeated(t, starts)
    for i in range(295):
        if suffix.SEPARATOR not in whole[i : i + 6]:
            assert marked[i] == (counts[whole[i : i + 6]] > 1)


def test_shards(spark):
    rows = texts()
    got = sharding.place(documents(spark), shards=5, virtual=512).toPandas()
    assert len(got) == len(rows)
    sizes = sorted((-1 if i is None else i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert sorted(zip(got["doc_id"].fillna(-1).astype(int), got["size"], got["text_crc32"], strict=True)) == sizes
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    loads = got.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= got.groupby("virtual_slot")["size"].sum().max()
    assert sharding.place(documents(spark).limit(0)).count() == 0


def test_rebalancing_moves_few_slots(spark):
    sums = spark.range(512).select(F.col("id").cast("int").alias("virtual"), (F.col("id") % 7 + 1).alias("bytes"), F.lit(1).alias("rows"))
    first = sharding.slot_map(spark, sums, 8, 512)
    again = sharding.slot_map(spark, sums, 8, 512, first)
    assert again.join(first, ["virtual", "shard"]).count() == 512 and again.agg(F.max("version")).collect()[0][0] == 2
    grown = sharding.slot_map(spark, sums, 9, 512, first)
    moved = grown.join(first.withColumnRenamed("shard", "old"), "virtual").where("shard <> old")
    loads = [r[1] for r in grown.join(sums, "virtual").groupBy("shard").agg(F.sum("bytes")).collect()]
    assert len(loads) == 9 and max(loads) <= 1.03 * sum(loads) / 9
    moved_bytes = moved.join(sums, "virtual").agg(F.sum("bytes")).collect()[0][0]
    assert moved_bytes <= 1.1 * sum(loads) / 9


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(700, 8))
    vectors[300] = vectors[200]
    rows = [(i, [float(np.float32(x)) for x in v], "clash") for i, v in enumerate(vectors)]
    rows += [(900, None, "c"), (1000, [1.0, None] * 4, "c"), (1100, [float("nan")] * 8, "c"), (1200, [float("inf")] * 8, "c"), (1300, [], "c"), (None, [0.5] * 8, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    whole = {i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in rows[:700]}
    want = []
    for q in range(0, 700, 100):
        scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    for block in (4096, 150):
        topk.BLOCK, before = block, topk.BLOCK
        try:
            got = topk.top_k(table).select("query_id", "rank", "vec_id", "score")
            assert sorted(map(tuple, got.collect())) == sorted(want)
        finally:
            topk.BLOCK = before
    assert topk.top_k(table.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:4], table.schema)
    assert topk.top_k(few).count() == 3
