"""Cases in which operators once did less than the whole job."""

import numpy as np

from tablesync.llm import decontaminate, topk


def test_top_k_is_exact_for_unequal_norms(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 3
    vectors = (centres[rng.integers(0, 40, 12000)] + rng.normal(size=(12000, 16)) * 0.3) * rng.uniform(0.2, 3, (12000, 1))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    whole = np.floor(1024 * vectors).astype(np.int64)
    want = []
    for q in range(0, 12000, 60):
        scores = whole @ whole[q]
        order = np.lexsort((np.arange(12000), -scores))
        want += [(q, n + 1, int(i), int(scores[i])) for n, i in enumerate(order[order != q][:10])]
    got = topk.top_k(table, every=60).select("query_id", "rank", "vec_id", "score", "evaluated").collect()
    assert sorted(tuple(r)[:4] for r in got) == want
    assert np.mean([r["evaluated"] for r in got]) < 4000  # the bound still spares work


def test_query_rows_that_repeat_and_components_of_any_size(spark):
    rng = np.random.default_rng(9)
    vectors = [[float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 7)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(100, vectors[100]), (100, vectors[7]), (301, vectors[5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(table, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [[int(np.floor(1024 * x)) for x in v] for _, v in rows]
    want = {}
    for q, (i, _) in enumerate(rows):
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), j) for w, (j, _) in zip(whole, rows) if j != i)
            want.setdefault(i, []).extend((n + 1, j, -s) for n, (s, j) in enumerate(scores[:5]))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    large = [(i, [x * 1e6 for x in v]) for i, v in enumerate(vectors)] + [(400, [1e300, -1e300, 0.5, 1.0])]
    found = topk.top_k(spark.createDataFrame(large, "vec_id long, embedding array<double>"), k=5).collect()
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    whole = [[int(1024 * x) if abs(x) > 1e15 else int(np.floor(1024 * x)) for x in v] for _, v in large]
    for q in (0, 100, 200):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), j) for w, (j, _) in zip(whole, large) if j != q)
        assert sorted(r["score"] for r in found if r["query_id"] == q) == sorted(clip(-s) for s, _ in scores[:5])


def test_bounds_hold_at_any_scale():
    rng = np.random.default_rng(5)
    for scale in (1, 1e3, 1e6):
        v = np.floor(rng.normal(size=(5000, 4)) * rng.uniform(0.1, 1, (5000, 1)) * 1024 * scale).astype(np.int64)
        greatest = float((v.astype(float) ** 2).sum(1).max())
        v = v.astype(float)
        pivots = topk.choose_pivots(topk.lifted(v[:500], greatest), 32)
        d, qd = topk.distances(topk.lifted(v, greatest), pivots), topk.distances(topk.flat(v), pivots)
        for q in range(0, 5000, 100):
            ids, best, _ = topk.nearest(v[q], qd[q], np.int64(q), np.arange(5000), v, d, 10, greatest)
            scores = v.astype(np.int64).astype(object) @ v[q].astype(np.int64).astype(object)  # beyond 64 bits at the largest scale
            order = [i for i in sorted(range(5000), key=lambda i: (-scores[i], i)) if i != q]
            assert list(ids) == order[:10]


def held(spark, items, docs):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(docs, items).collect()}


def test_words_put_in_or_left_out_do_not_hide_an_item(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)]
    item, short, city = words[:38], words[40:56], [*words[60:70], "in Paris", *words[70:80], "near Paris", *words[80:90]]
    docs = [
        ["before", *item[:19], "inserted", *item[19:], "after"],
        [*item[:19], *item[20:]],
        [*short[:8], "inserted", *short[8:]],
        [w.replace("Paris", "New York") for w in city],
        [*item[:10], *words[60:69], *item[28:]],  # too little of any item
        [*item[24:], *item[:24][::-1]],  # out of order
    ]
    got = held(spark, [" ".join(x) for x in (item, short, city)], [" ".join(d) for d in docs])
    assert got == {(0, 0): "verbatim", (1, 0): "verbatim", (2, 1): "verbatim", (3, 2): "reparameterised"}


def test_names_are_read_alike_wherever_they_stand(spark):
    item = "Ann ran from the old mill to the green bridge over there. Bertha then walked 5 km along a quiet river. \"Carl slept\" said nobody at all."
    docs = [
        item.lower(),
        item.replace(" Bertha", "\n  Bertha").replace("to the", "to\n the"),
        "yesterday " + item.replace("Ann", "Bob").replace("5 km", "12\n Km"),
        item.replace("Bertha", "Dora").replace("Carl", "Emil").replace("Ann", "Bob").lower().replace("bob", "Bob").replace("dora", "Dora").replace("emil", "Emil"),
        item.lower().replace("5 km", "12 km"),
        "so Karl walked to some town",
    ]
    items = [item, "Karl walked to some town"]
    assert held(spark, items, docs) == {(0, 0): "verbatim", (1, 0): "verbatim", (2, 0): "reparameterised", (3, 0): "reparameterised", (4, 0): "reparameterised", (5, 1): "verbatim"}


def test_short_and_slot_heavy_items_are_found_by_value(spark):
    items = ["Compute 12 x 34 + 56", "1 2 3 4 5 6 7 8 9 10 11 12", "Ann, Bob, Carl, Dora, Emil and Fritz", "who invented zero", "17 times 23 equals"]
    docs = [*items, "Compute 13 x 34 + 56", "1 2 3 4 5 6 7 8", "Uwe, Tim, Carl, Dora, Emil and Fritz", "who invented one", "17 times 24 equals", "1, 2 and 3 or 4 5 7 9"]
    got = held(spark, items, docs)
    assert got == {(n, n): "verbatim" for n in range(5)}
