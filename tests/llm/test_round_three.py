"""Merkle manifest, url filters and source divergence beside plain versions."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import documents, texts
from pyspark.sql import functions as F

from tablesync.llm import divergence, merkle, urls

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(hashes):
    """The root, and for each leaf the siblings to its left and right, level by level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for j in range(len(hashes)):
            run = at[j] // 3 * 3
            paths[j].append(("".join(level[run : at[j]]), "".join(level[at[j] + 1 : run + 3])))
            at[j] //= 3
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_manifest(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        held = sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), i) for i, r in enumerate(rows) if r["source"] == s)
        trees[s] = (*tree([x[2] for x in held]), [x[3] for x in held])
    root, above = tree([trees[s][0] for s in sources])
    out = []
    for s, upper in zip(sources, above):
        subroot, paths, places = trees[s]
        for path, i in zip(paths, places):
            row, whole = rows[i], path + upper
            own = fold = leaf(row, row["text"])
            if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                fold = leaf(row, row["text"].replace("\n", ""))
            for left, right in whole:
                fold = sha(left + fold + right)
            out.append((row["doc_id"], own, subroot, root, sha("".join(a + b for a, b in whole)), fold, fold == root))
    return out


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = texts() + [(200 + i, f"line {i}\nnext\n", "en", "s0") for i in range(90)]
    table = documents(spark, rows)
    want = plain_manifest([r.asDict() for r in table.collect()])
    got = [tuple(r) for r in merkle.manifest(table).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 9, 10, 28])
def test_trees_of_every_shape(spark, count):
    table = documents(spark, [(i, f"t\n{i}", "en", None if i % 5 == 1 else "a") for i in range(count)])
    want = plain_manifest([r.asDict() for r in table.collect()]) if count else []
    assert sorted((tuple(r) for r in merkle.manifest(table).collect()), key=repr) == sorted(want, key=repr)


def test_one_id_and_equal_rows_may_be_many(spark):
    rows = [(7, "same", "en", "hot")] * 120 + [(7, f"other {i % 3}", "en", "hot") for i in range(30)] + [(None, None, None, None)] * 2
    table = documents(spark, rows).repartition(5)
    want = plain_manifest([r.asDict() for r in table.collect()])
    assert Counter(tuple(r) for r in merkle.manifest(table).collect()) == Counter(want)


def test_tampering_shows_in_the_proof(spark):
    got = merkle.manifest(documents(spark, [(i, "a\nb" if i % 3 else "ab", "en", f"s{i % 2}") for i in range(40)])).collect()
    for row in got:
        touched = zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["doc_id"] % 3 != 0
        assert row["verified"] == (not touched) and row["verified"] == (row["folded_root"] == row["root"])


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def plain_rule(host, path, rules):
    fits = [(-len(h) - len(p), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits, default=None)


def plain_buckets(host, path):
    found = set()
    for part, text in (("h", host), ("p", path)):
        marked = f"^{text}$"
        if text:
            found |= {zlib.crc32((part + marked[i : i + n]).encode()) % urls.BUCKETS for n in urls.GRAMS for i in range(len(marked) - n + 1)}
    return found


URLS = [
    "http://a.example.net/en/1", "http://example.net/en/", "http://xexample.net/en/2", "http://example.net/en", "http://NET/x?y", "http://net", "http://net?/x",
    "https://Sub.Example.COM/de/3#t", "http://example.com/de", "http://example.org/fr/9", "http://example.org:80/fr/9", "http://u@example.org/fr/",
    "http://a/b://c.org/fr/1", "no scheme example.net/en/", "", None, "://", "://org/fr/x", "http://ÄÖ.example.org/fré", "http://x.net.org/en/a\nb",
    "http://best-casino-pills.example.com/en/4", "http://library-of-music.example.com/en/4", "http://a..org/fr/", "http://" + "x" * 5000 + ".example.org/" + "y" * 5000,
    "http://a.example.net/en/1", "HTTP://İ.example.com/DE/", "http://example.com\\de/x", "http://🙂.org/fr/🙂",
]


@pytest.fixture(scope="module")
def model(spark):
    return urls.train(urls.labelled_urls(spark))


def test_urls_are_judged_as_plain_code_does(spark, model):
    table = spark.createDataFrame([(i, u, "h", "v", "r", 0.5) for i, u in enumerate(URLS)] + [(None, URLS[0], "h", "v", "r", 0.5)], "page_id long, url string, host string, verdict string, rule string, score double")
    got = urls.judge(table, model=model).collect()
    assert len(got) == len(URLS) + 1
    for row in got:
        host, path = plain_parts(URLS[row["page_id"] or 0])
        rule = plain_rule(host, path, urls.RULES)
        score = 1 / (1 + np.exp(-np.clip(model.intercept + sum(model.weights[b] for b in plain_buckets(host, path)), -40, 40)))
        verdict = rule[3] if rule else "block" if score > urls.BLOCK_FROM else "allow"
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule[1] + rule[2] if rule else None, verdict)
        assert abs(row["score"] - score) < 1e-5


def test_longest_rule_wins_and_rules_may_be_many(spark, model):
    rules = [("org", "/", "block"), ("b.org", "/", "allow"), ("b.org", "/x/", "block"), ("a.b.org", "/x", "allow"), ("b.org", "", "block"), (None, "/", "allow")]
    rules += [(f"h{i}.org", "/", "allow") for i in range(50)]
    table = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate([(h, p) for h in ("org", "b.org", "c.b.org", "a.b.org", "h7.org", "xb.org") for p in ("", "/", "/x", "/x/y")])], "page_id long, url string")
    got = urls.judge(table, spark.createDataFrame(rules, "host string, path string, verdict string"), model=model).collect()
    for row in got:
        rule = plain_rule(row["host"], row["path"], [r for r in rules if r[0] is not None])
        assert row["rule"] == (rule[1] + rule[2] if rule else None)


def test_learning_separates_held_out_names(spark):
    rows = urls.labelled_urls(spark)
    host, path = urls.host_and_path(rows["url"])
    name = F.crc32(F.regexp_extract(host, r"^(?:www\.|blog\.|m\.)?([^.]+)", 1)) % 4
    kept = urls.train(rows.where(name != 0))
    held = rows.where(name == 0).select("verdict", kept.score(urls.grams(host, path)).alias("score")).collect()
    right = sum((r["score"] > urls.BLOCK_FROM) == (r["verdict"] == "block") for r in held)
    assert len(held) > 80 and right / len(held) >= 0.75


def test_a_bounded_share_is_learned_from(spark):
    rows = urls.labelled_urls(spark)
    assert urls.train(rows, most=1, epochs=1).weights != urls.train(rows, epochs=1).weights


def test_no_labels_and_no_rows(spark):
    none = urls.labelled_urls(spark).limit(0)
    rows = urls.judge(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"), labelled=none).collect()
    assert [(r["verdict"], r["score"], r["rule"]) for r in rows] == [("allow", 0.5, None)]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), labelled=none).count() == 0


def plain_divergence(rows):
    pattern = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    occurs, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for row in rows:
        lang, source = row["lang"] or "", row["source"] or ""
        groups.add((lang, source))
        found = Counter(w.translate(LOWER) for w in pattern.findall(row["text"] or ""))
        occurs[lang, source].update(found)
        held[lang].update(found.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= 3]

        def p_of(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        sources = sorted((s for a, s in groups if a == lang), key=str.encode)
        whole = p_of(sum((occurs[lang, s] for s in sources), Counter()))
        p = {s: p_of(occurs[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h) for h in sources if h != s]
            terms = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if occurs[lang, s][t] > 0 and p[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (v, i) in enumerate(found[: 200 if part == "term" else None])]
    return out


@pytest.mark.parametrize(("postings", "groups", "cells"), [(100_000, 256, 1 << 21), (60, 2, 64)])
def test_divergence_equals_plain_sums(spark, monkeypatch, postings, groups, cells):
    for name, value in (("POSTINGS", postings), ("GROUPS", groups), ("CELLS", cells)):
        monkeypatch.setattr(divergence, name, value)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = texts() + [(300 + i, " ".join(words[(i * j) % 300] for j in range(1, 200)), "xx", "hot" if i % 3 else f"t{i % 7}") for i in range(40)]
    rows += [(400, "lone words", "yy", "a"), (401, None, "yy", "b"), (402, "", "zz", "c"), (403, "A-b_C É日本 x1y", "en", "s0")]
    table = documents(spark, rows)
    assert Counter(tuple(r) for r in divergence.audit(table).collect()) == Counter(plain_divergence([r.asDict() for r in table.collect()]))


def test_divergence_of_nothing(spark):
    assert divergence.audit(documents(spark, [])).count() == 0
    assert divergence.audit(documents(spark, [(1, None, None, None)])).count() == 0


def test_portions_of_large_counts_are_exact():
    n = np.array([0, 10**9, 9 * 10**9, 4 * 10**12])
    assert divergence.portion(n, 10**13, 12345).tolist() == [1 + 10**9 * (int(x) + 1) // (10**13 + 12345) for x in n]
