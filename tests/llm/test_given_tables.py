"""Operators without SQL on the given tables, beside brute force or held-out rows."""

import collections
import itertools

import pyarrow.parquet as pq
import pytest
import regex
from tablesync.llm import decontaminate, minhash
from tablesync.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


def words_of(text):
    return regex.findall(r"\p{L}[\p{L}\p{M}]*|\p{N}+(?:[.,]\p{N}+)*", (text or "").lower())


def longest_common(one, two):
    """Length of the longest common subsequence."""
    row = [0] * (len(two) + 1)
    for word in one:
        before = row.copy()
        for j, other in enumerate(two):
            row[j + 1] = before[j] + 1 if word == other else max(before[j + 1], row[j])
    return row[-1]


def test_every_copied_item_is_found(spark, texts):
    """All windows of all items against all windows of all documents, by value and along single diagonals."""
    bench = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    size = decontaminate.WINDOW
    items = {r["item_id"]: words_of(r["text"]) for r in bench}
    assert all(len(w) >= size for w in items.values())
    places = collections.defaultdict(list)
    for item, words in items.items():
        for at in range(len(words) - size + 1):
            places[tuple(words[at : at + size])].append((item, at))
    expected = set()
    docs = {i: words_of(t) for i, t in texts.items()}
    for doc, words in docs.items():
        hit = collections.defaultdict(set)
        for at in range(len(words) - size + 1):
            for item, place in places.get(tuple(words[at : at + size]), ()):
                hit[item, at - place].add(place)
        for (item, _), found in hit.items():
            covered = {p + k for p in found for k in range(size)}
            if len(found) >= decontaminate.COVERAGE * (len(items[item]) - size + 1) or len(covered) >= decontaminate.LONG_MATCH:
                expected.add((doc, item))
    got = {(r["doc_id"], r["item_id"]): r for r in QUERIES["op2_benchmark_decontamination"](spark, SF_DIR).collect()}
    assert expected and expected <= set(got)
    assert all(got[pair]["kind"] == "verbatim" for pair in expected)
    for doc, item in set(got) - expected:  # what only chains or slots find still shares half of its words, in order
        assert longest_common(items[item], docs[doc]) >= len(items[item]) / 2


def test_near_duplicates_of_all_pairs(spark, texts):
    """Nine in ten at least of all pairs with a similarity of 0.8 or more are in one class, and no class lacks such pairs."""
    sets = {}
    for doc, text in texts.items():
        words = regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())
        if words:
            sets[doc] = collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
    holders = collections.defaultdict(list)
    for doc, found in sets.items():
        for shingle in found:
            holders[shingle].append(doc)
    near, parent = set(), {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for a, b in {pair for docs in holders.values() for pair in itertools.combinations(sorted(docs), 2)}:
        common = (sets[a] & sets[b]).total()
        if common >= minhash.SIMILARITY * (sets[a].total() + sets[b].total() - common):
            near.add((a, b))
            one, two = sorted((root(a), root(b)))
            parent[two] = one
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op7_minhash_near_dedup"](spark, SF_DIR).collect()}
    assert near and sum(got[a] == got[b] for a, b in near) >= 0.9 * len(near)
    # exact comparison links documents, so a class never reaches beyond the classes of all pairs
    assert all(root(doc) == root(got[doc]) for doc in sets)


def test_languages_of_documents_held_out(spark):
    told = {r["doc_id"]: r for r in QUERIES["op10_language_id"](spark, SF_DIR).collect()}
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "lang", "text"]).to_pylist()
    held = [(told[r["doc_id"]]["lang_pred"], r["lang"]) for r in table if told[r["doc_id"]]["held_out"] and r["lang"] is not None and words_of(r["text"])]
    assert len(held) > 200 and sum(a == b for a, b in held) >= 0.97 * len(held)
