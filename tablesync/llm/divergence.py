"""How far the sources of a language diverge in their words, and by which terms.

Terms are runs of letters and of all characters beyond ASCII, A-Z lower-cased. Tasks cut whole texts into terms as bytes and hand
out counts by (language, source, term), so what is shuffled are counts. Of these a *term-major index* is built: for every kept term its
postings (source, count), of which there are at most as many as the language has sources.

Divergence of source g from h is the sum of floor((p-q)^2 / q) over all V kept terms, where most p and q are *zero
baselines*, the probability of a term that does not occur. Rows of the matrix of sources are accumulated the way Gustavson multiplies
sparse matrices: in a block of terms every group g scatters each of its terms through the term's postings into a dense
accumulator with a cell for each peer. No pair of postings is ever emitted. The accumulators begin as if all terms of g
were absent from its peer and all terms of the peer from g; what a term in common adds is the correction to that. A task
gives one row of sums for each group, and Spark adds up the blocks. Blocks hold a bounded number of postings (`POSTINGS`), and a task accumulates for a
bounded number of groups (`GROUPS`) at a time.

All arithmetic is on whole numbers: p by decimals in SQL and by 64-bit integers, or Python's where a count is too large for
them, in the tasks. The sums fit 64 bits because the p of a group sum up to 10^9 + V at most.

Nulls and edges: null texts, languages and sources count as empty ones. A group without terms has pairs and no terms; a language with no
kept term has pairs of value 0. A lone source has no pairs. Repeated rows are documents of their own. An empty table gives no rows. Only
the three named columns are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import chunks
from tablesync.operators.versions import broadcast_if_small
from tablesync.session import settle, temporary

UNIT = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
#: Postings of a block of terms, and groups for which a task accumulates.
POSTINGS = 100_000
GROUPS = 256
#: Cells worked on at a time.
CELLS = 1 << 21

LETTERS = np.zeros(256, bool)
LETTERS[128:] = LETTERS[ord("A") : ord("Z") + 1] = LETTERS[ord("a") : ord("z") + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms in order, and the row that each stands in."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = LETTERS[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(data)]
    begins[first] = inside[first]  # a text ends the term of the one before
    at = np.flatnonzero(begins)
    letters = LOWER[data[inside]]
    starts = np.cumsum(inside)[at] - 1
    offsets = np.append(starts, len(letters)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])
    return terms, np.searchsorted(ends, at, side="right") - 1


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of each stretch of rows; a null term for every group met."""
    for part in chunks(batches, "text", 8 << 20):
        lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
        wide = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
        terms, row = terms_of(part.column("text"))
        coded = terms.dictionary_encode()
        many = max(len(coded.dictionary), 1)
        held, times = np.unique(row * many + coded.indices.to_numpy(), return_counts=True)  # one a document and term
        place, of = np.unique(group[held // many] * many + held % many, return_inverse=True)
        occurrences = np.zeros(len(place), np.int64)
        np.add.at(occurrences, of, times)
        met = np.unique(group)
        groups = pa.array(np.concatenate([met, place // many]))
        names = [pc.take(x.dictionary, pc.cast(y, pa.int64())) for x, y in ((lang, pc.divide(groups, wide)), (source, pa.array(groups.to_numpy() % wide)))]
        told = pa.concat_arrays([pa.nulls(len(met), pa.large_string()), coded.dictionary.take(pa.array(place % many))])
        zeros = np.zeros(len(met), np.int64)
        counts = [np.concatenate([zeros, x]) for x in (occurrences, np.bincount(of, minlength=len(place)).astype(np.int64))]
        yield pa.RecordBatch.from_arrays([*names, told.cast(pa.string()), *map(pa.array, counts)], ["lang", "source", "term", "n", "docs"])


def portion(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of terms that occur n times in a group of `total` occurrences."""
    if len(n) and int(n.max()) >= (1 << 62) // UNIT:
        return np.array([1 + UNIT * (int(x) + 1) // (total + terms) for x in n], np.int64)
    return 1 + UNIT * (n + 1) // (total + terms)


def diverge(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def scatter(terms: np.ndarray, peers: np.ndarray, p: np.ndarray, zero: np.ndarray, groups: range) -> np.ndarray:
    """For each of `groups`, the sums over one block of terms against every peer.

    The postings are (term, peer, p), sorted by term, terms numbered from 0; `zero` holds the baseline of every group.
    """
    size = len(zero)
    sums = np.zeros((len(groups), size), np.int64)
    count = int(terms[-1]) + 1 if len(terms) else 0
    begin = np.searchsorted(terms, np.arange(count + 1))
    own = np.argsort(peers, kind="stable")
    bounds = np.searchsorted(peers[own], np.arange(size + 1))
    held = np.diff(bounds)
    # peers whose term is absent from the group: equal p count together
    kinds, times = np.unique(np.stack([peers, p]), axis=1, return_counts=True) if len(p) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
    for i, g in enumerate(groups):
        mine = own[bounds[g] : bounds[g + 1]]
        sums[i] = (count - held[g] - held) * diverge(zero[g], zero)
        value, often = np.unique(p[mine], return_counts=True)
        for low in range(0, len(value), max(1, CELLS // size)):
            some = slice(low, low + max(1, CELLS // size))
            sums[i] += (diverge(value[some, None], zero[None]) * often[some, None]).sum(0)
        np.add.at(sums[i], kinds[0], diverge(zero[g], kinds[1]) * times)
        # each term of the group meets its postings
        sizes = begin[terms[mine] + 1] - begin[terms[mine]]
        done = 0
        while done < len(mine):
            upto = max(done + 1, int(np.searchsorted(np.cumsum(sizes[done:]), CELLS, side="right")) + done)
            n = sizes[done:upto]
            met = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[terms[mine[done:upto]]], n)
            here, there = np.repeat(p[mine[done:upto]], n), peers[met]
            shared = diverge(here, p[met]) - diverge(here, zero[there]) - diverge(zero[g], p[met]) + diverge(zero[g], zero[there])
            np.add.at(sums[i], there, shared)
            done = upto
    return sums


def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, g, sums) of every block of terms and its groups."""
    for batch in batches:
        for r in range(batch.num_rows):
            totals = batch.column("totals")[r].values.to_numpy()
            v, first = batch.column("v")[r].as_py(), batch.column("first")[r].as_py()
            groups = range(first, min(first + GROUPS, len(totals)))
            zero = np.concatenate([portion(np.zeros(1, np.int64), int(t), v) for t in totals]) if v else np.ones(len(totals), np.int64)
            lists = batch.column("terms")[r].values
            sizes = np.zeros(0, np.int64) if lists is None else np.diff(lists.offsets.to_numpy())
            posted = pa.array([], pa.struct([("g", pa.int32()), ("n", pa.int64())])) if lists is None else lists.flatten()
            peers, n = posted.field("g").to_numpy().astype(np.int64), posted.field("n").to_numpy()
            p = np.zeros(len(n), np.int64)
            order = np.argsort(peers, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(peers[order])) + 1) if len(order) else []:
                p[some] = portion(n[some], int(totals[peers[some[0]]]), v)
            sums = scatter(np.repeat(np.arange(len(sizes)), sizes), peers, p, zero, groups)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), len(totals)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("lang")[r].as_py()] * len(groups), pa.string()), pa.array(np.array(groups, np.int32)), rows], ["lang", "g", "sums"])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): every other source (`pair`), and the terms that set a source off from its language (`term`)."""
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    with temporary(docs.sparkSession):
        told = rows.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
        counts = settle(told.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
        by_source = Window.partitionBy("lang").orderBy("source")
        groups = counts.where("term is null").select("lang", "source", (F.row_number().over(by_source) - 1).alias("g"))
        groups = settle(groups, "term-groups")
        placed = counts.where("term is not null").join(broadcast_if_small(groups), ["lang", "source"])
        index = placed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("g", "n")).alias("postings"))
        index = settle(index.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"), "term-index")

        opened = index.select("lang", "term", F.col("n").alias("all"), F.inline("postings"))
        totals = opened.groupBy("lang", "g").agg(F.sum("n").alias("total"))
        whole = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all_total"), F.sum(F.size("postings")).alias("held"))
        known = groups.join(totals, ["lang", "g"], "left").join(whole, "lang", "left")
        zeros = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("total", "v", "all_total", "held")}
        known = settle(known.withColumns(zeros), "term-totals")

        # pairs
        lists = F.array_sort(F.collect_list(F.struct("g", "source", "total")))
        langs = known.groupBy("lang").agg(F.first("v").alias("v"), F.first("held").alias("held"), lists.alias("all"))
        langs = langs.select("lang", "v", F.col("all.source").alias("sources"), F.col("all.total").alias("totals"), F.ceil(F.col("held") / POSTINGS).alias("blocks"))
        langs = settle(langs, "term-languages")
        dealt = index.join(broadcast_if_small(langs.select("lang", "blocks")), "lang")
        block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
        blocks = dealt.select("lang", block, "postings").groupBy("lang", "block").agg(F.collect_list("postings").alias("terms"))
        starts = F.expr(f"sequence(0, (size(totals) - 1) div {GROUPS} * {GROUPS}, {GROUPS})")
        work = langs.select("lang", "v", "totals", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("blocks") - 1, F.lit(0)))).alias("block"))
        work = work.join(blocks, ["lang", "block"], "left").select("lang", "v", "totals", "terms", F.explode(starts.cast("array<int>")).alias("first"))
        partial = work.mapInArrow(accumulate, "lang string, g int, sums array<long>")
        summed = partial.select("lang", "g", F.posexplode("sums").alias("h", "value")).where("g <> h").groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
        named = broadcast_if_small(groups)
        pairs = summed.join(named, ["lang", "g"]).join(named.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
        pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

        # terms
        p = lambda n, total: F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * (cast({n} as decimal(20,0)) + 1)) div ({total} + v)")
        apart = opened.join(broadcast_if_small(known.select("lang", "g", "source", "total", "all_total", "v")), ["lang", "g"])
        apart = apart.select("lang", "source", "term", p("n", "total").alias("p"), p("`all`", "all_total").alias("q")).where("n > 0 and p > q")
        terms = apart.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

        order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
        rank = F.row_number().over(order)
        best = terms.withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)
        return settle(pairs.withColumn("rank", rank).unionByName(best), "divergence", keep=True)
