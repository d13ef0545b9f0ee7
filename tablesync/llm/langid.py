"""Language identification by unigram pieces, summed over all segmentations of every word.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum
over all ways to cut it into pieces (a forward algorithm), not that of the best cut. A text is scored by the product
over its words; the posterior under equal priors is the score.

Words are maximal runs of letters and marks of the lower-cased text; runs over 32 characters are scored 32 at a time.
Learning looks at a bounded sample (`sample_docs` documents a language, `sample_words` words a language); prediction
reads whole texts.

Nulls and edges: a null text, a text without letters, and every text when nothing could be learned give `und` with
score 0. Equal posteriors go to the language that sorts first. Repeated rows are predicted row by row. Only the id,
text and language columns are read, so other columns of the input never clash with those of the result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import array_chunks

START = "▁"
LONGEST_WORD = 32
UNKNOWN = 1e-8
BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters and marks in the model file, with or without the sign for a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        body = piece[1:] if piece.startswith(START) else piece
        if body and piece == piece.lower() and all(unicodedata.category(c)[0] in "LM" for c in body):
            kept.add(piece)
    return sorted(kept | {START})


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of every text; a null text has none."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    spaced = pc.replace_substring_regex(lowered, r"[^\p{L}\p{M}]+", " ")
    lists = pc.split_pattern(pc.utf8_trim(spaced, " "), " ")
    longest = pc.max(pc.utf8_length(lists.flatten())).as_py() or 0
    if longest > LONGEST_WORD:
        cut = pc.replace_substring_regex(spaced, r"([\p{L}\p{M}]{%d})" % LONGEST_WORD, r"\1 ")
        lists = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(cut, " +", " "), " "), " ")
    return lists


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of code points, zero padded, each word led by the start sign; and the lengths."""
    marked = [START + w for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.zeros((len(marked), int(lengths.max(initial=1))), np.uint64)
    flat = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    points[np.arange(points.shape[1])[None, :] < lengths[:, None]] = flat
    return points, lengths


def hash_pieces(pieces: list[str]) -> np.ndarray:
    out = np.zeros(len(pieces), np.uint64)
    with np.errstate(over="ignore"):
        for i, piece in enumerate(pieces):
            for c in piece:
                out[i] = out[i] * BASE + np.uint64(ord(c))
    return out


@dataclass
class Model:
    """Piece probabilities by language. `keys` are sorted piece hashes, `probability` is pieces by languages."""

    languages: list[str]
    keys: np.ndarray
    probability: np.ndarray
    longest: int
    known: dict[str, int] = field(default_factory=dict, repr=False)
    scores: list[np.ndarray] = field(default_factory=list, repr=False)

    #: Words whose scores a worker keeps between batches.
    CACHE = 400_000

    def matches(self, points: np.ndarray, lengths: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, rows, pieces) of the pieces that begin at `start`."""
        h = np.zeros(len(points), np.uint64)
        for size in range(1, min(self.longest, points.shape[1] - start) + 1):
            with np.errstate(over="ignore"):
                h = h * BASE + points[:, start + size - 1]
            rows = np.flatnonzero(lengths >= start + size)
            if not len(rows):
                return
            at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
            hit = self.keys[at] == h[rows]
            yield size, rows[hit], at[hit]

    def forward(self, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of every prefix, words by positions by languages. A character may also stand for itself, at a floor."""
        a = np.zeros((len(points), points.shape[1] + 1, len(self.languages)))
        a[:, 0] = 1
        for s in range(points.shape[1]):
            a[:, s + 1] += a[:, s] * UNKNOWN
            for size, rows, pieces in self.matches(points, lengths, s):
                a[rows, s + size] += a[rows, s] * self.probability[pieces]
        return a

    def log_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)))
        order = np.argsort([len(w) for w in words], kind="stable")
        for part in np.array_split(order, max(1, len(words) // 20_000)):
            if len(part):
                points, lengths = code_points([words[i] for i in part])
                out[part] = np.log(self.forward(points, lengths)[np.arange(len(part)), lengths])
        return out

    def cached(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        fresh = self.log_words(new)
        if not self.scores:
            self.scores.append(np.empty((0, len(self.languages))))
        base = len(self.scores[0])
        index = dict(zip(new, range(base, base + len(new)), strict=True))
        both = np.concatenate([self.scores[0], fresh])
        out = both[[self.known[w] if w in self.known else index[w] for w in words]]
        if len(both) <= self.CACHE:
            self.known.update(index)
            self.scores[0] = both
        return out

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and posterior of every text."""
        best = np.full(len(texts), "und", object)
        score = np.zeros(len(texts))
        if not self.languages:
            return best, score
        lists = words_of(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        coded = lists.flatten().dictionary_encode()
        vocabulary_ = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        if not vocabulary_:
            return best, score
        by_word = self.cached(vocabulary_)
        empty = np.array([not w for w in vocabulary_])
        by_word = np.where(empty[:, None], 0.0, by_word)
        total = np.stack([np.bincount(owner, by_word[codes, k], len(texts)) for k in range(len(self.languages))], 1)
        some = np.bincount(owner, ~empty[codes], len(texts)) > 0
        top = total.argmax(1)
        posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        best[some] = np.array(self.languages, object)[top[some]]
        score[some] = posterior[some]
        return best, score


def fit(words: pd.DataFrame, pieces: list[str], rounds: int = 3, smoothing: float = 0.1) -> Model:
    """Expectation maximisation over counted words (columns lang, word, n)."""
    languages = sorted(words["lang"].unique())
    keys = hash_pieces(pieces)
    order = np.argsort(keys)
    model = Model(languages, keys[order], np.full((len(pieces), len(languages)), 1 / len(pieces)), max(map(len, pieces)))
    if not languages:
        return model
    wide = words.pivot_table(index="word", columns="lang", values="n", aggfunc="sum", fill_value=0)[languages]
    texts, counts = list(wide.index), wide.to_numpy(float)
    for _ in range(rounds):
        expected = np.full_like(model.probability, smoothing)
        for part in np.array_split(np.argsort([len(w) for w in texts], kind="stable"), max(1, len(texts) // 20_000)):
            if not len(part):
                continue
            points, lengths = code_points([texts[i] for i in part])
            a = model.forward(points, lengths)
            b = np.zeros_like(a)
            b[np.arange(len(part)), lengths] = 1
            weight = counts[part] / a[np.arange(len(part)), lengths]
            for s in range(points.shape[1] - 1, -1, -1):
                b[:, s] += b[:, s + 1] * UNKNOWN
                for size, rows, found in model.matches(points, lengths, s):
                    through = model.probability[found] * b[rows, s + size]
                    b[rows, s] += through
                    np.add.at(expected, found, a[rows, s] * through * weight[rows])
        model.probability = expected / expected.sum(0)
    return model


def sample_words(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int, words_a_language: int) -> pd.DataFrame:
    """The most frequent words a language in a bounded sample of labelled documents, taken by a hash of the id."""
    lang = F.col(lang_col).cast("string").alias("lang")
    ids = docs.select(F.col(id_col).alias("id"), lang).where("lang is not null and id is not null").distinct()
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = ids.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= sample_docs).select("id")
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    runs = F.explode(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}]{1,%d}" % LONGEST_WORD), F.lit(0)))
    rows = docs.select(F.col(id_col).alias("id"), lang, F.col(text_col)).where("lang is not null").join(F.broadcast(chosen), "id", "left_semi")
    counted = rows.select("lang", runs.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counted.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= words_a_language)
    return top.select("lang", "word", "n").toPandas()


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def learn(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 1000, words_a_language: int = 30_000) -> Model:
    """The model of the documents that are not held out. Rows without an id or a language teach nothing."""
    taught = docs.where(remainder(id_col) != 1)
    return fit(sample_words(taught, id_col, text_col, lang_col, sample_docs, words_a_language), vocabulary(vocabulary_path))


def verdict(model: Model, text_col: str = "text") -> Column:
    """A column struct<lang, score> for the texts of a table."""

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [model.predict(part) for part in array_chunks(pa.array(texts, pa.large_string(), from_pandas=True))]
            pa.default_memory_pool().release_unused()  # a worker serves many tasks, and Arrow keeps what was freed
            if parts:
                yield pd.DataFrame({"lang": np.concatenate([p[0] for p in parts]), "score": np.concatenate([p[1] for p in parts])})
            else:
                yield pd.DataFrame({"lang": pd.Series([], dtype=object), "score": pd.Series([], dtype=float)})

    return predict(F.col(text_col))


def identify(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    found = verdict(learn(docs, vocabulary_path, id_col, text_col, lang_col), text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(remainder(id_col) == 1, F.lit(False)).alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_identified(docs: DataFrame, vocabulary_path: str, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text has a language with a score of at least `least`, with the columns they had."""
    found = "__language_found"
    scored = docs.withColumn(found, verdict(learn(docs, vocabulary_path), text_col))
    return scored.where((F.col(f"{found}.lang") != "und") & (F.col(f"{found}.score") >= least)).drop(found)
