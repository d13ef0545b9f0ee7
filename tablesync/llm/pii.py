"""Personal data by candidates and boosted trees.

Four base kinds are found by fixed patterns and checks and always kept. Generators with high recall propose further,
overlapping spans: telephone numbers without a plus sign, numbers in the form of social security and account
numbers, mail addresses with the sign spelled out, cards inside runs of digits that are no card as a whole. Boosted trees score every
proposal by its format, the checks of its field and its surroundings; what reaches a threshold becomes a span, of overlapping ones the best.

The trees are fitted on two bounded tables. `LESSONS` made-up candidates of the proposed kinds come from a rule: spans that are right or
wrong by their field, in surroundings that speak for them, against them, or say nothing. A bounded sample of the documents (`SAMPLE_DOCS`, by a
hash of the id) adds what numbers look like in the corpus: matches of the base patterns by their checks, account
numbers, cards and social security numbers by theirs, and other runs of digits as negative; a span that a generator proposes is never negative
but by its own check. The threshold is calibrated on every fourth candidate, which the trees have not seen: the least score from which on
`PRECISION` of the proposed kinds are positive.

Spans are code points, end exclusive, leftmost and non-overlapping within a base kind. The patterns are anchored at run
starts, which finds the same matches in one pass over very long runs.

Nulls and edges: a null text counts as empty. Rows are judged one by one, so repeated rows and null ids stay. An empty
table gives no rows. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import chunks

BASE = ["email", "ip", "card", "phone"]
ADDED = ["phone_local", "ssn", "iban", "email_spelled", "card_inside"]
PHONE_LOCAL, SSN, IBAN, SPELLED, INSIDE = range(len(BASE), len(BASE) + len(ADDED))
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PROPOSALS = [
    ("phone_local", re.compile(r"(?<![\w+.-])(?<![0-9] )(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])(?![ .][0-9])")),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("email_spelled", re.compile(r"(?<![\w.])[\w.%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]{2,})+")),
]
NUMBERS = re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){5,}+")
SAMPLE_DOCS = 20_000
LESSONS = 8_000
PRECISION = 0.99
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def ip_fits(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def card_fits(text: str) -> bool:
    return 13 <= len(d := digits_of(text)) <= 19 and luhn(d)


def phone_fits(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passes) of all matches of the base patterns."""
    found = [(0, a, b, True) for a, b in emails(text)] if "@" in text else []
    for kind, pattern, fits in ((1, IP, ip_fits), (2, CARD, card_fits), (3, PHONE, phone_fits)):
        if kind != 3 or "+" in text:
            found += [(kind, m.start(), m.end(), fits(m[0])) for m in pattern.finditer(text)]
    return found


def cards_inside(text: str) -> Iterator[Span]:
    """Runs of whole groups of digits, 13 to 19 in all, inside a match of the card pattern that is no card."""
    for m in CARD.finditer(text):
        if len(m[0]) > 13 and not card_fits(m[0]):
            groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer("[0-9]+", m[0])]
            for i, (start, _) in enumerate(groups):
                n = 0
                for a, b in groups[i:]:
                    n += b - a
                    if n > 19:
                        break
                    if n >= 13 and (start, b) != m.span():
                        yield start, b


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the generators propose; kinds count on from the base kinds."""
    found = [(len(BASE) + i, m.start(), m.end()) for i, (_, pattern) in enumerate(PROPOSALS) for m in pattern.finditer(text)]
    return found + [(INSIDE, a, b) for a, b in cards_inside(text)]


def ssn_fits(span: str) -> bool:
    area, group, serial = span.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def iban_fits(span: str) -> bool:
    plain = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def phone_local_fits(span: str) -> bool:
    gaps = re.findall("[ .-]", span)
    return 8 <= len(digits_of(span)) <= 13 and (span[0] == "(" or len(set(gaps)) == 1)


def spelled_fits(span: str) -> bool:
    return bool(re.search("[A-Za-z]", span.split("(at)")[0].split("[at]")[0])) and bool(re.search("[a-z]{2,6}$", span))


FITS = {PHONE_LOCAL: phone_local_fits, SSN: ssn_fits, IBAN: iban_fits, SPELLED: spelled_fits, INSIDE: card_fits}
#: Kinds whose check is proof enough, whatever is said before.
PROVEN = {IBAN, SPELLED, INSIDE}
# Words that speak for a kind when they stand before a candidate, and words that speak against all.
FOR = {
    PHONE_LOCAL: "phone|tel|call|mobile|cell|fax|dial|whatsapp|telefon|handy|rufnummer|teléfono|móvil|téléphone|numéro",
    SSN: "ssn|social|security|taxpayer|sozialversicherung|seguridad|sécurité",
    IBAN: "iban|account|bank|transfer|konto|cuenta|compte",
    SPELLED: "mail|email|contact|write|reach|kontakt|correo|courriel",
    INSIDE: "card|visa|mastercard|credit|karte|kreditkarte|tarjeta|carte",
}
AGAINST = (
    "order|invoice|part|serial|version|isbn|model|item|ref|reference|page|figure|ticket|tracking|sku|lot|case|article|catalog|build|release|total|score|population|votes"
    "|bestellung|rechnung|artikel|seite|pedido|factura|artículo|página|commande|facture"
)
NEAR_FOR = {kind: re.compile(rf"(?i)(?<!\w)(?:{words})(?!\w)") for kind, words in FOR.items()}
NEAR_AGAINST = re.compile(rf"(?i)(?<!\w)(?:{AGAINST})(?!\w)")


def features(text: str, start: int, end: int, kind: int = -1) -> list[float]:
    """Format, field check and surroundings of a candidate; `kind` is that of a proposal."""
    span = text[start:end]
    digits = digits_of(span)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    groups = re.findall("[0-9]+", span)
    runs = [len(r) for r in groups]
    near = max(0, start - 40)
    return [
        len(span), len(digits), sum(c.isalpha() for c in span), span.count(" "), span.count("-"), span.count("."), span.count("("),
        float("@" in span), float(span[:1] == "+"), len(runs), max(runs, default=0), min(runs, default=0),
        float(13 <= len(digits) <= 19 and luhn(digits)), float(9 <= len(digits) <= 15), float(len(runs) == 4 and all(len(r) <= 3 and int(r) <= 255 for r in groups)),
        float(before.isspace() or not before), float(before.isalnum()), float(after.isspace() or not after), float(after.isalnum()), len(set(digits)),
        float(set(runs[1:]) == {3} and runs[0] <= 3 and "-" not in span and "(" not in span),  # as thousands are grouped
        float(kind in FITS and FITS[kind](span)), float(kind in FOR and bool(NEAR_FOR[kind].search(text, near, start))), float(bool(NEAR_AGAINST.search(text, near, start))),
        *(float(kind == k) for k in FITS),
    ]


def made_span(kind: int, rng: random.Random) -> str:
    """A span in the form of a kind; its field check holds for some."""
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    if kind == SSN:
        return f"{rng.choice([number(3), number(3), '9' + number(2), '000', '666'])}-{number(2)}-{number(4)}"
    if kind == PHONE_LOCAL:
        gap = rng.choice(" .-")
        first = rng.choice(["({})", "{}", "{}"]).format(number(rng.randint(2, 5)))
        return f"{first}{rng.choice([gap, gap, gap, ' ', '-'])}{number(rng.randint(3, 4))}{gap}{number(rng.randint(3, 4))}"
    if kind == IBAN:
        land = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=2))
        body = "".join(rng.choices(rng.choice(["0123456789", "0123456789ABCDEFGH"]), k=rng.randint(12, 27)))
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{land}00")) % 97
        plain = f"{land}{check:02}{body}" if rng.random() < 0.5 else f"{land}{number(2)}{body}"
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if rng.random() < 0.5 else plain
    if kind == SPELLED:
        name = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 12)))
        gap, sides = rng.choice(["", " "]), rng.choice(["({})", "[{}]"])
        left = name if rng.random() < 0.8 else number(4)
        return f"{left}{gap}{sides.format('at')}{gap}{name[::-1]}{gap}{rng.choice([sides.format('dot'), '.'])}{gap}{rng.choice(['com', 'org', 'de', 'net', 'fr'])}"
    plain = "4" + number(rng.choice([12, 14, 15]))
    plain += next(d for d in "0123456789" if luhn(plain + d)) if rng.random() < 0.5 else number(1)
    return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if rng.random() < 0.5 else plain


def lessons(count: int = LESSONS, seed: int = 6) -> tuple[list[list[float]], list[float]]:
    """Features and labels of made-up candidates of the proposed kinds."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        kind = list(FITS)[i % len(FITS)]
        span = made_span(kind, rng)
        filler = lambda: " ".join("".join(rng.choices("aeinorstlmdu", k=rng.randint(2, 8))) for _ in range(rng.randint(1, 5)))
        said = rng.choice(["for", "against", "nothing"])
        word = {"for": rng.choice(FOR[kind].split("|")), "against": rng.choice(AGAINST.split("|")), "nothing": rng.choice([filler(), ""])}[said]
        lead = f"{filler()} {word}{rng.choice([': ', ' ', ' no. ', ' is '])}" if word else rng.choice(["", "(", '"'])
        tail = rng.choice([" ", ".", ", ", "", ")", "!"]) + filler()
        if kind == INSIDE:
            tail = " " + made_span(kind, rng) + tail
        text, start = lead + span + tail, len(lead)
        if (kind, start, start + len(span)) not in proposals(text):
            continue
        rows.append(features(text, start, start + len(span), kind))
        thousands = kind == PHONE_LOCAL and rows[-1][20] == 1.0
        surroundings = kind in PROVEN or said == "for" or (said == "nothing" and not thousands)
        labels.append(float(FITS[kind](span) and surroundings))
    return rows, labels


@dataclass
class Trees:
    """Boosted regression trees over binned features, for log odds. A tree is (feature, cut) for each inner node, and its leaves."""

    base: float
    cuts: list[np.ndarray]
    trees: list[tuple[list[tuple[int, int]], np.ndarray]]
    threshold: float = 1.0
    DEPTH = 3

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1)

    @staticmethod
    def leaf(nodes: list[tuple[int, int]], b: np.ndarray) -> np.ndarray:
        at = np.zeros(len(b), np.int64)
        splits = np.array(nodes)
        for _ in range(Trees.DEPTH):
            feature, cut = splits[at].T
            at = 2 * at + 1 + (b[np.arange(len(b)), feature] > cut)
        return at - len(nodes)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        odds = np.full(len(x), self.base)
        for nodes, leaves in self.trees:
            odds += leaves[self.leaf(nodes, b)]
        return 1 / (1 + np.exp(-odds))


def best_split(b: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int) -> tuple[int, int]:
    """The feature and bin whose split gains most; a node that gains nothing sends all rows one way."""
    best, where = 1e-9, (0, bins)
    for j in range(b.shape[1]):
        left_g, left_h = (np.cumsum(np.bincount(b[:, j], w, bins)) for w in (g, h))
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g.sum() ** 2 / (h.sum() + 1)
        if (k := int(gain.argmax())) < bins - 1 and gain[k] > best:
            best, where = gain[k], (j, k)
    return where


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, bins: int = 32) -> Trees:
    """Fits the trees to labels of 0 and 1 by gradients of the logistic loss."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(mean / (1 - mean))), cuts, [])
    b, odds = model.bins(x), np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        nodes: list[tuple[int, int]] = []
        at = np.zeros(len(x), np.int64)
        for level in range(Trees.DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = at == node
                nodes.append(best_split(b[rows], g[rows], h[rows], bins) if rows.any() else (0, bins))
            feature, cut = np.array(nodes)[at].T
            at = 2 * at + 1 + (b[np.arange(len(b)), feature] > cut)
        leaf = at - len(nodes)
        size = len(nodes) + 1
        leaves = rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + 1)
        model.trees.append((nodes, leaves))
        odds += leaves[leaf]
    return model


def candidate_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features and labels of the training candidates in the texts."""
    for batch in batches:
        rows, labels = [], []
        for text in batch["text"]:
            known, offered = matches(text), proposals(text)
            for kind, a, b in offered:
                fits = FITS[kind](text[a:b])
                if kind in (IBAN, INSIDE) or (kind == SSN and not fits):
                    rows.append(features(text, a, b, kind))
                    labels.append(float(fits))
            taken = Cover((a, b) for _, a, b in offered)
            for _, a, b, passes in known:
                if passes or taken.free(a, b):
                    rows.append(features(text, a, b))
                    labels.append(float(passes))
            taken = Cover([*taken.spans, *((a, b) for _, a, b, _ in known)])
            for m in NUMBERS.finditer(text):
                if taken.free(*m.span()):
                    rows.append(features(text, *m.span()))
                    labels.append(0.0)
        yield pd.DataFrame({"x": pd.Series(rows, dtype=object), "y": pd.Series(labels, dtype=float)})


def train(docs: DataFrame, id_col: str, text_col: str, sample_docs: int = SAMPLE_DOCS) -> Trees:
    """The trees and their threshold."""
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    sample = texts.join(F.broadcast(ids), "id", "left_semi").select("text")
    found = sample.mapInPandas(candidate_rows, "x array<double>, y double").orderBy(F.xxhash64("x"), "y").limit(5 * sample_docs).toPandas()
    rows, labels = lessons()
    x = np.array([*rows, *found["x"]], float)
    y = np.array([*labels, *found["y"]])
    held = np.arange(len(x)) % 4 == 0
    model = boost(x[~held], y[~held])
    judged = held & (x[:, -len(FITS) :].sum(1) > 0)
    score = model.score(x[judged])
    order = np.argsort(-score, kind="stable")
    precision = np.cumsum(y[judged][order]) / np.arange(1, judged.sum() + 1)
    good = np.flatnonzero(precision >= PRECISION)
    model.threshold = float(max(score[order][good[-1]], 0.5)) if len(good) else 1.0
    return model


def spans_of(text: str, model: Trees) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans of a text, each (kind, start, end)."""
    base = sorted((k, a, b) for k, a, b, passes in matches(text) if passes)
    kept = Cover((a, b) for _, a, b in base)
    offered = [c for c in proposals(text) if kept.free(*c[1:])]
    if not offered:
        return base, []
    score = model.score(np.array([features(text, a, b, k) for k, a, b in offered]))
    added = []
    for s, (kind, a, b) in sorted(zip(score, offered, strict=True), key=lambda c: (-c[0], c[1][1], -c[1][2])):
        if s >= model.threshold and kept.free(a, b):
            kept.add(a, b)
            added.append((kind, a, b))
    return base, sorted(added)


class Cover:
    """Which code points are taken, as ordered spans that do not overlap."""

    def __init__(self, spans: Iterable[Span]) -> None:
        self.spans: list[Span] = []
        for a, b in sorted(spans):  # base spans of different kinds may overlap
            if self.spans and a < self.spans[-1][1]:
                a, b = self.spans[-1][0], max(b, self.spans.pop()[1])
            self.spans.append((a, b))

    def free(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.spans, (end, 0))
        return at == 0 or self.spans[at - 1][1] <= start

    def add(self, start: int, end: int) -> None:
        bisect.insort(self.spans, (start, end))


NOTHING = hashlib.sha256(b"").hexdigest()


def find(model: Trees) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = BASE + ADDED

    def told(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{names[k]}:{a}:{b}" for k, a, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = re.compile("[0-9@]|\\(at\\)|\\[at\\]")
        for batch in chunks(batches, "text"):
            counts, hashes, spans, added = np.zeros((batch.num_rows, len(BASE)), np.int64), [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text or not some.search(text):
                    hashes.append(NOTHING), spans.append(""), added.append(0)
                    continue
                base, more = spans_of(text, model)
                for k, _, _ in base:
                    counts[i, k] += 1
                hashes.append(hashlib.sha256(told(base).encode()).hexdigest())
                spans.append(told(base + more))
                added.append(len(more))
            columns = [batch.column("doc_id"), *(pa.array(c) for c in counts.T.copy()), pa.array(hashes), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"])

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of every row; spans come by kind, then start."""
    model = train(docs, id_col, text_col, sample_docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with `[KIND]` for each span; spans that overlap go together under the first one's kind."""
    names, out, at = BASE + ADDED, [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if start >= at:
            out += [text[at:start], f"[{names[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
