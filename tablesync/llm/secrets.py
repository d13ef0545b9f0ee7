"""Secrets in texts, told from copied examples by how many owners share them, with DataFrame functions only.

Three base kinds are found by fixed patterns and always kept. A fourth, `other`, proposes tokens of well-known forms and
long mixed tokens outside the base spans. The hash of every candidate's value is counted over the whole corpus by
distinct repositories and distinct owners, where all copies of one text count as one owner's: what many owners and repositories hold in
texts of their own is a copied example, what few hold looks live. Of the kind `other` only live candidates become spans.

Spans are in code points, end exclusive, leftmost and non-overlapping within a kind. Places come from splitting the
text at marks set around the matches and adding up the lengths of the parts, so one pass finds all matches of a text.

Nulls and edges: a null text counts as empty. Null owners or repositories count as one owner or repository. Rows are
told apart by id and text, so rows with one id keep their own spans and repeated rows get the same ones. An empty
table gives no rows. Only the four named columns are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.versions import BROADCAST_BYTES, broadcast_if_small
from tablesync.session import settle

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
# Runs are maximal, so asking for the least length in the pattern drops the same matches as a later test.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OTHER = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|[A-Za-z0-9+/_-]{28,}={0,2}"
)
KINDS = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("other", OTHER)]
BASE = 3
LEAST_VALUE = 6
#: Owners, and repositories, from which on a value is a widely copied example.
EXAMPLE_OWNERS = 8
EXAMPLE_REPOSITORIES = 8

OPEN, CLOSE = "\x01", "\x02"


def parts(text: Column, number: int) -> Column:
    """Lengths of the stretches between and inside the matches of a kind, the matches with their value; odd ones are matches."""
    name, pattern = KINDS[number]
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, "\x03\x03"), pattern, f"{OPEN}$0{CLOSE}")
    pieces = F.split(marked, f"[{OPEN}{CLOSE}]", -1)

    def piece(p: Column, i: Column) -> Column:
        value = F.regexp_extract(p, ASSIGN_VALUE, 1) if name == "assign" else p
        return F.struct(F.lit(number).alias("kind"), i.alias("place"), F.char_length(p).alias("length"), F.when(i % 2 == 1, value).alias("value"))

    empty = F.array().cast("array<struct<kind:int,place:int,length:int,value:string>>")
    return F.when(text.rlike(pattern), F.transform(pieces, piece)).otherwise(empty)


def mixed(value: Column) -> Column:
    """Whether a token looks drawn at random rather than written: digits, and letters of both cases or a known form."""
    known = value.rlike(r"^(?:-----BEGIN|gh[pousr]_|xox[abprs]-|sk_live_|AIza)")
    return known | (value.rlike("[0-9].*[0-9].*[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]"))


def row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository: Column) -> DataFrame:
    """(id, row, kind, start, end, digest, live, owners, repositories) of all base spans and all proposals outside of them, one set for every distinct (id, row)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = F.explode(F.concat(*[parts(F.col("text"), k) for k in range(len(KINDS))]))
    rows = docs.select(F.col(id_col).alias("id"), row_hash(id_col, text_col).alias("row"), F.xxhash64(text).alias("content"), text.alias("text"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), repository.alias("repository"))
    any_kind = "|".join(f"(?:{p})" for _, p in KINDS)
    opened = rows.where(F.col("text").rlike(any_kind)).select("id", "row", "content", "owner", "repository", found.alias("x")).select("id", "row", "content", "owner", "repository", "x.*").distinct()
    along = Window.partitionBy("id", "row", "owner", "repository", "kind").orderBy("place")
    spans = opened.withColumn("end", F.sum("length").over(along)).where("value is not null")
    spans = spans.withColumn("start", F.col("end") - F.col("length"))
    keep = F.when(F.col("kind") == 0, F.char_length("value") >= LEAST_VALUE).when(F.col("kind") == BASE, mixed(F.col("value"))).otherwise(F.lit(True))
    spans = spans.where(keep).select("id", "row", "content", "owner", "repository", "kind", "start", "end", F.sha2("value", 256).alias("digest"))
    is_base = F.col("kind") < BASE
    before = Window.partitionBy("id", "row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("id", "row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.when(is_base, F.col("end"))).over(before)
    ahead = F.min(F.when(is_base, F.col("start"))).over(after)
    spans = spans.withColumn("reached", reached).withColumn("ahead", ahead)
    clear = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.col("ahead").isNull() | (F.col("ahead") >= F.col("end")))
    spans = settle(spans.where(is_base | clear).drop("reached", "ahead"), "secret-candidates")
    texts = spans.groupBy("digest", "content").agg(F.min(F.struct("owner", "repository")).alias("held"))
    owned = texts.select("digest", "held.owner", "held.repository").distinct().groupBy("digest", "owner").agg(F.count("*").alias("n"))
    shared = owned.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    shared = broadcast_if_small(settle(shared, "secret-owners"))
    wide = (F.col("owners") >= EXAMPLE_OWNERS) & (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    told = spans.join(shared, "digest").withColumn("live", ~wide)
    return told.select("id", "row", "kind", "start", "end", "digest", "live", "owners", "repositories").distinct()


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*[F.lit(k) for k, _ in KINDS])
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_other, n_live and n_examples of every row."""
    where = F.concat_ws("/", owner_col, "lang") if repository is None else repository
    span = F.struct("start", "kind", "end")
    base = F.col("kind") < BASE
    kept = candidates(docs, id_col, text_col, owner_col, where).where(base | F.col("live"))
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{name}") for k, (name, _) in enumerate(KINDS)]
    by_row = kept.groupBy("id", "row").agg(
        *counts,
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_examples"),
        F.collect_list(F.when(base, span)).alias("base"),
        F.collect_list(span).alias("all"),
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), row_hash(id_col, text_col).alias("row"))
    joined = rows.join(by_row.withColumnRenamed("row", "of"), (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.sha2(F.coalesce(listed(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(listed(F.col("all")), F.lit("")).alias("spans"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_other", "n_live", "n_examples")],
    )


def unused(docs: DataFrame, name: str) -> str:
    """The name, longer if the table has such a column."""
    while name in docs.columns:
        name += "_"
    return name


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository: Column | None = None, length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with a mark in place of every live secret in the text; `length_col` holds the new length.

    Overlapping spans are replaced together. Values that many owners and repositories share are examples and stay. The places of all
    live secrets are broadcast if their measured size allows, so that texts are cut where they are read; beyond, texts with matches are shuffled.
    """
    where = F.concat_ws("/", owner_col, "lang") if repository is None else repository
    at, of_id, of_row, of_cuts = (unused(docs, name) for name in ("__at", "__id", "__row", "__cuts"))
    live = candidates(docs, id_col, text_col, owner_col, where).where("live")
    before = Window.partitionBy("id", "row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    marked = live.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    along = Window.partitionBy("id", "row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = marked.withColumn("group", F.sum((F.col("start") >= F.col("reached")).cast("int")).over(along))
    merged = merged.groupBy("id", "row", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("id", "row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(of_cuts))
    cuts = settle(cuts.select(F.col("id").alias(of_id), F.col("row").alias(of_row), of_cuts), "secret-cuts")

    def with_cuts(rows: DataFrame, of: DataFrame) -> DataFrame:
        return rows.withColumn(at, row_hash(id_col, text_col)).join(of, (F.col(at) == F.col(of_row)) & F.col(id_col).eqNullSafe(F.col(of_id)), "left")

    wide = cuts.agg(F.sum(F.size(of_cuts) * 16 + F.coalesce(F.octet_length(F.col(of_id).cast("string")), F.lit(0)) + 48)).first()[0] or 0
    if wide <= BROADCAST_BYTES:
        others, joined = None, with_cuts(docs, F.broadcast(cuts))
    else:  # texts without a match of any kind are not shuffled
        any_kind = "|".join(f"(?:{p})" for _, p in KINDS)
        has = F.coalesce(F.col(text_col).rlike(any_kind), F.lit(False))
        others, joined = docs.where(~has), with_cuts(docs.where(has), cuts)
    edges = F.concat(F.array(F.lit(0)), F.transform(of_cuts, lambda c: c["end"]))
    stops = F.concat(F.transform(of_cuts, lambda c: c["start"]), F.array(F.char_length(text_col)))
    pieces = F.zip_with(edges, stops, lambda a, b: F.substring(F.col(text_col), a.cast("int") + 1, (b - a).cast("int")))
    cut = F.when(F.col(of_cuts).isNotNull(), F.array_join(pieces, mark)).otherwise(F.col(text_col))
    done = joined.withColumn(text_col, cut)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        done = done.withColumn(length_col, F.when(F.col(of_cuts).isNotNull(), F.char_length(text_col).cast(kind)).otherwise(F.col(length_col)))
    done = done.select(docs.columns)
    return done if others is None else others.unionByName(done)
