"""A Merkle manifest of a table: leaves, a tree for every source, one tree over the sources, and a proof for every row.

A row is hashed where it is read; only its id, source and digests travel on. Rows get their exact rank within their source,
and the rank's base-3 digits are columns: a *block* is what shares all but the last `LEVELS` digits, at most 3^LEVELS nodes.
Within a block the digits are grouped away one after the other, each time nesting the children's structs in their
parent's, on one shuffle. Blocks are the nodes of the next tier, until every source has one node. A last transform walks
the nested structs from the top and explodes them into leaves with their proofs, so no leaf is ever joined. Only whole
blocks, one row each, are joined with the proof of their own place in the tier above.

Ranks come from a range partitioning by source, id and digest: a row's rank is its place in its partition plus what the
partitions before hold of its source, counted per partition. So a source with a third of all rows is many tasks.

Nulls and edges: a null column is hashed as `-`; a null source is a source of its own, before all others; null ids come
first in their source and are never tampered with. Rows of one id are ordered by their digest, repeated rows are leaves of their own and
in any order give the same tree. A null text is not the empty text. An empty table gives no rows. Only the
five named columns are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.versions import broadcast_if_small
from tablesync.session import settle, temporary

FAN = 3
#: Digits that are nested in one block: at most 729 nodes.
LEVELS = 6
PLACE_BITS = 33  # of a monotonically increasing id, for the row within its partition

NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `rank`, from 0, within their `tree` by `order`, and `n`, the rows of the tree."""
    told = settle(rows.withColumn("_salt", F.monotonically_increasing_id()), "merkle-rows")
    by = ["tree", *order, "_salt"]
    laid = told.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    placed = settle(laid.withColumns({"_part": F.spark_partition_id(), "_place": place}), "merkle-places")
    counted = placed.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy("tree").orderBy("_part"))
    every = F.sum("_rows").over(Window.partitionBy("tree"))
    start = counted.select("tree", "_part", (upto - F.col("_rows") - F.col("_first")).alias("_start"), every.alias("n"))
    start = broadcast_if_small(settle(start, "merkle-starts"))
    joined = placed.join(start, ["tree", "_part"])
    return joined.withColumn("rank", F.col("_place") + F.col("_start")).drop("_place", "_start", "_part")


def nested(nodes: DataFrame) -> DataFrame:
    """(tree, n, block, h, kids) from (tree, n, rank, h, item): each block's nodes, nested level by level.

    `kids` of the lowest level hold item, those above the kids of their own. A tree with one node left is not hashed on.
    """
    digits = [f"_d{i}" for i in range(LEVELS)]
    cut = {d: F.expr(f"cast(rank div {FAN**i} % {FAN} as int)") for i, d in enumerate(digits)}
    cut["block"] = F.expr(f"rank div {FAN**LEVELS}")
    level = nodes.withColumns(cut).repartition("tree", "block").select("tree", "n", "block", *digits, "h", "item")
    for i, digit in enumerate(digits):
        inner = "kids" if i else "item"
        kids = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("place"), "h", inner)))
        level = level.groupBy("tree", "n", "block", *digits[i + 1 :]).agg(kids.alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["h"]), ""), 256)
        level = level.withColumn("h", F.when(F.col("n") > FAN**i, joined).otherwise(F.get("kids", F.lit(0))["h"]))
    return level


def unfolded(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, item, h, path, *carried) of every node nested in the blocks (with `path`, their own proof upwards)."""

    def step(kids: Column, i: Column, level: int) -> Column:
        text = lambda some: F.array_join(F.transform(some, lambda k: k["h"]), "")
        sides = F.struct(text(F.slice(kids, F.lit(1), i)).alias("left"), text(F.slice(kids, i + 2, F.lit(FAN))).alias("right"))
        return F.when(F.col("n") > FAN**level, F.array(sides)).otherwise(F.array().cast(NO_PATH))

    def kids_of(node: Column, level: int) -> Column:
        inner = "kids" if level else "item"
        path = lambda i: F.concat(step(node["kids"], i, level), node["path"]).alias("path")
        return F.transform(node["kids"], lambda kid, i: F.struct(kid["h"].alias("h"), kid[inner].alias(inner), path(i)))

    nodes = F.array(F.struct("h", "kids", "path"))
    for level in reversed(range(LEVELS)):
        nodes = F.flatten(F.transform(nodes, lambda node: kids_of(node, level)))  # noqa: B023
    opened = blocks.select("tree", *carried, F.explode(nodes).alias("node"))
    return opened.select("tree", "node.item", "node.h", "node.path", *carried)


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks over nodes (tree, n, rank, h, item), and (tree, h) of the last node of every tree."""
    most = nodes.agg(F.max("n")).first()[0] or 0  # one number
    tiers = []
    while True:
        tier = settle(nested(nodes), "merkle-tier")
        tiers.append(tier)
        most = -(-most // FAN**LEVELS)
        if most <= 1:
            return tiers, tier.select("tree", "h")
        rows = F.expr(f"(n + {FAN**LEVELS - 1}) div {FAN**LEVELS}")
        nodes = tier.select("tree", rows.alias("n"), F.col("block").alias("rank"), "h", F.struct(F.col("block").alias("rank")).alias("item"))


def descend(tiers: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, item, h, path, *carried) of the nodes that the lowest tier was made of, from (tree, path, *carried) of the trees."""
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for i, tier in enumerate(reversed(tiers)):
        nodes = unfolded(tier.join(above, ["tree", "block"]), carried)
        if i + 1 < len(tiers):
            above = nodes.select("tree", F.col("item.rank").alias("block"), "path", *carried)
    return nodes


def leaves(docs: DataFrame, id_col: str, source_col: str, lang_col: str, chars_col: str, text_col: str) -> DataFrame:
    """(tree, doc_id, h, tampered): the digest of every row, and that of its tampered form where it differs."""
    row = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(chars_col).cast("long").alias("n_chars"),
        F.col(text_col).cast("string").alias("text"),
    )
    front = [framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    tampered = F.when(touched, digest(*front, framed(F.replace("text", F.lit("\n"), F.lit("")))))
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    return row.select(tree.alias("tree"), "doc_id", digest(*front, framed(F.col("text"))).alias("h"), tampered.alias("tampered"))


def manifest(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", text_col: str = "text"
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    with temporary(docs.sparkSession):
        rows = ranked(leaves(docs, id_col, source_col, lang_col, chars_col, text_col), ["doc_id", "h"])
        low, subroots = climb(rows.select("tree", "n", "rank", "h", F.struct("doc_id", "tampered").alias("item")))
        one = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "h")
        sources = ranked(one, ["source_tree"])
        high, roots = climb(sources.select("tree", "n", "rank", "h", F.struct("source_tree").alias("item")))
        start = roots.select("tree", F.array().cast(NO_PATH).alias("path"), F.col("h").alias("root"))
        tops = descend(high, start, ["root"]).select(F.col("item.source_tree").alias("tree"), "path", F.col("h").alias("subroot"), "root")
        found = descend(low, tops, ["subroot", "root"])
        proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
        folded = F.aggregate("path", F.coalesce("item.tampered", "h"), lambda acc, s: digest(s["left"], acc, s["right"]))
        told = found.select("item.doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"))
        return settle(told.withColumn("verified", F.col("folded_root") == F.col("root")), "merkle-manifest", keep=True)
