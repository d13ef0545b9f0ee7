"""URL filters: rules on hosts and paths first, then a logistic regression on hashed character n-grams, with DataFrame functions only.

Host and path are cut from the url. A rule has a host and the beginning of a path and fits its host and all subdomains; of the
rules that fit the longest one decides. Rules are found by hash joins on the last labels of a host, one for every number of labels that a rule's host
has, so no url meets a rule of another host.

What no rule decides is left to the model. Its features are the character n-grams of host and path, hashed to `BUCKETS`
with the part they come from; a gram counts once a url. Weights are learned from a small table of labelled urls: a
bounded share of its rows, picked by hash (`MOST_LABELLED`), gradient descent on all of them at a time. Each epoch is one aggregation over the
features, whose result, at most a number per bucket, the driver adds to the weights. Gradients are summed as whole numbers, so
that they do not depend on the order of rows. Scoring looks the weights up in a literal array: one pass over the urls, no shuffle.

Nulls and edges: a null url, or one without `://`, has an empty host and path; no rule fits, and with no n-gram the model's intercept decides. Hosts are
taken as they are written, with ports and user names. Texts of any length are read once. Among equally long rules the
smaller one by host, path and verdict decides. Repeated rows are judged each; null ids stay. Empty tables give no rows; without labelled rows the model scores
a half and allows. Only the id and url columns are read, so other columns never clash.
"""

from __future__ import annotations

import json
import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.versions import broadcast_if_small
from tablesync.session import settle, temporary

GRAMS = (3, 4)
BUCKETS = 1 << 14
#: Most labelled urls that are learned from.
MOST_LABELLED = 5000
EPOCHS = 25
RATE = 0.5
PENALTY = 1e-3
#: Gradients are counted in so many parts of one.
PARTS = 1 << 30
BLOCK_FROM = 0.5

ALLOW, BLOCK = "allow", "block"

#: Names of hosts with their label. Those to block are sales spam, gambling, adult and tracking hosts.
NAMES = {
    BLOCK: """
        casino-royal casino-online best-casino casino-games mega-casino casino-jackpot poker-room online-poker slots-world free-slots jackpot-city
        cheap-watches cheap-meds cheap-rx cheap-loans cheap-viagra cheap-tickets online-pills diet-pills pills-direct buy-pills pills-store replica-bags
        spam-mail spam-links spam-site spam-network link-farm seo-farm content-farm like-farm click-farm
        adult-cams adult-video free-adult adult-chat adult-dating xxx-adult porn-tube sex-cams hot-singles xxx-videos
        sports-bets bets-online live-bets top-bets bets-tips free-spins free-bonus betting-odds bet-now
        win-money win-prizes big-win win-big lucky-win make-money payday-loans
        ads-server ads-network popup-ads ads-click banner-ads ad-track track-clicks click-track user-track tracking-pixel track-hub
    """,
    ALLOW: """
        cityparks library museum weather riverside schools gardening history mathematics physics chemistry biology cooking bread orchestra theatre
        railways cycling mountains lakeside painting astronomy geology oceans language poetry novels football running swimming chess hospital
        university engineering harbour cathedral thestation northern weathering thinking another nation
        science-news open-data town-hall local-news film-archive folk-music health-service public-library world-atlas art-gallery
        farm-museum adult-education racetrack trackandfield winter-sports windmill admission advent-calendar sheepfarm bicycle-club sailing-club
        forestry agriculture economics philosophy geography journalism transport housing council parliament election
    """,
}
#: Every name stands in each of these urls, so that nothing but the name tells the labels apart.
SHAPES = [
    "http://{}.example.com/en/", "https://www.{}.example.org/de/12.html", "http://blog.{}.example.net/fr/7?page=2", "https://m.{}.example.com/es/345",
]

#: The rules of the contract, as (host, path, verdict).
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased, and what follows up to `?` or `#`."""
    after = F.instr(url, "://")
    rest = F.when(after > 0, F.substring(url, after + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def grams(host: Column, path: Column) -> Column:
    """The distinct buckets of the n-grams of both parts; a gram may reach over their ends, which are marked."""

    def of(text: Column, part: str) -> list[Column]:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        found = [F.regexp_extract_all(marked, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1)) for n in GRAMS]
        return [F.transform(f, lambda g: F.crc32(F.concat(F.lit(part), g)).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint")).cast("int")) for f in found]

    held = F.when(host != "", F.concat(*of(host, "h"))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(held, F.when(path != "", F.concat(*of(path, "p"))).otherwise(F.array().cast("array<int>"))))


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    intercept: float

    def score(self, buckets: Column) -> Column:
        """The probability that a url with these buckets is to be blocked."""
        table = F.from_json(F.lit(json.dumps(self.weights)), "array<double>")
        return logistic(F.aggregate(buckets, F.lit(self.intercept), lambda acc, b: acc + F.get(table, b)))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(40.0)), F.lit(-40.0))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, verdict) of the built-in table."""
    rows = [(shape.format(name), verdict) for verdict, names in NAMES.items() for name in names.split() for shape in SHAPES]
    return spark.createDataFrame(rows, "url string, verdict string")


def train(labelled: DataFrame, most: int = MOST_LABELLED, epochs: int = EPOCHS) -> Model:
    """Weights from (url, verdict) rows; rows with another verdict, or none, are left out."""
    rows = labelled.where(F.col("verdict").isin(ALLOW, BLOCK))
    many = rows.count()
    share = F.pmod(F.xxhash64("url", "verdict"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(many, 1)))
    url = rows.where(share).distinct().select((F.col("verdict") == BLOCK).cast("int").alias("y"), *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    with temporary(labelled.sparkSession):
        known = settle(url.select("y", grams(F.col("host"), F.col("path")).alias("buckets")), "url-features")
        sizes = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("blocked")).first()
        n = sizes["n"]
        weights, scale = [0.0] * BUCKETS, {}
        intercept = 0.0 if not 0 < sizes["blocked"] < n else math.log(sizes["blocked"] / (n - sizes["blocked"]))
        for _ in range(epochs if n else 0):
            missed = F.round((Model(tuple(weights), intercept).score(F.col("buckets")) - F.col("y")) * PARTS).cast("long")
            summed = known.select(F.explode("buckets").alias("bucket"), missed.alias("missed")).groupBy("bucket").agg(F.sum("missed").alias("missed"))
            for row in sorted(summed.collect()):  # at most a row a bucket
                b, slope = row["bucket"], row["missed"] / PARTS / n + PENALTY * weights[row["bucket"]]
                scale[b] = scale.get(b, 0.0) + slope * slope  # each weight by the slopes it has seen
                weights[b] -= RATE * slope / math.sqrt(scale[b] + 1e-8)
    return Model(tuple(weights), intercept)


def ruled(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows (with host, path) and `rule`, the longest (length, host, path, verdict) that fits, or null."""
    clean = rules.where("host is not null and path is not null and verdict is not null").distinct()
    counted = F.size(F.split("host", r"\.", -1))
    told = rows
    labels = sorted(r["k"] for r in clean.select(counted.alias("k")).distinct().collect())  # as many as a host has labels
    for k in labels:
        # smaller texts first among equally long ones: sorted lists, the first fit of the greatest length is taken
        of = clean.where(counted == k).groupBy(F.col("host").alias("_host")).agg(F.array_sort(F.collect_list(F.struct("path", "verdict"))).alias(f"_rules{k}"))
        told = told.withColumn("_host", F.substring_index("host", ".", -k)).join(broadcast_if_small(of), "_host", "left").drop("_host")
    none = F.array().cast("array<struct<size:int,host:string,path:string,verdict:string>>")
    fits = [none]
    for k in labels:
        some = F.filter(F.coalesce(f"_rules{k}", F.array().cast("array<struct<path:string,verdict:string>>")), lambda r: F.startswith(F.col("path"), r["path"]))
        suffix = F.substring_index("host", ".", -k)
        fits.append(F.transform(some, lambda r: F.struct((-F.length(suffix) - F.length(r["path"])).alias("size"), suffix.alias("host"), r["path"].alias("path"), r["verdict"].alias("verdict"))))  # noqa: B023
    return told.withColumn("rule", F.get(F.array_sort(F.concat(*fits)), F.lit(0))).drop(*[f"_rules{k}" for k in labels])


def judge(
    pages: DataFrame, rules: DataFrame | None = None, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
    model: Model | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (of the model, rounded) of every row."""
    spark = pages.sparkSession
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string") if rules is None else rules
    model = model or train(labelled_urls(spark) if labelled is None else labelled)
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = ruled(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), rules)
    scored = rows.withColumn("score", F.round(model.score(grams(F.col("host"), F.col("path"))), 6))
    verdict = F.coalesce("rule.verdict", F.when(F.col("score") > BLOCK_FROM, BLOCK).otherwise(ALLOW))
    return scored.select("page_id", "host", "path", F.concat("rule.host", "rule.path").alias("rule"), verdict.alias("verdict"), "score")
