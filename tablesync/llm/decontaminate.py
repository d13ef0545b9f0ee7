"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts become sequences of lower-case words in which numbers, names and units carry a type mark. A *template* replaces
every marked word by its mark, so that "Ann ran 5 km" and "Bob ran 12 km" are one template. Windows are also compared with names read as words, so a copy in
other case or with other line breaks is found. Windows of eight template
words of the benchmark are hash-joined with those of the documents. Hits are counted along diagonals (document place
minus item place). Words put in or left out shift the rest to another diagonal, so neighbouring diagonals are joined to chains
that increase in item and document; each diagonal also counts alone. Where the item's windows hold slots, the slots must be filled consistently: one value of the
item always stands for one value of the document. Equal values are a verbatim copy, changed ones a re-parameterised
question; fillings that contradict each other are chance.

A document holds an item if a chain has all words of half of the item's windows, or windows over 25 words.

* Numbers: digits with inner points or commas. Names: capitalised words, wherever they stand, but for a fixed list of words that often start sentences.
  Units: words of a fixed list right after a number.
* Items of three to seven words are sought by one window of that length. Windows with fewer than four words besides numbers
  and units are sought by value, all words equal. An item of one or two words is found where it is all that a document says.
* Null texts have no windows. Texts of any length are read whole. Items with one id are sought each, and reported by their id. Rows of one id count as one document; a null id is reported as null and its rows stay
  in `drop_contaminated`. Ties between diagonals go to the smaller one. Empty tables give no rows. Only the id and text columns of
  both tables are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.versions import broadcast_if_small
from tablesync.session import settle

WINDOW = 8
SHORTEST = 3
LITERALS = 4
COVERAGE = 0.5
LONG_MATCH = 25
#: Words by which the diagonals of one chain may differ from the one it starts from.
SHIFT = 8
#: Rows of benchmark windows (28 bytes each) up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000

NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
# Words that count as units after a number.
UNITS = "km|m|cm|mm|mi|miles?|meters?|metres?|feet|foot|ft|inch(?:es)?|kg|g|mg|grams?|pounds?|lbs?|tons?|l|ml|liters?|litres?|seconds?|secs?|minutes?|mins?|hours?|hrs?|days?|weeks?|months?|years?|dollars?|cents?|euros?|percent|degrees?|mph|kmh"

#: Words that are no names though they start sentences.
STARTERS = (
    "a|an|the|this|that|these|those|in|on|at|of|to|for|from|with|by|and|or|but|if|when|while|after|before|as|since|he|she|it|they|we|you|i|his|her|its|their|our|your|my"
    "|what|which|who|whom|whose|where|why|how|is|are|was|were|do|does|did|can|could|will|would|should|has|have|had|there|here|then|than|so|not|no|each|every|all|some|any"
    "|find|calculate|compute|determine|show|prove|let|given|suppose|assume|consider|solve|der|die|das|ein|eine|und|oder|wenn|wie|was|wer|wo|warum|ist|sind|es|er|sie|wir"
    "|el|la|los|las|un|una|y|o|si|que|cómo|qué|quién|dónde|por|para|le|les|une|et|ou|des|du|est|que|quel|quelle|comment|pourquoi"
)


def marked_words(text: Column) -> Column:
    """Lower-case words, those of a type led by its mark."""
    plain = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, "   ")
    named = F.regexp_replace(plain, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{M}}\p{{N}}])(?!(?iu:{STARTERS})(?![\p{{L}}\p{{M}}]))\p{{Lu}}", f"{NAME}$0")
    numbered = F.regexp_replace(named, r"\p{N}+(?:[.,]\p{N}+)*", f"{NUMBER}$0")
    united = F.regexp_replace(F.lower(numbered), rf"({NUMBER}[\p{{N}}.,]*\p{{N}})\s*{NAME}?({UNITS})(?!\p{{L}})", f"$1 {UNIT}$2")
    return F.regexp_extract_all(united, F.lit(rf"[{NAME}{UNIT}]?\p{{L}}[\p{{L}}\p{{M}}]*|{NUMBER}\p{{N}}+(?:[.,]\p{{N}}+)*"), F.lit(0))


def is_slot(word: Column) -> Column:
    return word < "\x04"


def value(word: Column) -> Column:
    """The word without its mark."""
    return F.when(is_slot(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def is_amount(word: Column) -> Column:
    return is_slot(word) & (word >= NUMBER)


#: The ways to read a word: names and amounts as slots, amounts alone, all words by value.
SLOTS = [is_slot, is_amount, lambda word: F.lit(False)]


def word_hashes(words: Column, ways: list[int]) -> Column:
    """An array of structs with the hash of each word in each of the ways, as h0, h1, h2."""
    return F.transform(words, lambda w: F.struct(*[F.xxhash64(F.when(SLOTS[way](w), F.substring(w, 1, 1)).otherwise(value(w))).alias(f"h{way}") for way in ways]))


def runs(hashes: Column, size: int) -> Column:
    """The hash of each `size` neighbouring entries. Hashes of 2, 4 and 8 are put together from two of half that length, and
    other sizes from these, so that an entry costs a few hashes of two numbers whatever the size is."""
    ahead = lambda a, by: F.slice(a, F.lit(1 + by), F.size(a)) if by else a
    both = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    whole = lambda a: F.slice(a, F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0)))

    def joined(power: Column, width: int, rest: int, done: Column | None, offset: int) -> Column:
        if rest & width:
            part = ahead(power, offset)
            done = part if done is None else both(done, part)
            offset, rest = offset + width, rest - width
        if not rest:
            return whole(done)  # what reaches over the end of the array is cut off here
        return let(both(power, ahead(power, width)), lambda wider: joined(wider, 2 * width, rest, done, offset))

    return joined(hashes, 1, size, None, 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def item_windows(items: DataFrame) -> DataFrame:
    """(item, size, windows, place, way, key) of an item's windows, in the ways that leave enough words; `windows` counts them once.

    Those that numbers and units leave too few words are sought by value.
    """
    told = None
    for size in range(SHORTEST, WINDOW + 1):
        long_enough = items.where(F.size("words") >= size if size == WINDOW else F.size("words") == size)
        hashed = long_enough.select("item", "words", word_hashes(F.col("words"), [0, 1, 2]).alias("read"))
        keys = hashed.select("item", "words", *[runs(F.col(f"read.h{way}"), size).alias(f"keys{way}") for way in range(len(SLOTS))])
        opened = keys.select("*", F.size("keys0").alias("windows"), F.explode(F.sequence(F.lit(1), F.size("keys0"))).alias("place"))
        left = [size - F.size(F.filter(F.slice("words", F.col("place"), F.lit(size)), slot)) for slot in SLOTS[:2]]
        sought = [left[0] >= LITERALS, left[1] >= LITERALS, left[1] < LITERALS]
        keyed = [F.when(use, F.struct(F.lit(way).alias("way"), F.get(f"keys{way}", F.col("place") - 1).alias("key"))) for way, use in enumerate(sought)]
        rows = opened.select("item", F.lit(size).alias("size"), "windows", "place", F.inline(F.array_compact(F.array(*keyed))))
        told = rows if told is None else told.union(rows)
    return told


def hits(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, of, item, diagonal, places, windows, size) of the diagonals with hits; `of` is the hash of the text."""
    found = windows.select("size", "way").distinct().collect()  # a few rows
    few = windows.count() <= BROADCAST_ROWS
    worded = texts.select("doc_id", "of", marked_words(F.col("text")).alias("words"))
    opened = None
    for size in sorted({r["size"] for r in found}) or [WINDOW]:
        ways = sorted({r["way"] for r in found if r["size"] == size}) or [0]
        read = worded.where(F.size("words") >= size).select("doc_id", "of", word_hashes(F.col("words"), ways).alias("read"))
        hashed = read.select("doc_id", "of", *[runs(F.col(f"read.h{way}"), size).alias(f"k{way}") for way in ways])
        places = hashed.select("doc_id", "of", F.posexplode(F.arrays_zip(*[f"k{way}" for way in ways])).alias("at", "keys"))
        keys = [F.col("keys")[f"k{way}"] for way in ways]
        keys = [F.when(~k.isin(*keys[:i]), k) if i else k for i, k in enumerate(keys)]  # ways that read a window alike count once
        rows = places.select("doc_id", "of", "at", F.explode(F.array(*keys)).alias("key"), F.lit(size).alias("size")).where("key is not null")
        opened = rows if opened is None else opened.union(rows)
    # windows that read alike in two ways have one key
    sought = windows.drop("way").distinct()
    met = opened.join(F.broadcast(sought) if few else sought, ["key", "size"])
    return met.groupBy("doc_id", "of", "item", (F.col("at") + 1 - F.col("place")).alias("diagonal")).agg(
        F.array_sort(F.collect_set("place")).alias("places"), F.first("windows").alias("windows"), F.first("size").alias("size")
    )


def aligned(near: Column, size: Column, start: Column) -> Column:
    """(place, diagonal) of the item's words along one chain of hit windows, increasing in item and document.

    `near` holds (diagonal, places). The chain stays on its diagonal while that is hit, else it goes on with the next hit.
    """
    hit = F.flatten(F.transform(near, lambda n: F.transform(n["places"], lambda p: F.struct(p.alias("place"), F.abs(n["diagonal"] - start).alias("far"), n["diagonal"].alias("diagonal")))))
    places = F.map_from_entries(near)
    none = F.array().cast("array<struct<place:int,diagonal:int>>")
    state = F.struct(F.lit(0).alias("last"), F.lit(0).alias("upto"), start.alias("on"), F.lit(None).cast("int").alias("end"), none.alias("words"))

    def step(s: Column, h: Column) -> Column:
        first = F.greatest(h["place"], s["upto"] + 1)
        until = h["place"] + size - 1
        stays = (h["diagonal"] == s["on"]) | ~F.coalesce(F.array_contains(F.try_element_at(places, s["on"]), h["place"]), F.lit(False))
        fits = stays & (h["place"] > s["last"]) & (until >= first) & (s["end"].isNull() | (first + h["diagonal"] > s["end"]))
        more = F.transform(F.sequence(first, until), lambda q: F.struct(q.alias("place"), h["diagonal"].alias("diagonal")))
        moved = F.struct(h["place"].alias("last"), until.alias("upto"), h["diagonal"].alias("on"), (until + h["diagonal"]).alias("end"), F.concat(s["words"], more).alias("words"))
        return F.when(fits, moved).otherwise(s)

    return F.aggregate(F.array_sort(hit), state, step, lambda s: s["words"])


def chains(hit: DataFrame) -> DataFrame:
    """(doc_id, of, item, diagonal, cover, coverage, n_words) for every diagonal, alone and with those up to SHIFT words away."""
    around = Window.partitionBy("doc_id", "of", "item").orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    # few bytes but much work: a number of its own keeps adaptive execution from making one task of it
    tasks = int(hit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = hit.repartition(tasks, "doc_id", "of", "item").withColumn("near", F.collect_list(F.struct("diagonal", "places")).over(around))
    alone = F.array(F.struct("diagonal", "places"))
    both = F.when(F.size("near") > 1, F.array(alone, F.col("near"))).otherwise(F.array(alone))
    near = near.select("doc_id", "of", "item", "diagonal", "windows", "size", F.explode(both).alias("near"))
    told = near.withColumn("cover", aligned(F.col("near"), F.col("size"), F.col("diagonal"))).drop("near")
    # a window counts if all its words are in the chain, be it across a shift
    runs = F.size("cover") - F.col("size") + 1
    whole = F.filter(F.sequence(F.lit(1), runs), lambda i: F.element_at("cover", (i + F.col("size") - 1).cast("int"))["place"] - F.element_at("cover", i)["place"] == F.col("size") - 1)
    return told.withColumn("coverage", F.size(whole) / F.col("windows")).withColumn("n_words", F.size("cover"))


def whole_texts(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item) of documents that are, word for word, an item too short for windows."""
    short = items.where(F.size("words").between(1, SHORTEST - 1)).select("item", F.transform("words", value).alias("said"))
    said = F.transform(marked_words(F.col("text")), value)
    docs = texts.select("doc_id", said.alias("said")).where(F.size("said").between(1, SHORTEST - 1))
    spoken = lambda table, *names: table.select(*names, F.concat_ws(" ", "said").alias("said"))
    return spoken(docs, "doc_id").join(broadcast_if_small(spoken(short, "item")), "said").select("doc_id", "item")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, coverage, n_words, n_slots, kind) of every document and item it holds; kind is verbatim or reparameterised."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("of", F.xxhash64("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), marked_words(F.col(item_text).cast("string")).alias("words")).distinct()
    # several texts may share an id: an item is its id and its words
    items = items.withColumn("item", F.xxhash64(F.col("item_id").cast("string"), F.concat_ws(" ", "words")))
    windows = settle(item_windows(items), "benchmark-windows")
    on = chains(settle(hits(texts, windows), "hits"))
    on = settle(on.where((F.col("coverage") >= COVERAGE) | (F.col("n_words") >= LONG_MATCH)), "diagonals")
    wanted = on.select("of").distinct()
    words = texts.join(wanted, "of", "left_semi").select(F.col("doc_id").alias("id"), "of", marked_words(F.col("text")).alias("doc_words")).distinct()
    same = (on["of"] == words["of"]) & on["doc_id"].eqNullSafe(words["id"])
    filled = on.join(words, same).drop(words["of"], words["id"]).join(items, "item")
    slots = F.filter("cover", lambda c: is_slot(F.element_at("words", c["place"])))
    pairs = F.transform(slots, lambda c: F.struct(value(F.element_at("words", c["place"])).alias("item"), value(F.try_element_at("doc_words", (c["place"] + c["diagonal"]).cast("int"))).alias("doc")))
    filled = filled.withColumn("pairs", F.array_distinct(pairs))
    values = F.array_distinct(F.transform("pairs", lambda x: x["item"]))
    consistent = filled.where(F.size(values) == F.size("pairs"))
    equal = ~F.exists("pairs", lambda x: ~x["item"].eqNullSafe(x["doc"]))
    best = F.struct("coverage", "n_words", equal.cast("int").alias("same"), (-F.col("diagonal")).alias("d"), F.size("pairs").alias("n_slots"))
    # a document that is a short item, and no more
    short = whole_texts(texts, items).join(items, "item")
    no_slots = F.struct(F.lit(1.0).alias("coverage"), F.size("words").alias("n_words"), F.lit(1).alias("same"), F.lit(0).alias("d"), F.lit(0).alias("n_slots"))
    told = consistent.select("doc_id", "item_id", best.alias("x")).union(short.select("doc_id", "item_id", no_slots))
    one = told.groupBy("doc_id", "item_id").agg(F.max("x").alias("best"))
    kind = F.when(F.col("best.same") == 1, "verbatim").otherwise("reparameterised")
    return one.select("doc_id", "item_id", "best.coverage", "best.n_words", "best.n_slots", kind.alias("kind"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no item, with the columns they had."""
    held = contaminated(docs, benchmark, id_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(held, id_col, "left_anti").select(docs.columns)
