"""Benchmark decontamination as a prefix-filtered set join, in built-in expressions only.

Items are cut into windows of ``width`` consecutive words (an item of fewer words is one window). A window can
only occur where all its shingles (pairs of neighbouring words) occur, so for exact containment one shingle is the
necessary prefix: the rarest one in the corpus, ties by its place. Shingle counts come from one pass over the
corpus restricted to shingles of the benchmark. A second pass joins the shingles of documents with the prefixes;
the place of the shingle in its window and the length of the text bound where the window can lie, and the words at
that place are compared exactly. Shingle keys are hashes of upper-cased words: a collision or a
difference in case only costs a comparison.

The benchmark side is broadcast while it has at most ``broadcast_rows`` windows; beyond that the joins
shuffle, and each shingle row carries only the words around it. No group is larger than one text.

NULL and empty texts have no words. Repeated rows each get their result; rows are told apart by key and text.
NULL item ids are left out of the item list, their windows still count as hits. An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stage
from .sieve import split_by

WIDTH = 13
BROADCAST_ROWS = 300_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, before letters are lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def pieces_of(text: Column) -> Column:
    """Words in order; the first and the last element may be empty."""
    return F.split(F.coalesce(text, F.lit("")), _BETWEEN, -1)


def word_count(pieces: Column) -> Column:
    n = F.size(pieces)
    return (
        n - (F.element_at(pieces, 1) == "").cast("int") - ((n > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    ).cast("long")


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def shingle_key(word: Column, following: Column) -> Column:
    """A NULL ``following`` gives the key of the single word."""
    return F.xxhash64(F.upper(word), F.upper(following))


def windows_of(items: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """(window, n, words, item): the lower-cased words of each window, joined by blanks, for each item."""
    words = F.filter(pieces_of(lowered(F.col(f"`{text}`"))), lambda w: w != "")
    cut = items.select(F.col(f"`{item}`").cast("string").alias("item"), words.alias("all")).where(F.size("all") > 0)
    cut = cut.select("item", "all", F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))).alias("i"))
    cut = cut.select("item", F.slice("all", F.col("i"), width).alias("words"))
    return cut.select(F.array_join("words", " ").alias("window"), F.size("words").alias("n"), "words", "item")


def shingles(words: DataFrame, single: bool) -> DataFrame:
    """One row for each place in a text: its index from 0 and its key."""
    rows = words.select("*", F.posexplode("pieces").alias("place", "word"))
    following = F.lit(None).cast("string") if single else F.get("pieces", F.col("place") + 1)
    return rows.withColumn("key", shingle_key(F.col("word"), following))


def hits(docs: DataFrame, windows: DataFrame, small: bool, single: bool) -> DataFrame:
    """(columns of docs without pieces, begin, n, window): every place where a window occurs."""
    marked = F.broadcast if small else (lambda df: df)
    if single:
        keys = windows.select("window", "n", F.lit(0).alias("at"), shingle_key(F.col("window"), F.lit(None).cast("string")).alias("key"))
    else:
        pairs = windows.select(
            "window", "n", "words", F.posexplode(F.slice("words", 1, F.size("words") - 1)).alias("at", "word")
        ).select("window", "n", "at", shingle_key(F.col("word"), F.get("words", F.col("at") + 1)).alias("key"))
        pairs = stage(pairs, "shingles")
        seen = shingles(docs.select("pieces"), single).select("key")
        counts = seen.join(marked(pairs.select("key").distinct()), "key", "left_semi").groupBy("key").agg(F.count("*").alias("c"))
        # a shingle that the corpus lacks rules its window out
        rarest = pairs.join(marked(stage(counts, "shingle-counts")), "key", "left")
        rarest = rarest.groupBy("window", "n").agg(
            F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "at", "key")).alias("p")
        )
        keys = rarest.where("p.c > 0").select("window", "n", F.col("p.at").alias("at"), F.col("p.key").alias("key"))
        keys = stage(keys, "prefixes")
    places = shingles(docs, single)
    if not small:  # carry only the words that a window through this place can hold
        around = WIDTH if single else int(windows.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0])
        low = F.greatest(F.col("place") - around, F.lit(0))
        places = places.withColumn("pieces", F.slice("pieces", low + 1, 2 * around + 1)).withColumn("shift", low)
    else:
        places = places.withColumn("shift", F.lit(0))
    begin = F.col("place") - F.col("at") - F.col("shift")
    met = places.join(marked(keys), "key").where((begin >= 0) & (begin + F.col("n") <= F.size("pieces")))
    met = met.where(lowered(F.array_join(F.slice("pieces", begin + 1, F.col("n")), " ")) == F.col("window"))
    return met.withColumn("begin", F.col("place") - F.col("at")).drop("pieces", "place", "word", "key", "at", "shift")


def covered(spans: Column) -> Column:
    """Places in the union of (begin, end) spans."""
    start = F.struct(F.lit(0).cast("int").alias("n"), F.lit(-1).cast("int").alias("end"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["end"] - F.greatest(x["begin"], s["end"]), F.lit(0))).cast("int").alias("n"),
            F.greatest(x["end"], s["end"]).cast("int").alias("end"),
        ),
        lambda s: s["n"].cast("long"),
    )


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, share: int = 20, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``docs``: key, digest of its text, n_words, n_hit, n_items, items (sorted), contaminated.

    Contaminated: at least one word is hit and hit words times ``share`` reach the words of the text.
    """
    owned = stage(windows_of(items, item, item_text, width), "windows")
    windows = owned.select("window", "n", "words").distinct()
    n_windows, n_single = owned.agg(F.count("*"), F.coalesce(F.sum((F.col("n") == 1).cast("int")), F.lit(0))).first()
    small = n_windows <= broadcast_rows
    rows = docs.select(
        F.col(f"`{key}`").alias("_key"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("_digest"),
        pieces_of(F.col(f"`{text}`")).alias("pieces"),
    )
    found = hits(rows, windows.where("n > 1"), small, single=False)
    if n_single:
        found = found.unionByName(hits(rows, windows.where("n = 1"), small, single=True))
    found = stage(found.distinct(), "hits")
    by_item = found.join(F.broadcast(owned.select("window", "item")) if small else owned.select("window", "item"), "window")
    group = ["_key", "_digest"]
    spans = found.groupBy(*group).agg(
        covered(F.collect_set(F.struct("begin", (F.col("begin") + F.col("n")).alias("end")))).alias("n_hit")
    )
    named = by_item.groupBy(*group).agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = lambda a, b: a["_key"].eqNullSafe(b["_key"]) & (a["_digest"] == b["_digest"])
    hit = stage(
        spans.join(named, same(spans, named), "left").select(spans["_key"], spans["_digest"], "n_hit", "items"), "hit-texts"
    )
    counted = rows.select("_key", "_digest", word_count(F.col("pieces")).alias("n_words"))
    joined = counted.join(hit, same(counted, hit), "left").select(
        counted["_key"].alias(key), counted["_digest"].alias("digest"), "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return joined.select(
        "*", F.size("items").cast("long").alias("n_items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, items, key, text, **options).where("contaminated").select(
        F.col(f"`{key}`").alias("_key"), F.col("digest").alias("_digest")
    )
    bad = stage(bad.distinct(), "contaminated")
    # the columns of docs go as one struct, so none can clash; texts that are certainly clean stay where they are
    column = lambda name: F.col(f"`{name}`")
    digest = F.md5(F.coalesce(column(text), F.lit("")).cast("binary"))
    packed = docs.select(F.struct(*map(column, docs.columns)).alias("row"), column(key).alias("key"), digest.alias("digest"))
    others, maybe = split_by(packed, F.col("digest"), bad, "_digest")
    clean = maybe.join(bad, F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")), "left_anti")
    return others.select("row.*").unionByName(clean.select("row.*"))
