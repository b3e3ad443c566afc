"""Spelling variants by a variable-length gram index: words one edit apart, the form of each word and its root.

Words are counted over all texts first, so everything after works on distinct words. Then

1. *Gram dictionary.* Grams of 2 to 4 letters are counted over the vocabulary. A gram that occurs often is not kept but
   extended by its next letter, so common beginnings are pruned in favour of longer, rarer grams. Counts are held by
   classes of a hash, in a table of one size for any vocabulary.
2. *Decomposition.* At each place of a word stands one gram: the shortest one there that is not frequent.
3. *Affected grams.* An edit at a letter changes only grams over that letter, one behind the last letter only grams
   that end there and would go on. The most that one edit changes, ``m``, is known per word: a near word has all the
   others, at the same place or one further.
4. *List merging.* So of two near words one of the ``m + 1`` rarest grams of each is shared (rarest by one order over
   all grams), with lengths and places that fit; only these are written to lists and joined. Lists longer than
   ``LONG`` are dealt to several tasks, each of which gets all who ask that list.
5. *Verification* where a pair meets, by letters and then by edit distance; only true pairs leave a task.

``m`` is at most the longest gram, so with words of at least as many letters as the shortest and the longest gram
together, a gram is always left; shorter words are refused.

NULL and empty texts have no words. A NULL key counts as the empty text when letters are dropped. Repeated rows count
as often as they are there. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, held, mix64, picked, share, stage

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least this many times as frequent as the word.
TIMES = 10
DROP_EVERY = 31
SHORTEST, LONGEST = 2, 4
#: A gram that occurs so often in the vocabulary is extended by its next letter.
OFTEN = 24
#: Grams are counted by classes of their hash, 2^21 of them for any vocabulary; a full class extends its grams sooner.
CLASS_BITS = 21
#: Lists longer than this are dealt to several tasks.
LONG = 4_000
#: Lists so long that they are dealt are broadcast up to this number, joined by a shuffle beyond.
BROADCAST_ROWS = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n): runs of letters in small letters; where ``drop_every`` divides crc32 of "key:run" one letter is dropped."""
    rows = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"),
        # a greedy run of at least so many letters is a whole run, since a search tries every start from the left
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"),
    )
    rows = rows.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    rows = rows.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    rows = rows.select(F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("run")).alias("word"))
    counted = rows.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


class Grams:
    """The grams of up to eight letters of many words at once: letters are one byte each, so a gram is one number."""

    def __init__(self, words: pa.Array):
        self.size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.end = np.cumsum(self.size)
        letters = np.frombuffer("".join(words.to_pylist()).encode("latin-1"), dtype=np.uint8).astype(np.uint64)
        self.letters = np.concatenate([letters, np.zeros(8, dtype=np.uint64)])
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(letters)) - np.repeat(self.end - self.size, self.size)
        self.left = np.repeat(self.size, self.size) - self.place

    def of(self, length: int) -> np.ndarray:
        """The gram of ``length`` letters at every place; where fewer are left it is not to be used."""
        out, n = np.zeros(len(self.owner), dtype=np.uint64), len(self.owner)
        for i in range(length):
            out = (out << np.uint64(8)) | self.letters[i : n + i]
        return out


def class_of(grams: np.ndarray) -> np.ndarray:
    return (mix64(grams) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def gram_counts(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """(class, n): how often grams of each class stand in the distinct words; tasks add up before the shuffle."""

    def run(batches):
        seen = np.zeros(1 << CLASS_BITS, dtype=np.int64)
        for batch in batches:
            grams = Grams(batch.column(0))
            for length in range(shortest, longest + 1):
                seen += np.bincount(class_of(grams.of(length)[grams.left >= length]), minlength=len(seen))
        found = np.flatnonzero(seen)
        for at in range(0, len(found), 1 << 16):
            some = found[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], names=["class", "n"])

    return arrow_map(picked(words, "word"), run, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n"))


@dataclass
class Dictionary:
    """Occurrences by class of grams, and the number from which a gram is extended."""

    counts: np.ndarray
    limit: int
    shortest: int
    longest: int

    def often(self, grams: np.ndarray) -> np.ndarray:
        return self.counts[class_of(grams)] >= self.limit


def dictionary(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, often: int = OFTEN) -> Dictionary:
    """The table has one size for any vocabulary; the limit rises once classes are full."""
    table = gram_counts(words, shortest, longest).toArrow()
    counts = np.zeros(1 << CLASS_BITS, dtype=np.int32)
    counts[table.column("class").to_numpy()] = np.minimum(table.column("n").to_numpy(), np.iinfo(np.int32).max)
    return Dictionary(counts, max(often, 4 * int(counts.sum(dtype=np.int64)) >> CLASS_BITS), shortest, longest)


def listed(grams: Grams, known: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, gram, place): the rarest grams of every word, one more than an edit changes at most."""
    starts = grams.left >= known.shortest
    length = np.full(len(grams.owner), known.shortest)
    gram = grams.of(known.shortest)
    goes_on = starts
    for size in range(known.shortest, known.longest):
        goes_on = goes_on & (grams.left > size) & known.often(gram)
        length[goes_on] = size + 1
        gram = np.where(goes_on, grams.of(size + 1), gram)
    at = np.flatnonzero(starts)
    owner, gram, place, length = grams.owner[at], gram[at], grams.place[at], length[at]
    words = len(grams.size)
    n = np.bincount(owner, minlength=words)
    # an edit at a letter changes the grams over it
    over = np.bincount(at, minlength=len(starts) + 1) - np.bincount(at + length, minlength=len(starts) + 1)
    first = grams.end - grams.size
    most = np.maximum.reduceat(np.cumsum(over)[:-1], first) if words else n
    # a letter added behind the last changes the grams that end there and would go on
    open_end = (length == grams.left[at]) & (length < known.longest) & known.often(gram)
    most = np.maximum(most, np.bincount(owner[open_end], minlength=words))
    order = np.lexsort((place, gram, known.counts[class_of(gram)], owner))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
    chosen = order[rank <= most[owner[order]]]
    return owner[chosen], gram[chosen], place[chosen]


def list_of(gram: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A list holds the words of one length with a gram at one place."""
    return mix64(gram ^ mix64((place * 65_536 + size + 1).astype(np.uint64))).view(np.int64)


def letters_of(grams: Grams) -> np.ndarray:
    """Which letters a word has, as 64 bits; one edit changes two of them at most."""
    bits = np.uint64(1) << (grams.letters[: len(grams.owner)] & np.uint64(63))
    first = grams.end - grams.size
    return np.bitwise_or.reduceat(bits, first).view(np.int64) if len(first) else bits.view(np.int64)


def entries(words: DataFrame, known: Dictionary) -> DataFrame:
    """(word, n, letters, lists, asks): the lists a word stands in and those it asks."""
    shared = share(words, known)

    def nested(owner, values, n):
        order = np.argsort(owner, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[order], pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held(shared)
        for batch in batches:
            grams, n = Grams(batch.column(0)), batch.num_rows
            owner, gram, place = listed(grams, model)
            size = grams.size[owner]
            # a word asks those of its own length, and those longer by one, where a gram may stand one further
            own = list_of(gram, place, size)
            longer = [list_of(gram, place + step, size + 1) for step in (0, 1)]
            asks = nested(np.tile(owner, 3), np.concatenate([own, *longer]), n)
            columns = [*batch.columns, pa.array(letters_of(grams)), nested(owner, own, n), asks]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "letters", "lists", "asks"])

    return arrow_map(picked(words, "word", "n"), run, "word string, n bigint, letters bigint, lists array<bigint>, asks array<bigint>")


def merged(index: DataFrame, long: int = LONG) -> DataFrame:
    """(a, a_n, b, b_n): near words that meet in a list, ``a`` the shorter or smaller one, each pair once."""
    stands = index.select(F.explode("lists").alias("list"), *[F.col(c).alias(f"b_{c}") for c in ("word", "n", "letters")])
    asks = index.select(F.explode("asks").alias("list"), *[F.col(c).alias(f"a_{c}") for c in ("word", "n", "letters")])
    sizes = stands.groupBy("list").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > long)
    sizes = stage(sizes.select("list", F.ceil(F.col("size") / long).cast("int").alias("parts")), "long-lists")
    many = sizes.count()
    if many:
        parts = F.broadcast(sizes) if many <= BROADCAST_ROWS else sizes
        deal = F.coalesce(F.col("parts"), F.lit(1))
        stands = stands.join(parts, "list", "left").withColumn("part", F.pmod(F.xxhash64("b_word"), deal).cast("int")).drop("parts")
        asks = asks.join(parts, "list", "left").withColumn("part", F.explode(F.sequence(F.lit(0), deal - 1))).drop("parts")
    on = ["list", "part"] if many else ["list"]
    fits = (F.length("a_word") < F.length("b_word")) | (F.col("a_word") < F.col("b_word"))
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    met = asks.join(stands, on).where(alike & fits & (F.levenshtein("a_word", "b_word", 1) == 1))
    return met.select(F.col("a_word").alias("a"), F.col("a_n"), F.col("b_word").alias("b"), F.col("b_n")).distinct()


def near_pairs(words: DataFrame, often: int = OFTEN, long: int = LONG) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of ``words`` (word, n) that differ by one inserted, dropped or replaced letter."""
    return merged(stage(entries(words, dictionary(words, often=often)), "gram-index"), long)


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of ``forms`` (word, form): follows forms to the last, doubling the stride at each step."""
    chain = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps):
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        chain = stage(chain.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return chain


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = TIMES, often: int = OFTEN, long: int = LONG,
             **vocabulary_options) -> DataFrame:
    """One row per word: word, n, form (its most frequent near word, if ``times`` as frequent), form_n, n_near, root."""
    if vocabulary_options.get("least_length", LEAST_LENGTH) < SHORTEST + LONGEST:
        raise ValueError(f"words need {SHORTEST + LONGEST} letters or more")
    words = stage(vocabulary(docs, key, text, **vocabulary_options), "vocabulary")
    pairs = stage(near_pairs(words, often, long), "near-words")
    both = pairs.select("a", "b", "b_n").union(pairs.select("b", "a", "a_n")).toDF("word", "other", "other_n")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    table = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("n"))).alias("to"),
    )
    table = stage(table.select("word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.n").alias("form_n")), "forms")
    # every form is ``times`` as frequent as its word, so a chain has at most log(largest n) links
    largest, links = table.agg(F.max("n")).first()[0] or 0, 0
    while times > 1 and times ** (links + 1) <= largest:
        links += 1
    last = roots(table.where("form is not null"), max(links - 1, 0).bit_length())
    return table.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
