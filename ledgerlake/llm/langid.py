"""Language by cross-parsing entropy: the language whose labelled text needs the fewest phrases for a text wins.

A text is parsed greedily into phrases, each the longest match in a language's sample; a suffix automaton of the sample
follows the match letter by letter. A phrase costs log2(sample size + 256) bits, a place in the sample or a
new byte, so that samples of unequal sizes compare; the language with the least cost wins (ties, as of single common
words: the label with more rows, then the smaller name). The score is the share of the winner when every language has the weight 2^-cost per letter, over at most
``WEIGHED`` letters: 1 if no other comes near, one over the number of languages if all are alike.

*Learning* is bounded: of each of the ``LANGUAGES`` most frequent labels, the slices (the first ``SLICE`` characters) of
distinct texts in order of a hash, together ``SAMPLE_BYTES`` over all languages. Copies collapse before
they are shuffled. One task per language builds an automaton and returns its edges; tables for parsing are made from them
in the workers, about 120 MB whatever the number of languages. *Prediction* reads every row and whole texts.

Letters are bytes: ASCII letters in small letters, runs of other ASCII characters as one space, other characters as the
bytes of their small letters. Many pieces of texts are parsed at once in numpy. A piece begins as if a phrase began
there; where the piece before left a match open, it is parsed again until both parses begin a phrase at one place, so
the result is the parse of the whole text.

NULL, empty texts and texts without a letter are ``und`` with score 0, and so is every text if nothing can be learnt.
Rows with a NULL label or text teach nothing. Repeated rows are predicted one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import arrow_map, held, share, stage, text_chunks

UNKNOWN = "und"
LANGUAGES = 256
SAMPLE_BYTES = 400_000
SLICE = 400
#: How many times the texts needed are looked at, for want of which copies of one text leave a smaller sample.
SPARE = 8
#: Letters of a text that weigh in its score; its language is decided by all of them.
WEIGHED = 64
#: Bytes parsed in step with each other, and the length of one piece.
AT_ONCE = 1 << 20
PIECE = 256

_SPACE = 32
_LETTERS = np.full(256, _SPACE, dtype=np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def letters_of(text: str) -> np.ndarray:
    """Bytes of the small letters, every run of other ASCII characters as one space."""
    raw = _LETTERS[np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)]
    gap = raw == _SPACE
    again = np.zeros(len(raw), dtype=bool)
    again[1:] = gap[1:] & gap[:-1]
    return raw[~again]


def automaton(text: bytes) -> np.ndarray:
    """Edges (state, byte, state) of the suffix automaton of ``text``; state 0 is the empty match."""
    follow: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for letter in text:
        new = len(follow)
        follow.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and letter not in follow[p]:
            follow[p][letter] = new
            p = link[p]
        if p >= 0:
            q = follow[p][letter]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(letter) == q:
                    follow[p][letter] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    edges = [(state, letter, to) for state, out in enumerate(follow) for letter, to in out.items()]
    return np.array(edges, dtype=np.int32).reshape(-1, 3)


@dataclass
class Language:
    name: str
    size: int
    edges: np.ndarray

    @property
    def bits(self) -> float:
        return math.log2(self.size + 256)


@dataclass
class Model:
    """The languages, and the column of every byte in the tables (0: in no sample; the last one: past a text's end)."""

    languages: list[Language]
    columns: np.ndarray
    width: int

    def table(self, language: Language) -> np.ndarray:
        """next[state * width + column] = next state * width * 2, plus 1 where a new phrase begins with the byte."""
        states = int(language.edges[:, 2].max(initial=0)) + 1
        table = np.zeros((states, self.width), dtype=np.int32)
        state, letter, to = language.edges.T
        goal = to * np.int32(self.width * 2)
        table[state, self.columns[letter]] = goal
        fresh = table[0] | 1  # a byte that is nowhere in the sample is a phrase of its own
        table = np.where(table == 0, fresh, table)
        table[0] = fresh
        table[:, -1] = np.arange(states, dtype=np.int32) * (self.width * 2)
        return table.ravel()


def model_of(languages: list[Language]) -> Model:
    used = np.unique(np.concatenate([np.zeros(0, np.int32), *[x.edges[:, 1] for x in languages]]))
    columns = np.zeros(256, dtype=np.uint8 if len(used) < 254 else np.uint16)
    columns[used] = np.arange(1, len(used) + 1)
    return Model(languages, columns, len(used) + 2)


def train(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text", most_languages: int = LANGUAGES,
          sample_bytes: int = SAMPLE_BYTES, slice_chars: int = SLICE) -> Model:
    """A model of the rows of ``docs`` where ``learn`` holds."""
    rows = docs.where(learn).select(F.col(f"`{lang}`").cast("string").alias("name"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("name is not null and text is not null")
    seen = dict(rows.groupBy("name").count().orderBy(F.desc("count"), "name").limit(most_languages).collect())
    names = list(seen)
    if not names:
        return model_of([])
    room = max(sample_bytes // len(names), 1)
    per_language = -(-room // slice_chars) * 2
    # hashes are kept below a limit that leaves about SPARE times the texts needed, so the ranks see a bounded number
    below = {name: min(1 << 32, (SPARE * per_language << 32) // n + 1) for name, n in seen.items()}
    limits = F.create_map(*[F.lit(x) for pair in below.items() for x in pair])
    hashed = rows.withColumn("h", F.xxhash64("text")).where(F.col("name").isin(names))
    hashed = hashed.where(F.pmod("h", F.lit(1 << 32)) < F.element_at(limits, F.col("name")))
    # copies meet in one row before the shuffle
    known = hashed.groupBy("name", "h").agg(F.lit(1))
    chosen = known.select("name", "h", F.expr("row_number() over (partition by name order by h)").alias("rank")).where(F.col("rank") <= per_language)
    # per_language x languages is at most 2 x sample bytes / slice, plus two a language
    slices = hashed.join(F.broadcast(chosen.select("name", "h")), ["name", "h"])
    slices = slices.groupBy("name", "h").agg(F.min(F.left("text", F.lit(slice_chars))).alias("slice"))

    def build(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("h").to_numpy(), kind="stable")
        texts = group.column("slice").to_pylist()
        sample = b" ".join([letters_of(texts[i]).tobytes() for i in order])[:room]
        edges = automaton(sample)
        return pa.table({"name": group.column("name").slice(0, 1), "size": [len(sample)], "edges": pa.array([edges.tobytes()], pa.binary())})

    made = stage(slices, "language-slices").groupBy("name").applyInArrow(build, "name string, size bigint, edges binary").collect()
    return model_of([Language(r[0], r[1], np.frombuffer(r[2], np.int32).reshape(-1, 3)) for r in sorted(made, key=lambda r: names.index(r[0]))])


def pieces_of(texts: list[np.ndarray], piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters cut into pieces (one per column, padded with 256), the text of each, and whether the one before is of it too."""
    counts = np.array([-(-len(x) // piece) for x in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = np.full((len(owner), piece), 256, dtype=np.int64)
    end = np.cumsum(counts)
    for i, x in enumerate(texts):
        flat[end[i] - counts[i] : end[i]].reshape(-1)[: len(x)] = x
    follows = np.concatenate([[False], owner[1:] == owner[:-1]]) if len(owner) else np.zeros(0, dtype=bool)
    return np.ascontiguousarray(flat.T), owner, follows


def phrases(table: np.ndarray, cells: np.ndarray, owner: np.ndarray, follows: np.ndarray, n: int) -> np.ndarray:
    """Phrases of each of ``n`` texts: every step takes one letter of all pieces."""
    length, lanes = cells.shape
    begins = np.zeros((length, lanes), dtype=np.uint8)
    state = np.zeros(lanes, dtype=np.int32)
    for t in range(length):
        got = table.take((state >> 1) + cells[t])
        np.bitwise_and(got, 1, out=begins[t], casting="unsafe")
        state = got & ~1
    count = begins.sum(axis=0, dtype=np.int64)
    leaves = state  # the match that each piece leaves open
    taken = np.zeros(lanes, dtype=np.int32)  # the match with which its parse began
    extra = np.zeros(lanes, dtype=np.int64)
    while True:
        given = np.where(follows, np.concatenate([taken[:1], leaves[:-1]]), 0)
        lane = np.flatnonzero(given != taken)
        if not len(lane):
            break
        taken = given
        extra[lane] = 0
        now, t = given[lane], 0
        leaves = leaves.copy()
        while len(lane) and t < length:
            got = table.take((now >> 1) + cells[t, lane])
            flag, was = got & 1, begins[t, lane]
            extra[lane] += flag - was.astype(np.int64)
            now = got & ~1
            t += 1
            apart = (flag & was) == 0  # where both begin a phrase with this letter they go on alike
            met = lane[~apart]
            leaves[met] = state[met]
            lane, now = lane[apart], now[apart]
        leaves[lane] = now
    return np.bincount(owner, weights=count + extra, minlength=n).astype(np.int64)


def costs(model: Model, tables: list[np.ndarray], texts: list[np.ndarray], piece: int = PIECE) -> np.ndarray:
    """Bits of every text in every language."""
    letters, owner, follows = pieces_of(texts, piece)
    columns = np.append(model.columns.astype(np.int32), np.int32(model.width - 1))
    cells = columns[letters]
    out = np.zeros((len(texts), len(tables)))
    for i, (language, table) in enumerate(zip(model.languages, tables)):
        out[:, i] = phrases(table, cells, owner, follows, len(texts)) * language.bits
    return out


def predict(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, the language and its score."""
    shared = share(docs, model)
    base = docs.drop(lang, score)
    at = base.columns.index(text)
    schema = T.StructType([*base.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held(shared)
        names = np.array([x.name for x in fitted.languages], dtype=object)
        tables = None
        for batch in batches:
            for part, _ in text_chunks(batch, batch.schema.names[at], AT_ONCE):
                if tables is None:
                    tables = [fitted.table(x) for x in fitted.languages]
                raw = part.column(at).to_pylist()
                lettered = np.array([any(map(str.isalpha, x or "")) for x in raw]) & bool(len(names))
                found, value = np.full(len(raw), UNKNOWN, dtype=object), np.zeros(len(raw))
                rows = np.flatnonzero(lettered)
                if len(rows):
                    texts = [letters_of(raw[i]) for i in rows]
                    bits = costs(fitted, tables, texts)
                    best = bits.argmin(axis=1)
                    found[rows] = names[best]
                    size = np.array([len(x) for x in texts])
                    more = (bits - bits.min(axis=1, keepdims=True)) / size[:, None] * np.minimum(size, WEIGHED)[:, None]
                    value[rows] = 1 / np.exp2(-more).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found.tolist(), pa.string()), pa.array(value)], names=[*part.schema.names, lang, score]
                )

    return arrow_map(base, run, schema)
