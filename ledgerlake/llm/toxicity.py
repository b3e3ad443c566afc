"""Toxicity by multiple-instance learning: a text is toxic if any of its sentences is.

A sentence is the set of its words, up to a word that ends in a stop or to the end of a line. Sentences without a word
do not count, and one that repeats in a text counts once. A sentence has the probability sigmoid(bias + sum of its words'
weights); a word's weight is the sum of the weights of its hashed parts (the word, its first three to six letters, its
last four). Sentences are combined by noisy-or, and only labels of whole texts are used: the gradient of the noisy-or
hands the blame to sentences, which are then reported as spans.

The noisy-or of many harmless sentences grows with their number. So a logistic curve over its hazard (the sum of
-log(1 - p)) and the number of sentences gives the score; it is fitted on a quarter of the sample that the weights have
not seen.

Training reads a bounded sample of labelled rows in one task (``per_label`` of each label, whole texts of at most
``sample_bytes``); scoring reads every row and whole texts, and a worker keeps the weights of words it has met. A NULL or
empty text, or one without a word, has no sentence and scores 0. Repeated rows are scored one by one. Without rows of
both labels every text scores the share of label 1.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import arrow_map, held, mix64, share, text_chunks
from .compression import fit_curve, logit
from .sampling import fitted_on_sample

PER_LABEL = 4000
SAMPLE_BYTES = 200_000
BITS = 18
LEAST_TEXTS = 3
#: Words whose weights a worker keeps before it starts afresh.
KEPT = 400_000

_h = xxhash.xxh3_64_intdigest
_EDGES = bytes(i for i in range(128) if not (48 <= i < 58 or 97 <= i < 123 or 65 <= i < 91))
_STOPS = (b".", b"!", b"?")
_TOKEN = re.compile(rb"[^ \t\n\r\x0b\x0c]+|\n")


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-cased words with their punctuation; a line break becomes a stop of its own."""
    return text.lower().replace(b"\n", b" . ").split()


def parts_of(word: bytes) -> list[int]:
    """Hashes of the parts of a word without its outer punctuation; lengths are in characters."""
    core = word.strip(_EDGES)
    if not core:
        return []
    if core.isascii():
        return [_h(core, 1), _h(core[-4:], 2), *[_h(core[:n], 3) for n in (3, 4, 5, 6) if len(core) > n]]
    chars = core.decode("utf-8", "replace")
    return [_h(core, 1), _h(chars[-4:], 2), *[_h(chars[:n], 3) for n in (3, 4, 5, 6) if len(chars) > n]]


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    share: float | None = None  # the constant score where there is nothing to learn from
    curve: tuple[float, ...] | None = None  # by 1, log hazard and log number of sentences; None: the noisy-or itself

    def lookup(self) -> Words:
        return Words(self.weights)


class Words(dict):
    """word -> row of growing tables: its weight, whether it ends a sentence, and whether it is more than punctuation."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.table, self.mask, self.weight, self.stop, self.real = memoryview(weights), len(weights) - 1, [], [], []

    def __missing__(self, word: bytes) -> int:
        at = len(self.weight)
        table, mask = self.table, self.mask
        parts = parts_of(word)
        self.weight.append(sum([table[h & mask] for h in parts]))
        self.stop.append(word.endswith(_STOPS))
        self.real.append(bool(parts))
        self[word] = at
        return at


_NONE = np.zeros(0, dtype=np.int64)


def sets_of(words: np.ndarray, ends: np.ndarray, stop: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, word) pairs and the text of every sentence, from words of all texts and the end of each text.

    Each word is there once in a sentence, each set of words once in a text.
    """
    if not len(words):
        return _NONE, _NONE, _NONE
    closes = stop[words]
    closes[ends[ends > 0] - 1] = True
    number = np.concatenate([[0], np.cumsum(closes)[:-1]])
    owner = np.zeros(int(number[-1]) + 1, dtype=np.int64)
    owner[number] = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    own, word = np.divmod(np.unique(number * len(stop) + words), len(stop))
    own, word = own[real[word]], word[real[word]]
    if not len(own):
        return _NONE, _NONE, _NONE
    first = np.flatnonzero(np.diff(own, prepend=-1))
    owner = owner[own[first]]
    with np.errstate(over="ignore"):
        sets = mix64(np.add.reduceat(mix64(word + 1), first) ^ mix64(~owner))
    kept = np.zeros(len(first), dtype=bool)
    kept[np.unique(sets, return_index=True)[1]] = True
    size = np.diff(np.append(first, len(own)))
    return np.repeat(np.cumsum(kept) - 1, size)[np.repeat(kept, size)], word[np.repeat(kept, size)], owner[kept]


def sigmoid(logits):
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def sentences(words: Words, texts: list[bytes], bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Probability of every sentence and the number of its text."""
    ids: list[int] = []
    ends = np.zeros(len(texts), dtype=np.int64)
    get = words.__getitem__
    for i, text in enumerate(texts):
        ids.extend(map(get, tokens_of(text)))
        ends[i] = len(ids)
    own, word, owner = sets_of(np.array(ids, dtype=np.int64), ends, np.array(words.stop, dtype=bool), np.array(words.real, dtype=bool))
    logits = bias + np.bincount(own, weights=np.array(words.weight)[word] if len(word) else None, minlength=len(owner))
    return sigmoid(logits), owner


def hazard(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=-np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n)


def curve_inputs(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    number = np.bincount(owner, minlength=n)
    return np.stack([np.ones(n), np.log(np.maximum(hazard(p, owner, n), 1e-12)), np.log(np.maximum(number, 1))], axis=1)


def scored(p: np.ndarray, owner: np.ndarray, n: int, curve: tuple[float, ...] | None) -> np.ndarray:
    """The score of each of ``n`` texts; without a sentence 0."""
    if curve is None:
        return noisy_or(p, owner, n)
    return np.where(np.bincount(owner, minlength=n) > 0, sigmoid(curve_inputs(p, owner, n) @ np.array(curve)), 0.0)


def noisy_or(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(-hazard(p, owner, n))


def fit(texts: Iterable[bytes], labels: list[int], share: float, bits: int = BITS, epochs: int = 40, rate: float = 0.05,
        ridge: float = 0.5, seed: int = 3) -> Model:
    """Minimise the log loss of the noisy-or by mini-batches; ``share`` of label 1 weights the two labels.

    ``ridge`` is shared out over the texts. The weights of the epoch with the least loss on the texts kept for the curve count.
    """
    if len(set(labels)) < 2:
        return Model(0.0, np.zeros(1), share)
    size = 1 << bits
    types: dict[bytes, int] = {}
    docs = []
    for text in texts:
        docs.append(np.array([types.setdefault(w, len(types)) for w in tokens_of(text)], dtype=np.int32))
    n_types = len(types)
    stop = np.fromiter((w.endswith(_STOPS) for w in types), dtype=bool, count=n_types)
    flat, number = array("I"), array("B")
    for word in types:
        found = parts_of(word)
        flat.extend([h & (size - 1) for h in found])
        number.append(len(found))
    del types
    parts, number = np.array(flat, dtype=np.int32), np.array(number, dtype=np.int64)
    del flat
    real, begin = number > 0, np.concatenate([[0], np.cumsum(number)])
    kind = np.repeat(np.arange(n_types, dtype=np.int32), number)
    # of each label every fourth text is kept for the curve
    y = np.array(labels, dtype=float)
    later = np.zeros(len(docs), dtype=bool)
    for value in (0, 1):
        later[np.flatnonzero(y == value)[3::4]] = True
    # a part must occur in several sample texts
    seen = np.zeros(size, dtype=np.int64)
    for rows in (docs[i] for i in np.flatnonzero(~later)):
        own = np.unique(rows)
        each = number[own]
        ends = np.cumsum(each)
        at = np.arange(int(each.sum())) + np.repeat(begin[own] - ends + each, each)
        seen[np.unique(parts[at])] += 1
    kept = seen[parts] >= LEAST_TEXTS
    parts, kind = parts[kept], kind[kept]

    lines = []  # per text: the number of its sentences, and each distinct word of each of them
    for i, rows in enumerate(docs):
        own, word, owner = sets_of(rows.astype(np.int64), np.array([len(rows)]), stop, real)
        lines.append((len(owner), own.astype(np.int32), word.astype(np.int32)))
        docs[i] = _NONE  # no longer needed, and large together

    def logits_of(chosen):
        sizes = np.array([lines[i][0] for i in chosen], dtype=np.int64)
        own = np.concatenate([_NONE, *[lines[i][1] + at for i, at in zip(chosen, np.cumsum(sizes) - sizes)]])
        word = np.concatenate([_NONE, *[lines[i][2] for i in chosen]])
        by_type = np.bincount(kind, weights=w[parts], minlength=n_types)
        logits = bias + np.bincount(own, weights=by_type[word], minlength=int(sizes.sum()))
        return logits, own, word, np.repeat(np.arange(len(chosen)), sizes)

    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w, bias = np.zeros(size), -5.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    rng = np.random.default_rng(seed)
    ridge, unseen = ridge / max(len(docs), 1), np.flatnonzero(later)
    best, least = (w.copy(), bias), np.inf
    step = 0
    batch = 600
    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(~later))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            logits, own, word, owner = logits_of(chosen)
            if not len(logits):
                continue
            p = sigmoid(logits)
            doc = noisy_or(p, owner, len(chosen))
            # d loss / d logit of a sentence: p for label 0, -(1 - doc) p / doc for label 1
            pull = np.where(y[chosen] == 1, -(1 - doc) / np.maximum(doc, 1e-9), 1.0) * weight[chosen]
            g_sentence = pull[owner] * p / len(chosen)
            g_type = np.bincount(word, weights=g_sentence[own], minlength=n_types)
            g = np.bincount(parts, weights=g_type[kind], minlength=size) + ridge * w
            gb = g_sentence.sum()
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-6)
            bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
        if len(unseen):
            logits, _, _, owner = logits_of(unseen)
            doc = np.clip(noisy_or(sigmoid(logits), owner, len(unseen)), 1e-9, 1 - 1e-9)
            loss = -(weight[unseen] * np.where(y[unseen] == 1, np.log(doc), np.log1p(-doc))).sum()
        else:
            loss = -step
        if loss < least:
            best, least = (w.copy(), bias), loss
    w, bias = best[0].astype(np.float32).astype(float), best[1]
    chosen = unseen
    curve = None
    if len(set(y[chosen])) == 2:
        logits, _, _, owner = logits_of(chosen)
        held = np.bincount(owner, minlength=len(chosen)) > 0  # texts without a sentence score 0 whatever the curve
        x, kept = curve_inputs(sigmoid(logits), owner, len(chosen))[held], y[chosen][held]
        if len(set(kept)) == 2:
            curve = fit_curve(x, kept)
            curve[0] += logit(share) - logit(float(kept.mean()))  # back to the true share of the labels
            # more hazard never lowers a score
            curve = tuple(curve) if curve[1] > 0 else None
    return Model(float(bias), w.astype(np.float32), None, curve)


def train(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
          per_label: int = PER_LABEL, sample_bytes: int = SAMPLE_BYTES) -> Model:
    def fit_and_forget(texts: list[bytes], labels: list[int], share: float) -> Model:
        def taken():  # a text is given back as soon as its words are numbered
            texts.reverse()
            while texts:
                yield texts.pop()

        return fit(taken(), labels, share)

    return fitted_on_sample(docs, labels, label, key, text, per_label, sample_bytes, fit_and_forget)


def spans_of(text: bytes, words: Words, bias: float, least: float) -> Iterator[tuple[int, int, float]]:
    """Byte ranges of sentences whose probability is ``least`` or more, repeated ones included."""
    begin, end, inside = 0, 0, set()

    def found():
        if any(words.real[i] for i in inside):
            p = 1 / (1 + math.exp(-min(max(bias + sum(words.weight[i] for i in inside if words.real[i]), -30.0), 30.0)))
            if p >= least:
                yield begin, end, p

    for token in _TOKEN.finditer(text):
        if token.group() == b"\n":
            yield from found()
            inside = set()
            continue
        if not inside:
            begin = token.start()
        at, end = words[token.group().lower()], token.end()
        inside.add(at)
        if words.stop[at]:
            yield from found()
            inside = set()
    yield from found()


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score", spans: str | None = "spans",
          least: float = 0.5) -> DataFrame:
    """All columns of ``docs``, the score, and byte ranges (begin, end, p) of offending sentences."""
    shared = share(docs, model)
    base = docs.drop(*[c for c in (out, spans) if c])
    at = base.columns.index(text)
    fields = [T.StructField(out, T.DoubleType())]
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())])
    arrow_span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    if spans:
        fields.append(T.StructField(spans, T.ArrayType(span)))

    def run(batches):
        fitted = held(shared)
        words = fitted.lookup()
        for batch in batches:
            for part, raw in text_chunks(batch, batch.schema.names[at], 4 << 20):
                if len(words) > KEPT:
                    words = fitted.lookup()
                if fitted.share is not None:
                    values, p, owner = np.full(len(raw), fitted.share), np.zeros(0), np.zeros(0, np.int64)
                else:
                    p, owner = sentences(words, raw, fitted.bias)
                    values = scored(p, owner, len(raw), fitted.curve)
                columns, names = [*part.columns, pa.array(values, pa.float64())], [*part.schema.names, out]
                if spans:
                    hot = set(owner[p >= least].tolist())
                    found = [
                        [{"begin": a, "end": b, "p": q} for a, b, q in spans_of(raw[i], words, fitted.bias, least)]
                        if i in hot else [] for i in range(len(raw))
                    ]
                    columns.append(pa.array(found, arrow_span))
                    names.append(spans)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(base, run, T.StructType([*base.schema.fields, *fields]))
