"""Hidden Markov language model over whole texts.

A text is its words (ASCII letters lower-cased, split at ASCII white space) and one end token. The
``head`` most frequent training tokens have emission parameters of their own; the others are dealt by a hash into tail
classes, whose number grows with the square root of theirs, and every state emits the classes as it does tokens. Inside a
class each token has its exact smoothed share of the training counts, and one slot is for unknown ones. The
probabilities of all known tokens and of the slots sum to one in each state.

Work per step, all over whole tables:

* token counts: partial counts in each task, one sum by token;
* texts become rows of ids (of head tokens and of classes), written once; rarer tokens of each text go beside them with their
  counts and meet the token table in a join (a rare token cannot be a hot key of the training side,
  and a text brings each token once);
* each Baum-Welch pass sums expected counts inside a task and by token after it, so what reaches the
  driver is one (head and classes x states) table;
* scoring is one more pass with the scaled forward recursion, without approximation.

NULL texts are empty (one end token). Repeated rows are scored one by one. Rows with a NULL id take
part in training. An empty table gives an empty result; without training rows every token has
probability one.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, held, share, mix64, stage, text_chunks

END = b" "  # no word holds white space
HEAD = 1 << 16
#: Tail classes for every unit of the square root of the number of tail tokens.
TAIL = 4
STATES = 8
PASSES = 4
#: Weight of the unigram prior in the emission of a state, in tokens.
PRIOR = 5000.0
#: Tokens whose forward variables one task holds at a time.
CHUNK = 800_000
#: Steps of the recursion from one scaling to the next: far from the smallest double, as no emission of a state is below 1e-30.
SCALED = 8
#: Tokens whose expected counts are added at a time.
ADDED = 1 << 14
#: Distinct tokens that a counting task holds before it hands them on.
COUNTED = 400_000


@dataclass
class Hmm:
    """start (K), move (K x K), emit (head and classes x K)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over the column ``text``, the end token included."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part, raw in text_chunks(batch, "text"):
                for text in raw:
                    seen.update(words(text))
                seen[END] += len(raw)
                if len(seen) > COUNTED:
                    yield flush(seen)
                    seen = Counter()
        if seen:
            yield flush(seen)

    def flush(seen):
        return pa.record_batch(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"]
        )

    return arrow_map(texts.select("text"), run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


class Ids(dict):
    """token -> id; a token that is not of the head is counted in ``rare`` and has the id of its class, kept nowhere."""

    def __init__(self, head: list[bytes], classes: int):
        super().__init__(zip(head, range(len(head))))
        self.rare: dict[bytes, int] = {}
        self.classes = classes

    def __missing__(self, token: bytes) -> int:
        rare = self.rare
        rare[token] = rare.get(token, 0) + 1
        return len(self) + crc32(token) % self.classes


def encode(docs: DataFrame, head: list[bytes], classes: int, key_type: str) -> DataFrame:
    """Per row: ids of its tokens in order (those of classes follow those of ``head``), and the other tokens with counts."""
    shared = share(docs, head)
    schema = f"row bigint, key {key_type}, learn boolean, ids array<int>, rare array<struct<token:binary,n:int>>"

    def run(batches):
        ids_of = Ids(held(shared), classes)
        for batch in batches:
            for part, raw in text_chunks(batch, "text"):
                flat = array("i")
                ends, rare_ends, rare_tokens, rare_counts = [0], [0], [], []
                for text in raw:
                    tokens = words(text)
                    tokens.append(END)
                    flat.fromlist(list(map(ids_of.__getitem__, tokens)))
                    ends.append(len(flat))
                    if ids_of.rare:
                        rare_tokens += ids_of.rare
                        rare_counts += ids_of.rare.values()
                        ids_of.rare.clear()
                    rare_ends.append(len(rare_tokens))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(rare_tokens, pa.binary()), pa.array(rare_counts, pa.int32())], names=["token", "n"]
                )
                yield pa.record_batch(
                    [
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32))),
                        pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), pairs),
                    ],
                    names=["row", "key", "learn", "ids", "rare"],
                )

    return arrow_map(docs.select("row", "key", "learn", "text"), run, schema)


def flat_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a list column and the lengths of its lists."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(offsets).astype(np.int64)


def chunks(ids: np.ndarray, lengths: np.ndarray, most: int):
    """Runs of rows with about ``most`` tokens, longest rows first: (row numbers, time-major ids, rows per step)."""
    order = np.argsort(-lengths, kind="stable")
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    ends = np.cumsum(lengths[order])
    start = 0
    while start < len(order):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        rows = order[start:stop]
        size = lengths[rows]
        steps = np.bincount(size, minlength=int(size[0]) + 1)
        active = len(rows) - np.cumsum(steps)[:-1]  # rows longer than t, for t = 0, 1, ...
        first = np.concatenate([[0], np.cumsum(active)])[:-1]
        total = int(size.sum())
        rank = np.repeat(np.arange(len(rows)), size)
        at = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        timed = np.empty(total, dtype=np.int64)
        timed[first[at] + rank] = ids[np.repeat(begin[rows], size) + at]
        yield rows, timed, active, first
        start = stop


def forward(model: Hmm, timed, active, first, keep: bool):
    """Forward recursion, scaled at every ``SCALED``-th step. Returns log10 likelihoods by row and, if kept, the scaled
    variables, the scales of each scaled step and the sums of the variables at the end of each row."""
    emit, move = np.ascontiguousarray(model.emit), model.move
    n, k = int(active[0]), len(model.start)
    ones = np.ones(k)
    kept = np.empty((len(timed), k)) if keep else None
    log_scales, scales, last = np.zeros(n), {}, np.empty(n)
    a = np.empty((0, k))
    for t, (m, f) in enumerate(zip(active.tolist(), first.tolist())):
        e = emit.take(timed[f : f + m], axis=0)
        if t == 0:
            e *= model.start
        else:
            if m < len(a):
                last[m : len(a)] = a[m:] @ ones
                a = a[:m]
            e *= a @ move
        a = e
        if t % SCALED == SCALED - 1:
            s = a @ ones
            a /= s[:, None]
            log_scales[:m] += np.log10(s)
            scales[t] = s
        if keep:
            kept[f : f + m] = a
    last[: len(a)] = a @ ones
    return log_scales + np.log10(last), kept, scales, last


def expected(model: Hmm, ids, lengths, emitted: np.ndarray, moved: np.ndarray, started: np.ndarray, most: int) -> None:
    """Add the expected counts of all rows to the three tables in place."""
    sums = np.zeros(emitted.size)
    for _, timed, active, first in chunks(ids, lengths, most):
        _, alpha, scales, last = forward(model, timed, active, first, keep=True)
        emit, k = np.ascontiguousarray(model.emit), len(model.start)
        xi = np.zeros((k, k))
        back = np.ascontiguousarray(model.move.T)
        # the sum over states of both variables is one for every row
        beta = np.empty((0, k))
        sizes, starts = active.tolist(), first.tolist()
        for t in range(len(sizes) - 1, -1, -1):
            m, f = sizes[t], starts[t]
            if len(beta) < m:
                beta = np.concatenate([beta, np.repeat(1 / last[len(beta) : m, None], k, axis=1)])
            alpha[f : f + m] *= beta
            if t:
                e = emit.take(timed[f : f + m], axis=0)
                e *= beta
                if t in scales:
                    e /= scales[t][:, None]
                p = starts[t - 1]
                xi += alpha[p : p + m].T @ e
                beta = e @ back
        moved += xi * model.move
        started += alpha[: sizes[0]].sum(axis=0)
        for i in range(0, len(timed), ADDED):
            np.add.at(sums, (timed[i : i + ADDED, None] * k + np.arange(k)).ravel(), alpha[i : i + ADDED].ravel())
    emitted += sums.reshape(-1, k).T


def baum_welch_counts(encoded: DataFrame, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected emissions (K x head and classes), moves and starts over all rows that learn."""
    shared = share(encoded, model)

    def run(batches):
        hmm = held(shared)
        size, k = hmm.emit.shape
        emitted, moved, started = np.zeros((k, size)), np.zeros((k, k)), np.zeros(k)
        any_row = False
        for batch in batches:
            ids, lengths = flat_ids(batch.column(0))
            if len(lengths):
                any_row = True
                expected(hmm, ids, lengths, emitted, moved, started, CHUNK)
        if any_row:
            seen = np.flatnonzero(emitted.sum(axis=0))
            keys = np.concatenate([seen, -1 - np.arange(k + 1)]).astype(np.int32)
            values = np.concatenate([emitted[:, seen].T, moved, started[None, :]])
            for i in range(0, len(keys), 20_000):
                yield pa.record_batch(
                    [pa.array(keys[i : i + 20_000]),
                     *[pa.array(values[i : i + 20_000, j]) for j in range(k)]],
                    names=["key", *[f"s{j}" for j in range(k)]],
                )

    k = len(model.start)
    cols = [f"s{j}" for j in range(k)]
    parts = arrow_map(encoded.where("learn").select("ids"), run, "key int, " + ", ".join(f"{c} double" for c in cols))
    table = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in cols]).toArrow()  # head, classes and K + 1 rows at most
    shared.unpersist()
    keys = table.column("key").to_numpy()
    values = np.stack([table.column(c).to_numpy() for c in cols], axis=1) if len(keys) else np.zeros((0, k))
    emitted, moved, started = np.zeros((k, len(model.emit))), np.zeros((k, k)), np.zeros(k)
    emitted[:, keys[keys >= 0]] = values[keys >= 0].T
    for key, row in zip(keys[keys < 0], values[keys < 0]):
        if -1 - key < k:
            moved[-1 - key] = row
        else:
            started[:] = row
    return emitted, moved, started


def first_model(prior: np.ndarray, states: int, seed: int) -> Hmm:
    """The unigram distribution, tilted for each state by a keyed hash of the token's rank; sticky moves."""
    k = np.arange(states, dtype=np.uint64)[None, :]
    w = np.arange(len(prior), dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        u = mix64(mix64(w + np.uint64(seed)) ^ (k * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(11)
    emit = prior[:, None] * np.exp(1.5 * (u / float(1 << 53) - 0.5))
    stay = 0.95 if states > 1 else 1.0
    move = np.full((states, states), (1 - stay) / max(1, states - 1))
    np.fill_diagonal(move, stay)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def reestimate(prior: np.ndarray, emitted, moved, started, weight: float) -> Hmm:
    emit = np.ascontiguousarray((emitted.T + weight * prior[:, None]) / (emitted.sum(axis=1) + weight))
    k = len(started)
    return Hmm((started + 1) / (started.sum() + k), (moved + 1) / (moved.sum(axis=1, keepdims=True) + k), emit)


def score_ids(coded: DataFrame, model: Hmm, head_logs: np.ndarray, class_logs: np.ndarray, key_type: str) -> DataFrame:
    """Log10 likelihood of the ids of every row less that of their classes, and the base sum of its head tokens."""
    shared = share(coded, (model, np.append(head_logs, np.zeros(len(class_logs))), np.append(np.zeros(len(head_logs)), class_logs), len(head_logs)))
    schema = f"row bigint, key {key_type}, learn boolean, n_tokens bigint, n_head bigint, hmm double, base double"

    def run(batches):
        hmm, logs, of_classes, other = held(shared)
        for batch in batches:
            ids, lengths = flat_ids(batch.column(3))
            if not len(lengths):
                continue
            likelihood = np.zeros(len(lengths))
            for rows, timed, active, first in chunks(ids, lengths, CHUNK):
                likelihood[rows] = forward(hmm, timed, active, first, keep=False)[0]
            begin = np.cumsum(lengths) - lengths
            likelihood -= np.add.reduceat(of_classes[ids], begin)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(lengths),
                 pa.array(np.add.reduceat((ids < other).astype(np.int64), begin)), pa.array(likelihood), pa.array(np.add.reduceat(logs[ids], begin))],
                names=["row", "key", "learn", "n_tokens", "n_head", "hmm", "base"],
            )

    return arrow_map(coded.select("row", "key", "learn", "ids"), run, schema)


@dataclass
class Trained:
    """A fitted model with what scoring needs: the coded rows, the token counts, head tokens and the mass of classes."""

    rows: DataFrame
    vocabulary: DataFrame
    tokens: list[bytes]
    counts: np.ndarray
    mass: np.ndarray  # probability of every class, a slot for unknown tokens included
    n_total: int
    v_total: int
    hmm: Hmm

    @property
    def scale(self) -> float:
        """What counts + 1 are divided by in the model: every class has a slot for unknown tokens."""
        return float(self.n_total + self.v_total + len(self.mass))

    @property
    def base_scale(self) -> float:
        return float(self.n_total + self.v_total + 1)


def train(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", states: int = STATES, passes: int = PASSES,
    head: int = HEAD, prior: float = PRIOR, seed: int = 11, tail: int = TAIL,
) -> Trained:
    """Fit on the rows where ``learn`` holds; all rows are coded on the way."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
        F.coalesce(learn, F.lit(False)).alias("learn"), F.col(f"`{text}`").alias("text"),
    )
    vocabulary = stage(count_tokens(rows.where("learn")), "hmm-tokens")
    n_total, v_total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = vocabulary.orderBy(F.desc("n"), "token").limit(head).toArrow()  # at most ``head`` rows
    tokens, counts = top.column("token").to_pylist(), np.array(top.column("n").to_pylist(), dtype=np.float64)
    classes = max(1, int(tail * np.sqrt(v_total - len(tokens))))
    # counts + 1 of the tail tokens of every class: of all tokens, less those of the head
    sums = vocabulary.groupBy((F.crc32("token") % classes).cast("int").alias("c")).agg(F.sum(F.col("n") + 1).alias("n")).toArrow()
    mass = np.ones(classes)
    mass[sums.column("c").to_numpy()] += sums.column("n").to_numpy()
    np.subtract.at(mass, np.array([crc32(t) % classes for t in tokens], dtype=np.int64), counts + 1)
    scale = n_total + v_total + classes
    unigram = np.append(counts + 1, mass) / scale

    coded = stage(encode(rows, tokens, classes, rows.schema["key"].dataType.simpleString()), "hmm-ids")  # the row number is a stored value from here on
    model = first_model(unigram, states, seed)
    for _ in range(passes if n_total else 0):
        model = reestimate(unigram, *baum_welch_counts(coded, model), prior)
    return Trained(coded, vocabulary, tokens, counts, mass / scale, int(n_total), int(v_total), model)


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Train on the rows where ``learn`` holds and score every row; ``options`` as for ``train``.

    Returns key, learn, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10
    of the add-one unigram probability) and score (log10 of the model's probability of the text).
    ``head``, ``states`` and ``passes`` bound the model, not the data: every pass reads all rows.
    """
    fitted = train(docs, learn, key, text, **options)
    n = F.coalesce("n", F.lit(0)) + 1
    rare = (
        fitted.rows.select("row", F.explode("rare").alias("r"))
        .select("row", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
        .join(fitted.vocabulary, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(n / F.lit(fitted.base_scale))).alias("rare_log"),
            F.sum("times").alias("n_rare"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    zero = F.lit(0)
    head_logs = np.log10((fitted.counts + 1) / fitted.base_scale)
    key_type = fitted.rows.schema["key"].dataType.simpleString()
    # a rare token's share is of the model's scale
    other_scale = float(np.log10(fitted.base_scale / fitted.scale))
    return (
        score_ids(fitted.rows, fitted.hmm, head_logs, np.log10(fitted.mass), key_type)
        .join(rare, "row", "left")
        .select(
            F.col("key").alias(key), "learn", "n_tokens",
            (F.col("n_head") + F.coalesce("rare_known", zero)).alias("n_known"),
            F.lit(fitted.n_total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_log", zero)).alias("base_score"),
            (F.col("hmm") + F.coalesce("rare_log", zero) + F.coalesce("n_rare", zero) * other_scale).alias("score"),
        )
    )
