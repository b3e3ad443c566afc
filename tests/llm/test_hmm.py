import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hmm
from ledgerlake.llm.base import bucket_of


def tiny():
    rng = np.random.default_rng(1)
    norm = lambda a: a / a.sum(axis=-1, keepdims=True)
    return hmm.Hmm(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))).T.copy())


def by_paths(model, ids):
    total = 0.0
    for path in itertools.product(range(3), repeat=len(ids)):
        p = model.start[path[0]] * model.emit[ids[0], path[0]]
        for a, b, w in zip(path, path[1:], ids[1:]):
            p *= model.move[a, b] * model.emit[w, b]
        total += p
    return total


def test_forward_is_the_sum_over_all_paths():
    model, seqs = tiny(), [[0, 1, 4, 2], [3], [2, 2, 2, 0, 1], [4, 4]]
    ids, lengths = np.array(sum(seqs, [])), np.array([len(s) for s in seqs])
    got = np.zeros(4)
    for rows, timed, active, first in hmm.chunks(ids, lengths, 6):
        got[rows] = hmm.forward(model, timed, active, first, False)[0]
    assert got == pytest.approx([math.log10(by_paths(model, s)) for s in seqs])


def test_expected_counts_and_training_steps():
    model, seqs = tiny(), [[0, 1, 4, 2], [3], [2, 2, 2, 0, 1], [4, 4]]
    ids, lengths = np.array(sum(seqs, [])), np.array([len(s) for s in seqs])
    likelihoods = []
    for _ in range(4):
        emitted, moved, started = np.zeros((3, 5)), np.zeros((3, 3)), np.zeros(3)
        hmm.expected(model, ids, lengths, emitted, moved, started, 7)
        assert emitted.sum() == pytest.approx(len(ids))
        assert moved.sum() == pytest.approx((lengths - 1).sum())
        assert started.sum() == pytest.approx(len(seqs))
        assert emitted.sum(axis=0) == pytest.approx(np.bincount(ids, minlength=5))
        likelihoods.append(sum(math.log(by_paths(model, s)) for s in seqs))
        model = hmm.Hmm(started / started.sum(), moved / moved.sum(axis=1, keepdims=True), (emitted / emitted.sum(axis=1, keepdims=True)).T)
    assert likelihoods == sorted(likelihoods)


def test_counts_and_base_score(spark, frame):
    texts = ["a b A", "b\tc\nc É é", None, "", "a b A", "unseen word x " * 30]
    docs = frame(list(enumerate(texts)) + [(None, "a q")])
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    learn = ~F.coalesce(bucket_of(F.col("doc_id"), 7) == 2, F.lit(False))
    got = {r["doc_id"]: r for r in hmm.score(docs, learn, head=3, passes=2).collect()}
    pairs = [*enumerate(texts), (None, "a q")]
    counts = Counter()
    for i, t in pairs:
        if not held(i):
            counts.update([*(t or "").encode().lower().split(), b" "])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(pairs)
    for i, t in pairs:
        tokens = [*(t or "").encode().lower().split(), b" "]
        row = got[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), n)
        assert row["learn"] == (not held(i))
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
        assert row["score"] < 0


def test_score_against_a_plain_forward_recursion(spark, frame):
    """Every token with its own emission, tail classes undone; and all emissions of a state sum to one."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    p = np.arange(60, 0, -1.0) ** 2
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(0, 30), p=p / p.sum())) for _ in range(80)] + ["unseen w1 unseen new", None]
    docs = frame(list(enumerate(texts)))
    learn = F.col("doc_id") < 70
    options = {"head": 12, "states": 3, "passes": 2, "prior": 20.0}
    fitted = hmm.train(docs, learn, **options)
    classes = len(fitted.mass)
    assert classes > 10
    counts = {bytes(r["token"]): r["n"] for r in fitted.vocabulary.collect()}
    tail = [t for t in counts if t not in fitted.tokens]
    mass = np.zeros(classes)
    for t in tail:
        mass[zlib.crc32(t) % classes] += (counts[t] + 1) / fitted.scale
    assert mass + 1 / fitted.scale == pytest.approx(fitted.mass)

    def emission(token):
        if token in fitted.tokens:
            return fitted.hmm.emit[fitted.tokens.index(token)]
        c = zlib.crc32(token) % classes
        return fitted.hmm.emit[12 + c] * ((counts.get(token, 0) + 1) / fitted.scale / fitted.mass[c])

    slots = sum(fitted.hmm.emit[12 + c] / fitted.scale / fitted.mass[c] for c in range(classes))
    assert sum(emission(t) for t in counts) + slots == pytest.approx(np.ones(3))
    for r in hmm.score(docs, learn, **options).collect():
        a, total = fitted.hmm.start, 0.0
        for i, token in enumerate([*(texts[r["doc_id"]] or "").encode().lower().split(), b" "]):
            a = (a if i == 0 else a @ fitted.hmm.move) * emission(token)
            total += math.log10(a.sum())
            a = a / a.sum()
        assert r["score"] == pytest.approx(total)


def test_tail_classes_grow_and_partitions_do_not_matter(spark, frame):
    docs = frame([(i, " ".join(f"t{i}x{j}" for j in range(40)) + " common word") for i in range(30)])
    few = hmm.train(docs, F.col("doc_id") < 3, head=4, passes=0)
    many = [hmm.train(docs.repartition(n), F.lit(True), head=4, passes=2) for n in (1, 6)]
    assert len(few.mass) < len(many[0].mass) / 2
    assert np.allclose(many[0].hmm.emit, many[1].hmm.emit, rtol=1e-9) and np.allclose(many[0].hmm.move, many[1].hmm.move, rtol=1e-9)


def test_probabilities_sum_to_one(spark, frame):
    """One-token texts over all known tokens and an unknown one, without the end: emissions of each state sum to 1."""
    prior = np.array([0.5, 0.2, 0.3])
    model = hmm.reestimate(prior, np.random.default_rng(0).random((4, 3)), np.ones((4, 4)), np.ones(4), 5.0)
    assert model.emit.sum(axis=0) == pytest.approx(np.ones(4))
    assert model.move.sum(axis=1) == pytest.approx(np.ones(4))


def test_empty_table(spark, frame):
    assert hmm.score(frame([]), F.lit(True)).count() == 0
    only = hmm.score(frame([(1, "a b")]), F.lit(False)).first()
    assert only["train_tokens"] == 0 and only["base_score"] == 0 and only["score"] == pytest.approx(0)


def test_better_than_the_base_on_held_out_texts(spark, sf):
    from ledgerlake.llm.queries import QUERIES

    row = QUERIES["op1_hmm_score"](spark, sf).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_ids_are_found_in_one_pass():
    ids = hmm.Ids([b"a", b"b"], 5)
    tokens = [b"b", b"x", b"a", b"y", b"x", hmm.END]
    assert [ids[t] for t in tokens] == [1, 2 + zlib.crc32(b"x") % 5, 0, 2 + zlib.crc32(b"y") % 5, 2 + zlib.crc32(b"x") % 5, 2 + zlib.crc32(hmm.END) % 5]
    assert list(ids.rare.items()) == [(b"x", 2), (b"y", 1), (hmm.END, 1)]
    assert dict(ids) == {b"a": 0, b"b": 1}


def test_long_rows_of_rare_tokens_need_few_scalings():
    """Rows that end at, before and after a scaled step, with emissions near 1e-12, against a recursion scaled at each step."""
    rng = np.random.default_rng(5)
    model = tiny()
    model = hmm.Hmm(model.start, model.move, np.vstack([model.emit, 1e-12 * rng.random((20, 3))]))
    lengths = np.array([1, 2, hmm.SCALED - 1, hmm.SCALED, hmm.SCALED + 1, 2 * hmm.SCALED, 700, 701])
    ids = rng.integers(5, 25, lengths.sum())
    got, gamma = np.zeros(len(lengths)), np.zeros((3, 25))
    for rows, timed, active, first in hmm.chunks(ids, lengths, 900):
        likelihood, _, scales, _ = hmm.forward(model, timed, active, first, True)
        assert len(scales) == len(active) // hmm.SCALED
        got[rows] = likelihood
    moved, started = np.zeros((3, 3)), np.zeros(3)
    hmm.expected(model, ids, lengths, gamma, moved, started, 900)
    assert gamma.sum(axis=0) == pytest.approx(np.bincount(ids, minlength=25))
    assert moved.sum() == pytest.approx((lengths - 1).sum()) and started.sum() == pytest.approx(len(lengths))
    for row, part in zip(got, np.split(ids, np.cumsum(lengths)[:-1])):
        a, total = model.start * model.emit[part[0]], 0.0
        for w in part[1:]:
            total, a = total + math.log10(a.sum()), a / a.sum()
            a = (a @ model.move) * model.emit[w]
        assert row == pytest.approx(total + math.log10(a.sum()), rel=1e-12)
