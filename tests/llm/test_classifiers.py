import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import compression, sampling, toxicity
from ledgerlake.llm.queries import QUERIES


def labelled(frame, spark, make, label, n=160):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    rows, marks = [], []
    for i in range(n):
        rows.append((i, make(i % 2, word, rng)))
        marks.append((i, i % 2 if i % 8 else None, 1))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (0, 0, 1)], f"doc_id bigint, {label} int, text int")
    return frame([*rows, (None, None), (n, ""), (1, rows[1][1])]), labels


def toxic_text(y, word, rng):
    lines = [" ".join(word() for _ in range(8)) + "." for _ in range(6)]
    if y:
        lines[2] = " ".join([word(), "vileword" + rng.choice("xyz"), word()]) + "."
    return " ".join(lines)


def test_toxicity_finds_texts_and_sentences(spark, frame):
    docs, labels = labelled(frame, spark, toxic_text, "toxic")
    model = toxicity.train(docs, labels, "toxic")
    scored = toxicity.score(docs, model)
    assert set(docs.columns) <= set(scored.columns)
    rows = scored.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not r["text"]:
            assert r["score"] == 0 and r["spans"] == []
        elif r["doc_id"] is not None:
            assert (r["score"] >= 0.5) == (r["doc_id"] % 2 == 1)
            found = [r["text"].encode()[s["begin"] : s["end"]].decode() for s in r["spans"]]
            assert any("vileword" in f for f in found) == (r["doc_id"] % 2 == 1)
            assert all(f.count(".") == 1 and f.endswith(".") for f in found)


def test_noisy_or():
    p, owner = np.array([0.5, 0.5, 0.1]), np.array([0, 0, 2])
    assert toxicity.noisy_or(p, owner, 3) == pytest.approx([0.75, 0, 0.1])


def test_repeated_word_counts_once_in_a_sentence():
    model = toxicity.Model(-1.0, np.ones(1 << 4, dtype=np.float32))
    a, _ = toxicity.sentences(model.lookup(), [b"abc abc abc."], -1.0)
    b, _ = toxicity.sentences(model.lookup(), [b"abc abc."], -1.0)
    assert len(a) == len(b) == 1 and a[0] >= b[0] > 0.5


def scores_of(model, texts):
    words = model.lookup()
    p, owner = toxicity.sentences(words, [t.encode() for t in texts], model.bias)
    return toxicity.scored(p, owner, len(texts), model.curve)


@pytest.mark.parametrize("curve", [None, (0.3, 1.1, -0.4)])
def test_line_breaks_and_repeated_sentences_do_not_change_a_score(curve):
    rng = np.random.default_rng(1)
    model = toxicity.Model(-3.0, rng.normal(size=1 << 10).astype(np.float32), None, curve)
    lines = [f"word{i} and other{i % 7} words." for i in range(50)]
    plain = " ".join(lines)
    same = ["\n".join(lines), "\n\n\n".join(lines) + "\n\n", plain + "\n" + plain, " ".join(lines * 20), "... \n -- " + plain + " !\n?"]
    assert scores_of(model, [plain, *same]) == pytest.approx([scores_of(model, [plain])[0]] * 6)
    assert scores_of(model, ["", "\n\n", " . ! -- "]).tolist() == [0, 0, 0]


def test_spans_are_the_scored_sentences():
    model = toxicity.Model(-1.0, np.full(1 << 4, 0.4, dtype=np.float32))
    text = "One two three.\x0bFour five! \nsix\x0cseven \n\n ... eight nine ten eleven"
    words = model.lookup()
    p, owner = toxicity.sentences(words, [text.encode()], model.bias)
    spans = list(toxicity.spans_of(text.encode(), words, model.bias, 0.0))
    assert [text[a:b] for a, b, _ in spans] == ["One two three.", "Four five!", "six\x0cseven", "eight nine ten eleven"]
    assert [q for *_, q in spans] == pytest.approx(p.tolist())


def test_long_clean_texts_stay_clean(spark, frame):
    def of_many_lengths(y, word, rng):
        return " ".join(toxic_text(y and not i, word, rng) for i in range(rng.choice([1, 1, 2, 4, 8])))

    docs, labels = labelled(frame, spark, of_many_lengths, "toxic", 600)
    model = toxicity.train(docs, labels, "toxic")
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    clean = [" ".join(" ".join(word() for _ in range(8)) + "." for _ in range(n)) for n in (1, 6, 20, 60, 200)]
    toxic = [t.replace(".", ". An vilewordx is.", 1) for t in clean]
    got = scores_of(model, clean + toxic)
    assert (got[:5] < 0.5).all() and (got[5:8] >= 0.5).all()


def test_sample_is_bounded_by_bytes(spark, frame):
    docs = frame([(i, f"{i:03d}" + "x" * 97) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    def fit(texts, ys, share):
        return toxicity.Model(float(len(texts)), np.array([sum(ys)]), share)

    model = sampling.fitted_on_sample(docs, labels, "toxic", "doc_id", "text", 25, 200, fit, 1000)
    assert (model.bias, model.weights.tolist(), model.share) == (20.0, [10], 0.5)


def test_toxicity_without_labels(spark, frame):
    docs = frame([(1, "a b"), (2, None)])
    model = toxicity.train(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int"), "toxic")
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [1.0, 1.0]
    none = toxicity.train(frame([]), spark.createDataFrame([], "doc_id bigint, toxic int"), "toxic")
    assert toxicity.score(docs, none).first()["score"] == 0.5


def quality_text(y, word, rng):
    if y:
        return " ".join(word() for _ in range(60)) + "."
    return "!! ".join(word().upper() for _ in range(60)) + "!!"


def test_compression_tells_kinds_apart(spark, frame):
    docs, labels = labelled(frame, spark, quality_text, "quality")
    model = compression.train(docs, labels, "quality")
    rows = compression.score(docs, model, out="quality_score").collect()
    assert len(rows) == docs.count()
    right = [(r["quality_score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in rows if r["text"] and r["doc_id"] is not None]
    assert np.mean(right) > 0.97
    assert all(0 <= r["quality_score"] <= 1 for r in rows)


def test_compression_without_labels(spark, frame):
    docs = frame([(1, "a b"), (2, None)])
    model = compression.train(docs, spark.createDataFrame([], "doc_id bigint, quality int"), "quality")
    assert [r["score"] for r in compression.score(docs, model).collect()] == [0.5, 0.5]


def test_shape():
    assert compression.shape(b"Ouea Ouea Ouea Ouea abc12 DE!!") == compression.shape(b"Anti Anti Anti Anti xyz34 FG!!")
    assert compression.shape(b"a b c d") != compression.shape(b"a a a a")


@pytest.mark.parametrize("key, label, least", [("op3_toxicity", "toxic", 0.5), ("op8_compression_quality", "quality", 0.3)])
def test_held_out_accuracy(spark, sf, key, label, least):
    bigger = sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{bigger}/labels.parquet")
    got = QUERIES[key](spark, bigger)
    assert got.count() == spark.read.parquet(f"{bigger}/documents.parquet").count()
    assert got.where((F.col("score") >= least) != (F.col("predicted") == 1)).count() == 0
    right = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right > 0.85
