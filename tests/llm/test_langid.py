import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import langid
from ledgerlake.llm.queries import QUERIES


def parsed(text: bytes, sample: bytes) -> int:
    """Greedy longest matches, one after the other; a byte that is nowhere is a phrase."""
    at, n = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) + 1 and text[at : at + size] in sample:
            size += 1
        at, n = at + max(size - 1, 1), n + 1
    return n


def model_of(*samples):
    return langid.model_of([langid.Language(str(i), len(s), langid.automaton(s)) for i, s in enumerate(samples)])


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", min_size=1, max_size=60), st.lists(st.text("ab cd", max_size=90), min_size=1, max_size=5), st.integers(1, 9))
def test_phrases_against_plain_parse(sample, texts, piece):
    model = model_of(sample.encode(), b"ccd")
    raw = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
    tables = [model.table(x) for x in model.languages]
    got = langid.costs(model, tables, raw, piece)
    for i, text in enumerate(texts):
        for j, s in enumerate((sample.encode(), b"ccd")):
            assert got[i, j] == pytest.approx(parsed(text.encode(), s) * np.log2(len(s) + 256))


def test_letters():
    assert langid.letters_of("Ab, C--é1Ö\n").tobytes().decode() == "ab c é ö "
    assert langid.letters_of("ñ x  y" + "\ud800").tobytes().decode().startswith("ñ x y")
    assert len(langid.letters_of("")) == 0


def corpus(n=240):
    rng = random.Random(2)
    kinds = {"aa": "the and ing of to", "bb": "der und ung die zu", "cc": "в на ко то ра"}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(kinds))
        syllables = kinds[lang].split()
        rows.append((i, " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(30)), lang))
    return rows


def test_languages_are_told_apart(spark, frame):
    rows = corpus()
    # copies of one text, unlabelled rows, and texts without letters
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(300)]
    rows += [(2000, None, "aa"), (2001, "", "aa"), (2002, "12 ²-- 3", "bb"), (2003, rows[1][1], None), (2003, rows[1][1], None), (None, rows[2][1], "aa")]
    rows.append((2004, " ".join(r[1] for r in rows[:240] if r[2] == "bb") * 20, None))
    docs = frame(rows, ("doc_id", "text", "lang"), ("bigint", "string", "string"))
    learn = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    model = langid.train(docs, learn)
    assert sorted(x.name for x in model.languages) == ["aa", "bb", "cc"]
    out = langid.predict(docs, model)
    assert set(docs.columns) <= set(out.columns)
    got = out.select("doc_id", "text", "lang", "lang_pred", F.col("`score`")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (2000, 2001, 2002):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif r["doc_id"] == 2004:
            assert r["lang_pred"] == "bb"
        elif r["lang"] and r["doc_id"] is not None:
            assert r["lang_pred"] == r["lang"]


def test_result_does_not_hang_on_partitions(spark, frame):
    docs = frame(corpus(), ("doc_id", "text", "lang"), ("bigint", "string", "string"))
    both = [langid.train(docs.repartition(n), F.lit(True)) for n in (1, 7)]
    for a, b in zip(both[0].languages, both[1].languages):
        assert (a.name, a.size) == (b.name, b.size) and np.array_equal(a.edges, b.edges)


def test_nothing_to_learn(spark, frame):
    docs = frame([(1, "text", None), (2, None, None)], ("doc_id", "text", "lang"), ("bigint", "string", "string"))
    model = langid.train(docs, F.lit(True))
    assert {tuple(r) for r in langid.predict(docs, model).select("lang_pred", "score").collect()} == {("und", 0.0)}
    empty = frame([], ("doc_id", "text", "lang"), ("bigint", "string", "string"))
    assert langid.predict(empty, langid.train(empty, F.lit(True))).count() == 0


def test_held_out_accuracy(spark, sf):
    bigger = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{bigger}/documents.parquet")
    got = QUERIES["op11_cross_parsing"](spark, bigger)
    assert got.count() == docs.count()
    right = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
