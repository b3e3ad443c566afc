"""One very long text among short ones, for the operators whose other tests have none."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import compression, hmm, toxicity
from ledgerlake.llm.chat import format_chats
from ledgerlake.llm.decontaminate import contamination

LONG = "plain words of a long text, one after another. " * 20_000


@pytest.fixture(scope="module")
def pairs():
    return [(i, f"short text {i} of plain words. {'vile' if i % 2 else 'kind'} ending.") for i in range(40)] + [(100, LONG), (101, None), (102, "")]


def test_hmm(spark, frame, pairs):
    rows = {r["doc_id"]: r for r in hmm.score(frame(pairs), F.col("doc_id") < 30, passes=1).collect()}
    assert rows[100]["n_tokens"] == len(LONG.split()) + 1 and rows[100]["score"] < 0 and rows[101]["n_tokens"] == 1


@pytest.mark.parametrize("module", [toxicity, compression])
def test_classifiers(spark, frame, pairs, module):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(100, 0)], "doc_id bigint, label int")
    rows = module.score(frame(pairs), module.train(frame(pairs), labels, "label")).collect()
    assert len(rows) == len(pairs) and all(0 <= r["score"] <= 1 for r in rows if r["score"] != "x")


def test_contamination(spark, frame, pairs):
    passage = " ".join(f"item{i}" for i in range(20))
    docs = frame([*pairs, (200, LONG + passage), (201, passage)])
    items = spark.createDataFrame([("a", passage), ("b", None)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in contamination(docs, items).collect()}
    assert got[200] == (len(LONG.split()) + 20, 20, False) and got[201] == (20, 20, True) and got[100][1] == 0


def test_chats(spark):
    turns = [(1, 0, "user", LONG), (1, 1, "assistant", "yes"), (2, 0, "user", "a"), (2, 1, "assistant", LONG)]
    rows = format_chats(spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")).collect()
    assert len(rows) == 2 and all(any(LONG.strip() in str(v) for v in r) for r in rows)
