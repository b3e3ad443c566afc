import random
from collections import defaultdict
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import probminhash as k
from ledgerlake.llm.components import components


def shingle_set(text, size=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(pairs):
    """Classes by all pairs: frozensets of row positions."""
    sets = [shingle_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(pairs)):
        for j in range(i):
            same = (pairs[i][1] or "") == (pairs[j][1] or "")
            union = len(sets[i] | sets[j])
            if same or union and len(sets[i] & sets[j]) >= 0.8 * union:
                root[find(i)] = find(j)
    out = defaultdict(set)
    for i in range(len(pairs)):
        out[find(i)].add(pairs[i][0])
    return {frozenset(x) for x in out.values()}


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    shared = " ".join(word() for _ in range(60))
    texts = [None, "", "one", "one two", "one  two", "ONE two three four five six", "one two three four five six"]
    for _ in range(12):  # families around a base whose members differ from each other by more than from the base
        base = [word() for _ in range(90)]
        texts.append(" ".join(base))
        for _ in range(rng.choice([1, 4, 9])):
            copy = list(base)
            for at in rng.sample(range(90), rng.choice([1, 1, 2])):
                copy[at] = word()
            texts.append(" ".join(copy))
        texts.append(texts[-1])
    texts += [shared + " " + " ".join(word() for _ in range(40)) for _ in range(25)]  # alike, but not enough
    return list(enumerate(texts))


def test_classes_match_all_pairs(spark, frame):
    pairs = corpus()
    got = defaultdict(set)
    for r in k.classes(frame(pairs)).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert {frozenset(x) for x in got.values()} == brute(pairs)
    assert all(c == min(x) for c, x in got.items())


def test_keep_one_row_of_each_class(spark, frame):
    pairs = corpus()[:40]
    pairs += [pairs[10], pairs[10], (None, "lonely words of a row without id"), (None, "lonely words of a row without id")]
    docs = frame(pairs)
    kept = k.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    want = [None, *(min(x) for x in brute(pairs[:-2]))]
    assert sorted(ids, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("block", [4, 8, 256])
def test_blocks_find_what_stars_leave(spark, block):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    texts, roots = [], []
    for i in range(40):
        own = list(base) if i % 4 == 0 else [f"x{rng.random()}" for _ in range(100)]
        own[50] = f"y{i}"
        texts.append(" ".join(own))
        roots.append(0 if i < 10 and i % 4 == 0 else i)
    registers = k.signatures(*k.weighted(*k.shingles([t.encode() for t in texts])), 40, 192)
    keys, marks = k.band_keys(registers, 32, 6), (k.mix64(registers) & np.uint64(255)).astype(np.uint8)
    one = lambda i: bytearray([i])
    docs = spark.createDataFrame([(one(i), t) for i, t in enumerate(texts)], "digest binary, text string")
    rows = [(int(b), one(i), one(roots[i]), bytearray(marks[i].tobytes()), keys[i].tolist()) for i in range(40) for b in keys[i]]
    members = spark.createDataFrame(rows, "band bigint, digest binary, root binary, marks binary, bands array<bigint>")
    found = k.compared_in_blocks(members, docs, 0.8, 0.7, block).collect()
    links = [(bytes(r["a"])[0], bytes(r["b"])[0]) for r in found]
    assert all(a % 4 == b % 4 == 0 and roots[a] != roots[b] for a, b in links)
    up = {i: roots[i] for i in range(40)}
    top = lambda x: x if up[x] == x else top(up[x])
    for a, b in links:
        up[top(a)] = top(b)
    assert len({top(i) for i in range(0, 40, 4)}) == 1 and len({top(i) for i in range(40)}) == 31


def test_signatures_estimate_similarity():
    words = [f"w{i}" for i in range(300)]
    a, b = " ".join(words[:200]).encode(), " ".join(words[40:240]).encode()
    sets = shingle_set(a.decode()), shingle_set(b.decode())
    registers = k.signatures(*k.weighted(*k.shingles([a, b, b"", b"x"])), 4, 2000)
    want = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert (registers[0] == registers[1]).mean() == pytest.approx(want, abs=0.04)
    assert (registers[2] == 0).all() and len(set(registers[3])) == 1


def test_weights_count_repetitions():
    a = ("a b c d e " * 4 + "f g h i j k l").encode()
    hashes, owner, weight = k.weighted(*k.shingles([a]))
    assert len(hashes) == len(shingle_set(a.decode())) and weight.max() > 1.5 and weight.min() == 1


def test_pairs_whose_repeat_counts_differ(spark, frame):
    rng = random.Random(6)
    pairs = []
    for i in range(60):
        n, line, times = ((104, 10, 300), (64, 8, 50))[i % 2]
        base = [f"w{rng.random()}" for _ in range(n)]
        at = n // 2
        pairs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:at] + base[at : at + line] * times + base[at + line :]))]
    docs = spark.createDataFrame([(bytearray(str(i).encode()), t) for i, t in pairs], "digest binary, text string")
    made = {int(bytes(r["digest"])): r for r in k.sketch(docs, k.BANDS, k.ROWS).collect()}
    for i in range(0, 120, 2):
        a, b = made[i], made[i + 1]
        assert set(a["bands"]) & set(b["bands"])
        assert np.mean([x == y for x, y in zip(a["marks"], b["marks"])]) >= k.NEAR
    got = defaultdict(set)
    for r in k.classes(frame(pairs)).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert {frozenset(x) for x in got.values()} == brute(pairs) and len(got) == 60


def test_signature_comparison_loses_less_than_banding():
    n = k.BANDS * k.ROWS
    below = sum(comb(n, j) * k.LEAST**j * (1 - k.LEAST) ** (n - j) for j in range(n + 1) if j / n < k.NEAR)
    assert below < 0.01 * (1 - k.LEAST**k.ROWS) ** k.BANDS


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (4, 40), (4, 40)]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect():
        got[r["root"]].add(r["node"])
    assert dict(got) == {1: {1, 2, 3}, 5: {5, 6, 7, 8, 9}, 4: {4, 40}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_hot_texts_are_joined_apart(spark, frame, monkeypatch):
    monkeypatch.setattr(k, "COPIES", 3)
    pairs = corpus()[:40]
    pairs += [(1000 + i, pairs[5][1]) for i in range(50)] + [(2000 + i, "") for i in range(9)] + [(3000, pairs[5][1])] * 4
    got = defaultdict(set)
    for r in k.classes(frame(pairs)).collect():
        got[r["class_id"]].add(r["doc_id"])
    want = brute(pairs)
    assert {frozenset(x) for x in got.values()} == want
    kept = [r["doc_id"] for r in k.keep_one(frame(pairs)).select("doc_id").collect()]
    assert sorted(kept) == sorted(min(x) for x in want)
    rows = frame(pairs).select(F.col("doc_id").alias("key"), k.digest_of(F.col("text")).alias("digest"))
    table = rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
    joined = k.joined_to(rows, table)
    assert joined.count() == len(pairs) and joined.where("least is null").isEmpty()


def test_recall_against_all_pairs_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = defaultdict(set)
    for r in k.classes(docs).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert {frozenset(x) for x in got.values()} == brute([tuple(r) for r in docs.collect()])


def test_empty_table(spark, frame):
    assert k.classes(frame([])).count() == 0
    assert k.keep_one(frame([])).count() == 0


def test_links_are_named_for_what_they_count(frame):
    assert k.classes(frame([(1, "a")])).columns == ["doc_id", "class_id", "verified_links"]
