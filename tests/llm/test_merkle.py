import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from ledgerlake.llm import merkle
from ledgerlake.llm.queries import ORACLES, QUERIES

COLUMNS = ("doc_id", "source", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root and the proof (siblings before and after, level by level) of every node."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            first = at - at % 3
            paths[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 3])))
            places[i] = at // 3
        nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(docs):
    groups = defaultdict(list)
    for doc_id, source, text in docs:
        groups[source].append((doc_id is not None, doc_id or 0, leaf(doc_id, source, text), doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda r: r[:3])
    roots = {s: tree([r[2] for r in groups[s]]) for s in order}
    root, tops = tree([roots[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for row, path in zip(groups[s], roots[s][1]):
            out.append((row[3], row[2], roots[s][0], root, tuple(path + top)))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "leaf", "subroot", "root", "proof").collect()
    return sorted(((*r[:4], tuple((s["before"], s["after"]) for s in r["proof"])) for r in rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_against_plain_trees(spark, frame, levels):
    rng = random.Random(levels)
    docs = [(i, rng.choice(["a", "a", "b", "é", "Z", None]), f"text {i}\n") for i in range(230)]
    docs += [(1000 + i, f"single {i}", "x") for i in range(11)]
    docs += [(5, "a", "other"), (5, "a", "other"), (None, "a", None), (None, None, ""), (7, "", "long " * 30_000)]
    rng.shuffle(docs)
    df = frame(docs, ("doc_id", "source", "text"), ("bigint", "string", "string")).repartition(7)
    out = merkle.manifest(df, COLUMNS, levels=levels)
    assert got(out) == expected(docs)
    folded = out.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root"))
    assert folded.count() == 0


@pytest.mark.parametrize("docs", [[], [(1, "a", "x")], [(1, None, None), (2, None, None)], [(1, "a", "x"), (2, "b", "x")], [(i, "a", "") for i in range(3)]])
def test_small_tables(spark, frame, docs):
    df = frame(docs, ("doc_id", "source", "text"), ("bigint", "string", "string"))
    assert got(merkle.manifest(df, COLUMNS)) == expected(docs)


def test_tampered_rows_are_found(spark, frame, tmp_path):
    rows = [(i, "one\ntwo" if i % 3 else "one two", "en", "s", 7) for i in range(40)] + [(None, "a\nb", "en", "s", 3), (50, None, "en", "s", 0)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    out = {r["doc_id"]: r for r in QUERIES["op12_merkle_manifest"](spark, path).collect()}
    assert len(out) == len(rows)
    for doc_id, text, *_ in rows:
        cut = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and "\n" in (text or "")
        assert out[doc_id]["verified"] == (not cut)


def test_query_against_sql(spark, sf):
    assert compare(QUERIES["op12_merkle_manifest"](spark, sf), duck(sf), ORACLES["op12_merkle_manifest"]) is None
