import os
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerlake.llm import shards as k
from ledgerlake.llm.queries import BYTE_PAIR_RANKS, QUERIES

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_PAIR_RANKS), reason="no vocabulary files here")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_order_is_a_permutation_with_an_inverse(n):
    order = k.Order(n, 99)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.numbers(slots).tolist() == list(range(n))
    if n >= 1000:
        assert slots.tolist() != k.Order(n, 98).slots(np.arange(n)).tolist()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


@pytest.fixture(scope="module")
def ranks():
    return k.read_ranks(BYTE_PAIR_RANKS)


def test_shards_hold_every_token_in_order(spark, frame, ranks, tmp_path):
    import tiktoken

    texts = ["hello world " * 40, None, "", "naïve 漢字 text", "a", "word " * 3000, "hello world " * 40]
    docs = frame([*enumerate(texts), (None, "no id")]).repartition(3)
    path = f"file://{tmp_path}/shards"
    sequences, files, layout = k.materialise(docs, ranks, len(ranks), path, length=64, per_shard=8)
    order = layout.order
    assert k.read_layout(path) == layout and layout.shards == files.count()
    rows = sequences.collect()
    assert sorted(r["slot"] for r in rows) == list(range(order.n)) and files.count() == -(-order.n // 8)
    coder = tiktoken.Encoding("own", pat_str=k.PATTERN, mergeable_ranks=ranks, special_tokens={})
    back = list(k.read_slots(path, 0, order.n))
    assert [s for s, _, _ in back] == list(range(order.n))
    assert [n for _, n, _ in back] == order.numbers(np.arange(order.n)).tolist()
    stream = np.concatenate([t for _, _, t in sorted(back, key=lambda r: r[1])])
    ends = np.flatnonzero(stream == len(ranks))
    got = sorted(coder.decode(x[:-1].tolist()) for x in np.split(stream, ends + 1)[:-1])
    assert got == sorted([*(t or "" for t in texts), "no id"])
    # a reader that resumes in the middle sees the same records
    assert [(s, t.tolist()) for s, _, t in k.read_slots(path, 13, 21)] == [(s, t.tolist()) for s, _, t in back[13:21]]
    sizes = {os.path.getsize(f"{tmp_path}/shards/{r['file']}") for r in files.collect() if r["records"] == 8}
    assert sizes == {8 * (16 + 2 * 64)}
    held = defaultdict(int)
    for r in rows:
        for d in r["keys"]:
            held[d] += 1
    assert set(held) == {*range(7), None} and held[5] > 40
    crc = {r["slot"]: r["crc32"] for r in k.read_back(files, path).where("in_place").collect()}
    assert crc == {s: zlib.crc32(t.tobytes()) for s, _, t in back}


def test_empty_table(spark, frame, ranks, tmp_path):
    sequences, files, layout = k.materialise(frame([]), ranks, len(ranks), f"file://{tmp_path}/none")
    assert layout.order.n == 0 and sequences.count() == 0 and files.count() == 0


def test_wide_tokens_and_displaced_records(spark, frame, ranks, tmp_path):
    path = f"file://{tmp_path}/wide"
    docs = frame([(i, f"text {i} " * 30) for i in range(20)])
    _, files, layout = k.materialise(docs, ranks, 70_000, path, length=16, per_shard=8)
    assert layout.token_bytes == 4
    tokens = np.concatenate([t for *_, t in k.read_slots(path, 0, layout.sequences)])
    assert (tokens == 70_000).sum() == 20 and k.read_back(files, path).where("not in_place").isEmpty()
    name = f"{tmp_path}/wide/shard-00000000.bin"
    with open(name, "rb") as file:
        data = file.read()
    with open(name, "wb") as file:  # two records change places
        file.write(data[layout.stride : 2 * layout.stride] + data[: layout.stride] + data[2 * layout.stride :])
    assert [r["slot"] for r in k.read_back(files, path).where("not in_place").orderBy("slot").collect()] == [0, 1]


def test_query_joins_by_a_shuffle(spark, sf, capsys):
    QUERIES["op9_training_order"](spark, sf).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_query(spark, sf):
    got = QUERIES["op9_training_order"](spark, sf)
    rows = got.collect()
    assert all(r["in_place"] for r in rows) and sorted(r["slot"] for r in rows) == list(range(len(rows)))
    ids = {d for r in rows for d in r["doc_ids"]}
    assert ids == {r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
