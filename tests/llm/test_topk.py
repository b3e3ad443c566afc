import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from ledgerlake.llm import topk as k
from ledgerlake.llm.queries import ORACLES, QUERIES


def brute(rows, asks, n):
    usable = [(i, key, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, (key, v) in enumerate(rows)
              if v is not None and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all()]
    out = []
    for i, key, q in usable:
        if key is None or not asks(key):
            continue
        scored = []
        for j, other, c in usable:
            if i != j:
                m = min(len(q), len(c))
                scored.append((-int(q[:m] @ c[:m]), other is None, other or 0, j))
        out += [(key, r + 1, None if none else other, -s) for r, (s, none, other, _) in enumerate(sorted(scored)[:n])]
    return sorted(out, key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, id string, row int")


@pytest.mark.parametrize("block, shelf", [(8192, 2), (16, 1), (50, 3)])
def test_matches_brute_force(spark, block, shelf):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 12).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[10][1]) for i in range(15)]  # ties
    rows += [(10, rows[10][1]), (None, rows[10][1]), (400, None), (410, []), (420, [0.0] * 12), (430, [float("nan")] * 12),
             (440, [float("inf")] + [0.0] * 11), (450, [0.5, -0.5]), (460, [None] + [0.1] * 11)]
    got = k.search(frame_of(spark, rows), F.col("vec_id") % 10 == 0, block=block, per_shelf=shelf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lambda i: i % 10 == 0, 10)


def test_few_rows(spark):
    rows = [(0, [0.5]), (1, [0.25])]
    assert [tuple(r) for r in k.search(frame_of(spark, rows), F.col("vec_id") == 0).collect()] == [(0, 1, 1, 512 * 256)]
    assert k.search(frame_of(spark, rows[:1]), F.lit(True)).count() == 0
    assert k.search(frame_of(spark, []), F.lit(True)).count() == 0


def test_reading_stops_early_on_proof():
    rng = np.random.default_rng(1)
    ints = rng.integers(-100, 100, (4000, 16))
    ints[7] = 900
    index = k.Index(ints, np.argsort(-ints, axis=0, kind="stable").T.astype(np.int32).ravel())
    q = np.full(16, 500)
    left = index.best(q, 1, None)
    assert 7 in left and len(left) < 200


def test_query_matches_its_oracle(spark, sf):
    assert compare(QUERIES["op10_impact_topk"](spark, sf), duck(sf), ORACLES["op10_impact_topk"]) is None
