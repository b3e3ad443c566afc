import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators import sets

SCHEMA = "k int, dia string, x double"


@pytest.mark.parametrize("seed", range(3))
def test_located_differences_equal_all_differences(spark, seed):
    rng = random.Random(seed)
    base = [(rng.randint(0, 40) if rng.random() > 0.05 else None, rng.choice(["d1", "d2", None]), rng.choice([0.0, 1.5, None])) for _ in range(400)]
    other = [r for r in base if rng.random() > 0.02] + [(7, "d1", 9.0), (7, "d1", 9.0), (None, None, None)]
    rng.shuffle(other)
    a, b = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(other, SCHEMA)
    want = [rows(x) for x in sets.reconcile(a, b)]
    for window in (None, F.col("dia")):
        only_a, only_b, leaves = sets.reconcile_tree(a, b, ["k"], leaves=16, window=window)
        assert [rows(only_a), rows(only_b)] == want
        assert 0 < leaves.count() <= 48


def test_equal_tables_are_settled_by_their_sums(spark):
    a = spark.createDataFrame([(i % 5, "d", float(i)) for i in range(50)], SCHEMA)
    only_a, only_b, leaves = sets.reconcile_tree(a, a.orderBy(F.desc("x")).repartition(3), ["k"])
    assert leaves.count() == 0 and only_a.count() == only_b.count() == 0
    # a NULL and a value in another column are not the same row
    x = spark.createDataFrame([(1, None, 2.0)], SCHEMA)
    y = spark.createDataFrame([(1, "d", None)], SCHEMA)
    assert [d.count() for d in sets.reconcile_tree(x, y, ["k"])[:2]] == [1, 1]
