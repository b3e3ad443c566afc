import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators import incremental
from ledgerlake.sources import snapshots
from ledgerlake.sources.scratch import stage

SPEC = incremental.Totals(["grupo", "zona"], ["valor"], ["valor", "dia"])
SCHEMA = "id int, grupo string, zona int, valor double, dia int, ver int"


def versions(rng, n):
    held, out = {}, []
    for ver in range(n):
        for i in range(60):
            move = rng.random()
            if move < 0.25:
                held[i] = (rng.choice(["a", "b", "c", None]), rng.randint(0, 1), rng.choice([None, 0.1, 2.5, -3.0]), rng.randint(0, 9))
            elif move < 0.35:
                held.pop(i, None)
        out += [(i, *row, ver) for i, row in held.items()]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_maintained_totals_equal_a_recompute(spark, seed):
    snaps = stage(spark.createDataFrame(versions(random.Random(seed), 4), SCHEMA), "s")
    state = None
    for ver in range(4):
        known = snaps.where(F.col("ver") <= ver)
        changes = snapshots.changes_since(known, ["id"], start=ver - 1 if ver else None, types=incremental.ALL_CHANGES, keep_meta=True)
        current = known.where(F.col("ver") == ver).drop("ver")
        state = stage(incremental.maintain(state, changes, SPEC, current), "t")
        assert rows(state, *SPEC.columns) == rows(incremental.totals_of(current, SPEC), *SPEC.columns)


def test_only_groups_that_lost_an_extreme_are_looked_up(spark):
    make = lambda data: spark.createDataFrame(data, "id int, grupo string, zona int, valor double, dia int")
    state = stage(incremental.totals_of(make([(1, "a", 0, 1.0, 1), (2, "a", 0, 5.0, 2), (3, "b", 0, 1.0, 1), (4, "b", 0, 2.0, 2)]), SPEC), "s")
    kinds = [(1, "a", 0, 1.0, 1, "delete"), (5, "a", 0, 0.5, 0, "insert"), (6, "b", 0, 9.0, 3, "insert")]
    changes = spark.createDataFrame(kinds, f"id int, grupo string, zona int, valor double, dia int, {snapshots.CHANGE_TYPE} string")
    # rows that would give wrong extremes: they must not be read, since better values came
    wrong = make([(9, "a", 0, -99.0, -99), (9, "b", 0, -99.0, -99)])
    got = {r["grupo"]: r for r in incremental.maintain(state, changes, SPEC, wrong).collect()}
    assert (got["a"]["min_valor"], got["a"]["max_valor"], got["a"]["registros"]) == (0.5, 5.0, 2)
    assert (got["b"]["min_valor"], got["b"]["max_valor"], got["b"]["registros"]) == (1.0, 9.0, 3)
    gone = spark.createDataFrame([(4, "b", 0, 2.0, 2, "delete")], changes.schema)
    rest = make([(3, "b", 0, 1.0, 1), (9, "a", 0, -99.0, -99)])
    got = {r["grupo"]: r for r in incremental.maintain(state, gone, SPEC, rest).collect()}
    assert got["b"]["max_valor"] == 1.0 and got["a"]["min_valor"] == 1.0


def test_groups_without_rows_go(spark):
    make = lambda data: spark.createDataFrame(data, "id int, grupo string, zona int, valor double, dia int")
    state = incremental.totals_of(make([(1, None, 0, None, 1)]), SPEC)
    gone = spark.createDataFrame([(1, None, 0, None, 1, "delete")], f"id int, grupo string, zona int, valor double, dia int, {snapshots.CHANGE_TYPE} string")
    assert incremental.maintain(state, gone, SPEC, make([])).count() == 0
