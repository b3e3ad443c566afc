"""Upsert and validity history: hand-made cases and invariants."""

import datetime as dt
import random

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as s
from pyspark.sql import functions as F

from ledgerlake.operators import history
from ledgerlake.operators.joins import dedup_latest, plan_text, scd2_asof_join
from ledgerlake.sources.scratch import stage
from ledgerlake.sources.tables import write_partitioned

D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"
FAR = dt.date(9999, 12, 31)


def batch(spark, data):
    return spark.createDataFrame(data, "k string, v string")


def d(text):
    return dt.date.fromisoformat(text)


def versions(hist):
    return rows(hist, "k", "v", "data_inicio", "data_fim", "atual")


def test_upsert(spark):
    target = batch(spark, [("a", "1"), ("b", "2")])
    assert rows(history.upsert(target, batch(spark, [("b", "3"), ("c", "4")]), ["k"])) == [("a", "1"), ("b", "3"), ("c", "4")]
    assert rows(history.upsert(target, batch(spark, []), ["k"])) == [("a", "1"), ("b", "2")]
    assert rows(history.upsert(batch(spark, []), target, ["k"])) == rows(target)
    assert rows(history.upsert(None, target, ["k"])) == rows(target)
    with pytest.raises(history.DuplicateKeyError):
        history.upsert(target, batch(spark, [("a", "1"), ("a", "2")]), ["k"])


def test_upsert_new_column(spark):
    source = spark.createDataFrame([("b", "3", 9)], "k string, v string, extra int")
    out = history.upsert(batch(spark, [("a", "1"), ("b", "2")]), source, ["k"])
    assert rows(out, "k", "v", "extra") == [("a", "1", None), ("b", "3", 9)]


def test_diff(spark):
    old = batch(spark, [("same", "1"), ("null", None), ("changed", "1"), ("gone", "1"), ("tonull", "1")])
    new = batch(spark, [("same", "1"), ("null", None), ("changed", "2"), ("new", "1"), ("tonull", None)])
    assert dict(rows(history.diff(old, new, ["k"], ["v"]), "k", "mudanca")) == {
        "same": "igual", "null": "igual", "changed": "alterado", "gone": "ausente", "new": "novo", "tonull": "alterado",
    }


def test_scd2_changes(spark):
    h1 = history.scd2_apply(None, batch(spark, [("same", "1"), ("chg", "1"), ("miss", "1"), ("null", None)]), "k", D1)
    h2 = history.scd2_apply(h1, batch(spark, [("same", "1"), ("chg", "2"), ("new", None), ("null", "x")]), "k", D2)
    assert versions(h2) == sorted([
        ("same", "1", d(D1), FAR, True),
        ("chg", "1", d(D1), d(D2), False), ("chg", "2", d(D2), FAR, True),
        ("miss", "1", d(D1), FAR, True),
        ("new", None, d(D2), FAR, True),
        ("null", None, d(D1), d(D2), False), ("null", "x", d(D2), FAR, True),
    ], key=repr)
    back = history.scd2_apply(h2, batch(spark, [("chg", "1")]), "k", D3)
    assert [r for r in versions(back) if r[0] == "chg"] == sorted([
        ("chg", "1", d(D1), d(D2), False), ("chg", "2", d(D2), d(D3), False), ("chg", "1", d(D3), FAR, True),
    ], key=repr)


def test_scd2_close_missing_and_snapshot(spark):
    h1 = history.scd2_apply(None, batch(spark, [("a", "1"), ("b", "1")]), "k", D1)
    closed = history.scd2_apply(h1, batch(spark, [("a", "1")]), "k", D2, close_missing=True)
    assert versions(closed) == [("a", "1", d(D1), FAR, True), ("b", "1", d(D1), d(D2), False)]
    snap = history.scd2_apply(h1, batch(spark, [("a", "1")]), "k", D2, mode="snapshot")
    assert versions(snap) == [
        ("a", "1", d(D1), d(D2), False), ("a", "1", d(D2), FAR, True), ("b", "1", d(D1), FAR, True),
    ]


@pytest.mark.parametrize("mode", ["changes", "snapshot"])
def test_scd2_same_day_rerun(spark, mode):
    h1 = history.scd2_apply(None, batch(spark, [("a", "1")]), "k", D1)
    b2 = batch(spark, [("a", "2"), ("b", "1")])
    h2 = history.scd2_apply(h1, b2, "k", D2, mode=mode)
    assert versions(history.scd2_apply(h2, b2, "k", D2, mode=mode)) == versions(h2)
    fixed = history.scd2_apply(h2, batch(spark, [("a", "3")]), "k", D2, mode=mode)
    assert [r for r in versions(fixed) if r[0] == "a"] == [("a", "1", d(D1), d(D2), False), ("a", "3", d(D2), FAR, True)]


def test_scd2_refuses(spark):
    h = history.scd2_apply(None, batch(spark, [("a", "1")]), "k", D2)
    with pytest.raises(history.LateBatchError):
        history.scd2_apply(h, batch(spark, [("a", "2")]), "k", D1)
    with pytest.raises(history.DuplicateKeyError):
        history.scd2_apply(h, batch(spark, [("a", "2"), ("a", "3")]), "k", D3)
    with pytest.raises(ValueError):
        history.scd2_apply(h, batch(spark, []), "k", D3, mode="other")


keys = s.sampled_from("abcd")
values = s.one_of(s.none(), s.sampled_from(["1", "2"]))
batches = s.lists(s.dictionaries(keys, values, min_size=1), min_size=1, max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_scd2_invariants(spark, daily):
    """One open version per key, no overlap, no gap, and equal to a plain replay."""
    hist, truth = None, {}
    for n, day_batch in enumerate(daily):
        asof = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        hist = history.scd2_apply(hist, batch(spark, list(day_batch.items())), "k", asof)
        for k, v in day_batch.items():
            runs = truth.setdefault(k, [])
            if not runs or runs[-1][1] != v:
                runs.append((asof, v))
    got = {}
    for k, v, a, b, cur in versions(hist):
        got.setdefault(k, []).append((a, v, b, cur))
    assert set(got) == set(truth)
    for k, vs in got.items():
        vs.sort(key=lambda r: r[0])
        assert [(a, v) for a, v, _, _ in vs] == truth[k]
        assert [cur for *_, cur in vs] == [False] * (len(vs) - 1) + [True]
        assert all(x[2] == y[0] for x, y in zip(vs, vs[1:])) and vs[-1][2] == FAR


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(s.dictionaries(keys, values), s.dictionaries(keys, values, min_size=1))
def test_upsert_is_idempotent(spark, old, new):
    source = batch(spark, list(new.items()))
    once = history.upsert(batch(spark, list(old.items())), source, ["k"])
    assert dict(rows(once)) == {**old, **new}
    assert rows(history.upsert(once, source, ["k"])) == rows(once)


def test_asof_join(spark):
    hist = spark.createDataFrame(
        [("a", "old", d(D1), d(D2)), ("a", "new", d(D2), FAR), ("b", "only", d(D2), d(D3))],
        "k string, v string, data_inicio date, data_fim date",
    )
    events = spark.createDataFrame(
        [("a", d("2023-12-31")), ("a", d(D1)), ("a", d(D2)), ("a", d("2031-05-05")), ("b", d(D3)), ("b", d(D2)), ("c", d(D2))],
        "k string, dia date",
    )
    for slot in (1, 30, 5000):
        assert rows(scd2_asof_join(events, hist, "k", "dia", slot_days=slot), "k", "dia", "v") == sorted([
            ("a", d("2023-12-31"), None), ("a", d(D1), "old"), ("a", d(D2), "new"), ("a", d("2031-05-05"), "new"),
            ("b", d(D2), "only"), ("b", d(D3), None), ("c", d(D2), None),
        ], key=repr)


def test_rebuild_equals_daily_runs(spark):
    days = {D1: [("a", "1"), ("b", "1")], D2: [("a", "1"), ("b", "2")], D3: [("a", "2"), ("b", "2")]}
    hist = None
    for day, data in days.items():
        hist = history.scd2_apply(hist, batch(spark, data), "k", day)
    snaps = spark.createDataFrame([(k, v, d(day)) for day, data in days.items() for k, v in data], "k string, v string, dia date")
    assert versions(history.scd2_from_snapshots(snaps, "k", ["v"], "dia")) == versions(hist)


def test_erase_and_retain(spark):
    t = {"x": batch(spark, [("a", "1"), ("a", "2"), ("b", "1")]), "y": batch(spark, [("b", "1")])}
    left, removed = history.erase_subject(t, "k", spark.createDataFrame([("a",), ("a",)], "k string"))
    assert rows(left["x"]) == [("b", "1")] and rows(left["y"]) == [("b", "1")]
    assert rows(removed) == [("x", 2), ("y", 0)]
    dated = spark.createDataFrame([(d("2024-01-01"),), (d("2023-12-02"),), (d("2023-12-01"),)], "dia date")
    assert rows(history.retain(dated, "dia", 30, "2024-01-01")) == [(d("2023-12-02"),), (d("2024-01-01"),)]


def test_dedup_is_deterministic(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z")] * 50 + [("b", None, None)]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(dedup_latest(df, ["k"], ["t"])) == [("a", 2, "z"), ("b", None, None)]


DAYS = ["2024-01-01", "2024-01-05", "2024-01-07", "2024-01-10", "2024-01-20"]


@pytest.mark.parametrize("seed", range(4))
def test_splice_in_any_order_equals_a_rebuild(spark, seed):
    rng = random.Random(seed)
    batches = {d: {k: rng.choice(["a", "b", None]) for k in range(12) if rng.random() < 0.8} for d in DAYS}
    order = [*DAYS, rng.choice(DAYS)]
    rng.shuffle(order)
    hist = None
    for day in order:
        batch = spark.createDataFrame([(k, v) for k, v in batches[day].items()], "cli int, perfil string")
        hist = stage(history.scd2_splice(hist, batch, "cli", day), "h")
    seen = spark.createDataFrame([(k, v, d) for d, b in batches.items() for k, v in b.items()], "cli int, perfil string, dia string")
    rebuilt = history.scd2_from_snapshots(seen.withColumn("dia", F.col("dia").cast("date")), "cli", ["perfil"], "dia")
    assert rows(hist.drop(history.SEEN)) == rows(rebuilt)
    days = {(r["cli"], str(d)) for r in hist.collect() for d in r[history.SEEN]}
    assert days == {(k, d) for d, b in batches.items() for k in b}


def test_splice_replaces_a_day_and_leaves_other_keys(spark):
    make = lambda pairs: spark.createDataFrame(pairs, "cli int, perfil string")
    hist = None
    for day, pairs in (("2024-01-01", [(1, "a"), (2, "a")]), ("2024-01-05", [(1, "b")]), ("2024-01-09", [(1, "a")])):
        hist = stage(history.scd2_splice(hist, make(pairs), "cli", day), "h")
    hist = history.scd2_splice(hist, make([(1, "a")]), "cli", "2024-01-05")
    assert [tuple(map(str, r)) for r in sorted(hist.drop(history.SEEN).collect())] == [
        ("1", "a", "2024-01-01", "9999-12-31", "True"), ("2", "a", "2024-01-01", "9999-12-31", "True")
    ]
    with pytest.raises(history.DuplicateKeyError):
        history.scd2_splice(hist, make([(1, "a"), (1, "b")]), "cli", "2024-01-06")


def test_erase_leaves_untouched_files(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    data = [(i, y, z) for i in range(40) for y in (2020, 2021, 2022) for z in ("a b", None) if not (y == 2022 and i > 1)]
    write_partitioned(spark.createDataFrame(data, "id int, ano int, zona string"), path, ["ano", "zona"])
    times = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    # subject 7 is in every year but 2022, subjects 0 and 1 are all of 2022: they go from one zone only
    before = times()
    gone = spark.createDataFrame([(99,), (None,)], "id int")
    assert history.erase_in_place(spark, path, ["ano", "zona"], "id", gone) == [] and times() == before
    history.erase_in_place(spark, path, ["ano", "zona"], "id", spark.createDataFrame([(7,), (7,)], "id int"))
    after = times()
    kept = {f: t for f, t in before.items() if "ano=2022" in f}
    assert kept and kept.items() <= after.items() and not {f for f in before if "ano=2022" not in f} & set(after)
    history.erase_in_place(spark, path, ["ano", "zona"], "id", spark.createDataFrame([(0,), (1,)], "id int"))
    want = [r for r in data if r[0] not in (0, 1, 7)]
    assert rows(spark.read.schema("id int, ano int, zona string").parquet(path), "id", "ano", "zona") == sorted(want, key=repr)


def test_daily_states_equal_the_history_on_each_day(spark):
    rng = random.Random(3)
    seen = [(k, rng.choice(["a", "b", None]), f"2024-01-{day:02d}") for k in range(9) for day in (1, 4, 9) if rng.random() < 0.8]
    hist = history.scd2_from_snapshots(spark.createDataFrame(seen, "cli int, v string, dia string").withColumn("dia", F.col("dia").cast("date")), "cli", ["v"], "dia")
    hist = stage(hist, "h")
    got = {(str(r["dia"]), r["v"]): r["clientes"] for r in history.daily_states(hist, "v", "2023-12-30", "2024-01-12").collect()}
    want = {}
    for day in ["2023-12-30", *[f"2024-01-{d:02d}" for d in range(1, 12)]]:
        for r in history.scd2_at(hist, day).groupBy("v").count().collect():
            want[day, r["v"]] = r["count"]
    assert got == want


def test_splice_makes_the_pieces_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "cli int, p string")
    hist = history.scd2_splice(None, rows, "cli", "2024-01-03")
    late = history.scd2_splice(hist, rows.limit(1), "cli", "2024-01-01")
    assert plan_text(late, "simple").count("array_sort(") == 1 and late.count() == 2
