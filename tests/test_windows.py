"""Windows against brute force on small random series, with one dominant key."""

import datetime as dt
import random
import statistics

import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators import windows
from ledgerlake.operators.windows import Trailing

DAY0 = dt.date(2020, 1, 1)
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series():
    rng = random.Random(7)
    days = sorted(rng.sample(range(2000), 400))
    out = [("hot", DAY0 + dt.timedelta(days=d), round(rng.uniform(1, 100), 2)) for d in days]
    out += [("cold", DAY0 + dt.timedelta(days=d), None if d % 7 == 0 else float(d)) for d in range(0, 1500, 13)]
    return out


def frame(data, key, day, days):
    return [v for k, d, v in data if k == key and 0 <= (day - d).days <= days and v is not None]


def test_trailing(spark, series):
    df = spark.createDataFrame(series, "k string, d date, v double")
    specs = [Trailing("m", "avg", "v", 30), Trailing("s", "stddev", "v", 90), Trailing("t", "sum", "v", 365)]
    for slot in (None, 365, 1000):
        out = windows.trailing(df, "d", specs, ["k"], slot_days=slot).collect()
        assert len(out) == len(series)
        for r in out:
            m, s, t = (frame(series, r["k"], r["d"], n) for n in (30, 90, 365))
            assert r["m"] == (pytest.approx(statistics.mean(m)) if m else None)
            assert r["s"] == (pytest.approx(statistics.stdev(s)) if len(s) > 1 else None)
            assert r["t"] == (pytest.approx(sum(t)) if t else None)


def test_zscore_equals_window(spark, series):
    from pyspark.sql import Window

    df = spark.createDataFrame(series, "k string, d date, v double")
    w = Window.partitionBy("k")
    z = F.round((F.col("v") - F.avg("v").over(w)) / F.stddev("v").over(w), 4)
    assert rows(windows.zscore(df, "k", "v"), "k", "d", "zscore") == rows(df.withColumn("z", z), "k", "d", "z")


def test_zscore_constant_and_single(spark):
    df = spark.createDataFrame([("c", 1.0), ("c", 1.0), ("s", 5.0)], "k string, v double")
    assert {tuple(r) for r in windows.zscore(df, "k", "v").select("zscore", "anomalia").collect()} == {(None, False)}


@pytest.fixture(scope="module")
def events():
    """900 events, most of them of one user and many at the same instant."""
    rng = random.Random(3)
    out = []
    for i in range(900):
        user = "hot" if rng.random() < 0.7 else f"u{rng.randrange(5)}"
        second = rng.choice([0, 600, 1200]) if rng.random() < 0.3 else rng.randrange(20000)
        out.append((i, user, T0 + dt.timedelta(seconds=second), round(rng.uniform(0, 10), 2)))
    return out


SCHEMA = "id int, u string, ts timestamp_ntz, v double"


@pytest.mark.parametrize("slot", [7, 60, 5000])
def test_velocity(spark, events, slot):
    out = windows.velocity_flag(spark.createDataFrame(events, SCHEMA), "u", "ts", 600, 3, slot_seconds=slot)
    got = {r["id"]: (r["eventos_janela"], r["alerta_velocidade"], r["v"]) for r in out.collect()}
    assert len(got) == len(events)
    for i, u, ts, v in events:
        n = sum(1 for _, x, t, _ in events if x == u and 0 <= (ts - t).total_seconds() <= 600)
        assert got[i] == (n, n >= 3, v)


def test_velocity_keeps_events_without_key_or_time(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "a", t, 1.0), (2, None, t, 1.0), (3, "a", None, 1.0)], SCHEMA)
    out = windows.velocity_flag(df, "u", "ts", 600, 1)
    assert rows(out, "id", "eventos_janela", "alerta_velocidade") == [(1, 1, True), (2, None, False), (3, None, False)]


def test_sessions(spark, events):
    out = windows.sessionize(spark.createDataFrame(events, SCHEMA), "u", "ts", 120, "v")
    expected = []
    for u in {e[1] for e in events}:
        mine = sorted((t, v) for _, x, t, v in events if x == u)
        current = [mine[0]]
        for prev, this in zip(mine, mine[1:]):
            if (this[0] - prev[0]).total_seconds() > 120:
                expected.append((u, len(current), current))
                current = []
            current.append(this)
        expected.append((u, len(current), current))
    want = sorted((u, c[0][0], c[-1][0] + dt.timedelta(seconds=120), n, round(sum(v for _, v in c), 2)) for u, n, c in expected)
    got = sorted(tuple(r) for r in out.select("u", F.col("inicio").cast("timestamp_ntz"), F.col("fim").cast("timestamp_ntz"), "eventos", "valor_total").collect())
    assert got == want


def test_gap_equal_to_limit_continues(spark):
    data = [(1, "a", T0, 1.0), (2, "a", T0 + dt.timedelta(seconds=60), 1.0), (3, "a", T0 + dt.timedelta(seconds=120, microseconds=1), 1.0)]
    out = windows.sessionize(spark.createDataFrame(data, SCHEMA), "u", "ts", 60)
    assert sorted(r["eventos"] for r in out.collect()) == [1, 2]


def test_sliding_matches_builtin(spark, events):
    df = spark.createDataFrame(events, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    got = rows(windows.sliding_agg(df, "u", "ts", 1800, 600, "v"), "u", "inicio", "fim", "eventos")
    builtin = df.groupBy("u", F.window("ts", "1800 seconds", "600 seconds").alias("w")).count()
    assert got == rows(builtin.select("u", "w.start", "w.end", "count"))
    with pytest.raises(ValueError):
        windows.sliding_agg(df, "u", "ts", 1000, 600, "v")


def test_rank_rows_with_ties(spark):
    rng = random.Random(1)
    data = [(i, 5 if rng.random() < 0.5 else rng.randrange(10)) for i in range(500)]
    out = windows.rank_rows(spark.createDataFrame(data, "id int, v int"), [F.desc("v"), F.asc("id")], parts=7)
    want = {i: n for n, (i, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), 1)}
    assert {r["id"]: r["posicao"] for r in out.collect()} == want


def test_rolling_corr(spark):
    flat = [("a", DAY0 + dt.timedelta(days=i), float(i), None if i == 2 else 2.0 * i) for i in range(5)]
    df = spark.createDataFrame(flat + [("b", DAY0, 1.0, 1.0), ("b", DAY0 + dt.timedelta(days=1), 1.0, 2.0)], "k string, d date, x double, y double")
    got = {(r["k"], r["d"].day): r["correlacao"] for r in windows.rolling_corr(df, "k", "d", "x", "y").collect()}
    assert got["a", 1] is None and got["a", 5] == 1.0
    assert got["b", 2] is None  # x does not vary


def test_pct_change(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 6.0)], "k string, t int, v double")
    assert rows(windows.pct_change(df, ["k"], "t", "v", "c"), "t", "c") == [(1, None), (2, None), (3, 20.0)]
