import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import profiles

COLS = ["x", "s", "none"]


def made(spark, n=20_000):
    return spark.range(n).select(
        (F.pmod(F.col("id") * 7919, F.lit(5000)) - 100).cast("double").alias("x"), F.concat(F.lit("k"), F.col("id") % 700).alias("s"),
        F.lit(None).cast("int").alias("none"), F.concat(F.lit("dia"), F.col("id") % 5).alias("dia"),
    )


def test_merged_profiles_are_within_their_error(spark):
    df = made(spark)
    parts = profiles.profile_parts(df, COLS, "dia")
    assert parts.count() == 15
    got = {r["coluna"]: r for r in profiles.read_profile(profiles.merge_profiles(parts, numeric=["x"])).collect()}
    assert {c: (r["registros"], r["nulos"]) for c, r in got.items()} == {"x": (20_000, 0), "s": (20_000, 0), "none": (20_000, 20_000)}
    assert abs(got["x"]["distintos_aprox"] / 5000 - 1) < 4 * profiles.DISTINCT_ERROR
    assert abs(got["s"]["distintos_aprox"] / 700 - 1) < 4 * profiles.DISTINCT_ERROR and got["none"]["distintos_aprox"] == 0
    assert float(got["x"]["minimo"]) == -100 and float(got["x"]["maximo"]) == 4899  # as numbers, not as texts
    assert got["s"]["q50"] is None and got["none"]["q50"] is None
    for share in (25, 50, 75):
        assert got["x"][f"q{share}"] == pytest.approx(5000 * share / 100 - 100, abs=3 * profiles.RANK_ERROR * 5000)
    # profiles of profiles are the same
    again = profiles.merge_profiles(profiles.merge_profiles(parts, ["dia", "coluna"], ["x"]), numeric=["x"])
    assert {r["coluna"]: r["registros"] for r in again.collect()} == {c: 20_000 for c in COLS}


def test_drift_ranks_the_shifted_column_first(spark):
    old = spark.range(20_000).select(F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("b"), F.col("id").alias("c"))
    new = old.select((F.col("a") + 6000).alias("a"), (F.col("b") + 200).alias("b"), F.lit(None).cast("bigint").alias("c"))
    cols = ["a", "b", "c"]
    far = profiles.distribution_drift(profiles.profile_parts(old, cols), profiles.profile_parts(new, cols)).collect()
    got = {r["coluna"]: r for r in far}
    assert set(got) == {"a", "b"}
    assert got["a"]["ks"] == pytest.approx(0.3, abs=0.03) and got["b"]["ks"] < 0.04
    assert got["a"]["psi"] > 0.2 > got["b"]["psi"] >= 0


def test_empty_profiles(spark):
    none = made(spark, 0)
    parts = profiles.profile_parts(none, COLS, "dia")
    assert parts.count() == 0
    assert profiles.distribution_drift(profiles.profile_parts(none, COLS), profiles.profile_parts(made(spark, 100), COLS)).count() == 0
