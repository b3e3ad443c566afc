import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators import quality as q
from ledgerlake.sources import snapshots


@pytest.fixture(scope="module")
def df(spark):
    data = [(i, None if i == 0 else float(i), "F" if i % 2 else "O") for i in range(20)]
    return spark.createDataFrame(data, "id long, v double, s string")


def report(df, spec):
    return {(r["verificacao"], r["coluna"]): (r["valor"], r["ok"]) for r in q.run_checks(df, spec).collect()}


def test_null_share_boundary(spark, df):
    assert report(df, {"nulls": {}})["nulls", "v"] == (0.05, True)  # exactly 5 % passes
    more = df.where("id < 19")
    assert report(more, {"nulls": {}})["nulls", "v"][1] is False
    assert report(df.limit(0), {"nulls": {}})["nulls", "v"] == (0.0, True)


def test_null_passes_range_and_list(spark, df):
    got = report(df, {"range": {"column": "v", "min_val": 1, "max_val": 19}, "consistency": {"column": "s", "allowed_values": ["F", "O"]}})
    assert got["range", "v"] == (0.0, True) and got["consistency", "s"] == (0.0, True)
    assert rows(q.check_range(df, "v", 2, 19)) == [(1, False)]
    nulls = spark.createDataFrame([(None,), ("F",), ("X",)], "s string")
    assert rows(q.check_allowed(nulls, "s", ["F"])) == [(1, False)]


def test_unique_counts_keys(spark, df):
    twice = df.unionByName(df.where("id < 3"))
    assert report(twice, {"uniqueness": {"key_column": "id"}, "row_count": {"min_rows": 23}}) == {
        ("uniqueness", "id"): (3.0, False), ("row_count", None): (23.0, True),
    }
    assert rows(q.check_unique(twice, ["id"])) == [(3, False)]
    empty = report(df.limit(0), {"uniqueness": {"key_column": "id"}, "row_count": {}})
    assert empty == {("uniqueness", "id"): (0.0, True), ("row_count", None): (0.0, False)}


def test_schema_and_columns(spark, df):
    assert rows(q.check_schema(df, {"id": "long", "v": "double", "s": "string"})) == []
    assert {r[:2] for r in rows(q.check_schema(df, {"id": "integer", "v": "double", "x": "string"}))} == {
        ("id", "tipo"), ("s", "extra"), ("x", "ausente"),
    }
    assert rows(q.check_columns(df, ["id", "x"])) == [("id", True), ("x", False)]


def test_raise_in_order(spark, df):
    with pytest.raises(q.DataQualityError):
        q.raise_on_fail(q.run_checks(df, {"completeness": {"required_columns": ["x"]}}))
    with pytest.raises(q.SchemaDriftError):
        q.raise_on_fail(q.run_checks(df, {"schema_drift": {"expected_schema": {"id": "long"}}}))
    q.raise_on_fail(q.run_checks(df, {"row_count": {"min_rows": 1}, "unknown": {}}))


def test_publish_gate(spark, df, tmp_path):
    path = str(tmp_path / "t")
    q.publish(df, path, 1, {"row_count": {"min_rows": 1}})
    with pytest.raises(q.DataQualityError):
        q.publish(df, path, 2, {"row_count": {"min_rows": 999}})
    assert snapshots.list_versions(spark, path) == ["1"]


def test_metrics_and_status(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, s string")
    m = q.table_metrics(df, "silver", "t", "2024-01-01", 7)
    assert rows(m) == [("silver", "t", "2024-01-01", 3, 1, 1, 7, 83.33)]
    assert q.table_metrics(df.limit(0), "silver", "t", "2024-01-01").isEmpty()
    data = [("t", "2024-01-01", x, y) for x, y in [(94.99, 0), (95.0, 0), (98.99, 0), (99.0, 0), (100.0, 1)]]
    metrics = spark.createDataFrame(data, "tabela string, data_verificacao string, qualidade_pct double, total_duplicatas long")
    assert [r["status"] for r in q.quality_status(metrics).orderBy("qualidade_pct").collect()] == [
        "CRITICO", "ATENCAO", "ATENCAO", "OK", "ATENCAO",
    ]
    assert q.quality_alerts(metrics).count() == 3


def test_monitor_skips_broken(spark):
    df = spark.createDataFrame([(1,)], "id int")
    out = q.monitor_all({"a.x": df, "a.broken": lambda: spark.table("nope"), "a.empty": df.limit(0)}, "2024-01-01")
    assert rows(out, "tabela") == [("x",)]


def test_drift_and_profile(spark):
    old = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b"), (None, None)], "n double, c string")
    new = spark.createDataFrame([(5.0, "a"), (5.0, "a"), (5.0, "c"), (5.0, "b")], "n double, c string")
    got = {r["coluna"]: r for r in q.drift(old, new, ["n"], ["c"]).collect()}
    assert (got["n"]["delta_pct_nulos"], got["n"]["delta_media"]) == (-0.5, 3.0)
    assert got["c"]["distancia_tv"] == pytest.approx((abs(0.5 - 1 / 3) + abs(0.25 - 2 / 3) + 0.25) / 2)
    assert got["c"]["delta_distintos"] == 1
    prof = {r["coluna"]: r for r in q.profile(old, exact=True).collect()}
    assert (prof["n"]["nulos"], prof["n"]["media"], prof["c"]["distintos"]) == (2, 2.0, 2)


def test_monitor_survives_a_table_that_fails_while_running(spark):
    df = spark.createDataFrame([(1,)], "id int")
    bad = df.selectExpr("id / (id - 1) as x")  # division by zero when executed
    assert rows(q.monitor_all({"a.bad": bad, "a.x": df}, "2024-01-01"), "tabela") == [("x",)]


def test_publish_observed_commits_only_what_passes(spark, tmp_path):
    path, made = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    good = spark.createDataFrame([(1, "a", 2.0), (2, "b", None)], "id int, k string, x double")
    checks = {
        "completeness": {"required_columns": ["id"]}, "uniqueness": {"key_column": "id"}, "row_count": {"min_rows": 2},
        "nulls": {"max_null_percentage": 0.5}, "range": {"column": "x", "min_val": 0, "max_val": 5}, "consistency": {"column": "k", "allowed_values": ["a", "b"]},
    }

    def counting(batches):
        for b in batches:
            made.add(len(b))
            yield b

    report = q.publish_observed(good.mapInPandas(counting, good.schema), path, 1, checks)
    assert made.value == 2  # computed once
    assert rows(report) == rows(q.run_checks(good, checks))
    assert snapshots.list_versions(spark, path) == ["1"] and snapshots.read_current(spark, path).count() == 2
    for bad in (good.union(good), good.limit(0), good.withColumn("k", F.lit("z")), good.withColumn("x", F.lit(9.0))):
        with pytest.raises(q.DataQualityError):
            q.publish_observed(bad, path, 2, checks)
        assert snapshots.list_versions(spark, path) == ["1"]
    q.publish_observed(good, path, 2, checks)  # takes the place of the failed attempts
    assert snapshots.list_versions(spark, path) == ["1", "2"] and snapshots.read_current(spark, path).count() == 2
    with pytest.raises(FileExistsError):
        q.publish_observed(good, path, 2, checks)
