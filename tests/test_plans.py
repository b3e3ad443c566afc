"""Physical plans: pushdown, guarded broadcasts, single scans."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.operators import joins, quality, windows
from ledgerlake.operators.joins import plan_text
from ledgerlake.queries import views as v
from ledgerlake.sources import snapshots, tables


def scans(text):
    return len(re.findall(r"FileScan parquet", text))


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan_text(entry.queries()["scan_parquet"](spark, sf))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "o_custkey" not in text


def test_broadcast_only_of_a_proven_bound(spark, sf):
    o = v.table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    c = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joins.explain_has(joins.guarded_join(o, c, "o_custkey", rows=c.count()), "BroadcastHashJoin")
        assert not joins.explain_has(joins.guarded_join(o, c, "o_custkey", rows=c.count(), max_rows=10), "BroadcastHashJoin")
        assert not joins.explain_has(joins.guarded_join(o, c, "o_custkey"), "BroadcastHashJoin")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_reject_becomes_inner(spark, sf):
    o = v.table(spark, sf, "orders").select("o_custkey")
    c = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    text = plan_text(joins.join_left_reject(o, c, "o_custkey", "c_name"), "simple")
    assert "Inner" in text and "LeftOuter" not in text


def test_checks_are_one_scan(spark, sf):
    df = v.table(spark, sf, "orders")
    spec = {
        "uniqueness": {"key_column": "o_orderkey"}, "nulls": {}, "row_count": {},
        "range": {"column": "o_totalprice", "min_val": 0, "max_val": 1}, "consistency": {"column": "o_orderstatus", "allowed_values": ["F"]},
    }
    assert scans(plan_text(quality.run_checks(df, spec), "simple")) == 1
    assert scans(plan_text(quality.table_metrics(df, "a", "b", "2024-01-01"), "simple")) == 1
    assert scans(plan_text(quality.profile(df), "simple")) == 1


def test_current_snapshot_is_partition_pruned(spark, tmp_path):
    path = str(tmp_path / "s")
    tables.write_partitioned(spark.range(10).withColumn("ver", F.col("id") % 3), path, ["ver"])
    text = plan_text(snapshots.current_snapshot(spark.read.parquet(path)), "simple")
    assert re.search(r"PartitionFilters: \[isnotnull\(ver#\d+\), \(ver#\d+ = ", text)


def test_dedup_and_sessions_combine_before_the_shuffle(spark, sf):
    e = v.table(spark, sf, "events")
    assert "partial_max" in plan_text(joins.dedup_latest(e, ["user_id"], ["ts"]), "simple")
    assert "partial_min" in plan_text(windows.sessionize(e, "user_id", "ts", 60), "simple")
    assert "partial_sum" in plan_text(windows.sliding_agg(e, "user_id", "ts", 60, 30, "value"), "simple")
