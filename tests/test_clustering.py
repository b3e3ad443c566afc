import datetime as dt
import glob

import pytest
import pyarrow.parquet as pq
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.sources import clustering


def skipped(path, column, low, high):
    """Share of files that a filter low <= column < high need not open, by their minima and maxima."""
    files, out = sorted(glob.glob(f"{path}/*.parquet")), 0
    for name in files:
        meta = pq.ParquetFile(name).metadata
        at = [i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == column][0]
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out += max(s.max for s in stats) < low or min(s.min for s in stats) >= high
    return out / len(files)


def test_every_column_skips_files(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 6).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)).alias("b"), "id"
    )
    path = str(tmp_path / "z")
    clustering.rewrite_zordered(df, path, ["a", "b"], 16)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).isEmpty() and back.count() == 60_000
    assert skipped(path, "a", 100, 150) >= 0.5 and skipped(path, "b", 100, 150) >= 0.5


def test_odd_columns(spark, tmp_path):
    data = [(None, None, None, None), ("a", dt.date(2024, 1, 1), 1.5, True), ("é", dt.date(1960, 1, 1), float("nan"), False), ("", None, -1.0, None)] * 3
    df = spark.createDataFrame(data, "s string, d date, x double, flag boolean")
    clustering.rewrite_zordered(df, path := str(tmp_path / "z"), ["s", "d", "x", "flag"], 3)
    assert repr(rows(spark.read.parquet(path))) == repr(rows(df))
    clustering.rewrite_zordered(df.limit(0), path := str(tmp_path / "none"), ["s", "x"], 3)
    assert spark.read.schema(df.schema).parquet(path).count() == 0
    with pytest.raises(ValueError):
        clustering.zorder_key(df, [])


def test_ranks_follow_the_order_of_values(spark):
    df = spark.createDataFrame([(x, None if x == 0 else f"{x:03d}") for x in range(300)], "n int, s string")
    got = clustering.zorder_key(df, ["n"]).orderBy("n").select("_z").collect()
    zs = [r[0] for r in got]
    assert zs == sorted(zs) and len(set(zs)) > 100
    texts = [r[0] for r in clustering.zorder_key(df, ["s"]).orderBy("n").select("_z").collect()]
    assert texts == sorted(texts) and texts[0] == 0
