"""Parquet and catalog tables: scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_path(ref: str) -> bool:
    return "/" in ref


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def mark_written(spark: SparkSession, path: str) -> None:
    """Put the success marker into a folder: from then on it counts as written."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(hpath, True).close()


def table_exists(spark: SparkSession, ref: str) -> bool:
    return path_exists(spark, ref) if is_path(ref) else spark.catalog.tableExists(ref)


def read_table(spark: SparkSession, ref: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a path or a catalog table; only the named columns are read."""
    df = spark.read.parquet(ref) if is_path(ref) else spark.table(ref)
    return df.select(*columns) if columns else df


def read_landing(spark: SparkSession, base: str, glob: str = "extracao=*") -> DataFrame:
    """All daily landing folders under ``base``; the folder key stays a column."""
    return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{glob}")


def write_landing(df: DataFrame, base: str, asof: str, key: str = "extracao") -> str:
    """Replace one day's landing folder. A second run of the day gives the same folder."""
    path = f"{base.rstrip('/')}/{key}={asof}"
    df.write.mode("overwrite").parquet(path)
    return path


def conform(df: DataFrame, schema) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks as typed NULLs; keep extra columns last."""
    have = set(df.columns)
    cols = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    known = {f.name for f in schema.fields}
    return df.select(*cols, *[c for c in df.columns if c not in known])


def write_overwrite(df: DataFrame, path: str) -> None:
    """Overwrite, merging schemas: new columns are taken in, dropped ones stay as NULL."""
    spark = df.sparkSession
    if path_exists(spark, path):
        df = conform(df, spark.read.parquet(path).schema)
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("ano", "mes")) -> None:
    """Replace only the partitions present in ``df``.

    Rows are spread by the partition key plus a hash of the row within AQE's rebalance, so a
    partition holding most rows is written by several tasks instead of one.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_as_table(df: DataFrame, ref: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*by) if by else writer).saveAsTable(ref)


def register_external(spark: SparkSession, ref: str, path: str) -> None:
    """Name a parquet path in the catalog, creating the schema when missing."""
    if "." in ref:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {ref.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ref} USING parquet LOCATION '{path}'")
    if spark.catalog.tableExists(ref) and any(
        c.isPartition for c in spark.catalog.listColumns(ref)
    ):
        spark.sql(f"MSCK REPAIR TABLE {ref}")


def load_all(spark: SparkSession, spec: dict[str, str], target: str) -> DataFrame:
    """Re-load landed paths into tables under ``target``; a failing one does not stop the rest.

    Returns one status row per table: tabela, ok, registros, erro. The loop is over table
    names; the rows themselves move inside Spark. Row counts come from the written files.
    """
    status = []
    for name, source in spec.items():
        dest = f"{target.rstrip('/')}/{name}"
        try:
            write_overwrite(spark.read.parquet(source), dest)
            status.append((name, True, spark.read.parquet(dest).count(), None))
        except Exception as exc:  # noqa: BLE001 - reported per table
            status.append((name, False, None, type(exc).__name__))
    return spark.createDataFrame(status, "tabela string, ok boolean, registros bigint, erro string")
