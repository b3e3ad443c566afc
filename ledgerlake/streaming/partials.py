"""Partial results that micro-batches store, one folder per batch, and the base into which they are compacted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import snapshots

BATCH = "batch_id"


def stored_partials(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The compacted base of a folder of partial results and the batches after it."""
    base = f"{path}_base"
    known = snapshots.list_versions(spark, base)
    fields = T.StructType([f for f in schema.fields if f.name != BATCH])
    later = spark.read.schema(T.StructType([*fields.fields, T.StructField(BATCH, T.LongType())])).parquet(path)
    if not known:
        return later.drop(BATCH)
    later = later.where(F.col(BATCH) > int(known[-1]))  # folders up to there are not opened
    return snapshots.read_snapshots(spark, base, known[-1:]).drop("ver").select(*fields.names).unionByName(later.drop(BATCH))


def compact_partials(spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]) -> int | None:
    """Merge all batches so far into a new base, so that readers open one folder; returns its last batch.

    ``merge`` must give rows of the same columns that merge again. Batches are not removed; a base counts once whole.
    """
    newest = spark.read.schema(T.StructType([T.StructField(BATCH, T.LongType())])).parquet(path).agg(F.max(BATCH)).first()[0]
    known = snapshots.list_versions(spark, f"{path}_base")
    if newest is None or (known and int(known[-1]) >= newest):
        return newest
    snapshots.write_snapshot(merge(stored_partials(spark, path, schema)), f"{path}_base", newest)
    return newest
