"""Windows on a stream that late rows correct.

An engine's watermark closes a window and drops what comes behind it. Here every micro-batch adds the partial sums of its
rows to their windows, whether closed or not, so no row is lost. Rows behind the watermark are also kept in a side
table, and the windows they reopen are marked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import SUM_TYPE
from .partials import BATCH, compact_partials, stored_partials
from .trades import trigger_options

__all__ = ["compact_partials", "corrected_windows", "merge_windows", "partial_schema", "stored_partials", "windows_so_far"]

def _micros(interval: str) -> F.Column:
    return F.expr(f"unix_micros(timestamp '1970-01-01 00:00:00+00:00' + interval {interval})")


PARTIALS = "inicio timestamp, fim timestamp, eventos bigint, soma decimal(38,10), atrasados bigint, reaberta boolean"


def partial_schema(df: DataFrame, key: str) -> T.StructType:
    return T.StructType([df.schema[key], *T.StructType.fromDDL(PARTIALS).fields])


def merge_windows(partials: DataFrame, key: str) -> DataFrame:
    return partials.groupBy(key, "inicio", "fim").agg(
        F.sum("eventos").alias("eventos"), F.sum("soma").cast("decimal(38,10)").alias("soma"),
        F.sum("atrasados").alias("atrasados"), F.max("reaberta").alias("reaberta"),
    )


def corrected_windows(
    df: DataFrame, key: str, ts: str, value: str, out: str, checkpoint: str, size: str = "1 hour", delay: str = "1 hour",
    trigger: str | None = None,
) -> StreamingQuery:
    """Per micro-batch: partial sums of (key, window), late rows (``<out>/atrasadas``), and how far event time has come.

    The watermark of a batch is the greatest time of the batches before it less ``delay``; a row before it is late, and
    reopens its window if that had ended by then. A repeated batch overwrites its own folders, so it adds nothing twice.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id:  # one row, written last by the batch before
            before = spark.read.parquet(f"{out}/marcas/{BATCH}={batch_id - 1}").first()[0]
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        mark = F.lit(before).cast("bigint") - _micros(delay)
        rows = batch.withColumn("_late", F.coalesce(at < mark, F.lit(False))).withColumn("_at", at).persist()
        try:
            windows = rows.where(F.col("_at").isNotNull()).groupBy(F.window(F.timestamp_micros("_at"), size).alias("_w"), key).agg(
                F.count(F.lit(1)).alias("eventos"),
                F.coalesce(F.sum(F.col(value).cast(SUM_TYPE)), F.lit(0)).cast("decimal(38,10)").alias("soma"),
                F.sum(F.col("_late").cast("bigint")).alias("atrasados"),
            )
            windows = windows.select(
                key, F.col("_w.start").alias("inicio"), F.col("_w.end").alias("fim"), "eventos", "soma", "atrasados",
                F.coalesce(F.unix_micros("_w.end") <= mark, F.lit(False)).alias("reaberta"),
            )
            windows.write.mode("overwrite").parquet(f"{out}/parciais/{BATCH}={batch_id}")
            rows.where("_late").select(*batch.columns).write.mode("overwrite").parquet(f"{out}/atrasadas/{BATCH}={batch_id}")
            far = rows.agg(F.greatest(F.max("_at"), F.lit(before).cast("bigint")).alias("ate"))
            far.write.mode("overwrite").parquet(f"{out}/marcas/{BATCH}={batch_id}")
        finally:
            rows.unpersist()

    return (
        df.writeStream.foreachBatch(add).outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger)).start()
    )


def windows_so_far(spark: SparkSession, out: str, schema: T.StructType, key: str) -> DataFrame:
    """The windows from all batches: events, value, late events among them, and whether late ones reopened it."""
    merged = merge_windows(stored_partials(spark, f"{out}/parciais", schema), key)
    return merged.withColumn("valor_total", F.round("soma", 2).cast("double")).drop("soma")
