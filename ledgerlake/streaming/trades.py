"""Structured Streaming pipelines over landed event files.

Checkpoints and outputs are never removed here: a restart continues where it stopped.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from .. import presets
from ..functions import SUM_TYPE
from ..operators.joins import guarded_join
from ..operators.quality import split_quarantine
from ..plans import gold
from ..plans.silver import enrich_trades
from ..sources.readers import decode_envelope
from ..sources.tables import table_exists
from .partials import compact_partials, stored_partials


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event-time watermark; zone-less timestamps are read as UTC instants first."""
    if dict(df.dtypes)[ts] != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def trigger_options(trigger: str | None) -> dict[str, Any]:
    """None drains what has arrived and stops; "1 minute" keeps running at that pace."""
    return {"availableNow": True} if trigger is None else {"processingTime": trigger}


def stop_named(spark: SparkSession, name: str) -> bool:
    """Stop a running query of this name, and only that one."""
    for query in spark.streams.active:
        if query.name == name:
            query.stop()
            return True
    return False


def stream_to_table(
    df: DataFrame, ref: str, checkpoint: str, trigger: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet path or a catalog table."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    writer = writer.trigger(**trigger_options(trigger))
    writer = writer.queryName(name) if name else writer
    return writer.start(ref) if "/" in ref else writer.toTable(ref)


def drain(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def decode_trades(raw: DataFrame, stamp: str, body: str = "Body") -> DataFrame:
    return enrich_trades(decode_envelope(raw, body, presets.TRADE_SCHEMA), stamp)


def run_trades_stream(
    raw: DataFrame, ref: str, checkpoint: str, stamp: str, trigger: str | None = None, name: str | None = None,
    validate: bool = False, body: str = "Body",
) -> StreamingQuery:
    """Envelope files -> decoded, enriched trades -> append. ``validate`` leaves out what quarantine takes."""
    if name is not None:
        stop_named(raw.sparkSession, name)
    if validate:
        raw = split_quarantine(raw, body)[0]
    return stream_to_table(decode_trades(raw, stamp, body), ref, checkpoint, trigger, name)


def run_quarantine_stream(
    raw: DataFrame, ref: str, checkpoint: str, trigger: str | None = None, name: str | None = None, body: str = "Body"
) -> StreamingQuery:
    """Envelope files -> messages that fail validation, with all their columns and the reason -> append.

    A query of its own over the same files: what it takes is exactly what ``run_trades_stream`` leaves out.
    """
    if name is not None:
        stop_named(raw.sparkSession, name)
    return stream_to_table(split_quarantine(raw, body)[1], ref, checkpoint, trigger, name)


def foreach_batch_refresh(
    df: DataFrame,
    out: str,
    checkpoint: str,
    fns: dict[str, Callable[[DataFrame], DataFrame]],
    trigger: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Per micro-batch, write each ``fns[name](batch)`` to ``<out>/<name>/batch_id=<n>``.

    A repeated batch overwrites its own folder, so replays after a failure add nothing twice.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, fn in fns.items():
                fn(batch).write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(refresh)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger))
        .start()
    )


def gold_batch(bench: DataFrame, asof: str) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """What each batch of trades adds to gold: flagged rows, and partial sums per hour."""
    return {
        "fraude": lambda batch: gold.fraud_trades(batch, bench, asof),
        "parciais": gold.hour_partials,
    }


def finish_gold(spark: SparkSession, out: str, bench: DataFrame, asof: str) -> dict[str, DataFrame]:
    """The four stream gold tables from what the batches stored under ``out``.

    Partial sums are compacted first, so a run opens the base and the batches since the last one.
    """
    schema = spark.read.parquet(f"{out}/parciais").schema
    compact_partials(spark, f"{out}/parciais", schema, gold.merge_partials)
    partials = gold.merge_partials(stored_partials(spark, f"{out}/parciais", schema))
    return {
        "fraude": spark.read.parquet(f"{out}/fraude").drop("batch_id"),
        "anomalias": gold.intraday_anomalies_of(partials, bench, asof),
        "volume": gold.intraday_volume_of(partials, bench, asof),
        "ranking": gold.ranking_of(partials, bench, asof),
    }


def complete_result(df: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Drain an aggregating stream in complete mode and return its last full result.

    The result is written by the executors, one folder per batch; the newest is read back.
    """
    done: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        done.append(batch_id)

    drain(
        df.writeStream.foreachBatch(write)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    spark = df.sparkSession
    if not done:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(f"{out}/batch_id={done[-1]}")


def stream_static_join(df: DataFrame, static: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Stream joined to a bounded table, broadcast when its checked size allows."""
    return guarded_join(df, static, on, how)


def _sums(value: str) -> list:
    return [
        F.count("*").alias("eventos"),
        F.round(F.sum(F.col(value).cast(SUM_TYPE)), 2).cast("double").alias("valor_total"),
    ]


def stream_tumbling(df: DataFrame, key: str, ts: str, value: str, size: str = "1 hour", delay: str = "1 hour"):
    """Per key and fixed window: events and value."""
    marked = with_watermark(df, ts, delay)
    return marked.groupBy(F.window(ts, size).alias("janela"), key).agg(*_sums(value)).select(
        key, F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "eventos", "valor_total"
    )


def stream_sliding(
    df: DataFrame, key: str, ts: str, value: str, size: str = "1 hour", slide: str = "15 minutes",
    delay: str = "1 hour",
):
    """Per key and sliding window: events and value."""
    marked = with_watermark(df, ts, delay)
    return marked.groupBy(F.window(ts, size, slide).alias("janela"), key).agg(*_sums(value)).select(
        key, F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "eventos", "valor_total"
    )


def stream_sessions(df: DataFrame, key: str, ts: str, value: str, gap: str = "30 minutes", delay: str = "1 hour"):
    """Per key and activity session: events and value. A session closes after ``gap`` without events."""
    marked = with_watermark(df, ts, delay)
    return marked.groupBy(F.session_window(ts, gap).alias("janela"), key).agg(*_sums(value)).select(
        key, F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"), "eventos", "valor_total"
    )


def stream_dedup(df: DataFrame, ident: str, ts: str, delay: str) -> DataFrame:
    """Drop repeated ids that arrive within ``delay`` of each other; state is cleared after it."""
    return with_watermark(df, ts, delay).dropDuplicatesWithinWatermark([ident])


def replay(
    raw: DataFrame, fn: Callable[[DataFrame], DataFrame], ref: str, fresh_checkpoint: str
) -> StreamingQuery:
    """Rebuild a result from the landing log: same code, new checkpoint and new target, drain and stop.

    A target that holds files already is refused: its sink would skip the batches it knows.
    """
    if table_exists(raw.sparkSession, ref):
        raise FileExistsError(f"{ref} is in use; replay into a new target")
    return drain(stream_to_table(fn(raw), ref, fresh_checkpoint))


PROGRESS = (
    "consulta string, batch_id bigint, instante string, linhas_entrada bigint, "
    "linhas_por_seg double, duracao_ms bigint"
)


def progress_rows(query: StreamingQuery) -> DataFrame:
    """Recent progress of a query as rows, for a look at a running one: the engine keeps the last batches only.

    ``drain_recorded`` keeps every batch.
    """
    rows = [
        (
            p["name"] or p["id"], p["batchId"], p["timestamp"], p["numInputRows"],
            float(p.get("processedRowsPerSecond") or 0.0), p["durationMs"].get("triggerExecution", 0),
        )
        for p in query.recentProgress
    ]
    return SparkSession.getActiveSession().createDataFrame(rows, PROGRESS)


class StreamMetrics(StreamingQueryListener):
    """Listener that keeps one row per finished micro-batch and appends them to a metrics path, ``every`` at a time."""

    def __init__(self, spark: SparkSession, path: str, every: int = 500):
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.last: dict[str, int] = {}
        self.lock, self.writing = threading.Lock(), threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        row = (
            p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows,
            float(p.processedRowsPerSecond or 0.0), p.durationMs.get("triggerExecution", 0),
        )
        with self.lock:
            self.rows.append(row)
            self.last[str(p.runId)] = p.batchId
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()

    def flush(self) -> None:
        """Write what is kept; when it returns, whatever was kept before is written, by this call or another."""
        with self.writing:
            with self.lock:
                rows, self.rows = self.rows, []
            if rows:
                self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the last batch of a finished query has been told; progress comes after the batch."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last is not None and self.last.get(str(query.runId), -1) < last["batchId"]:
            if time.monotonic() > until:
                raise TimeoutError(f"no progress of batch {last['batchId']} within {seconds} s")
            time.sleep(0.05)


def drain_recorded(start: Callable[[], StreamingQuery], spark: SparkSession, path: str) -> DataFrame:
    """Start a query, drain it, and return one row per micro-batch, however many there were."""
    listener = StreamMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        listener.wait_for(drain(start()))
    finally:
        spark.streams.removeListener(listener)
        listener.flush()
    return spark.read.schema(PROGRESS).parquet(path)
