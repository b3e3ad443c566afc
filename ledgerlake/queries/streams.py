"""Structured Streaming T1-T12: every stream reads the given events (or files Spark made from them)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import gold, silver
from ..sources import evolving
from ..sources.readers import stream_files
from ..sources.scratch import scratch_dir
from ..streaming import corrections, velocity
from ..streaming import trades as st
from . import views as v
from .golds import INTRADAY, RANKING, STREAM_FRAUD, VOLUME
from .registry import query
from .scans import PAYLOAD_CASES, envelopes, payloads
from .views import ASOF, STAMP, dsum, r
from .windows import SESSIONS, sliding_sql


def event_stream(spark, sf, files: int = 6, max_files: int = 2) -> DataFrame:
    """The events as a file stream of several micro-batches: landed in files by time, a few per trigger."""
    schema = v.table(spark, sf, "events").schema
    return stream_files(spark, ordered_events(spark, sf, files), schema, max_files=max_files)


def ordered_events(spark, sf, files: int = 8) -> str:
    """Events landed in time order, so that a watermark sees late rows only where meant."""
    path = scratch_dir(spark, "events_by_time")
    v.table(spark, sf, "events").repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


#: Bytes of a row group of landed envelopes, before compression.
ROW_GROUP = 4 << 20


def land(df: DataFrame, path: str, files: int, by: Sequence[str] = ()) -> None:
    """Append ``df`` to a landing folder in so many files, of small row groups: a micro-batch reads few files, but its tasks share their row groups.

    Rows are dealt in turn, or by a hash of the columns ``by``, which spares the sort that dealing in turn needs.
    """
    df.repartition(files, *by).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("stream_file_source", "select event_id, user_id, event_type, value from events")
def stream_file_source(spark, sf):
    out = scratch_dir(spark, "stream_out")
    rows = event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    st.drain(st.stream_to_table(rows, out, scratch_dir(spark, "ckpt")))
    return spark.read.schema(rows.schema).parquet(out)


@query("stream_sink_append", "select event_id, value from events")
def stream_sink_append(spark, sf):
    """Two runs on one checkpoint: the second finds nothing new and repeats nothing."""
    out, ckpt = scratch_dir(spark, "stream_out"), scratch_dir(spark, "ckpt")
    rows = event_stream(spark, sf).select("event_id", "value")
    for _ in range(2):
        st.drain(st.stream_to_table(rows, out, ckpt))
    return spark.read.schema(rows.schema).parquet(out)


@query(
    "stream_enrich",
    f"""select timestamp, ticker, preco, quantidade, tipo, 'Corretora' as corretora, cast(id_transacao as varchar) as id_transacao, hora, minuto, valor_total,
  case when quantidade>8000 then 'Volume Alto' when quantidade>5000 then 'Volume Medio' else 'Normal' end as alerta_volume,
  case when preco>80 then 'Preco Alto' when preco<15 then 'Preco Baixo' else 'Normal' end as alerta_preco, '{STAMP}' as processado_em from v_trades""",
)
def stream_enrich(spark, sf):
    landed, out = scratch_dir(spark, "capture"), scratch_dir(spark, "stream_silver")
    captured = envelopes(spark, sf)
    land(captured, landed, 6)
    raw = stream_files(spark, landed, captured.schema, max_files=2)
    st.drain(st.run_trades_stream(raw, out, scratch_dir(spark, "ckpt"), STAMP))
    return _ntz(spark.read.parquet(out), "timestamp")


@query(
    "stream_continuous",
    f"""select timestamp, ticker, preco, quantidade, tipo, 'Corretora' as corretora, cast(id_transacao as varchar) as id_transacao, valor_total from v_trades""",
)
def stream_continuous(spark, sf):
    """An always-on named stream: it runs on a timer, is stopped by name, and goes on with new files on its checkpoint."""
    landed, out, ckpt = scratch_dir(spark, "capture"), scratch_dir(spark, "stream_silver"), scratch_dir(spark, "ckpt")
    captured = envelopes(spark, sf)
    name = f"trades_{ckpt[-8:]}"
    for part in range(2):
        half = captured.where(F.pmod(F.xxhash64("Body"), F.lit(2)) == part)
        land(half, landed, 4)
        raw = stream_files(spark, landed, captured.schema, max_files=2)
        running = st.run_trades_stream(raw, out, ckpt, STAMP, "1 second", name)
        running.processAllAvailable()
        if not st.stop_named(spark, name):
            raise RuntimeError(f"the stream {name} does not run")
    rows = spark.read.parquet(out).select("timestamp", "ticker", "preco", "quantidade", "tipo", "corretora", "id_transacao", "valor_total")
    return _ntz(rows, "timestamp")


@query(
    "stream_foreach_batch",
    f"""select 'anomalias' as tabela, ticker, hora, zscore_intraday as medida, tipo_anomalia as rotulo from ({INTRADAY}) a
union all select 'volume', ticker, hora, pct_volume_diario, pressao_compradora from ({VOLUME}) b
union all select 'ranking', ticker, cast(rank_volume as int), variacao_vs_historico_pct, tendencia from ({RANKING}) c
union all select 'fraude', ticker, total_alertas, cast(count(*) as double), score_fraude from ({STREAM_FRAUD}) d group by ticker, total_alertas, score_fraude""",
)
def stream_foreach_batch(spark, sf):
    """Gold refreshed per micro-batch: each batch adds its fraud rows and its hourly partial sums.

    The four gold tables are then finished from what the batches stored.
    """
    out = scratch_dir(spark, "stream_gold")
    bench = v.trade_benchmark(spark, sf)
    raw = stream_files(spark, ordered_events(spark, sf), v.table(spark, sf, "events").schema, max_files=2)
    rows = silver.enrich_trades(v.decoded_trades(raw), STAMP)
    st.drain(st.foreach_batch_refresh(rows, out, scratch_dir(spark, "ckpt"), st.gold_batch(bench, ASOF)))
    tables = st.finish_gold(spark, out, bench, ASOF)
    label = lambda df, name, *cols: df.select(
        F.lit(name).alias("tabela"), "ticker", *[F.col(c).alias(n) for c, n in zip(cols, ("hora", "medida", "rotulo"))]
    )
    fraud = tables["fraude"].groupBy("ticker", "total_alertas", "score_fraude").agg(F.count("*").cast("double").alias("n"))
    return (
        label(tables["anomalias"], "anomalias", "hora", "zscore_intraday", "tipo_anomalia")
        .unionByName(label(tables["volume"], "volume", "hora", "pct_volume_diario", "pressao_compradora"))
        .unionByName(label(tables["ranking"], "ranking", "rank_volume", "variacao_vs_historico_pct", "tendencia"))
        .unionByName(label(fraud, "fraude", "total_alertas", "n", "score_fraude"))
    )


@query("stream_static_join", STREAM_FRAUD)
def stream_static_join(spark, sf):
    """Fraud rules on the stream against the yearly benchmark: the batch function, unchanged."""
    out = scratch_dir(spark, "stream_fraud")
    rows = silver.enrich_trades(v.decoded_trades(event_stream(spark, sf)), STAMP)
    flagged = gold.fraud_trades(rows, v.trade_benchmark(spark, sf), ASOF)
    st.drain(st.stream_to_table(flagged, out, scratch_dir(spark, "ckpt")))
    return _ntz(spark.read.parquet(out), "timestamp")


@query(
    "stream_tumbling",
    f"""select event_type, date_trunc('hour',ts)::timestamp as inicio, date_trunc('hour',ts)::timestamp+interval 1 hour as fim,
  count(*) as eventos, {dsum('value')} as valor_total from events group by 1,2,3""",
)
def stream_tumbling(spark, sf):
    agg = st.stream_tumbling(event_stream(spark, sf), "event_type", "ts", "value")
    return _ntz(st.complete_result(agg, scratch_dir(spark, "tumbling"), scratch_dir(spark, "ckpt")), "inicio", "fim")


@query("stream_sliding", sliding_sql("event_type", 3600, 900))
def stream_sliding(spark, sf):
    agg = st.stream_sliding(event_stream(spark, sf), "event_type", "ts", "value")
    return _ntz(st.complete_result(agg, scratch_dir(spark, "sliding"), scratch_dir(spark, "ckpt")), "inicio", "fim")


@query("stream_sessions", SESSIONS)
def stream_sessions(spark, sf):
    # a session window drops rows behind the watermark in every mode: the files must come in time order
    raw = stream_files(spark, land_by_week(spark, sf, late=False), v.table(spark, sf, "events").schema, max_files=WEEK_FILES)
    agg = st.stream_sessions(raw, "user_id", "ts", "value", gap="1 hour")
    return _ntz(st.complete_result(agg, scratch_dir(spark, "sessions"), scratch_dir(spark, "ckpt")), "inicio", "fim")


#: Files of a week of landed events, and of the micro-batch that reads them.
WEEK_FILES = 8


def land_by_week(spark, sf, late: bool = True) -> str:
    """Events landed in four steps by time, one after another, then (``late``) the first hour once more.

    A file source takes files in the order they were written. Every step has exactly ``WEEK_FILES`` files, empty ones if
    need be, so it is one micro-batch whatever the partitions of the table, and only the last one is late.
    """
    path = scratch_dir(spark, "events_late")
    e = v.table(spark, sf, "events")
    cuts = [None, "2024-01-08", "2024-01-15", "2024-01-22", None]
    steps = []
    for lo, hi in zip(cuts, cuts[1:]):
        part = e
        part = part.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) if lo else part
        part = part.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz")) if hi else part
        steps.append(part)
    if late:
        steps.append(e.where(F.col("ts") < F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")))
    for done, part in enumerate(steps, 1):
        land(part, path, WEEK_FILES, by=e.columns)
        landed = len(spark.read.schema(e.schema).parquet(path).inputFiles())
        for _ in range(done * WEEK_FILES - landed):  # a task without rows writes no file
            spark.createDataFrame([], e.schema).coalesce(1).write.mode("append").parquet(path)
    return path


@query(
    "stream_late_data",
    f"""select event_type, date_trunc('hour',ts)::timestamp as inicio, date_trunc('hour',ts)::timestamp+interval 1 hour as fim,
  count(*) as eventos, {dsum('value')} as valor_total from events group by 1,2,3
having date_trunc('hour',ts)::timestamp+interval 1 hour <= (select max(ts) from events) - interval 1 hour""",
)
def stream_late_data(spark, sf):
    """Append mode with a watermark: a window is emitted once closed, rows behind the watermark are dropped."""
    out = scratch_dir(spark, "late")
    raw = stream_files(spark, land_by_week(spark, sf), v.table(spark, sf, "events").schema, max_files=WEEK_FILES)
    agg = st.stream_tumbling(raw, "event_type", "ts", "value", "1 hour", "1 hour")
    st.drain(st.stream_to_table(agg, out, scratch_dir(spark, "ckpt")))
    return _ntz(spark.read.schema(agg.schema).parquet(out), "inicio", "fim")


@query(
    "stream_late_corrected",
    f"""select event_type, date_trunc('hour',ts)::timestamp as inicio, date_trunc('hour',ts)::timestamp+interval 1 hour as fim,
  2 * count(*) filter (ts < timestamp '2024-01-01 01:00:00') + count(*) filter (ts >= timestamp '2024-01-01 01:00:00') as eventos,
  {dsum("value * case when ts < timestamp '2024-01-01 01:00:00' then 2 else 1 end")} as valor_total,
  count(*) filter (ts < timestamp '2024-01-01 01:00:00') as atrasados,
  count(*) filter (ts < timestamp '2024-01-01 01:00:00') > 0 as reaberta from events group by 1,2,3""",
)
def stream_late_corrected(spark, sf):
    """The last file repeats the first hour, weeks behind the watermark: its rows are kept and correct closed windows."""
    out = scratch_dir(spark, "corrected")
    schema = v.table(spark, sf, "events").schema
    raw = stream_files(spark, land_by_week(spark, sf), schema, max_files=WEEK_FILES)
    st.drain(corrections.corrected_windows(raw, "event_type", "ts", "value", out, scratch_dir(spark, "ckpt")))
    partial = corrections.partial_schema(raw, "event_type")
    corrections.compact_partials(spark, f"{out}/parciais", partial, lambda rows: corrections.merge_windows(rows, "event_type"))
    return _ntz(corrections.windows_so_far(spark, out, partial, "event_type"), "inicio", "fim")


@query(
    "stream_velocity",
    """select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 600 seconds preceding and current row) as eventos_janela,
  count(*) over (partition by user_id order by ts range between interval 600 seconds preceding and current row)>=2 as alerta_velocidade from events""",
)
def stream_velocity(spark, sf):
    """The velocity rule while events arrive, in files by time: state by group of keys, removed by timers."""
    out = scratch_dir(spark, "velocity")
    raw = stream_files(spark, land_by_week(spark, sf, late=False), v.table(spark, sf, "events").schema, max_files=WEEK_FILES)
    raw = raw.select("event_id", "user_id", "ts")
    rows = velocity.stream_velocity(raw, "user_id", "ts", 600, 2).drop("ts")
    st.drain(st.stream_to_table(rows, out, scratch_dir(spark, "ckpt")))
    return spark.read.schema(rows.schema).parquet(out)


@query("stream_dedup", "select event_id, event_type, value from events")
def stream_dedup(spark, sf):
    """Every event is landed twice; ids seen within the delay are dropped."""
    twice, out = scratch_dir(spark, "twice"), scratch_dir(spark, "dedup")
    e = v.table(spark, sf, "events")
    e.unionByName(e).repartitionByRange(4, "ts").write.parquet(twice)
    raw = stream_files(spark, twice, e.schema, max_files=4)
    rows = st.stream_dedup(raw, "event_id", "ts", "1 hour").select("event_id", "event_type", "value")
    st.drain(st.stream_to_table(rows, out, scratch_dir(spark, "ckpt")))
    return spark.read.parquet(out)


@query(
    "stream_replay",
    f"select 'antes' as execucao, event_id, {r('value*2', 2)} as valor_total from events"
    f" union all select 'replay', event_id, {r('value*2', 2)} from events",
)
def stream_replay(spark, sf):
    """A result rebuilt from the landing log with a new checkpoint equals the first one."""
    from ..functions import dec_round

    def compute(rows: DataFrame) -> DataFrame:
        return rows.select("event_id", dec_round(F.col("value") * 2, 2).alias("valor_total"))

    parts, log = [], event_stream(spark, sf)
    for run in ("antes", "replay"):
        out = scratch_dir(spark, f"replay_{run}")
        st.replay(log, compute, out, scratch_dir(spark, "ckpt"))
        parts.append(spark.read.parquet(out).select(F.lit(run).alias("execucao"), "event_id", "valor_total"))
    return parts[0].unionByName(parts[1])


@query("stream_progress", "select cast(4 as bigint) as lotes, count(*) as linhas_entrada from events")
def stream_progress(spark, sf):
    """Recorded progress of a drained stream of four files, one per micro-batch: batches and input rows."""
    raw = stream_files(spark, ordered_events(spark, sf, 4), v.table(spark, sf, "events").schema, max_files=1)
    start = lambda: st.stream_to_table(raw.select("event_id"), scratch_dir(spark, "progress"), scratch_dir(spark, "ckpt"))
    done = st.drain_recorded(start, spark, scratch_dir(spark, "metrics"))
    return done.where("linhas_entrada > 0").agg(
        F.count_distinct("batch_id").alias("lotes"), F.sum("linhas_entrada").alias("linhas_entrada")
    )


@query(
    "stream_quarantine",
    f"""select case when valido then 'silver' else 'quarentena' end as destino, case when valido then null else motivo end as motivo,
  count(*) as registros from ({PAYLOAD_CASES}) p group by 1,2""",
)
def stream_quarantine(spark, sf):
    """Payloads landed in several files: good ones reach silver, the others quarantine with their reason."""
    landed, good, bad = (scratch_dir(spark, n) for n in ("capture", "stream_silver", "stream_quarantine"))
    body = payloads(spark, sf).select(F.col("corpo").cast("binary").alias("Body"))
    land(body, landed, 6)
    raw = stream_files(spark, landed, body.schema, max_files=2)
    st.drain(st.run_quarantine_stream(raw, bad, scratch_dir(spark, "ckpt")))
    st.drain(st.run_trades_stream(raw, good, scratch_dir(spark, "ckpt"), STAMP, validate=True))
    kept = spark.read.parquet(good).select(F.lit("silver").alias("destino"), F.lit(None).cast("string").alias("motivo"))
    rejected = spark.read.parquet(bad).select(F.lit("quarentena").alias("destino"), "motivo")
    return kept.unionByName(rejected).groupBy("destino", "motivo").agg(F.count("*").alias("registros"))


@query("stream_schema_rescue", "select event_id, user_id, value, case when event_id % 3 > 0 then event_type end as event_type, cast(null as varchar) as _resgatado from events")
def stream_schema_rescue(spark, sf):
    """A field that comes up while the stream runs is rescued, taken into the schema, and read back for all its rows."""
    land, out, ckpt, schemas = (scratch_dir(spark, n) for n in ("json", "rescued", "ckpt", "schemas"))
    evolving.store_schema(spark, schemas, "event_id bigint, user_id bigint, value double")
    e = v.table(spark, sf, "events")
    for part in range(3):  # without the field, with it before the schema knows it, and after
        rows = e.where(F.col("event_id") % 3 == part).select("event_id", "user_id", "value", *(["event_type"] if part else []))
        rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(land)
        st.drain(evolving.rescuing_stream(spark, land, out, ckpt, schemas))
        evolving.evolve(spark, out, schemas)
    return evolving.read_rescued(spark, out, schemas)
