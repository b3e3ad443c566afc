"""Batch and stream jobs over a lakehouse folder: ``<base>/<layer>/<table>``.

A job reads stored tables, calls one plan function and publishes a checked new version. Any
scheduler can call ``run``; jobs do not know of each other.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import presets
from .operators import history, quality
from .operators.joins import dedup_latest
from .plans import gold, silver
from .sources import snapshots, tables
from .streaming import trades as st


class Lake(NamedTuple):
    """Folder layout, processing date and version of one run."""

    spark: SparkSession
    base: str
    asof: str
    ver: int

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def bronze(self, table: str) -> DataFrame:
        """All daily extracts."""
        return tables.read_landing(self.spark, self.path("bronze", table))

    def extract(self, table: str) -> DataFrame:
        """The extract of the processing date only."""
        glob = f"extracao={self.asof}"
        return tables.read_landing(self.spark, self.path("bronze", table), glob).drop("extracao")

    def exists(self, layer: str, table: str) -> bool:
        return bool(snapshots.list_versions(self.spark, self.path(layer, table)))

    def current(self, layer: str, table: str) -> DataFrame:
        return snapshots.read_current(self.spark, self.path(layer, table)).drop("ver")


class Job(NamedTuple):
    layer: str
    table: str
    build: Callable[[Lake], DataFrame]
    checks: dict[str, dict[str, Any]]


def _fx(lake: Lake) -> DataFrame:
    series = lake.current("silver", "bcb").where(F.col("indicador") == "cambio_usd_brl")
    return series.select(F.col("data").alias("date"), F.col("valor").alias("cambio"))


def _benchmark(lake: Lake) -> DataFrame:
    return gold.benchmark(lake.current("gold", "performance_acoes"))


def _trades(lake: Lake) -> DataFrame:
    return lake.spark.read.parquet(lake.path("silver", "streaming"))


def _merged(lake: Lake, table: str, key: str, rows: DataFrame) -> DataFrame:
    """The stored silver table with today's rows merged into it by key."""
    stored = lake.current("silver", table) if lake.exists("silver", table) else None
    return history.upsert(stored, rows, [key])


def _present(*cols: str) -> dict[str, dict[str, Any]]:
    return {"completeness": {"required_columns": list(cols)}, "row_count": {"min_rows": 1}}


JOBS: dict[str, Job] = {
    "silver_acoes": Job(
        "silver", "acoes", lambda k: silver.silver_bars(k.bronze("acoes"), k.asof),
        {**_present("date", "ticker", "close", "volume"), "nulls": {"max_null_percentage": 0.05}},
    ),
    "silver_bcb": Job(
        "silver", "bcb", lambda k: silver.silver_series(k.bronze("bcb"), k.asof), _present("data", "indicador", "valor")
    ),
    "silver_world_bank": Job(
        "silver", "world_bank",
        lambda k: silver.silver_yearly(dedup_latest(k.bronze("world_bank"), ["ano", "indicador"], ["extracao"]), k.asof),
        _present("ano", "indicador", "valor"),
    ),
    "silver_clientes": Job(
        "silver", "clientes",
        lambda k: _merged(k, "clientes", "hash_cliente", silver.silver_customers(k.extract("clientes"), k.asof)),
        {**_present("hash_cliente", "score_credito"), "uniqueness": {"key_column": "hash_cliente"}},
    ),
    "silver_ordens": Job(
        "silver", "ordens", lambda k: _merged(k, "ordens", "id_ordem", silver.silver_orders(k.extract("ordens"), k.asof)),
        {**_present("id_ordem", "hash_cliente"), "uniqueness": {"key_column": "id_ordem"}},
    ),
    "gold_anomalias": Job(
        "gold", "anomalias", lambda k: gold.anomalies(k.current("silver", "acoes"), k.asof), _present("date", "ticker", "zscore")
    ),
    "gold_performance": Job(
        "gold", "performance_acoes", lambda k: gold.performance(k.current("silver", "acoes"), k.asof),
        _present("ticker", "ano", "preco_medio"),
    ),
    "gold_indicadores_bcb": Job(
        "gold", "indicadores_bcb", lambda k: gold.series_indicators(k.current("silver", "bcb"), k.asof), _present("data")
    ),
    "gold_contexto_macro": Job(
        "gold", "contexto_macroeconomico", lambda k: gold.macro_context(k.current("silver", "world_bank"), k.asof),
        _present("ano", "cenario_macro"),
    ),
    "gold_acoes_vs_cambio": Job(
        "gold", "acoes_vs_cambio", lambda k: gold.fx_correlation(k.current("silver", "acoes"), _fx(k), k.asof),
        _present("date", "ticker"),
    ),
    "gold_posicao_clientes": Job(
        "gold", "posicao_clientes",
        lambda k: gold.positions(k.current("silver", "ordens"), k.current("silver", "clientes"), k.asof),
        _present("hash_cliente", "ticker"),
    ),
    "gold_score_risco": Job(
        "gold", "score_risco_clientes", lambda k: gold.risk_score(k.current("gold", "posicao_clientes"), k.asof),
        {**_present("hash_cliente", "score_risco"), "uniqueness": {"key_column": "hash_cliente"}},
    ),
    "gold_deteccao_fraude": Job(
        "gold", "deteccao_fraude",
        lambda k: gold.fraud_orders(k.current("silver", "ordens"), k.current("gold", "score_risco_clientes"), k.asof),
        _present("id_ordem", "score_fraude"),
    ),
    "gold_perfil_clientes": Job(
        "gold", "perfil_clientes", lambda k: gold.segment_profile(k.current("silver", "clientes")), _present("perfil_risco")
    ),
    "gold_ordens_consolidadas": Job(
        "gold", "ordens_consolidadas", lambda k: gold.orders_consolidated(k.current("silver", "ordens")), _present("ticker")
    ),
    "gold_ranking_perfil": Job(
        "gold", "ranking_acoes_perfil", lambda k: gold.ranking_by_profile(k.current("silver", "ordens")), _present("ticker")
    ),
    "gold_fraude_streaming": Job(
        "gold", "fraude_streaming", lambda k: gold.fraud_trades(_trades(k), _benchmark(k), k.asof), _present("id_transacao")
    ),
    "gold_anomalias_intraday": Job(
        "gold", "anomalias_intraday", lambda k: gold.intraday_anomalies(_trades(k), _benchmark(k), k.asof), _present("ticker")
    ),
    "gold_volume_intraday": Job(
        "gold", "volume_intraday", lambda k: gold.intraday_volume(_trades(k), _benchmark(k), k.asof), _present("ticker")
    ),
    "gold_ranking_realtime": Job(
        "gold", "ranking_acoes_realtime", lambda k: gold.ranking(_trades(k), _benchmark(k), k.asof), _present("ticker")
    ),
}


def run(spark: SparkSession, name: str, base: str, asof: str, ver: int | None = None) -> str:
    """Build one table, check it, and commit it as the next version. Returns the version folder."""
    job = JOBS[name]
    path = f"{base.rstrip('/')}/{job.layer}/{job.table}"
    if ver is None:
        known = snapshots.list_versions(spark, path)
        ver = int(known[-1]) + 1 if known else 1
    lake = Lake(spark, base, asof, ver)
    return quality.publish(job.build(lake), path, ver, job.checks)


class HistoryJob(NamedTuple):
    """A validity history: source table, key, and the attributes it keeps."""

    layer: str
    table: str
    source: tuple[str, str]
    columns: tuple[str, ...]
    key: str = "hash_cliente"


HISTORIES: dict[str, HistoryJob] = {
    "clientes_scd": HistoryJob("silver", "clientes_scd", ("silver", "clientes"), presets.SCD2_CUSTOMERS),
    "score_risco_scd": HistoryJob("gold", "score_risco_scd", ("gold", "score_risco_clientes"), presets.SCD2_RISK_SCORE),
}


#: The mode of a history that takes days in any order.
ANY_ORDER = "any_order"


def run_history(spark: SparkSession, name: str, base: str, asof: str, mode: str = "changes", ver: int | None = None) -> str:
    """One day of a validity history, from the current version of its source or from version ``ver``.

    Open versions are a snapshot per day; versions closed on a day are one folder of their
    own and are never rewritten. The day starts from the newest snapshot before it, so a
    second run of the day writes the same two folders again. A day before one already stored is refused.

    In the mode ``any_order`` days may come in any order and again: versions carry the days they were seen on, and every
    run commits the whole history as a new version, in which only keys of the batch are new.
    """
    job = HISTORIES[name]
    path = f"{base.rstrip('/')}/{job.layer}/{job.table}"
    lake = Lake(spark, base, asof, 0)
    source = lake.current(*job.source) if ver is None else snapshots.read_snapshots(spark, lake.path(*job.source), [ver])
    batch = source.select(*job.columns)
    if mode == ANY_ORDER:
        known = snapshots.list_versions(spark, f"{path}/versoes")
        prior = snapshots.read_current(spark, f"{path}/versoes").drop("ver") if known else None
        snapshots.write_snapshot(history.scd2_splice(prior, batch, job.key, asof), f"{path}/versoes", int(known[-1]) + 1 if known else 1)
        return path
    day = asof.replace("-", "")
    stored = snapshots.list_versions(spark, f"{path}/abertas")
    if stored and stored[-1] > day:
        raise history.LateBatchError(f"{name} already holds {stored[-1]}, after {day}; keep it in the mode {ANY_ORDER} to take late days")
    earlier = [v for v in stored if v < day]
    prior = snapshots.read_snapshots(spark, f"{path}/abertas", earlier[-1:]).drop("ver") if earlier else None
    after = history.scd2_apply(prior, batch, job.key, asof, mode).persist()
    try:
        after.where(history.CURRENT).write.mode("overwrite").parquet(f"{path}/abertas/ver={day}")
        tables.write_landing(after.where(f"not {history.CURRENT}"), f"{path}/fechadas", asof, key="fechada_em")
    finally:
        after.unpersist()
    return path


def read_history(spark: SparkSession, name: str, base: str) -> DataFrame:
    """All versions of a history, closed and open."""
    job = HISTORIES[name]
    path = f"{base.rstrip('/')}/{job.layer}/{job.table}"
    if snapshots.list_versions(spark, f"{path}/versoes"):
        return snapshots.read_current(spark, f"{path}/versoes").drop("ver", history.SEEN)
    open_rows = snapshots.read_current(spark, f"{path}/abertas").drop("ver")
    closed = tables.read_landing(spark, f"{path}/fechadas", "fechada_em=*").drop("fechada_em")
    return open_rows.unionByName(closed)


def run_monitoring(spark: SparkSession, base: str, asof: str, names: list[str] | None = None) -> DataFrame:
    """Metrics of the stored tables, appended to the history of the day; returns today's status."""
    lake = Lake(spark, base, asof, 0)
    chosen = {f"{j.layer}.{j.table}": j for n, j in JOBS.items() if names is None or n in names}
    versions = {n: snapshots.list_versions(spark, lake.path(j.layer, j.table)) for n, j in chosen.items()}
    metrics = quality.monitor_all(
        {n: (lambda j=j: lake.current(j.layer, j.table)) for n, j in chosen.items()},
        asof,
        {n: int(v[-1]) for n, v in versions.items() if v},
    )
    path = lake.path("gold", "observabilidade")
    tables.write_landing(metrics, path, asof, key="dia")
    return quality.quality_status(tables.read_landing(spark, path, "dia=*").drop("dia"))


def run_stream(spark: SparkSession, base: str, stamp: str, every: str | None = None, max_files: int = 1000):
    """Captured envelopes -> silver trades. ``every`` keeps it running; otherwise drain and stop.

    Messages that fail validation go to ``quarantine/streaming`` with reason and raw body. Each target has one
    checkpoint, shared by both ways of running, so switching between them loses and repeats nothing.
    ``max_files`` bounds the files of one micro-batch.
    """
    lake = Lake(spark, base, stamp, 0)
    source = lake.path("bronze", "kafka")
    raw = spark.readStream.format("parquet").schema(spark.read.parquet(source).schema)
    raw = raw.option("maxFilesPerTrigger", max_files).load(source)
    rejected = st.run_quarantine_stream(
        raw, lake.path("quarantine", "streaming"), lake.path("checkpoints", "quarantine"), every, "trades_quarantine"
    )
    if every is None:
        st.drain(rejected)
    return st.run_trades_stream(
        raw, lake.path("silver", "streaming"), lake.path("checkpoints", "streaming"), stamp, every, "trades", validate=True
    )


#: Gold tables that are finished from what stream batches stored.
STREAM_GOLD = {
    "fraude": "gold_fraude_streaming", "anomalias": "gold_anomalias_intraday", "volume": "gold_volume_intraday",
    "ranking": "gold_ranking_realtime",
}


def run_stream_gold(spark: SparkSession, base: str, asof: str, max_files: int = 1000) -> dict[str, str]:
    """New silver trades -> the four stream gold tables, each committed as its next version.

    Only files that arrived since the last run are read: every batch stores its flagged rows and its hourly
    partial sums, and the tables are finished from those. Rows flagged earlier keep the benchmark of their day.
    """
    lake = Lake(spark, base, asof, 0)
    source, stored = lake.path("silver", "streaming"), lake.path("gold", "lotes_streaming")
    trades = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", max_files).parquet(source)
    bench = _benchmark(lake)
    st.drain(st.foreach_batch_refresh(trades, stored, lake.path("checkpoints", "gold_streaming"), st.gold_batch(bench, asof)))
    committed = {}
    for name, df in st.finish_gold(spark, stored, bench, asof).items():
        job = JOBS[STREAM_GOLD[name]]
        path = lake.path(job.layer, job.table)
        known = snapshots.list_versions(spark, path)
        committed[name] = quality.publish(df, path, int(known[-1]) + 1 if known else 1, job.checks)
    return committed
