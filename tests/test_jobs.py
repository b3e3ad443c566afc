"""The whole lake from bronze to gold in one session, through the command-line jobs."""

import json

import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake import jobs
from ledgerlake.operators import history
from ledgerlake.plans import silver
from ledgerlake.queries import views as v
from ledgerlake.sources import snapshots, tables

ASOF = "2026-01-01"
ORDER = [
    "silver_acoes", "silver_bcb", "silver_world_bank", "silver_clientes", "silver_ordens", "gold_anomalias",
    "gold_performance", "gold_indicadores_bcb", "gold_contexto_macro", "gold_acoes_vs_cambio", "gold_posicao_clientes",
    "gold_score_risco", "gold_deteccao_fraude", "gold_perfil_clientes", "gold_ordens_consolidadas", "gold_ranking_perfil",
    "gold_fraude_streaming", "gold_anomalias_intraday", "gold_volume_intraday", "gold_ranking_realtime",
]


@pytest.fixture(scope="module")
def base(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    bronze = lambda name, df: tables.write_landing(df, f"{root}/bronze/{name}", ASOF)
    bronze("acoes", v.raw_bars(spark, sf))
    bronze("bcb", v.series(spark, sf).withColumn("data", F.date_format("data", "dd/MM/yyyy")))
    bronze("world_bank", v.yearly(spark, sf))
    clients = silver.bronze_customers(v.raw_customers(spark, sf), ASOF, "s")
    bronze("clientes", clients)
    known = clients.select(
        F.col("id_cliente").substr(4, 20).cast("long").alias("cli"), "hash_cliente", "perfil_risco", "faixa_saldo"
    )
    orders = v.plain_orders(spark, sf).join(known, "cli").drop("cli")
    bronze("ordens", orders.withColumn("id_ordem", F.expr("uuid()")))
    body = {"timestamp": "2024-01-01T10:00:00", "ticker": "PROMO", "preco": 95.0, "quantidade": 9001, "tipo": "compra",
            "corretora": "c", "id_transacao": "1"}
    capture = spark.createDataFrame([(bytearray(json.dumps(body).encode()),)], "Body binary")
    capture.write.parquet(f"{root}/bronze/kafka")
    return root


def test_every_job(spark, base):
    assert set(ORDER) == set(jobs.JOBS)
    jobs.run_stream(spark, base, "2026-01-01T00:00:00").awaitTermination()
    for name in ORDER:
        assert jobs.run(spark, name, base, ASOF).endswith("ver=1")
    job = jobs.JOBS["gold_deteccao_fraude"]
    fraud = snapshots.read_current(spark, f"{base}/{job.layer}/{job.table}")
    assert fraud.count() == tables.read_landing(spark, f"{base}/bronze/ordens").count()
    stream = snapshots.read_current(spark, f"{base}/gold/fraude_streaming")
    assert rows(stream, "id_transacao", "score_fraude") == [("1", "Critico")]


def test_stream_gold_reads_new_trades_only(spark, base):
    """After the jobs above: one trade is stored, then a second one arrives."""
    def batches():
        return spark.read.parquet(f"{base}/gold/lotes_streaming/parciais").select("batch_id").distinct().count()

    jobs.run_stream_gold(spark, base, ASOF)
    assert batches() == 1
    body = {"timestamp": "2024-01-01T11:00:00", "ticker": "PROMO", "preco": 95.0, "quantidade": 9001, "tipo": "venda",
            "corretora": "c", "id_transacao": "2"}
    more = spark.createDataFrame([(bytearray(json.dumps(body).encode()),), (bytearray(b"{"),)], "Body binary")
    more.write.mode("append").parquet(f"{base}/bronze/kafka")
    jobs.run_stream(spark, base, "2026-01-01T00:00:00").awaitTermination()
    for _ in range(2):  # the second run finds nothing new
        jobs.run_stream_gold(spark, base, ASOF)
        assert batches() == 2
    kept = snapshots.read_current(spark, f"{base}/gold/fraude_streaming")
    assert rows(kept, "id_transacao") == [("1",), ("2",)]
    everything = jobs.JOBS["gold_ranking_realtime"].build(jobs.Lake(spark, base, ASOF, 1))
    stored = snapshots.read_current(spark, f"{base}/gold/ranking_acoes_realtime")
    assert rows(stored.select(*everything.columns)) == rows(everything)
    assert spark.read.parquet(f"{base}/quarantine/streaming").count() == 1


def test_second_run_is_a_new_version(spark, base):
    assert jobs.run(spark, "silver_bcb", base, "2026-01-02").endswith("ver=2")
    assert snapshots.list_versions(spark, f"{base}/silver/bcb") == ["1", "2"]


def test_newest_landing_of_a_bar_wins(spark, tmp_path):
    base = str(tmp_path)
    bar = "date string, ticker string, open double, high double, low double, close double, volume long, dividends double, stock_splits double"
    land = lambda day, *bars: tables.write_landing(
        spark.createDataFrame([(*b, 0.0, 0.0) for b in bars], bar), f"{base}/bronze/acoes", day
    )
    land("2026-01-01", ("2026-01-01", "A", 9.0, 9.0, 9.0, 9.0, 5), ("2026-01-01", "B", 9.0, 9.0, 9.0, 9.0, 5))
    land("2026-01-02", ("2026-01-01", "A", 1.0, 2.0, 1.0, 2.0, 6), ("2026-01-01", "B", 1.0, 1.0, 1.0, None, 6))
    jobs.run(spark, "silver_acoes", base, "2026-01-02")
    stored = snapshots.read_current(spark, f"{base}/silver/acoes")
    assert "extracao" not in stored.columns
    assert rows(stored, "ticker", "open", "close", "volume") == [("A", 1.0, 2.0, 6)]


def test_next_day_is_merged(spark, base):
    stored = snapshots.read_current(spark, f"{base}/silver/clientes").drop("ver")
    n = stored.count()
    today = stored.where("churn").drop("faixa_etaria", "score_categoria", "data_processamento").withColumn("idade", F.lit(20))
    extra = today.limit(1).withColumn("hash_cliente", F.lit("novo"))
    tables.write_landing(today.unionByName(extra), f"{base}/bronze/clientes", "2026-01-02")
    churned = today.count()
    jobs.run(spark, "silver_clientes", base, "2026-01-02")
    merged = snapshots.read_current(spark, f"{base}/silver/clientes")
    assert (merged.count(), merged.where("idade = 20 and faixa_etaria = 'Jovem' and churn").count() >= churned) == (n + 1, True)


def test_history_jobs(spark, base):
    n = snapshots.read_current(spark, f"{base}/silver/clientes").count()
    for name in jobs.HISTORIES:
        jobs.run_history(spark, name, base, "2026-01-01")
    first = jobs.read_history(spark, "clientes_scd", base)
    assert first.count() == n and first.where("atual").count() == n
    # half of the clients change profile the next day; the day is run twice
    changed = snapshots.read_current(spark, f"{base}/silver/clientes").drop("ver").withColumn(
        "perfil_risco", F.when(F.col("ativo"), "Novo").otherwise(F.col("perfil_risco"))
    )
    active = changed.where("ativo").count()
    snapshots.write_snapshot(changed, f"{base}/silver/clientes", 99)
    for _ in range(2):
        jobs.run_history(spark, "clientes_scd", base, "2026-01-02")
        hist = jobs.read_history(spark, "clientes_scd", base)
        assert (hist.count(), hist.where("atual").count()) == (n + active, n)
    with pytest.raises(history.LateBatchError):
        jobs.run_history(spark, "clientes_scd", base, "2026-01-01")
    assert jobs.read_history(spark, "clientes_scd", base).count() == n + active
    assert hist.groupBy("hash_cliente").agg(F.sum(F.col("atual").cast("int")).alias("n")).where("n <> 1").isEmpty()


def test_history_of_days_in_any_order(spark, base, tmp_path):
    import shutil

    lake = str(tmp_path / "lake")
    shutil.copytree(f"{base}/silver/clientes", f"{lake}/silver/clientes")
    first = int(snapshots.list_versions(spark, f"{lake}/silver/clientes")[0])
    rows_of = snapshots.read_snapshots(spark, f"{lake}/silver/clientes", [first]).drop("ver")
    for ver, label in ((201, "Novo"), (202, "Outro")):
        snapshots.write_snapshot(rows_of.withColumn("perfil_risco", F.when(F.col("ativo"), label).otherwise(F.col("perfil_risco"))), f"{lake}/silver/clientes", ver)
    days = {"2026-01-01": first, "2026-01-02": 201, "2026-01-03": 202}
    for day in ("2026-01-03", "2026-01-01", "2026-01-02", "2026-01-01"):
        jobs.run_history(spark, "clientes_scd", lake, day, jobs.ANY_ORDER, days[day])
    got = jobs.read_history(spark, "clientes_scd", lake)
    n, active = rows_of.count(), rows_of.where("ativo").count()
    assert (got.count(), got.where("atual").count()) == (n + 2 * active, n)
    assert {str(r[0]) for r in got.where("perfil_risco = 'Novo'").select("data_fim").distinct().collect()} == {"2026-01-03"}


def test_monitoring(spark, base):
    for _ in range(2):  # a second run of the day replaces the first
        status = jobs.run_monitoring(spark, base, "2026-01-03", ["silver_bcb", "gold_performance"])
        assert sorted(r["tabela"] for r in status.collect()) == ["bcb", "performance_acoes"]
    assert {r["versao_cdf"] for r in status.collect()} == {1, 2}
