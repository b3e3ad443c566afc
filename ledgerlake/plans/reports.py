"""Display reports over the silver and gold tables. Sorting happens only here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import count_where, dec_round, dec_sum, exact_avg, safe_div
from ..operators.aggregates import flag_rate, share_of_total
from ..operators.joins import guarded_join
from ..operators.sets import sort_by_rank, top_k


def _int_avg(col: str, scale: float, digits: int):
    """Mean of an integer column in units of ``scale``; integer sums are exact."""
    return dec_round(safe_div(F.sum(col), F.count(col)) / F.lit(scale), digits)


def sector_summary(bars: DataFrame) -> DataFrame:
    return (
        bars.groupBy("setor")
        .agg(
            F.count_distinct("ticker").alias("tickers"),
            F.count("*").alias("registros"),
            exact_avg("variacao_diaria_pct", 4).alias("variacao_media_pct"),
            exact_avg("amplitude_diaria", 4).alias("amplitude_media"),
            _int_avg("volume", 1e6, 2).alias("volume_medio_M"),
        )
        .orderBy(F.desc("volume_medio_M"), "setor")
    )


def series_filter(series: DataFrame, names: Sequence[str], year: int, k: int = 10) -> DataFrame:
    rows = series.where(F.col("indicador").isin(list(names)) & (F.col("ano") == year)).select(
        "data", "indicador", dec_round("valor", 6).alias("valor"), "ano", "mes", "trimestre"
    )
    return top_k(rows, [F.desc("data"), "indicador"], k)


def profile_mix(clients: DataFrame) -> DataFrame:
    return share_of_total(
        clients, ["perfil_risco"], "clientes", "pct", 1,
        exact_avg("score_credito", 0).alias("score_medio"),
        exact_avg("saldo", 2).alias("saldo_medio"),
        count_where(F.col("churn")).alias("churners"),
    ).orderBy(F.desc("clientes"), "perfil_risco")


def trades_by_type(trades: DataFrame) -> DataFrame:
    return (
        trades.groupBy("ticker", "tipo")
        .agg(
            F.count("*").alias("transacoes"),
            F.sum("quantidade").alias("volume_total"),
            exact_avg("preco", 2).alias("preco_medio"),
            dec_sum("valor_total", 0).alias("valor_financeiro_total"),
        )
        .orderBy("ticker", "tipo")
    )


def anomaly_distribution(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("tipo_anomalia")
        .agg(
            F.count("*").alias("ocorrencias"),
            exact_avg(F.abs("zscore"), 4).alias("zscore_medio"),
            F.max(F.abs("zscore")).alias("zscore_maximo"),
            exact_avg(F.abs("variacao_diaria_pct"), 4).alias("variacao_media_abs_pct"),
        )
        .orderBy(F.desc("ocorrencias"), "tipo_anomalia")
    )


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    rows = anomalies.where("anomalia").select(
        "date", "ticker", "empresa", "setor",
        F.col("close").alias("preco_fechamento"), F.col("variacao_diaria_pct").alias("variacao_pct"),
        "zscore", "tipo_anomalia",
    )
    return top_k(rows, [F.desc(F.abs("zscore")), "date", "ticker"], k)


def most_volatile(anomalies: DataFrame) -> DataFrame:
    names = ("total_dias", "dias_anomalia", "pct_anomalias", "zscore_medio_anomalias")
    return flag_rate(anomalies, ["ticker", "empresa", "setor"], "anomalia", F.abs("zscore"), names).orderBy(
        F.desc("pct_anomalias"), "ticker"
    )


def sector_year(perf: DataFrame) -> DataFrame:
    return (
        perf.groupBy("setor", "ano")
        .agg(
            F.count_distinct("ticker").alias("tickers"),
            exact_avg("variacao_media_pct", 4).alias("retorno_medio_pct"),
            exact_avg("volatilidade", 4).alias("volatilidade_media"),
            dec_round(exact_avg("volume_medio") / F.lit(1e6), 2).alias("volume_medio_M"),
            dec_round(F.sum("volume_total") / F.lit(1e9), 2).alias("volume_total_B"),
        )
        .orderBy("setor", "ano")
    )


def risk_return(perf: DataFrame, calm: float = 1.5) -> DataFrame:
    means = perf.groupBy("ticker", "empresa", "setor").agg(
        exact_avg("variacao_media_pct").alias("_r"), exact_avg("volatilidade").alias("_v")
    )
    r, v = F.col("_r"), F.col("_v")
    label = (
        F.when((r > 0) & (v < calm), presets.RISK_RETURN_IDEAL)
        .when((r > 0) & (v >= calm), presets.RISK_RETURN_RISKY)
        .when(r <= 0, presets.RISK_RETURN_POOR)
    )
    return means.select(
        "ticker", "empresa", "setor",
        dec_round(r, 4).alias("retorno_medio"),
        dec_round(v, 4).alias("volatilidade_media"),
        label.alias("perfil_ativo"),
    ).orderBy(F.desc("retorno_medio"), "ticker")


def risk_categories(scores: DataFrame) -> DataFrame:
    return share_of_total(
        scores, ["categoria_risco"], "clientes", "pct", 1,
        exact_avg("score_risco", 2).alias("score_medio"),
        exact_avg("limite_operacional", 0).alias("limite_medio"),
    ).orderBy(F.desc("score_medio"), "categoria_risco")


def high_risk_clients(
    scores: DataFrame, clients: DataFrame, category: str = "Risco Alto", client: str = "hash_cliente", k: int = 10
) -> DataFrame:
    risky = scores.where(F.col("categoria_risco") == category).select(
        client, "categoria_risco", F.col("score_risco").alias("score"), "limite_operacional"
    )
    active = clients.where("ativo").select(
        client, F.col("perfil_risco").alias("perfil_declarado"), "score_credito", "idade", "faixa_etaria", "ativo"
    )
    return top_k(risky.join(active, client), ["score", client], k)


def fraud_levels(fraud: DataFrame) -> DataFrame:
    shares = share_of_total(
        fraud, ["score_fraude"], "ordens", "pct", 2,
        exact_avg("valor_total", 2).alias("valor_medio"),
        count_where(F.col("requer_revisao")).alias("requer_revisao"),
    )
    return sort_by_rank(shares, "score_fraude", presets.SEVERITY_ORDER)


def critical_orders(
    fraud: DataFrame, clients: DataFrame, tie: Sequence[str], client: str = "hash_cliente", k: int = 15
) -> DataFrame:
    """Most severe orders. ``tie`` completes the order where alerts and value are equal."""
    profile = clients.select(client, F.col("perfil_risco").alias("perfil_cliente"))
    cols = [
        client, "ticker", "preco", "quantidade", "valor_total", "tipo", "score_fraude", "total_alertas",
        *presets.ORDER_RULES,
    ]
    cols = [*[c for c in tie if c not in cols], *cols]
    critical = fraud.where(F.col("score_fraude") == presets.SEVERITY_ORDER[0]).select(*cols)
    joined = guarded_join(critical, profile, client, "inner")
    return top_k(joined, [F.desc("total_alertas"), F.desc("valor_total"), *tie], k)


def stream_fraud_levels(fraud: DataFrame) -> DataFrame:
    counts = fraud.groupBy("score_fraude").agg(
        F.count("*").alias("transacoes"),
        exact_avg("valor_total", 2).alias("valor_medio"),
        count_where(F.col("alerta_desvio_historico")).alias("com_desvio_historico"),
    )
    return sort_by_rank(counts, "score_fraude", presets.SEVERITY_ORDER)


def intraday_top(anomalies: DataFrame, k: int = 15) -> DataFrame:
    rows = anomalies.where("anomalia").select(
        "ticker", "hora", "preco_medio_hora", F.col("preco_medio").alias("preco_historico"), "volume_hora",
        F.col("zscore_intraday").alias("zscore"), "tipo_anomalia",
    )
    return top_k(rows, [F.desc(F.abs("zscore")), "ticker", "hora"], k)


def pressure_share(volume: DataFrame, k: int | None = 18) -> DataFrame:
    both = F.col("volume_compras") + F.col("volume_vendas") + F.lit(0.001)
    rows = volume.select(
        "ticker", "hora", "total_transacoes",
        dec_round(F.col("volume_compras") / both * 100, 1).alias("pct_compras"),
        dec_round(F.col("volume_vendas") / both * 100, 1).alias("pct_vendas"),
        "pressao_compradora", "alerta_volume_intraday", "pct_volume_diario",
    )
    return top_k(rows, ["hora", "ticker"], k) if k else rows.orderBy("hora", "ticker")


def ranking_display(rank: DataFrame) -> DataFrame:
    return rank.select(
        F.col("rank_volume").alias("posicao"), "ticker", "total_transacoes",
        dec_round(F.col("volume_total") / F.lit(1e6), 2).alias("volume_M"),
        dec_round(F.col("valor_total") / F.lit(1e6), 2).alias("valor_financeiro_M"),
        F.col("preco_medio_atual").alias("preco_atual"),
        "variacao_vs_historico_pct", "tendencia",
    ).orderBy("posicao")


def score_evolution(hist: DataFrame, client: str = "hash_cliente", k: int = 20) -> DataFrame:
    rows = hist.select(
        client, "score_risco", "categoria_risco", "limite_operacional", "data_inicio", "data_fim", "atual"
    )
    return top_k(rows, [client, "data_inicio"], k)


# --- business questions ---------------------------------------------------------------------


def top_fraud_clients(fraud: DataFrame, client: str = "hash_cliente", k: int = 10) -> DataFrame:
    """Clients with most alerts and the mean value of their orders under review."""
    suspicious = fraud.where("requer_revisao").groupBy(client).agg(
        F.count("*").alias("ordens_suspeitas"),
        F.sum("total_alertas").alias("alertas"),
        exact_avg("valor_total", 2).alias("valor_medio_suspeito"),
    )
    return top_k(suspicious, [F.desc("alertas"), F.desc("valor_medio_suspeito"), client], k)


def score_by_profile(scores: DataFrame) -> DataFrame:
    return scores.groupBy("perfil_risco").agg(
        F.count("*").alias("clientes"), exact_avg("score_risco", 2).alias("score_medio")
    )


def churn_by_profile(clients: DataFrame) -> DataFrame:
    churned = count_where(F.col("churn"))
    return clients.groupBy("perfil_risco").agg(
        F.count("*").alias("clientes"),
        dec_round(safe_div(churned * F.lit(100.0), F.count("*")), 2).alias("taxa_churn_pct"),
    )


def critical_clients(clients: DataFrame, fraud: DataFrame, client: str = "hash_cliente") -> DataFrame:
    """Clients with at least one critical order (semi join, no duplicates)."""
    critical = fraud.where(F.col("score_fraude") == presets.SEVERITY_ORDER[0]).select(client)
    return clients.join(critical, client, "left_semi")


def worst_fall(anomalies: DataFrame, k: int = 1) -> DataFrame:
    falls = anomalies.where(F.col("tipo_anomalia") == presets.ANOMALY_DOWN)
    return top_k(falls.select("date", "ticker", "variacao_diaria_pct", "zscore"), ["zscore", "date", "ticker"], k)


def count_profile(clients: DataFrame, profile: str = "Conservador") -> DataFrame:
    return clients.where(F.col("perfil_risco") == profile).agg(F.count("*").alias("clientes"))
