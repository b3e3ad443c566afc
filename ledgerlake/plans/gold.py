"""Gold analyses: each takes its input tables and returns a DataFrame; sinks are separate.

Tables keyed by symbol (the yearly benchmark, hourly groups) come from aggregates, so what is
joined to the fact rows has one row per symbol. Its size is still checked before a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import (
    SUM_TYPE,
    band,
    compare_label,
    count_where,
    dec_round,
    dec_sum,
    exact_avg,
    guard_zero,
    label_map,
    safe_div,
    signed_sum,
    sum_where,
)
from ..operators.aggregates import pivot_series
from ..operators.joins import dedup_latest, guarded_join, join_left_reject, latest_slice
from ..operators.rules import DEFAULT_ORDER_RULES, DEFAULT_TRADE_RULES, Rule, apply_rules
from ..operators.windows import Trailing, label_z, pct_change, rank_by, rolling_corr, trailing, zscore
from ..sources.scratch import stage


def _stamped(df: DataFrame, asof: str) -> DataFrame:
    return df.withColumn("data_processamento", F.lit(asof))


# --- market ---------------------------------------------------------------------------------


def anomalies(
    bars: DataFrame, asof: str, key: str = "ticker", value: str = "variacao_diaria_pct", k: float = 2.0
) -> DataFrame:
    """Days whose change is more than ``k`` deviations from the symbol's mean.

    The deduplicated days are written once: the statistics and the scoring both read them.
    """
    cols = ["date", key, "empresa", "setor", "open", "close", "volume", value]
    unique = stage(dedup_latest(bars.select(*cols), ["date", key]), "days")
    scored = zscore(unique, key, value, k)
    return _stamped(scored.select(*cols, "zscore", "anomalia", "tipo_anomalia"), asof)


def performance(
    bars: DataFrame,
    asof: str,
    keys: Sequence[str] = ("ticker", "empresa", "setor", "ano"),
    price: str = "close",
    change: str = "variacao_diaria_pct",
    volume: str = "volume",
) -> DataFrame:
    """Price, change and volume summary per symbol and year."""
    return _stamped(
        bars.groupBy(*keys).agg(
            exact_avg(price, 2).alias("preco_medio"),
            dec_round(F.min(price), 2).alias("preco_minimo"),
            dec_round(F.max(price), 2).alias("preco_maximo"),
            exact_avg(change, 4).alias("variacao_media_pct"),
            dec_round(F.stddev_samp(change), 4).alias("volatilidade"),
            dec_round(safe_div(F.sum(volume), F.count(volume)), 0).alias("volume_medio"),
            F.sum(volume).alias("volume_total"),
            F.count("*").alias("dias_negociados"),
        ),
        asof,
    )


def benchmark(perf: DataFrame, year: str = "ano") -> DataFrame:
    """Latest year of the performance table.

    The (small) summary is written once: the year lookup, the slice and every analysis that
    joins it then read the same file, and its real size is known to the join.
    """
    cols = ["ticker", "empresa", "setor", "preco_medio", "volatilidade", "volume_medio"]
    return latest_slice(stage(perf.select(*cols, year), "benchmark"), year).drop(year)


def daily_bars(bars: DataFrame) -> DataFrame:
    """One row per (date, ticker)."""
    return bars.groupBy("date", "ticker").agg(
        exact_avg("close", 2).alias("preco_medio"),
        exact_avg("variacao_diaria_pct", 4).alias("variacao_media_pct"),
        F.sum("volume").alias("volume_dia"),
        F.min("ano").alias("ano"),
        F.min("mes").alias("mes"),
    )


def fx_correlation(bars: DataFrame, fx: DataFrame, asof: str, days: int = 90) -> DataFrame:
    """Rolling correlation of each symbol's daily change with the exchange rate's change.

    ``fx`` is (date, cambio), one row per date.
    """
    joined = join_left_reject(daily_bars(bars), fx, "date", "cambio")
    moved = pct_change(joined, ["ticker"], "date", "cambio", "cambio_variacao_pct", 4)
    corr = rolling_corr(
        moved, "ticker", "date", "variacao_media_pct", "cambio_variacao_pct", days, "correlacao_cambio", 4
    )
    r, fxp = F.col("correlacao_cambio"), F.col("cambio_variacao_pct")
    decoupled = (F.abs("variacao_media_pct") > 5) & (F.abs(fxp) < 1)
    out = corr.withColumns({
        "sensibilidade_cambio": band(r, presets.FX_SENSITIVITY, presets.FX_SENSITIVITY_DEFAULT),
        "alerta_desacoplamento": F.when(decoupled, presets.FX_DECOUPLED).otherwise(presets.FX_COUPLED),
        "recomendacao": F.when((r > 0.3) & (fxp > 2), presets.FX_BUY)
        .when((r < -0.3) & (fxp > 2), presets.FX_SELL)
        .otherwise(presets.FX_NEUTRAL),
    })
    return _stamped(
        out.select(
            "date", "ticker", "preco_medio", "variacao_media_pct", "cambio", "cambio_variacao_pct",
            "correlacao_cambio", "sensibilidade_cambio", "alerta_desacoplamento", "recomendacao", "ano", "mes",
        ),
        asof,
    )


# --- macro ----------------------------------------------------------------------------------


def series_indicators(series: DataFrame, asof: str, names: Sequence[str] = presets.DAILY_SERIES) -> DataFrame:
    """Wide daily indicators with trailing means, deviation, accumulation, trend and alerts."""
    rate, fx, prices = names
    wide = pivot_series(series, "data", names)
    t = trailing(
        wide,
        "data",
        [
            Trailing("selic_media_7d", "avg", rate, 7, 4),
            Trailing("selic_volatilidade_30d", "stddev", rate, 30, 4),
            Trailing("cambio_media_7d", "avg", fx, 7, 4),
            Trailing("ipca_acumulado_12m", "sum", prices, 365),
        ],
    )
    gap = safe_div(F.col(fx) - F.col("cambio_media_7d"), F.col("cambio_media_7d")) * 100
    t = t.withColumn("cambio_variacao_pct", dec_round(gap, 2))
    high, medium = presets.CRITICAL_HIGH
    return _stamped(
        t.withColumns({
            "tendencia_selic": compare_label(rate, "selic_media_7d", presets.TREND),
            "alerta_cambio": band(
                F.abs("cambio_variacao_pct"), [(">", 5, high), (">", 2, medium)], presets.NORMAL
            ),
            "alerta_inflacao": band("ipca_acumulado_12m", [(">", 5, high), (">", 3, medium)], presets.NORMAL),
        }),
        asof,
    )


def macro_context(
    yearly: DataFrame, asof: str, names: Sequence[str] = presets.YEARLY_SERIES, null_label: str | None = None
) -> DataFrame:
    """Yearly output and unemployment: changes, trends, scenario, risk and market impact."""
    gdp, jobless = names
    wide = pivot_series(yearly, "ano", names)
    moved = pct_change(wide, [], "ano", gdp, "pib_variacao_pct", 2)
    moved = pct_change(moved, [], "ano", jobless, "desemprego_variacao_pct", 2, diff=True)
    g, u, level = F.col("pib_variacao_pct"), F.col("desemprego_variacao_pct"), F.col(jobless)
    scenario = (
        F.when((g > 2) & (u < 0), presets.SCENARIO_EXPANSION)
        .when((g > 0) & (u > 0), presets.SCENARIO_SLOWDOWN)
        .when((g < 0) & (u > 1), presets.SCENARIO_RECESSION)
        .otherwise(presets.SCENARIO_OTHER)
    )
    risk = F.when((g < -2) | (level > 15), "Alto").when((g < 0) | (level > 10), "Moderado").otherwise("Baixo")
    out = moved.withColumns({
        "tendencia_pib": band(g, presets.GDP_TREND, presets.GDP_TREND_DEFAULT, null_label),
        "tendencia_desemprego": band(u, presets.JOBLESS_TREND, presets.JOBLESS_TREND_DEFAULT, null_label),
        "cenario_macro": scenario,
        "alerta_risco": risk,
    })
    impact = label_map("cenario_macro", presets.SCENARIO_IMPACT, presets.SCENARIO_IMPACT_DEFAULT)
    return _stamped(out.withColumn("impacto_bolsa", impact), asof)


# --- clients --------------------------------------------------------------------------------


def positions(
    orders: DataFrame,
    clients: DataFrame,
    asof: str,
    client: str = "hash_cliente",
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Net position per client and symbol, with the client's profile.

    Every order counts unless ``statuses`` narrows it; anything that is not a purchase
    reduces the net quantity.
    """
    rows = orders.where(F.col("status").isin(list(statuses))) if statuses else orders
    buy, sell = F.col("tipo") == "compra", F.col("tipo") == "venda"
    agg = rows.groupBy(client, "ticker").agg(
        signed_sum(buy, "quantidade").alias("quantidade_liquida"),
        sum_where(buy, "valor_total").alias("_bought"),
        sum_where(sell, "valor_total").alias("_sold"),
        F.count("*").alias("total_ordens"),
        count_where(F.col("status") == "executada").alias("ordens_executadas"),
        count_where(F.col("status") == "cancelada").alias("ordens_canceladas"),
    )
    shaped = agg.select(
        client,
        "ticker",
        "quantidade_liquida",
        dec_round("_bought", 2).alias("total_comprado"),
        dec_round("_sold", 2).alias("total_vendido"),
        "total_ordens",
        "ordens_executadas",
        "ordens_canceladas",
        dec_round(F.col("_bought") - F.col("_sold"), 2).alias("valor_investido"),
        dec_round(F.col("_sold") - F.col("_bought"), 2).alias("resultado_estimado"),
        compare_label("quantidade_liquida", F.lit(0), presets.POSITION).alias("situacao"),
    )
    profile = clients.select(client, "perfil_risco", "faixa_saldo", "score_credito")
    return guarded_join(_stamped(shaped, asof), profile, client)


def risk_score(
    pos: DataFrame,
    asof: str,
    client: str = "hash_cliente",
    weights: Sequence[float] = presets.SCORE_WEIGHTS,
    limits: dict = presets.RISK_LIMIT,
) -> DataFrame:
    """Weighted 0-100 score per client, its category and the operating limit."""
    keys = [client, "perfil_risco", "faixa_saldo", "score_credito"]
    base = pos.groupBy(*keys).agg(
        F.count("ticker").alias("num_ativos"),
        F.sum("total_ordens").alias("total_ordens"),
        F.sum("ordens_canceladas").alias("total_canceladas"),
        dec_sum("valor_investido").alias("valor_total_investido"),
        count_where(F.col("situacao") == presets.POSITION[1]).alias("posicoes_descoberto"),
        exact_avg("resultado_estimado", 2).alias("resultado_medio"),
    )
    parts = base.withColumns({
        "taxa_cancelamento_pct": dec_round(safe_div("total_canceladas", "total_ordens") * 100, 2),
        "score_credito_norm": dec_round(F.col("score_credito") / F.lit(850.0) * 100, 2),
        "score_perfil": label_map("perfil_risco", presets.PROFILE_POINTS, presets.PROFILE_POINTS_DEFAULT),
        "score_saldo": label_map("faixa_saldo", presets.BALANCE_POINTS, presets.BALANCE_POINTS_DEFAULT),
    }).withColumn(
        "score_comportamento",
        band("taxa_cancelamento_pct", presets.BEHAVIOUR_POINTS, presets.BEHAVIOUR_POINTS_DEFAULT),
    )
    names = ("score_credito_norm", "score_perfil", "score_saldo", "score_comportamento")
    w = [F.col(n) * F.lit(float(x)) for n, x in zip(names, weights)]
    scored = parts.withColumn("score_risco", dec_round(w[0] + w[1] + w[2] + w[3], 2))
    scored = scored.withColumn(
        "categoria_risco", band("score_risco", presets.RISK_CATEGORY, presets.RISK_CATEGORY_DEFAULT)
    )
    limit = label_map("categoria_risco", limits, presets.RISK_LIMIT_DEFAULT)
    return _stamped(scored.withColumn("limite_operacional", limit), asof)


def fraud_orders(
    orders: DataFrame,
    scores: DataFrame,
    asof: str,
    client: str = "hash_cliente",
    rules: Sequence[Rule] = tuple(DEFAULT_ORDER_RULES),
) -> DataFrame:
    """Alert flags and severity per order. A client without score has no limit to exceed."""
    limits = scores.select(client, "score_risco", "categoria_risco", "limite_operacional")
    return _stamped(apply_rules(guarded_join(orders, limits, client), rules), asof)


def segment_profile(
    clients: DataFrame,
    asof: str | None = None,
    keys: Sequence[str] = ("perfil_risco", "faixa_etaria", "score_categoria", "pais"),
) -> DataFrame:
    """Clients, averages and churn per segment."""
    churned = count_where(F.col("churn"))
    return clients.groupBy(*keys).agg(
        F.count("*").alias("total_clientes"),
        exact_avg("saldo", 2).alias("saldo_medio"),
        exact_avg("score_credito", 0).alias("score_medio"),
        exact_avg("salario_estimado", 2).alias("salario_medio"),
        churned.alias("total_churn"),
        dec_round(safe_div(churned, F.count("*")) * 100, 2).alias("taxa_churn_pct"),
    )


def orders_consolidated(
    orders: DataFrame,
    keys: Sequence[str] = ("ticker", "perfil_risco", "faixa_saldo", "tipo", "status", "ano"),
) -> DataFrame:
    return orders.groupBy(*keys).agg(
        F.count("*").alias("total_ordens"),
        dec_sum("valor_total").alias("volume_total"),
        exact_avg("preco", 2).alias("preco_medio"),
        exact_avg("quantidade", 0).alias("qtd_media"),
    )


def ranking_by_profile(
    orders: DataFrame, keys: Sequence[str] = ("ticker", "perfil_risco"), status: str = "executada"
) -> DataFrame:
    return (
        orders.where(F.col("status") == status)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_ordens"),
            dec_sum("valor_total").alias("volume_total"),
            exact_avg("preco", 2).alias("preco_medio"),
        )
    )


# --- trades ---------------------------------------------------------------------------------


def fraud_trades(
    trades: DataFrame,
    bench: DataFrame,
    asof: str,
    rules: Sequence[Rule] = tuple(DEFAULT_TRADE_RULES),
) -> DataFrame:
    """Alert flags per trade against the symbol's benchmark. Works on batch and stream."""
    known = guarded_join(trades, bench.select("ticker", "preco_medio", "volatilidade"), "ticker")
    flags = [r.name for r in rules]
    return _stamped(
        apply_rules(known, rules).select(
            "id_transacao", "timestamp", "ticker", "tipo", "preco", "quantidade", "valor_total",
            "preco_medio", "volatilidade", *flags, "total_alertas", "score_fraude", "requer_revisao",
        ),
        asof,
    )


def hour_partials(trades: DataFrame) -> DataFrame:
    """Sums per (ticker, hour of day) from which the intraday tables are finished.

    Partials of separate batches add up (``merge_partials``), so a stream stores them per
    batch and never reads its old rows again.
    """
    buy, sell = F.col("tipo") == "compra", F.col("tipo") == "venda"
    return trades.groupBy("ticker", "hora").agg(
        F.count("*").alias("n"),
        F.sum("quantidade").alias("q"),
        F.sum(F.col("valor_total").cast(SUM_TYPE)).alias("v"),
        F.sum(F.col("preco").cast(SUM_TYPE)).alias("p_sum"),
        F.count("preco").alias("p_n"),
        F.min("preco").alias("p_min"),
        F.max("preco").alias("p_max"),
        F.sum(F.when(buy, F.col("quantidade")).otherwise(0)).alias("q_buy"),
        F.sum(F.when(sell, F.col("quantidade")).otherwise(0)).alias("q_sell"),
        count_where(buy).alias("n_buy"),
        count_where(sell).alias("n_sell"),
    )


def merge_partials(partials: DataFrame, keys: Sequence[str] = ("ticker", "hora")) -> DataFrame:
    sums = ("n", "q", "v", "p_sum", "p_n", "q_buy", "q_sell", "n_buy", "n_sell")
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.min("p_min").alias("p_min"), F.max("p_max").alias("p_max")
    )


def _mean_price() -> Column:
    return dec_round(safe_div("p_sum", "p_n"), 2)


def hourly_bars(trades: DataFrame) -> DataFrame:
    """Per (ticker, hour of day): mean price, value, volume, trades."""
    return hourly_bars_of(hour_partials(trades))


def hourly_bars_of(partials: DataFrame) -> DataFrame:
    return partials.select(
        "ticker",
        "hora",
        _mean_price().alias("preco_medio_hora"),
        dec_round("v", 2).alias("valor_total_hora"),
        F.col("q").alias("volume_hora"),
        F.col("n").alias("total_transacoes_hora"),
    )


def intraday_anomalies(trades: DataFrame, bench: DataFrame, asof: str, k: float = 2.0) -> DataFrame:
    """Hours whose mean price is more than ``k`` historical deviations off the benchmark."""
    return intraday_anomalies_of(hour_partials(trades), bench, asof, k)


def intraday_anomalies_of(partials: DataFrame, bench: DataFrame, asof: str, k: float = 2.0) -> DataFrame:
    known = bench.select("ticker", "preco_medio", "volatilidade")
    hours = guarded_join(hourly_bars_of(partials), known, "ticker")
    dev = dec_round(F.col("preco_medio") * F.col("volatilidade") / 100, 4)
    z = safe_div(F.col("preco_medio_hora") - F.col("preco_medio"), guard_zero("desvio_historico_rs"))
    scored = hours.withColumn("desvio_historico_rs", dev).withColumn("zscore_intraday", dec_round(z, 4))
    return _stamped(label_z(scored, "zscore_intraday", k, "anomalia", "tipo_anomalia"), asof)


def intraday_volume(
    trades: DataFrame, bench: DataFrame, asof: str, cuts: Sequence[float] = (15, 30)
) -> DataFrame:
    """Hourly volume, its share of the mean daily volume, and buy / sell pressure."""
    return intraday_volume_of(hour_partials(trades), bench, asof, cuts)


def intraday_volume_of(
    partials: DataFrame, bench: DataFrame, asof: str, cuts: Sequence[float] = (15, 30)
) -> DataFrame:
    hours = partials.select(
        "ticker",
        "hora",
        F.col("n").alias("total_transacoes"),
        F.col("q").alias("volume_hora"),
        dec_round("v", 2).alias("valor_total_hora"),
        _mean_price().alias("preco_medio_hora"),
        F.col("q_buy").alias("volume_compras"),
        F.col("q_sell").alias("volume_vendas"),
    )
    joined = guarded_join(hours, bench.select("ticker", "volume_medio"), "ticker")
    pct = safe_div("volume_hora", guard_zero("volume_medio")) * 100
    high, medium = presets.CRITICAL_HIGH
    return _stamped(
        joined.withColumn("pct_volume_diario", dec_round(pct, 2)).withColumns({
            "alerta_volume_intraday": band(
                "pct_volume_diario", [(">", cuts[1], high), (">", cuts[0], medium)], presets.NORMAL
            ),
            "pressao_compradora": compare_label("volume_compras", "volume_vendas", presets.PRESSURE),
        }),
        asof,
    )


def ranking(trades: DataFrame, bench: DataFrame, asof: str) -> DataFrame:
    """Symbols by traded value with the change against the benchmark price."""
    return ranking_of(hour_partials(trades), bench, asof)


def ranking_of(partials: DataFrame, bench: DataFrame, asof: str) -> DataFrame:
    sums = merge_partials(partials, ["ticker"]).select(
        "ticker",
        F.col("n").alias("total_transacoes"),
        F.col("q").alias("volume_total"),
        dec_round("v", 2).alias("valor_total"),
        _mean_price().alias("preco_medio_atual"),
        F.col("n_buy").alias("total_compras"),
        F.col("n_sell").alias("total_vendas"),
        dec_round("p_min", 2).alias("preco_minimo"),
        dec_round("p_max", 2).alias("preco_maximo"),
    )
    hist = bench.select("ticker", "empresa", "setor", F.col("preco_medio").alias("preco_medio_historico"))
    joined = guarded_join(sums, hist, "ticker")
    change = safe_div(
        F.col("preco_medio_atual") - F.col("preco_medio_historico"), guard_zero("preco_medio_historico")
    )
    up, down, flat = presets.TREND
    out = joined.withColumn("variacao_vs_historico_pct", dec_round(change * 100, 2)).withColumn(
        "tendencia", band("variacao_vs_historico_pct", [(">", 1, up), ("<", -1, down)], flat)
    )
    return rank_by(_stamped(out, asof), [F.desc("valor_total"), F.asc("ticker")])
