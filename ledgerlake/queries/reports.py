"""Display reports and business questions of section 2.12."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.history import scd2_from_snapshots
from ..plans import gold, reports
from . import views as v
from .aggregations import RISK_RETURN
from .golds import INTRADAY, RANKING, STREAM_FRAUD, VOLUME
from .registry import query
from .views import ASOF, FAR, davg, dsum, r


@query(
    "report_sector_summary",
    f"""select setor, count(distinct ticker) as tickers, count(*) as registros, {r(davg('variacao_diaria_pct'), 4)} as variacao_media_pct,
  {r(davg('amplitude_diaria'), 4)} as amplitude_media, {r('cast(sum(volume) as double)/count(volume)/1000000::double', 2)} as "volume_medio_M"
from v_bars group by setor""",
)
def report_sector_summary(spark, sf):
    return reports.sector_summary(v.bars(spark, sf))


@query(
    "report_series_filter",
    f"""select data, indicador, valor, cast(year(data) as int) as ano, cast(month(data) as int) as mes, cast(quarter(data) as int) as trimestre
from v_series where indicador in ('selic','cambio_usd_brl') and year(data)=1998 order by data desc, indicador limit 10""",
)
def report_series_filter(spark, sf):
    from ..plans.silver import with_date_parts

    return reports.series_filter(with_date_parts(v.series(spark, sf), "data"), ["selic", "cambio_usd_brl"], 1998)


@query(
    "report_profile_mix",
    f"""select perfil_risco, count(*) as clientes, {r('count(*)*100::double/sum(count(*)) over ()', 1)} as pct,
  {r(davg('score_credito'), 0)} as score_medio, {r(davg('saldo'), 2)} as saldo_medio, count(*) filter (churn) as churners from v_clients group by 1""",
)
def report_profile_mix(spark, sf):
    return reports.profile_mix(v.clients(spark, sf))


@query(
    "report_trades_by_type",
    f"""select ticker, tipo, count(*) as transacoes, cast(sum(quantidade) as bigint) as volume_total, {r(davg('preco'), 2)} as preco_medio,
  {dsum('valor_total', 0)} as valor_financeiro_total from v_trades group by 1,2""",
)
def report_trades_by_type(spark, sf):
    return reports.trades_by_type(v.trades(spark, sf))


@query(
    "report_trades_sample",
    "select id_transacao, timestamp, ticker, preco, quantidade, valor_total, hora, minuto from v_trades order by timestamp desc, id_transacao limit 10",
)
def report_trades_sample(spark, sf):
    from ..operators.sets import top_k

    cols = ["id_transacao", "timestamp", "ticker", "preco", "quantidade", "valor_total", "hora", "minuto"]
    rows = top_k(v.trades(spark, sf).select(*cols), [F.desc("timestamp"), "id_transacao"], 10)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "report_anomaly_dist",
    f"""select tipo_anomalia, count(*) as ocorrencias, {r(davg('abs(zscore)'), 4)} as zscore_medio, max(abs(zscore)) as zscore_maximo,
  {r(davg('abs(variacao_diaria_pct)'), 4)} as variacao_media_abs_pct from v_anom group by 1""",
)
def report_anomaly_dist(spark, sf):
    return reports.anomaly_distribution(v.anomalies(spark, sf))


@query(
    "report_top_anomalies",
    """select date, ticker, empresa, setor, close as preco_fechamento, variacao_diaria_pct as variacao_pct, zscore, tipo_anomalia
from v_anom where anomalia order by abs(zscore) desc, date, ticker limit 10""",
)
def report_top_anomalies(spark, sf):
    return reports.top_anomalies(v.anomalies(spark, sf))


@query(
    "report_volatile",
    f"""select ticker, empresa, setor, count(*) as total_dias, count(*) filter (anomalia) as dias_anomalia,
  {r('count(*) filter (anomalia)*100::double/count(*)', 2)} as pct_anomalias, {r(davg('case when anomalia then abs(zscore) end'), 4)} as zscore_medio_anomalias
from v_anom group by 1,2,3""",
)
def report_volatile(spark, sf):
    return reports.most_volatile(v.anomalies(spark, sf))


@query(
    "report_sector_year",
    f"""select setor, ano, count(distinct ticker) as tickers, {r(davg('variacao_media_pct'), 4)} as retorno_medio_pct, {r(davg('volatilidade'), 4)} as volatilidade_media,
  {r(davg('volume_medio') + '/1000000::double', 2)} as "volume_medio_M", {r('sum(volume_total)/1000000000::double', 2)} as "volume_total_B" from v_perf group by 1,2""",
)
def report_sector_year(spark, sf):
    return reports.sector_year(v.performance(spark, sf))


@query("report_risk_return", RISK_RETURN)
def report_risk_return(spark, sf):
    return reports.risk_return(v.performance(spark, sf))


@query(
    "report_risk_categories",
    f"""select categoria_risco, count(*) as clientes, {r('count(*)*100::double/sum(count(*)) over ()', 1)} as pct,
  {r(davg('score_risco'), 2)} as score_medio, {r(davg('limite_operacional'), 0)} as limite_medio from v_score group by 1""",
)
def report_risk_categories(spark, sf):
    return reports.risk_categories(v.scores(spark, sf))


@query(
    "report_high_risk_clients",
    """select s.cli, s.categoria_risco, s.score_risco as score, s.limite_operacional, c.perfil_risco as perfil_declarado, c.score_credito, c.idade, c.faixa_etaria, c.ativo
from v_score s join v_clients c on s.cli=c.cli where s.categoria_risco='Risco Moderado' and c.ativo order by s.score_risco, s.cli limit 10""",
)
def report_high_risk_clients(spark, sf):
    return reports.high_risk_clients(v.scores(spark, sf), v.clients(spark, sf), "Risco Moderado", client="cli")


@query(
    "report_fraud_levels",
    f"""select score_fraude, count(*) as ordens, {r('count(*)*100::double/sum(count(*)) over ()', 2)} as pct, {r(davg('valor_total'), 2)} as valor_medio,
  count(*) filter (requer_revisao) as requer_revisao from v_fraud group by 1""",
)
def report_fraud_levels(spark, sf):
    return reports.fraud_levels(v.fraud(spark, sf))


@query(
    "report_critical_orders",
    """select f.data_ordem, f.status, f.cli, f.ticker, f.preco, f.quantidade, f.valor_total, f.tipo, f.score_fraude, f.total_alertas, f.alerta_valor_alto,
  f.alerta_volume_suspeito, f.alerta_preco_atipico, f.alerta_perfil_incompativel, c.perfil_risco as perfil_cliente
from v_fraud f join v_clients c on f.cli=c.cli where f.score_fraude='Critico'
order by f.total_alertas desc, f.valor_total desc, f.data_ordem, f.cli, f.ticker, f.status limit 15""",
)
def report_critical_orders(spark, sf):
    tie = ["data_ordem", "cli", "ticker", "status"]
    return reports.critical_orders(v.fraud(spark, sf), v.clients(spark, sf), tie, client="cli")


@query(
    "report_stream_fraud",
    f"""select score_fraude, count(*) as transacoes, {r(davg('valor_total'), 2)} as valor_medio, count(*) filter (alerta_desvio_historico) as com_desvio_historico
from ({STREAM_FRAUD}) f group by 1""",
)
def report_stream_fraud(spark, sf):
    return reports.stream_fraud_levels(gold.fraud_trades(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF))


@query(
    "report_intraday_top",
    f"""select ticker, hora, preco_medio_hora, preco_medio as preco_historico, volume_hora, zscore_intraday as zscore, tipo_anomalia
from ({INTRADAY.replace('>2', '>0.01').replace('<-2', '<-0.01')}) i where anomalia order by abs(zscore_intraday) desc, ticker, hora limit 15""",
)
def report_intraday_top(spark, sf):
    odd = gold.intraday_anomalies(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF, k=0.01)
    return reports.intraday_top(odd)


@query(
    "report_pressure_share",
    f"""select ticker, hora, total_transacoes, {r('volume_compras/(volume_compras+volume_vendas+0.001::double)*100', 1)} as pct_compras,
  {r('volume_vendas/(volume_compras+volume_vendas+0.001::double)*100', 1)} as pct_vendas, pressao_compradora, alerta_volume_intraday, pct_volume_diario
from ({VOLUME}) i order by hora, ticker limit 18""",
)
def report_pressure_share(spark, sf):
    return reports.pressure_share(gold.intraday_volume(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF))


@query(
    "report_ranking",
    f"""select rank_volume as posicao, ticker, total_transacoes, {r('volume_total/1000000::double', 2)} as "volume_M",
  {r('valor_total/1000000::double', 2)} as "valor_financeiro_M", preco_medio_atual as preco_atual, variacao_vs_historico_pct, tendencia from ({RANKING}) i""",
)
def report_ranking(spark, sf):
    return reports.ranking_display(gold.ranking(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF))


SCORE_HISTORY = f"""
select cli, ordens as score_risco, perfil_risco as categoria_risco, ordens*1000 as limite_operacional, make_date(ver,1,1) as data_inicio,
  coalesce(make_date(cast(lead(ver) over w as int),1,1), date '{FAR}') as data_fim, lead(ver) over w is null as atual
from (select *, lag(ordens) over (partition by cli order by ver) as antes from v_snap) t where antes is null or antes<>ordens
window w as (partition by cli order by ver) order by cli, data_inicio limit 20"""


@query("report_score_evolution", SCORE_HISTORY)
def report_score_evolution(spark, sf):
    dated = v.yearly_snapshots(spark, sf).select(
        "cli", F.col("ordens").alias("score_risco"), F.col("perfil_risco").alias("categoria_risco"),
        (F.col("ordens") * 1000).alias("limite_operacional"), F.make_date("ver", F.lit(1), F.lit(1)).alias("dia"),
    )
    hist = scd2_from_snapshots(dated, "cli", ["score_risco", "categoria_risco", "limite_operacional"], "dia")
    return reports.score_evolution(hist, client="cli")


@query(
    "q_top_fraud_clients",
    f"""select cli, count(*) as ordens_suspeitas, cast(sum(total_alertas) as bigint) as alertas, {r(davg('valor_total'), 2)} as valor_medio_suspeito
from v_fraud where requer_revisao group by cli order by alertas desc, valor_medio_suspeito desc, cli limit 10""",
)
def q_top_fraud_clients(spark, sf):
    return reports.top_fraud_clients(v.fraud(spark, sf), client="cli")


@query("q_score_by_profile", f"select perfil_risco, count(*) as clientes, {r(davg('score_risco'), 2)} as score_medio from v_score group by 1")
def q_score_by_profile(spark, sf):
    return reports.score_by_profile(v.scores(spark, sf))


@query(
    "q_churn_by_profile",
    f"select perfil_risco, count(*) as clientes, {r('count(*) filter (churn)*100::double/count(*)', 2)} as taxa_churn_pct from v_clients group by 1",
)
def q_churn_by_profile(spark, sf):
    return reports.churn_by_profile(v.clients(spark, sf))


@query("q_critical_clients", "select cli, perfil_risco from v_clients where cli in (select cli from v_fraud where score_fraude='Critico')")
def q_critical_clients(spark, sf):
    return reports.critical_clients(v.clients(spark, sf).select("cli", "perfil_risco"), v.fraud(spark, sf), client="cli")


@query(
    "q_worst_fall",
    "select date, ticker, variacao_diaria_pct, zscore from v_anom where zscore<-0.25 order by zscore, date, ticker limit 1",
)
def q_worst_fall(spark, sf):
    # daily changes here are skewed upwards: a lower limit than 2 lets falls count as abnormal
    return reports.worst_fall(gold.anomalies(v.bars(spark, sf), ASOF, k=0.25))


@query("q_count_profile", "select count(*) as clientes from v_clients where perfil_risco='Conservador'")
def q_count_profile(spark, sf):
    return reports.count_profile(v.clients(spark, sf))
