"""Gold analyses C1-C16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.rules import Rule, apply_rules
from ..plans import gold
from . import views as v
from .registry import query
from .views import ASOF, davg, dsum, dtotal, r


WEEK = "over (order by data range between interval 7 days preceding and current row)"
YEAR = "over (order by data range between interval 365 days preceding and current row)"


@query("gold_anomalies", "select * from v_anom")
def gold_anomalies(spark, sf):
    return v.anomalies(spark, sf)


@query("gold_performance", "select * from v_perf")
def gold_performance(spark, sf):
    return v.performance(spark, sf)


@query(
    "gold_series_indicators",
    f"""
select *, case when selic>selic_media_7d then 'Alta' when selic<selic_media_7d then 'Queda' else 'Estavel' end as tendencia_selic,
  case when abs(cambio_variacao_pct)>5 then 'Critico' when abs(cambio_variacao_pct)>2 then 'Alto' else 'Normal' end as alerta_cambio,
  case when ipca_acumulado_12m>5 then 'Critico' when ipca_acumulado_12m>3 then 'Alto' else 'Normal' end as alerta_inflacao,
  '{ASOF}' as data_processamento
from (select *, {r('(cambio_usd_brl-cambio_media_7d)/nullif(cambio_media_7d,0)*100', 2)} as cambio_variacao_pct from (
 select data, selic, cambio_usd_brl, ipca,
  {r(davg('selic', WEEK), 4)} as selic_media_7d,
  {r('stddev_samp(selic) over (order by data range between interval 30 days preceding and current row)', 4)} as selic_volatilidade_30d,
  {r(davg('cambio_usd_brl', WEEK), 4)} as cambio_media_7d,
  {dtotal('ipca', YEAR)} as ipca_acumulado_12m
 from v_wide) a) b""",
)
def gold_series_indicators(spark, sf):
    return gold.series_indicators(v.series(spark, sf), ASOF)


@query(
    "gold_macro_context",
    f"""
select *, case cenario_macro when 'Expansao Economica' then 'Positivo - Favoravel para acoes ciclicas'
   when 'Desaceleracao' then 'Negativo - Favora acoes defensivas' when 'Recessao' then 'Muito Negativo - Ouro e defensivas'
   else 'Neutro' end as impacto_bolsa, '{ASOF}' as data_processamento from (
select *, case when pib_variacao_pct>2 then 'Crescimento Alto' when pib_variacao_pct>0 then 'Crescimento Moderado'
   when pib_variacao_pct>-2 then 'Queda Moderada' else 'Queda Severa' end as tendencia_pib,
  case when desemprego_variacao_pct<-1 then 'Melhorando (Rápido)' when desemprego_variacao_pct<0 then 'Melhorando'
   when desemprego_variacao_pct<1 then 'Piorando' else 'Piorando (Rápido)' end as tendencia_desemprego,
  case when pib_variacao_pct>2 and desemprego_variacao_pct<0 then 'Expansao Economica'
   when pib_variacao_pct>0 and desemprego_variacao_pct>0 then 'Desaceleracao'
   when pib_variacao_pct<0 and desemprego_variacao_pct>1 then 'Recessao' else 'Transicao' end as cenario_macro,
  case when pib_variacao_pct<-2 or desemprego>15 then 'Alto' when pib_variacao_pct<0 or desemprego>10 then 'Moderado' else 'Baixo' end as alerta_risco
from (select ano, pib_anual, desemprego, {r('(pib_anual-lag(pib_anual) over w)/nullif(lag(pib_anual) over w,0)*100', 2)} as pib_variacao_pct,
   {r('desemprego-lag(desemprego) over w', 2)} as desemprego_variacao_pct
  from (select ano, max(case when indicador='pib_anual' then valor end) as pib_anual,
    max(case when indicador='desemprego' then valor end) as desemprego from v_yearly group by ano) p window w as (order by ano)) a) b""",
)
def gold_macro_context(spark, sf):
    return gold.macro_context(v.yearly(spark, sf), ASOF)


@query(
    "gold_fx_correlation",
    f"""
select date, ticker, preco_medio, variacao_media_pct, cambio, cambio_variacao_pct, correlacao_cambio,
  case when correlacao_cambio>0.5 then 'Alta Positiva (Exportadora)' when correlacao_cambio>0.2 then 'Moderada Positiva'
   when correlacao_cambio<-0.5 then 'Alta Negativa (Importadora)' when correlacao_cambio<-0.2 then 'Moderada Negativa' else 'Baixa Correlacao' end as sensibilidade_cambio,
  case when abs(variacao_media_pct)>5 and abs(cambio_variacao_pct)<1 then 'Sim - Acao se desacoplou do cambio' else 'Nao' end as alerta_desacoplamento,
  case when correlacao_cambio>0.3 and cambio_variacao_pct>2 then 'Comprar - Exportadora com cambio em alta'
   when correlacao_cambio<-0.3 and cambio_variacao_pct>2 then 'Vender - Importadora com cambio em alta' else 'Neutro' end as recomendacao,
  ano, mes, '{ASOF}' as data_processamento
from (select *, {r('covar_pop(x,y) over w/nullif(stddev_pop(x) over w*stddev_pop(y) over w,0)', 4)} as correlacao_cambio from (
 select *, case when cambio_variacao_pct is not null then variacao_media_pct end as x,
   case when variacao_media_pct is not null then cambio_variacao_pct end as y from (
 select *, {r('(cambio-lag(cambio) over (partition by ticker order by date))/nullif(lag(cambio) over (partition by ticker order by date),0)*100', 4)} as cambio_variacao_pct
 from (select date, ticker, {r(davg('close'), 2)} as preco_medio, {r(davg('variacao_diaria_pct'), 4)} as variacao_media_pct,
    min(ano) as ano, min(mes) as mes from v_bars group by date, ticker) d
 join (select data, valor as cambio from v_series where indicador='cambio_usd_brl') f on d.date=f.data) a) b
 window w as (partition by ticker order by date range between interval 90 days preceding and current row)) c""",
)
def gold_fx_correlation(spark, sf):
    fx = v.series(spark, sf).where(F.col("indicador") == "cambio_usd_brl")
    return gold.fx_correlation(
        v.bars(spark, sf), fx.select(F.col("data").alias("date"), F.col("valor").alias("cambio")), ASOF
    )


@query("gold_positions", "select * from v_pos")
def gold_positions(spark, sf):
    return v.positions(spark, sf)


@query("gold_risk_score", "select * from v_score")
def gold_risk_score(spark, sf):
    return v.scores(spark, sf)


@query("gold_fraud_orders", "select * from v_fraud")
def gold_fraud_orders(spark, sf):
    return v.fraud(spark, sf)


STREAM_FRAUD = f"""
select *, case when total_alertas>=3 then 'Critico' when total_alertas=2 then 'Alto' when total_alertas=1 then 'Medio' else 'Normal' end as score_fraude,
  total_alertas>=2 as requer_revisao, '{ASOF}' as data_processamento from (
 select *, cast(alerta_volume_suspeito as int)+cast(alerta_preco_atipico as int)+cast(alerta_valor_elevado as int)+cast(alerta_desvio_historico as int) as total_alertas from (
 select t.id_transacao, t.timestamp, t.ticker, t.tipo, t.preco, t.quantidade, t.valor_total, b.preco_medio, b.volatilidade,
  t.quantidade>9000 as alerta_volume_suspeito, t.preco>90 or t.preco<12 as alerta_preco_atipico, t.valor_total>500000 as alerta_valor_elevado,
  coalesce(abs(t.preco-b.preco_medio)>b.preco_medio*b.volatilidade/100*2,false) as alerta_desvio_historico
 from v_trades t left join v_bench b on t.ticker=b.ticker) x) y"""


@query("gold_fraud_stream", STREAM_FRAUD)
def gold_fraud_stream(spark, sf):
    out = gold.fraud_trades(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


HOURLY = f"""select ticker, hora, {r(davg('preco'), 2)} as preco_medio_hora, {dsum('valor_total')} as valor_total_hora,
  cast(sum(quantidade) as bigint) as volume_hora, count(*) as total_transacoes_hora from v_trades group by ticker, hora"""

INTRADAY = f"""
select *, coalesce(abs(zscore_intraday)>2,false) as anomalia,
  case when zscore_intraday>2 then 'Alta Anormal' when zscore_intraday<-2 then 'Queda Anormal' else 'Normal' end as tipo_anomalia,
  '{ASOF}' as data_processamento from (
 select *, {r('(preco_medio_hora-preco_medio)/case when desvio_historico_rs=0 then 1 else desvio_historico_rs end', 4)} as zscore_intraday from (
 select h.*, b.preco_medio, b.volatilidade, {r('b.preco_medio*b.volatilidade/100', 4)} as desvio_historico_rs
 from ({HOURLY}) h left join v_bench b on h.ticker=b.ticker) a) c"""


@query("gold_intraday_anomalies", INTRADAY)
def gold_intraday_anomalies(spark, sf):
    return gold.intraday_anomalies(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF)


VOLUME = f"""
select *, case when pct_volume_diario>30 then 'Critico' when pct_volume_diario>15 then 'Alto' else 'Normal' end as alerta_volume_intraday,
  case when volume_compras>volume_vendas then 'Compra' when volume_compras<volume_vendas then 'Venda' else 'Neutro' end as pressao_compradora,
  '{ASOF}' as data_processamento from (
 select h.*, b.volume_medio, {r('cast(volume_hora as double)/case when b.volume_medio=0 then 1 else b.volume_medio end*100', 2)} as pct_volume_diario
 from (select ticker, hora, count(*) as total_transacoes, cast(sum(quantidade) as bigint) as volume_hora, {dsum('valor_total')} as valor_total_hora,
   {r(davg('preco'), 2)} as preco_medio_hora, cast(sum(case when tipo='compra' then quantidade else 0 end) as bigint) as volume_compras,
   cast(sum(case when tipo='venda' then quantidade else 0 end) as bigint) as volume_vendas from v_trades group by ticker, hora) h
 left join v_bench b on h.ticker=b.ticker) a"""


@query("gold_intraday_volume", VOLUME)
def gold_intraday_volume(spark, sf):
    return gold.intraday_volume(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF)


RANKING = f"""
select *, case when variacao_vs_historico_pct>1 then 'Alta' when variacao_vs_historico_pct<-1 then 'Queda' else 'Estavel' end as tendencia,
  '{ASOF}' as data_processamento, cast(row_number() over (order by valor_total desc, ticker) as int) as rank_volume from (
 select t.*, b.empresa, b.setor, b.preco_medio as preco_medio_historico,
  {r('(preco_medio_atual-b.preco_medio)/case when b.preco_medio=0 then 1 else b.preco_medio end*100', 2)} as variacao_vs_historico_pct
 from (select ticker, count(*) as total_transacoes, cast(sum(quantidade) as bigint) as volume_total, {dsum('valor_total')} as valor_total,
   {r(davg('preco'), 2)} as preco_medio_atual, count(*) filter (tipo='compra') as total_compras, count(*) filter (tipo='venda') as total_vendas,
   {r('min(preco)', 2)} as preco_minimo, {r('max(preco)', 2)} as preco_maximo from v_trades group by ticker) t
 left join v_bench b on t.ticker=b.ticker) a"""


@query("gold_ranking", RANKING)
def gold_ranking(spark, sf):
    return gold.ranking(v.trades(spark, sf), v.trade_benchmark(spark, sf), ASOF)


SEGMENTS = f"""
select perfil_risco, faixa_etaria, score_categoria, pais, count(*) as total_clientes, {r(davg('saldo'), 2)} as saldo_medio,
  {r(davg('score_credito'), 0)} as score_medio, {r(davg('salario_estimado'), 2)} as salario_medio,
  count(*) filter (churn) as total_churn, {r('cast(count(*) filter (churn) as double)/count(*)*100', 2)} as taxa_churn_pct
from v_clients group by 1,2,3,4"""
CONSOLIDATED = f"""
select ticker, perfil_risco, faixa_saldo, tipo, status, ano, count(*) as total_ordens, {dsum('valor_total')} as volume_total,
  {r(davg('preco'), 2)} as preco_medio, {r(davg('quantidade'), 0)} as qtd_media from v_orders group by 1,2,3,4,5,6"""
BY_PROFILE = f"""
select ticker, perfil_risco, count(*) as total_ordens, {dsum('valor_total')} as volume_total, {r(davg('preco'), 2)} as preco_medio
from v_orders where status='executada' group by 1,2"""


@query("gold_segment_profile", SEGMENTS)
def gold_segment_profile(spark, sf):
    return gold.segment_profile(v.clients(spark, sf))


@query("gold_orders_consolidated", CONSOLIDATED)
def gold_orders_consolidated(spark, sf):
    return gold.orders_consolidated(v.orders(spark, sf))


@query("gold_ranking_profile", BY_PROFILE)
def gold_ranking_profile(spark, sf):
    return gold.ranking_by_profile(v.orders(spark, sf))


@query(
    "rule_engine",
    """
select o_orderkey, caro, urgente, antigo, total_alertas,
  case when total_alertas>=3 then 'Critico' when total_alertas>=2 then 'Alto' when total_alertas>=1 then 'Medio' else 'Normal' end as score_fraude,
  total_alertas>=2 as requer_revisao
from (select *, caro::int+urgente::int+antigo::int as total_alertas from (
 select o_orderkey, coalesce(o_totalprice>250000,false) as caro, coalesce(o_orderpriority='1-URGENT',false) as urgente,
  coalesce(o_orderdate<timestamp '1997-01-01',false) as antigo from orders) a) b""",
)
def rule_engine(spark, sf):
    rules = [
        Rule("caro", "o_totalprice > 250000"),
        Rule("urgente", "o_orderpriority = '1-URGENT'"),
        Rule("antigo", "o_orderdate < date'1997-01-01'"),
    ]
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return apply_rules(orders, rules).drop("o_totalprice", "o_orderpriority", "o_orderdate")
