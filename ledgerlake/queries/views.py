"""Brokerage-shaped inputs derived from the given tables, for Spark and as oracle SQL.

Each view exists twice: a DataFrame function and a SQL text written independently of it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..functions import band, dec_round, exact_avg
from ..plans import gold, silver

ASOF = "2026-01-01"
STAMP = "2026-01-01T00:00:00"
SALT = "salt-de-teste"
FAR = "9999-12-31"

COMPANIES = {"ECONOMY": "Economia SA", "PROMO": "Promo SA", "LARGE": "Grande SA", "SMALL": "Pequena SA"}
SECTORS = {"ECONOMY": "Varejo", "PROMO": "Varejo", "LARGE": "Industria", "MEDIUM": "Industria"}
EVENT_COMPANIES = {"view": "Vista SA", "click": "Clique SA", "purchase": "Compra SA"}
EVENT_SECTORS = {"view": "Midia", "click": "Midia", "purchase": "Varejo"}

# --- Spark ----------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_customers(spark, sf) -> DataFrame:
    """Customer rows under the CSV's header names."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    key = F.col("c_custkey")
    balance = F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal") * 20)
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("CustomerId"),
        F.col("c_name").alias("Surname"),
        (300 + (key * 37) % 551).cast("int").alias("CreditScore"),
        F.col("n_name").alias("Geography"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("Gender"),
        (18 + (key * 13) % 60).cast("int").alias("Age"),
        (key % 11).cast("int").alias("Tenure"),
        balance.alias("Balance"),
        (key % 4 + 1).cast("int").alias("NumOfProducts"),
        (F.abs(F.col("c_acctbal")) * 10).alias("EstimatedSalary"),
        F.when(key % 2 == 0, 1).otherwise(0).alias("IsActiveMember"),
        F.when(key % 5 == 0, 1).otherwise(0).alias("Exited"),
    )


def clients(spark, sf) -> DataFrame:
    raw = raw_customers(spark, sf).withColumnsRenamed(presets.CUSTOMER_CSV)
    shaped = raw.select(
        F.col("CustomerId").alias("cli"),
        "pais", "score_credito", "idade", "saldo", "salario_estimado",
        (F.col("Exited") == 1).alias("churn"),
        (F.col("IsActiveMember") == 1).alias("ativo"),
        band("score_credito", presets.RISK_PROFILE, presets.RISK_PROFILE_DEFAULT).alias("perfil_risco"),
        band("saldo", presets.BALANCE_BAND, presets.BALANCE_BAND_DEFAULT).alias("faixa_saldo"),
    )
    return silver.silver_customers(shaped, ASOF).drop("data_processamento")


def plain_orders(spark, sf) -> DataFrame:
    li, o, p = (table(spark, sf, t) for t in ("lineitem", "orders", "part"))
    value = F.col("l_extendedprice") * F.col("l_quantity") / 5
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            F.col("o_custkey").alias("cli"),
            F.col("p_type").alias("ticker"),
            (F.col("l_extendedprice") / 1000).alias("preco"),
            (F.col("l_quantity") * 200).cast("long").alias("quantidade"),
            value.alias("valor_total"),
            F.when(F.col("l_returnflag") == "R", "venda").otherwise("compra").alias("tipo"),
            F.when(F.col("o_orderstatus") == "F", "executada")
            .when(F.col("o_orderstatus") == "P", "cancelada")
            .otherwise("pendente")
            .alias("status"),
            F.col("o_orderdate").cast("date").alias("data_ordem"),
        )
    )


def orders(spark, sf) -> DataFrame:
    """Silver orders: plain orders with the client's profile and date parts."""
    profile = clients(spark, sf).select("cli", "perfil_risco", "faixa_saldo")
    joined = plain_orders(spark, sf).join(profile, "cli")
    return silver.silver_orders(joined, ASOF).drop("data_processamento")


def raw_bars(spark, sf) -> DataFrame:
    """Daily OHLCV per part type; first and last trade of a day by line order."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_type").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") / 1000).alias("p"),
        (F.col("l_quantity") * 200).cast("long").alias("q"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("at"),
    )
    return rows.groupBy("ticker", "date").agg(
        F.min_by("p", "at").alias("open"),
        F.max("p").alias("high"),
        F.min("p").alias("low"),
        F.max_by("p", "at").alias("close"),
        F.sum("q").alias("volume"),
    )


def bars(spark, sf) -> DataFrame:
    """Silver bars. The grouping above already gives one row per (ticker, date)."""
    return silver.silver_bars(raw_bars(spark, sf), ASOF, COMPANIES, SECTORS, dedup=False)


def performance(spark, sf) -> DataFrame:
    return gold.performance(bars(spark, sf), ASOF)


def anomalies(spark, sf) -> DataFrame:
    return gold.anomalies(bars(spark, sf), ASOF)


def series(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "selic")
        .when(F.col("o_orderpriority") == "2-HIGH", "cambio_usd_brl")
        .otherwise("ipca")
    )
    return (
        o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
        .groupBy(F.col("o_orderdate").cast("date").alias("data"), name.alias("indicador"))
        .agg(dec_round(exact_avg("o_totalprice") / 1000, 4).alias("valor"))
    )


def yearly(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    name = F.when(F.col("o_orderstatus") == "F", "pib_anual").otherwise("desemprego")
    return (
        o.where(F.col("o_orderstatus").isin("F", "O"))
        .groupBy(F.year("o_orderdate").alias("ano"), name.alias("indicador"))
        .agg(dec_round(exact_avg("o_totalprice") / 20000, 4).alias("valor"))
    )


def decoded_trades(events: DataFrame) -> DataFrame:
    """Events under the trade payload's names; works on a batch or a stream of events."""
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("ticker"),
        (F.col("value") / 3.5).alias("preco"),
        ((F.col("event_id") % 100 + 1) * 100).alias("quantidade"),
        F.when(F.col("event_id") % 2 == 0, "compra").otherwise("venda").alias("tipo"),
        F.col("event_id").alias("id_transacao"),
    )


def trades(spark, sf) -> DataFrame:
    return silver.enrich_trades(decoded_trades(table(spark, sf, "events")), STAMP)


def trade_bars(spark, sf) -> DataFrame:
    """Daily bars of the traded symbols, the history the stream analyses compare with."""
    rows = trades(spark, sf).select(
        "ticker", F.to_date("timestamp").alias("date"), "preco", "quantidade",
        F.struct("timestamp", "id_transacao").alias("at"),
    )
    daily = rows.groupBy("ticker", "date").agg(
        F.min_by("preco", "at").alias("open"),
        F.max("preco").alias("high"),
        F.min("preco").alias("low"),
        F.max_by("preco", "at").alias("close"),
        F.sum("quantidade").alias("volume"),
    )
    return silver.silver_bars(daily, ASOF, EVENT_COMPANIES, EVENT_SECTORS, dedup=False)


def trade_benchmark(spark, sf) -> DataFrame:
    return gold.benchmark(gold.performance(trade_bars(spark, sf), ASOF))


def positions(spark, sf) -> DataFrame:
    return gold.positions(orders(spark, sf), clients(spark, sf), ASOF, client="cli")


def scores(spark, sf) -> DataFrame:
    return gold.risk_score(positions(spark, sf), ASOF, client="cli")


def fraud(spark, sf) -> DataFrame:
    """Fraud flags per order; the score table is a stored gold table, so it is staged first."""
    from ..sources.scratch import stage

    silver_orders = stage(orders(spark, sf), "orders")
    pos = gold.positions(silver_orders, clients(spark, sf), ASOF, client="cli")
    score = stage(gold.risk_score(pos, ASOF, client="cli"), "scores")
    return gold.fraud_orders(silver_orders, score, ASOF, client="cli")


def yearly_snapshots(spark, sf) -> DataFrame:
    """One snapshot of the active clients per order year: ver, cli, ordens, perfil_risco."""
    o = table(spark, sf, "orders")
    return (
        o.groupBy(F.year("o_orderdate").alias("ver"), F.col("o_custkey").alias("cli"))
        .agg(F.count("*").alias("ordens"))
        .withColumn("perfil_risco", band("ordens", [(">=", 3, "Arrojado"), (">=", 2, "Moderado")], "Conservador"))
    )


def history(spark, sf) -> DataFrame:
    """Validity history of the yearly profile."""
    from ..operators.history import scd2_from_snapshots

    dated = yearly_snapshots(spark, sf).withColumn("dia", F.make_date("ver", F.lit(1), F.lit(1)))
    return scd2_from_snapshots(dated, "cli", ["perfil_risco"], "dia")


def run_log(spark, sf) -> DataFrame:
    """Events read as a run log: an error is a failed run, ``value`` its length in seconds."""
    e = table(spark, sf, "events")
    start = F.col("ts")
    prefix = (
        F.when(F.col("event_type") == "view", "t1_extracao_")
        .when(F.col("event_type") == "click", "t2_silver_")
        .when(F.col("event_type") == "purchase", "t3_gold_")
        .when(F.col("event_type") == "signup", "t_sql_")
        .otherwise("x_")
    )
    length = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
    return e.select(
        F.concat(prefix, F.col("user_id").cast("string")).alias("task_id"),
        F.concat(F.lit("dag_"), F.col("event_type")).alias("dag_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("state"),
        F.date_trunc("day", start).cast("timestamp_ntz").alias("execution_date"),
        start.alias("start_date"),
        (start + length).alias("end_date"),
    )


# --- SQL ------------------------------------------------------------------------------------


def r(x: str, n: int) -> str:
    """Half-up rounding of a double by its shortest decimal text, as Spark rounds."""
    return f"cast(round(cast(cast(cast({x} as double) as varchar) as decimal(38,15)),{n}) as double)"


def _sum(x: str, over: str = "") -> str:
    return f"sum(cast(cast({x} as varchar) as decimal(28,10))) {over}"


def _dbl(x: str) -> str:
    """Nearest double of a decimal, by way of its text."""
    return f"cast(cast({x} as varchar) as double)"


def dsum(x: str, n: int = 2) -> str:
    return _dbl(f"round({_sum(x)},{n})")


def davg(x: str, over: str = "") -> str:
    return f"({_dbl(_sum(x, over))}/nullif(count({x}) {over},0))"


def dtotal(x: str, over: str = "") -> str:
    return _dbl(_sum(x, over))


def case(col: str, cuts, default: str) -> str:
    whens = " ".join(f"when {col} {op.replace('==', '=')} {lim} then '{lab}'" for op, lim, lab in cuts)
    return f"case {whens} else '{default}' end"


def lookup(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"when {col}='{k}' then '{v}'" for k, v in mapping.items())
    return f"case {whens} else '{default}' end"


def _bars_sql(source: str, companies: dict, sectors: dict) -> str:
    return f"""
select ticker, date, {r('open', 2)} as open, {r('high', 2)} as high, {r('low', 2)} as low, {r('close', 2)} as close,
  volume, cast(year(date) as int) as ano, cast(month(date) as int) as mes, cast(quarter(date) as int) as trimestre,
  {r(f"({r('close', 2)}-{r('open', 2)})/nullif({r('open', 2)},0)*100", 4)} as variacao_diaria_pct,
  {r(f"{r('high', 2)}-{r('low', 2)}", 2)} as amplitude_diaria,
  {lookup('ticker', companies, 'Desconhecido')} as empresa, {lookup('ticker', sectors, 'Outros')} as setor,
  '{ASOF}' as data_processamento
from {source} where close is not null and volume > 0"""


def _perf_sql(source: str) -> str:
    return f"""
select ticker, empresa, setor, ano, {r(davg('close'), 2)} as preco_medio, {r('min(close)', 2)} as preco_minimo,
  {r('max(close)', 2)} as preco_maximo, {r(davg('variacao_diaria_pct'), 4)} as variacao_media_pct,
  {r('stddev_samp(variacao_diaria_pct)', 4)} as volatilidade,
  {r('cast(sum(volume) as double)/count(volume)', 0)} as volume_medio, cast(sum(volume) as bigint) as volume_total,
  count(*) as dias_negociados, '{ASOF}' as data_processamento
from {source} group by ticker, empresa, setor, ano"""


VIEWS = {
    "v_raw": """
select c_custkey as CustomerId, c_name as Surname, cast(300+(c_custkey*37)%551 as int) as CreditScore,
  n_name as Geography, case when c_custkey%2=0 then 'Female' else 'Male' end as Gender,
  cast(18+(c_custkey*13)%60 as int) as Age, cast(c_custkey%11 as int) as Tenure,
  case when c_acctbal<0 then 0 else c_acctbal*20 end as Balance, cast(c_custkey%4+1 as int) as NumOfProducts,
  abs(c_acctbal)*10 as EstimatedSalary, (c_custkey%2=0) as active, (c_custkey%5=0) as churn
from customer join nation on c_nationkey=n_nationkey""",
    "v_clients": f"""
select CustomerId as cli, Geography as pais, CreditScore as score_credito, Age as idade, Balance as saldo,
  EstimatedSalary as salario_estimado, churn, active as ativo,
  case when CreditScore>=750 then 'Arrojado' when CreditScore>=600 then 'Moderado' else 'Conservador' end as perfil_risco,
  case when Balance=0 then 'Sem saldo' when Balance<50000 then 'Baixo' when Balance<150000 then 'Medio' else 'Alto' end as faixa_saldo,
  case when Age<30 then 'Jovem' when Age<50 then 'Adulto' else 'Senior' end as faixa_etaria,
  case when CreditScore>=750 then 'Excelente' when CreditScore>=650 then 'Bom' when CreditScore>=550 then 'Regular' else 'Ruim' end as score_categoria
from v_raw""",
    "v_plain": """
select o_custkey as cli, p_type as ticker, l_extendedprice/1000 as preco, cast(l_quantity*200 as bigint) as quantidade,
  l_extendedprice*l_quantity/5 as valor_total, case when l_returnflag='R' then 'venda' else 'compra' end as tipo,
  case o_orderstatus when 'F' then 'executada' when 'P' then 'cancelada' else 'pendente' end as status,
  cast(o_orderdate as date) as data_ordem
from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey""",
    "v_orders": """
select p.*, c.perfil_risco, c.faixa_saldo, cast(year(data_ordem) as int) as ano, cast(month(data_ordem) as int) as mes
from v_plain p join v_clients c on p.cli=c.cli""",
    "v_bars0": """
select ticker, date, max(case when ra=1 then p end) as open, max(p) as high, min(p) as low,
  max(case when rd=1 then p end) as close, cast(sum(q) as bigint) as volume
from (select p_type as ticker, cast(l_shipdate as date) as date, l_extendedprice/1000 as p, cast(l_quantity*200 as bigint) as q,
  row_number() over (partition by p_type,cast(l_shipdate as date) order by l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice) as ra,
  row_number() over (partition by p_type,cast(l_shipdate as date) order by l_orderkey desc,l_linenumber desc,l_partkey desc,l_suppkey desc,l_extendedprice desc) as rd
  from lineitem join part on l_partkey=p_partkey) z group by ticker, date""",
    "v_bars": _bars_sql("v_bars0", COMPANIES, SECTORS),
    "v_perf": _perf_sql("v_bars"),
    "v_anom": f"""
select date, ticker, empresa, setor, open, close, volume, variacao_diaria_pct, zscore,
  coalesce(abs(zscore)>2, false) as anomalia,
  case when zscore>2 then 'Alta Anormal' when zscore<-2 then 'Queda Anormal' else 'Normal' end as tipo_anomalia,
  '{ASOF}' as data_processamento
from (select *, {r('(variacao_diaria_pct-avg(variacao_diaria_pct) over w)/nullif(stddev_samp(variacao_diaria_pct) over w,0)', 4)} as zscore
  from v_bars window w as (partition by ticker)) t""",
    "v_series": f"""
select cast(o_orderdate as date) as data,
  case o_orderpriority when '1-URGENT' then 'selic' when '2-HIGH' then 'cambio_usd_brl' else 'ipca' end as indicador,
  {r(davg('o_totalprice')+'/1000', 4)} as valor
from orders where o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM') group by 1,2""",
    "v_wide": """
select data, max(case when indicador='selic' then valor end) as selic,
  max(case when indicador='cambio_usd_brl' then valor end) as cambio_usd_brl,
  max(case when indicador='ipca' then valor end) as ipca from v_series group by data""",
    "v_yearly": f"""
select cast(year(o_orderdate) as int) as ano, case o_orderstatus when 'F' then 'pib_anual' else 'desemprego' end as indicador,
  {r(davg('o_totalprice')+'/20000', 4)} as valor from orders where o_orderstatus in ('F','O') group by 1,2""",
    "v_trades": f"""
select ts as timestamp, event_type as ticker, value/3.5 as preco, (event_id%100+1)*100 as quantidade,
  case when event_id%2=0 then 'compra' else 'venda' end as tipo, event_id as id_transacao,
  cast(hour(ts) as int) as hora, cast(minute(ts) as int) as minuto,
  {r('value/3.5*((event_id%100+1)*100)', 2)} as valor_total from events""",
    "v_tbars0": """
select ticker, cast(timestamp as date) as date, arg_min(preco, (timestamp, id_transacao)) as open, max(preco) as high,
  min(preco) as low, arg_max(preco, (timestamp, id_transacao)) as close, cast(sum(quantidade) as bigint) as volume
from v_trades group by 1,2""",
    "v_tbars": _bars_sql("v_tbars0", EVENT_COMPANIES, EVENT_SECTORS),
    "v_tperf": _perf_sql("v_tbars"),
    "v_bench": "select * from v_tperf where ano=(select max(ano) from v_tperf)",
    "v_pos": f"""
select a.*, '{ASOF}' as data_processamento, c.perfil_risco, c.faixa_saldo, c.score_credito from (
 select cli, ticker, cast(sum(case when tipo='compra' then quantidade else -quantidade end) as bigint) as quantidade_liquida,
  {dsum("case when tipo='compra' then valor_total else 0 end")} as total_comprado,
  {dsum("case when tipo='venda' then valor_total else 0 end")} as total_vendido,
  count(*) as total_ordens, count(*) filter (status='executada') as ordens_executadas,
  count(*) filter (status='cancelada') as ordens_canceladas,
  {dsum("case when tipo='compra' then valor_total when tipo='venda' then -valor_total else 0 end")} as valor_investido,
  {dsum("case when tipo='venda' then valor_total when tipo='compra' then -valor_total else 0 end")} as resultado_estimado,
  case when sum(case when tipo='compra' then quantidade else -quantidade end)>0 then 'Comprado'
    when sum(case when tipo='compra' then quantidade else -quantidade end)<0 then 'Vendido a Descoberto' else 'Zerado' end as situacao
 from v_orders group by cli, ticker) a left join v_clients c on a.cli=c.cli""",
    "v_score": f"""
select *, case categoria_risco when 'Baixo Risco' then 500000 when 'Risco Moderado' then 200000 when 'Risco Alto' then 50000 else 10000 end as limite_operacional,
  '{ASOF}' as data_processamento from (
 select *, case when score_risco>=70 then 'Baixo Risco' when score_risco>=50 then 'Risco Moderado' when score_risco>=30 then 'Risco Alto' else 'Risco Critico' end as categoria_risco from (
 select *, {r('score_credito_norm*0.4::double + score_perfil*0.2::double + score_saldo*0.2::double + score_comportamento*0.2::double', 2)} as score_risco from (
 select *, case when taxa_cancelamento_pct<20 then 100 when taxa_cancelamento_pct<50 then 60 else 20 end as score_comportamento from (
 select cli, perfil_risco, faixa_saldo, score_credito, count(ticker) as num_ativos, cast(sum(total_ordens) as bigint) as total_ordens,
  cast(sum(ordens_canceladas) as bigint) as total_canceladas, {dsum('valor_investido')} as valor_total_investido,
  count(*) filter (situacao='Vendido a Descoberto') as posicoes_descoberto, {r(davg('resultado_estimado'), 2)} as resultado_medio,
  {r('cast(sum(ordens_canceladas) as double)/sum(total_ordens)*100', 2)} as taxa_cancelamento_pct,
  {r('score_credito/850::double*100', 2)} as score_credito_norm,
  case perfil_risco when 'Arrojado' then 100 when 'Moderado' then 60 else 30 end as score_perfil,
  case faixa_saldo when 'Alto' then 100 when 'Medio' then 60 when 'Baixo' then 30 else 10 end as score_saldo
 from v_pos group by cli, perfil_risco, faixa_saldo, score_credito) a) b) c) d""",
    "v_fraud": f"""
select *, coalesce(case when total_alertas>=3 then 'Critico' when total_alertas=2 then 'Alto' when total_alertas=1 then 'Medio' else 'Normal' end) as score_fraude,
  total_alertas>=2 as requer_revisao, '{ASOF}' as data_processamento from (
 select *, cast(alerta_valor_alto as int)+cast(alerta_volume_suspeito as int)+cast(alerta_preco_atipico as int)+cast(alerta_perfil_incompativel as int) as total_alertas from (
 select o.*, s.score_risco, s.categoria_risco, s.limite_operacional,
  coalesce(valor_total>limite_operacional,false) as alerta_valor_alto, quantidade>9000 as alerta_volume_suspeito,
  preco>90 or preco<12 as alerta_preco_atipico, o.perfil_risco='Conservador' and valor_total>200000 as alerta_perfil_incompativel
 from v_orders o left join v_score s on o.cli=s.cli) a) b""",
    "v_snap": """
select *, case when ordens>=3 then 'Arrojado' when ordens>=2 then 'Moderado' else 'Conservador' end as perfil_risco from (
 select cast(year(o_orderdate) as int) as ver, o_custkey as cli, count(*) as ordens from orders group by 1,2) a""",
    "v_hist": f"""
select cli, perfil_risco, make_date(ver,1,1) as data_inicio,
  coalesce(make_date(cast(lead(ver) over w as int),1,1), date '{FAR}') as data_fim, lead(ver) over w is null as atual
from (select cli, ver, perfil_risco, lag(perfil_risco) over (partition by cli order by ver) as antes from v_snap) t
where antes is null or antes<>perfil_risco window w as (partition by cli order by ver)""",
    "v_runs": """
select concat(case event_type when 'view' then 't1_extracao_' when 'click' then 't2_silver_' when 'purchase' then 't3_gold_'
   when 'signup' then 't_sql_' else 'x_' end, user_id) as task_id, concat('dag_',event_type) as dag_id,
  case when event_type='error' then 'failed' else 'success' end as state, date_trunc('day',ts)::timestamp as execution_date,
  ts as start_date, value as secs from events""",
}


def with_views(sql: str) -> str:
    """Put the ``v_`` views a statement names (and those they name) in front of it as CTEs."""
    ctes: dict[str, str] = {}

    def require(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name not in ctes:
                require(VIEWS[name])
                ctes[name] = VIEWS[name].strip()

    require(sql)
    if not ctes:
        return sql.strip()
    return "with " + ",\n".join(f"{n} as ({b})" for n, b in ctes.items()) + "\n" + sql.strip()
