"""Aggregations A1-A19, sorting O1-O4, unions and set differences U1-U4."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions import count_where, dec_round, dec_sum, exact_avg, signed_sum, sum_where
from ..operators import aggregates, sets
from ..operators.joins import having_count
from ..plans import gold
from . import views as v
from .golds import BY_PROFILE, CONSOLIDATED, HOURLY, SEGMENTS
from .registry import query
from .views import davg, dsum, r


@query("performance_summary", "select * exclude (data_processamento) from v_perf")
def performance_summary(spark, sf):
    return v.performance(spark, sf).drop("data_processamento")


@query(
    "conditional_sums",
    f"""select ticker, {dsum("case when tipo='compra' then valor_total else 0 end")} as comprado,
  {dsum("case when tipo='venda' then valor_total else 0 end")} as vendido,
  cast(sum(case when tipo='compra' then quantidade else -quantidade end) as bigint) as liquida,
  count(*) filter (status='cancelada') as canceladas from v_plain group by ticker""",
)
def conditional_sums(spark, sf):
    buy = F.col("tipo") == "compra"
    return v.plain_orders(spark, sf).groupBy("ticker").agg(
        dec_round(sum_where(buy, "valor_total"), 2).alias("comprado"),
        dec_round(sum_where(F.col("tipo") == "venda", "valor_total"), 2).alias("vendido"),
        signed_sum(buy, "quantidade").alias("liquida"),
        count_where(F.col("status") == "cancelada").alias("canceladas"),
    )


@query("client_positions", "select cli, ticker, quantidade_liquida, valor_investido, situacao, perfil_risco from v_pos")
def client_positions(spark, sf):
    return v.positions(spark, sf).select(
        "cli", "ticker", "quantidade_liquida", "valor_investido", "situacao", "perfil_risco"
    )


@query("hourly_bars", HOURLY)
def hourly_bars(spark, sf):
    return gold.hourly_bars(v.trades(spark, sf))


@query(
    "daily_bars",
    f"""select date, ticker, {r(davg('close'), 2)} as preco_medio, {r(davg('variacao_diaria_pct'), 4)} as variacao_media_pct,
  cast(sum(volume) as bigint) as volume_dia, min(ano) as ano, min(mes) as mes from v_bars group by 1,2""",
)
def daily_bars(spark, sf):
    return gold.daily_bars(v.bars(spark, sf))


@query("pivot_series", "select * from v_wide")
def pivot_series(spark, sf):
    return aggregates.pivot_series(v.series(spark, sf), "data", presets.DAILY_SERIES)


@query("segment_profile", SEGMENTS)
def segment_profile(spark, sf):
    return gold.segment_profile(v.clients(spark, sf))


@query("orders_consolidated", CONSOLIDATED)
def orders_consolidated(spark, sf):
    return gold.orders_consolidated(v.orders(spark, sf)).orderBy(F.desc("volume_total"))


@query("ranking_by_profile", BY_PROFILE)
def ranking_by_profile(spark, sf):
    return gold.ranking_by_profile(v.orders(spark, sf)).orderBy(F.desc("volume_total"))


@query(
    "agg_count_distinct",
    "select ticker, count(distinct cli) as clientes, count(*) as ordens, max(quantidade) as maior from v_plain group by ticker",
)
def agg_count_distinct(spark, sf):
    return v.plain_orders(spark, sf).groupBy("ticker").agg(
        F.count_distinct("cli").alias("clientes"), F.count("*").alias("ordens"), F.max("quantidade").alias("maior")
    )


@query(
    "agg_cond_distinct",
    f"""select count(distinct case when versoes>1 then cli end) as clientes_mudaram, count(distinct cli) as total_clientes,
  {r('count(distinct case when versoes>1 then cli end)*100::double/count(distinct cli)', 2)} as pct_com_mudanca
from (select cli, count(*) as versoes from v_hist group by cli) t""",
)
def agg_cond_distinct(spark, sf):
    return aggregates.changed_share(v.history(spark, sf), "cli")


@query("agg_having", "select o_custkey, count(*) as n from orders group by 1 having count(*)>10")
def agg_having(spark, sf):
    return having_count(v.table(spark, sf, "orders"), ["o_custkey"], F.col("n") > 10)


@query(
    "agg_share_of_total",
    f"""select status, count(*) as ordens, {r('count(*)*100::double/sum(count(*)) over ()', 2)} as pct, {r(davg('preco'), 2)} as preco_medio
from v_plain group by status""",
)
def agg_share_of_total(spark, sf):
    return aggregates.share_of_total(
        v.plain_orders(spark, sf), ["status"], "ordens", "pct", 2, exact_avg("preco", 2).alias("preco_medio")
    )


@query(
    "agg_flag_rate",
    f"""select ticker, count(*) as total, count(*) filter (anomalia) as marcados, {r('count(*) filter (anomalia)*100::double/count(*)', 2)} as pct,
  {r(davg('case when anomalia then abs(zscore) end'), 4)} as media from v_anom group by ticker""",
)
def agg_flag_rate(spark, sf):
    return aggregates.flag_rate(
        v.anomalies(spark, sf), ["ticker"], "anomalia", F.abs("zscore"), ("total", "marcados", "pct", "media")
    )


RISK_RETURN = f"""
select ticker, empresa, setor, {r(davg('variacao_media_pct'), 4)} as retorno_medio, {r(davg('volatilidade'), 4)} as volatilidade_media,
  case when {davg('variacao_media_pct')}>0 and {davg('volatilidade')}<1.5 then 'Ideal (alto retorno, baixo risco)'
   when {davg('variacao_media_pct')}>0 and {davg('volatilidade')}>=1.5 then 'Retorno com risco'
   when {davg('variacao_media_pct')}<=0 then 'Risco sem retorno' end as perfil_ativo
from v_perf group by ticker, empresa, setor"""


@query("agg_case_on_agg", RISK_RETURN)
def agg_case_on_agg(spark, sf):
    from ..plans import reports

    return reports.risk_return(v.performance(spark, sf))


@query("agg_global_count", "select count(*) as total from lineitem")
def agg_global_count(spark, sf):
    return aggregates.row_count(v.table(spark, sf, "lineitem"))


@query(
    "null_profile",
    """select count(*) as total_registros, count(*) filter (selic is null) as selic, count(*) filter (cambio_usd_brl is null) as cambio_usd_brl,
  count(*) filter (ipca is null) as ipca,
  count(*) filter (selic is null)+count(*) filter (cambio_usd_brl is null)+count(*) filter (ipca is null) as total_nulos from v_wide""",
)
def null_profile(spark, sf):
    wide = aggregates.pivot_series(v.series(spark, sf), "data", presets.DAILY_SERIES)
    return aggregates.null_profile(wide.drop("data"))


@query(
    "agg_layer_counts",
    """select 'bronze' as camada, (select count(*) from orders)+(select count(*) from lineitem)+(select count(*) from events) as total_registros
union all select 'silver', (select count(*) from v_bars)+(select count(*) from v_series)
union all select 'gold', (select count(*) from v_perf)""",
)
def agg_layer_counts(spark, sf):
    t = lambda n: v.table(spark, sf, n)
    return aggregates.layer_counts({
        "bronze": {"orders": t("orders"), "lineitem": t("lineitem"), "events": t("events")},
        "silver": {"bars": v.bars(spark, sf), "series": v.series(spark, sf)},
        "gold": {"performance": v.performance(spark, sf)},
    })


# --- sorting --------------------------------------------------------------------------------


@query("sort_multi", f"select o_custkey, o_orderstatus, {dsum('o_totalprice')} as total from orders group by 1,2 order by 1, 3 desc")
def sort_multi(spark, sf):
    sums = v.table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(dec_sum("o_totalprice").alias("total"))
    return sums.orderBy("o_custkey", F.desc("total"))


@query(
    "topk_abs",
    "select date, ticker, zscore from v_anom where anomalia order by abs(zscore) desc, date, ticker limit 10",
)
def topk_abs(spark, sf):
    rows = v.anomalies(spark, sf).where("anomalia").select("date", "ticker", "zscore")
    return sets.top_k(rows, [F.desc(F.abs("zscore")), "date", "ticker"], 10)


@query(
    "sort_case_rank",
    "select score_fraude, count(*) as ordens from v_fraud group by 1 order by case score_fraude when 'Critico' then 1 when 'Alto' then 2 when 'Medio' then 3 else 4 end",
)
def sort_case_rank(spark, sf):
    counts = v.fraud(spark, sf).groupBy("score_fraude").agg(F.count("*").alias("ordens"))
    return sets.sort_by_rank(counts, "score_fraude", presets.SEVERITY_ORDER)


@query("limit_ordered", "select date, ticker, open, close from v_bars where ticker='PROMO' order by date desc limit 8")
def limit_ordered(spark, sf):
    rows = v.bars(spark, sf).where("ticker = 'PROMO'").select("date", "ticker", "open", "close")
    return sets.top_k(rows, [F.desc("date")], 8)


# --- unions ---------------------------------------------------------------------------------


@query(
    "union_counts",
    """select 'orders' as tabela, count(*) as registros from orders union all select 'customer', count(*) from customer
union all select 'events', count(*) from events""",
)
def union_counts(spark, sf):
    return aggregates.table_counts({n: v.table(spark, sf, n) for n in ("orders", "customer", "events")})


@query(
    "union_padded",
    f"""select 'BRONZE' as camada, ticker, date, {r('open', 2)} as open, {r('close', 2)} as close, volume,
  cast(null as double) as variacao_diaria_pct, cast(null as varchar) as empresa from v_bars0
union all select 'SILVER', ticker, date, open, close, volume, variacao_diaria_pct, empresa from v_bars""",
)
def union_padded(spark, sf):
    bronze = v.raw_bars(spark, sf).select(
        "ticker", "date", dec_round("open", 2).alias("open"), dec_round("close", 2).alias("close"), "volume"
    )
    shaped = v.bars(spark, sf).select("ticker", "date", "open", "close", "volume", "variacao_diaria_pct", "empresa")
    return sets.union_layers({"BRONZE": bronze, "SILVER": shaped})


@query(
    "reconcile_except",
    """select 'a' as lado, l_orderkey, l_quantity from (select l_orderkey, l_quantity from lineitem where l_returnflag<>'R'
  except all select l_orderkey, l_quantity from lineitem where l_returnflag<>'A') x
union all select 'b', l_orderkey, l_quantity from (select l_orderkey, l_quantity from lineitem where l_returnflag<>'A'
  except all select l_orderkey, l_quantity from lineitem where l_returnflag<>'R') y""",
)
def reconcile_except(spark, sf):
    li = v.table(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_quantity"]
    only_a, only_b = sets.reconcile(li.where("l_returnflag <> 'R'"), li.where("l_returnflag <> 'A'"), cols)
    return only_a.select(F.lit("a").alias("lado"), *cols).unionByName(only_b.select(F.lit("b").alias("lado"), *cols))


@query(
    "reconcile_tree",
    """select 'a' as lado, * from (select l_orderkey, l_linenumber, l_quantity from lineitem
  except all select l_orderkey, l_linenumber, case when l_orderkey % 97 = 5 then l_quantity + 1 else l_quantity end as l_quantity from lineitem where l_orderkey % 97 <> 5 or l_returnflag <> 'R') x
union all select 'b', * from (select l_orderkey, l_linenumber, case when l_orderkey % 97 = 5 then l_quantity + 1 else l_quantity end as l_quantity from lineitem where l_orderkey % 97 <> 5 or l_returnflag <> 'R'
  except all select l_orderkey, l_linenumber, l_quantity from lineitem) y""",
)
def reconcile_tree(spark, sf):
    """Two copies of the lines; in one some orders were changed or lost. Only the leaves that hold them are compared."""
    li = v.table(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_quantity"]
    hit = F.col("l_orderkey") % 97 == 5
    changed = li.where(~hit | (F.col("l_returnflag") != "R")).withColumn("l_quantity", F.when(hit, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    window = F.date_format("l_shipdate", "yyyy")
    only_a, only_b, _ = sets.reconcile_tree(li, changed, ["l_orderkey"], cols, 1024, window)
    return only_a.select(F.lit("a").alias("lado"), *cols).unionByName(only_b.select(F.lit("b").alias("lado"), *cols))


@query(
    "reconcile_counts",
    """select * from (select l_orderkey, l_quantity, count(*) filter (l_returnflag<>'R') as em_a,
  count(*) filter (l_returnflag<>'A') as em_b from lineitem group by 1,2) t where em_a<>em_b""",
)
def reconcile_counts(spark, sf):
    li = v.table(spark, sf, "lineitem")
    return sets.reconcile_counts(
        li.where("l_returnflag <> 'R'"), li.where("l_returnflag <> 'A'"), ["l_orderkey", "l_quantity"]
    )
