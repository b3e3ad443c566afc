"""Joins J1-J11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history, joins
from ..operators.sets import top_k
from ..sources.scratch import stage
from . import views as v
from .registry import query


@query("join_broadcast_left", "select o_orderkey, o_totalprice, c_name from orders left join customer on o_custkey=c_custkey and c_mktsegment='BUILDING'")
def join_broadcast_left(spark, sf):
    c = v.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), "c_name"
    )
    o = v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return joins.guarded_join(o, c, "o_custkey", rows=c.count()).drop("o_custkey")


@query("join_size_guarded", "select l_orderkey, l_linenumber, l_quantity, o_orderstatus from lineitem left join orders on l_orderkey=o_orderkey")
def join_size_guarded(spark, sf):
    li = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    # a stored table's rows are known from its files; beyond the limit the join goes without a hint
    return joins.guarded_join(li, o, "l_orderkey", "left", rows=o.count(), max_rows=1000)


@query(
    "join_left_reject",
    "select b.date, b.ticker, b.close, s.valor as cambio from v_bars b join v_series s on b.date=s.data where s.indicador='cambio_usd_brl'",
)
def join_left_reject(spark, sf):
    fx = v.series(spark, sf).where("indicador = 'cambio_usd_brl'").select(
        F.col("data").alias("date"), F.col("valor").alias("cambio")
    )
    return joins.join_left_reject(v.bars(spark, sf).select("date", "ticker", "close"), fx, "date", "cambio")


@query(
    "join_inner_topk",
    """select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey=c_custkey
where o_orderstatus='F' order by o_totalprice desc, o_orderkey limit 20""",
)
def join_inner_topk(spark, sf):
    o = v.table(spark, sf, "orders").where("o_orderstatus = 'F'")
    c = v.table(spark, sf, "customer")
    both = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")
    return top_k(both, [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("join_auto_broadcast", "select s_suppkey, s_name, n_name from supplier left join nation on s_nationkey=n_nationkey")
def join_auto_broadcast(spark, sf):
    s, n = v.table(spark, sf, "supplier"), v.table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select("s_suppkey", "s_name", "n_name")


@query("filter_scalar_subquery", "select ticker, ano, preco_medio from v_perf where ano=(select max(ano) from v_perf)")
def filter_scalar_subquery(spark, sf):
    stored = stage(v.performance(spark, sf).select("ticker", "ano", "preco_medio"), "performance")
    return joins.latest_slice(stored, "ano")


@query(
    "semi_join_having",
    "select cli, perfil_risco, data_inicio from v_hist where cli in (select cli from v_hist group by cli having count(*)>1)",
)
def semi_join_having(spark, sf):
    return joins.having_keys(v.history(spark, sf).select("cli", "perfil_risco", "data_inicio"), ["cli"])


@query(
    "join_asof_validity",
    """select o_orderkey, o_custkey as cli, h.perfil_risco from orders left join v_hist h
on h.cli=o_custkey and h.data_inicio<=cast(o_orderdate as date) and cast(o_orderdate as date)<h.data_fim""",
)
def join_asof_validity(spark, sf):
    ev = v.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("cli"), "o_orderdate")
    out = joins.scd2_asof_join(ev, v.history(spark, sf).drop("atual"), "cli", "o_orderdate")
    return out.select("o_orderkey", "cli", "perfil_risco")


@query(
    "diff_classify",
    """select coalesce(n.cli, a.cli) as cli, case when n.cli is not null then n.ordens else a.ordens end as ordens,
  case when n.cli is not null then n.perfil_risco else a.perfil_risco end as perfil_risco,
  case when a.cli is null then 'novo' when n.cli is null then 'ausente' when a.ordens=n.ordens and a.perfil_risco=n.perfil_risco then 'igual' else 'alterado' end as mudanca
from (select * from v_snap where ver=1997) a full join (select * from v_snap where ver=1998) n on a.cli=n.cli""",
)
def diff_classify(spark, sf):
    snaps = v.yearly_snapshots(spark, sf)
    return history.diff(snaps.where("ver = 1997"), snaps.where("ver = 1998"), ["cli"], ["ordens", "perfil_risco"])
