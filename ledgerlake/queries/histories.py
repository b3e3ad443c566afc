"""Upsert and history M1-M7, M13."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import history, incremental
from ..sources import snapshots
from ..sources.scratch import scratch_dir, stage
from ..sources.tables import write_partitioned
from . import views as v
from .registry import query
from .views import FAR

OLD, NEW = 1997, 1998


@query(
    "merge_upsert",
    """select cli, ordens, perfil_risco from v_snap where ver=1998 union all
select cli, ordens, perfil_risco from v_snap a where ver=1997 and not exists (select 1 from v_snap b where b.ver=1998 and b.cli=a.cli)""",
)
def merge_upsert(spark, sf):
    snaps = v.yearly_snapshots(spark, sf)
    target, source = snaps.where(F.col("ver") == OLD).drop("ver"), snaps.where(F.col("ver") == NEW).drop("ver")
    return history.upsert(target, source, ["cli"])


def _two_batches(spark, sf, mode: str, days=("2024-01-01", "2024-01-02"), **kw) -> DataFrame:
    """History after the 1997 and then the 1998 snapshot arrive on two days."""
    snaps = v.yearly_snapshots(spark, sf)
    first = snaps.where(F.col("ver") == OLD).drop("ver")
    second = snaps.where(F.col("ver") == NEW).drop("ver")
    hist = history.scd2_apply(None, first, "cli", days[0])
    return history.scd2_apply(hist, second, "cli", days[1], mode, **kw)


def _scd2_sql(changed: str) -> str:
    return f"""
with a as (select cli, ordens, perfil_risco from v_snap where ver=1997), b as (select cli, ordens, perfil_risco from v_snap where ver=1998)
select a.cli, a.ordens, a.perfil_risco, date '2024-01-01' as data_inicio,
  case when b.cli is not null and ({changed}) then date '2024-01-02' else date '{FAR}' end as data_fim,
  not (b.cli is not null and ({changed})) as atual from a left join b on a.cli=b.cli
union all select b.cli, b.ordens, b.perfil_risco, date '2024-01-02', date '{FAR}', true from b left join a on a.cli=b.cli
where a.cli is null or ({changed})"""


def _nested(sql: str) -> str:
    """Turn the leading CTEs of a statement into subqueries, so that the views can go first."""
    head, body = sql.strip().split("\n", 1)
    a, b = head[len("with a as "):].split(", b as ")
    return body.replace(" from a left", f" from {a} a left").replace("from b left", f"from {b} b left").replace(
        "join b on", f"join {b} b on"
    ).replace("join a on", f"join {a} a on")


@query("scd2_snapshot", _nested(_scd2_sql("true")))
def scd2_snapshot(spark, sf):
    return _two_batches(spark, sf, "snapshot")


@query("scd2_changes", _nested(_scd2_sql("a.perfil_risco<>b.perfil_risco")))
def scd2_changes(spark, sf):
    return _two_batches(spark, sf, "changes", tracked=["perfil_risco"])


@query("scd2_late_batch", "select * from v_hist")
def scd2_late_batch(spark, sf):
    """The yearly batches arrive out of order, and one of them twice: the history is that of the right order."""
    # every batch is read several times: the orders are grouped once for all of them
    path = scratch_dir(spark, "batches")
    write_partitioned(v.yearly_snapshots(spark, sf).drop("ordens"), path, ["ver"])
    snaps = spark.read.parquet(path)
    years = sorted(r[0] for r in snaps.select("ver").distinct().collect())  # a handful of batches
    late = years[1::2] + years[::2] + years[:1]
    hist = None
    for year in late:
        batch = snaps.where(F.col("ver") == year).drop("ver")
        hist = stage(history.scd2_splice(hist, batch, "cli", f"{year}-01-01"), "late-history")
    return hist.drop(history.SEEN)


@query("scd2_current", "select cli, perfil_risco, data_inicio from v_hist where atual")
def scd2_current(spark, sf):
    return history.scd2_current(v.history(spark, sf)).select("cli", "perfil_risco", "data_inicio")


@query("scd2_rebuild", "select * from v_hist")
def scd2_rebuild(spark, sf):
    return v.history(spark, sf)


@query(
    "scd2_history",
    """select cli, count(*) as versoes, arg_min(perfil_risco, data_inicio) as valor_inicial, max(case when atual then perfil_risco end) as valor_atual,
  min(data_inicio) as desde, max(data_inicio) as ultima_mudanca,
  cast(max(case when atual then date_diff('day', data_inicio, date '2002-01-01') end) as int) as dias_no_estado
from v_hist group by cli having count(*)>1""",
)
def scd2_history(spark, sf):
    return history.scd2_history(v.history(spark, sf), "cli", "perfil_risco", "2002-01-01", more_than=1)


@query(
    "scd2_days",
    "select cli, data_inicio, cast(date_diff('day', data_inicio, least(data_fim, date '2002-01-01')) as int) as dias_neste_perfil from v_hist",
)
def scd2_days(spark, sf):
    return history.scd2_days(v.history(spark, sf), "2002-01-01").select("cli", "data_inicio", "dias_neste_perfil")


@query("scd2_at_date", "select cli, perfil_risco from v_hist where data_inicio<=date '1998-06-30' and date '1998-06-30'<data_fim")
def scd2_at_date(spark, sf):
    return history.scd2_at(v.history(spark, sf), "1998-06-30").select("cli", "perfil_risco")


@query(
    "scd2_transitions",
    """select de, para, count(*) as transicoes, count(*) filter (dias<400) as rapidas from (
 select lag(perfil_risco) over w as de, perfil_risco as para, data_inicio, date_diff('day', lag(data_inicio) over w, data_inicio) as dias
 from v_hist window w as (partition by cli order by data_inicio)) t
where de is not null and data_inicio>=date '1996-01-01' and data_inicio<date '2000-01-01' group by 1,2""",
)
def scd2_transitions(spark, sf):
    return history.scd2_transitions(
        v.history(spark, sf), "cli", "perfil_risco", "1996-01-01", "2000-01-01", fast_days=400
    )


def _subjects(spark, sf) -> DataFrame:
    return v.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("cli"))


def _subject_tables(spark, sf) -> dict[str, DataFrame]:
    return {
        "clientes": v.clients(spark, sf).select("cli"),
        "pedidos": v.table(spark, sf, "orders").select(F.col("o_custkey").alias("cli")),
    }


@query(
    "erase_subject",
    """select 'clientes' as tabela, c_custkey as cli from customer where c_acctbal>=0
union all select 'pedidos', o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal<0)""",
)
def erase_subject(spark, sf):
    remaining, _ = history.erase_subject(_subject_tables(spark, sf), "cli", _subjects(spark, sf))
    parts = [df.select(F.lit(name).alias("tabela"), "cli") for name, df in remaining.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "erase_subject_counts",
    """select 'clientes' as tabela, (select count(*) from customer where c_acctbal<0) as removidos
union all select 'pedidos', (select count(*) from orders where o_custkey in (select c_custkey from customer where c_acctbal<0))""",
)
def erase_subject_counts(spark, sf):
    keys = stage(_subjects(spark, sf), "subjects")
    return history.erase_subject(_subject_tables(spark, sf), "cli", keys)[1]


@query(
    "cdc_maintain",
    """select perfil_risco, count(*) as registros, cast(sum(ordens) as bigint) as soma_ordens, min(ordens) as min_ordens, max(ordens) as max_ordens,
  min(cli) as min_cli, max(cli) as max_cli
from v_snap where ver=(select max(ver) from v_snap) group by 1""",
)
def cdc_maintain(spark, sf):
    """Totals by profile, carried from version to version by inserts, updates and deletes; never from all rows."""
    snaps = stage(v.yearly_snapshots(spark, sf), "versions")
    spec = incremental.Totals(["perfil_risco"], ["ordens"], ["ordens", "cli"])
    offsets = spark.createDataFrame([], "consumidor string, versao int")
    state = None
    for upto in sorted(r[0] for r in snaps.select("ver").distinct().collect())[::2]:  # what the consumer finds when it runs
        known = snaps.where(F.col("ver") <= upto)
        current = snapshots.current_snapshot(known)
        result, offsets = snapshots.consume_changes(
            known, offsets, "totais", lambda rows: incremental.maintain(state, rows, spec, current), ["cli"],
            types=incremental.ALL_CHANGES, keep_meta=True,
        )
        if result is not None:
            state, offsets = stage(result, "totals"), stage(offsets, "offsets")
    return state.withColumn("soma_ordens", F.col("soma_ordens").cast("long")).drop("n_ordens")


@query("erase_in_place", "select o_orderkey, o_custkey, cast(year(o_orderdate) as int) as ano from orders where o_custkey not in (select c_custkey from customer where c_acctbal < -990)")
def erase_in_place(spark, sf):
    """A few subjects erased from a partitioned table: only the partitions that hold one are written again."""
    path = scratch_dir(spark, "orders_by_year")
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano"))
    write_partitioned(o, path, ["ano"])
    gone = v.table(spark, sf, "customer").where("c_acctbal < -990").select(F.col("c_custkey").alias("o_custkey"))
    history.erase_in_place(spark, path, ["ano"], "o_custkey", gone)
    return spark.read.parquet(path)


@query(
    "scd2_daily_states",
    """select dia, perfil_risco, count(*) as clientes from (select cast(unnest(generate_series(date '1996-11-01', date '1998-02-28', interval 1 day)) as date) as dia) d
join v_hist on data_inicio <= dia and dia < data_fim group by 1, 2""",
)
def scd2_daily_states(spark, sf):
    return history.daily_states(v.history(spark, sf), "perfil_risco", "1996-11-01", "1998-03-01")
