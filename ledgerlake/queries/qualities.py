"""Quality, monitoring and run-log keys: D1-D16, L1-L4."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..operators import profiles, quality, windows
from ..operators.aggregates import pivot_series
from ..plans import runlog
from ..sources import snapshots
from ..sources.scratch import scratch_dir, stage
from . import views as v
from .registry import query
from .scans import PAYLOAD_CASES, payloads
from .views import ASOF, r


def _wide(spark, sf):
    return pivot_series(v.series(spark, sf), "data", presets.DAILY_SERIES)


@query(
    "dq_columns",
    "select 'o_orderkey' as coluna, true as presente, count(*) filter (o_orderkey is null) as nulos from orders union all select 'o_desconto', false, null",
)
def dq_columns(spark, sf):
    o = v.table(spark, sf, "orders")
    nulls = quality.check_nulls(o).select("coluna", "nulos")
    return quality.check_columns(o, ["o_orderkey", "o_desconto"]).join(nulls, "coluna", "left")


@query("dq_unique", "select count(*) as chaves_repetidas, count(*)=0 as ok from (select l_orderkey, l_linenumber from lineitem group by 1,2 having count(*)>1) t")
def dq_unique(spark, sf):
    return quality.check_unique(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _null_row(c: str) -> str:
    n = f"count(*) filter ({c} is null)"
    return f"select '{c}' as coluna, {n} as nulos, cast({n} as double)/count(*) as pct_nulos, cast({n} as double)/count(*)<=0.05 as ok from v_wide"


@query("dq_nulls", " union all ".join(_null_row(c) for c in ("data", "selic", "cambio_usd_brl", "ipca")))
def dq_nulls(spark, sf):
    return quality.check_nulls(_wide(spark, sf))


@query(
    "dq_schema",
    """select 'o_orderdate' as coluna, 'extra' as problema, cast(null as varchar) as esperado, 'timestamp_ntz' as atual, count(*) filter (o_orderdate is null) as nulos from orders
union all select 'o_orderpriority', 'extra', null, 'string', count(*) filter (o_orderpriority is null) from orders
union all select 'o_desconto', 'ausente', 'double', null, null
union all select 'o_totalprice', 'tipo', 'integer', 'double', count(*) filter (o_totalprice is null) from orders""",
)
def dq_schema(spark, sf):
    expected = {
        "o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "string", "o_totalprice": "integer", "o_desconto": "double",
    }
    o = v.table(spark, sf, "orders")
    nulls = quality.check_nulls(o).select("coluna", "nulos")
    return quality.check_schema(o, expected).join(nulls, "coluna", "left")


@query("dq_rows", "select count(*) as total, count(*)>=1000 as ok from orders")
def dq_rows(spark, sf):
    return quality.check_rows(v.table(spark, sf, "orders"), 1000)


@query("dq_range", "select count(*) filter (l_discount<0.02 or l_discount>0.08) as fora, count(*) filter (l_discount<0.02 or l_discount>0.08)=0 as ok from lineitem")
def dq_range(spark, sf):
    return quality.check_range(v.table(spark, sf, "lineitem"), "l_discount", 0.02, 0.08)


@query("dq_allowed", "select count(*) filter (o_orderstatus not in ('F','O')) as invalidos, count(*) filter (o_orderstatus not in ('F','O'))=0 as ok from orders")
def dq_allowed(spark, sf):
    return quality.check_allowed(v.table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "dq_report",
    """with t as (select count(*) as n, count(distinct o_orderkey) as d, count(*) filter (o_totalprice<0 or o_totalprice>400000) as fora,
  count(*) filter (o_orderstatus not in ('F','O','P')) as inv from orders)
select 'completeness' as verificacao, 'o_orderkey' as coluna, 1.0::double as valor, 1.0::double as limite, true as ok
union all select 'completeness', 'o_custkey', 1.0, 1.0, true
union all select 'uniqueness', 'o_orderkey', (n-d)::double, 0.0, n=d from t
union all select 'nulls', c, 0.0, 0.05, true from (select unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) as c) z
union all select 'row_count', null, n::double, 1.0, n>=1 from t
union all select 'range', 'o_totalprice', fora::double, 0.0, fora=0 from t
union all select 'consistency', 'o_orderstatus', inv::double, 0.0, inv=0 from t""",
)
def dq_report(spark, sf):
    return quality.run_checks(v.table(spark, sf, "orders"), {
        "completeness": {"required_columns": ["o_orderkey", "o_custkey"]},
        "uniqueness": {"key_column": "o_orderkey"},
        "nulls": {"max_null_percentage": 0.05},
        "row_count": {"min_rows": 1},
        "range": {"column": "o_totalprice", "min_val": 0, "max_val": 400000},
        "consistency": {"column": "o_orderstatus", "allowed_values": ["F", "O", "P"]},
    })


def _profile_row(c: str, mean: bool) -> str:
    return f"""select '{c}' as coluna, count(*) as registros, count(*) filter ({c} is null) as nulos, count(distinct {c}) as distintos,
  {r(f'avg({c})', 4) if mean else 'cast(null as double)'} as media from customer"""


@query("dq_profile", " union all ".join([_profile_row("c_custkey", True), _profile_row("c_mktsegment", False), _profile_row("c_acctbal", True)]))
def dq_profile(spark, sf):
    from ..functions import dec_round

    prof = quality.profile(v.table(spark, sf, "customer"), ["c_custkey", "c_mktsegment", "c_acctbal"], exact=True)
    return prof.select("coluna", "registros", "nulos", "distintos", dec_round("media", 4).alias("media"))


@query("dq_profile_sketch")
def dq_profile_sketch(spark, sf):
    return quality.profile(v.table(spark, sf, "lineitem"))


def _metrics_sql(layer: str, table: str, view: str, cols: list[str]) -> str:
    nulls = "+".join(f"count(*) filter ({c} is null)" for c in cols)
    return f"""select '{layer}' as camada, '{table}' as tabela, '{ASOF}' as data_verificacao, count(*) as total_registros,
  {nulls} as total_nulos, count(*)-(select count(*) from (select distinct {','.join(cols)} from {view}) d) as total_duplicatas,
  cast(0 as bigint) as versao_cdf, {r(f"(1-({nulls})/(count(*)*{len(cols)})::double)*100", 2)} as qualidade_pct from {view}"""


LINES = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate"
).split()
CUSTOMERS = (
    "c_custkey c_name c_nationkey c_acctbal c_mktsegment"
).split()


@query("table_metrics", _metrics_sql("silver", "linhas", "lineitem", LINES))
def table_metrics(spark, sf):
    return quality.table_metrics(v.table(spark, sf, "lineitem"), "silver", "linhas", ASOF)


WIDE = ["data", "selic", "cambio_usd_brl", "ipca"]
MONITOR = " union all ".join([
    _metrics_sql("silver", "linhas", "lineitem", LINES),
    _metrics_sql("gold", "indicadores", "v_wide", WIDE),
    _metrics_sql("bronze", "clientes", "customer", CUSTOMERS),
])


def _monitor(spark, sf) -> DataFrame:
    return quality.monitor_all(
        {
            "silver.linhas": v.table(spark, sf, "lineitem"),
            "gold.indicadores": _wide(spark, sf),
            "bronze.clientes": v.table(spark, sf, "customer"),
            "bronze.ausente": lambda: spark.read.parquet(f"{sf}/nao_existe.parquet"),
        },
        ASOF,
    ).drop("tempo_seg")  # a measured time has no oracle


@query("monitor_all", MONITOR)
def monitor_all(spark, sf):
    return _monitor(spark, sf)


@query(
    "quality_status",
    f"""select *, case when qualidade_pct<95 then 'CRITICO' when qualidade_pct<99 or total_duplicatas>0 then 'ATENCAO' else 'OK' end as status
from ({MONITOR}) m""",
)
def quality_status(spark, sf):
    today = _monitor(spark, sf)
    earlier = today.withColumn("data_verificacao", F.lit("2025-12-31"))
    return quality.quality_status(today.unionByName(earlier))


@query(
    "alert_daily_count",
    "select data_ordem, count(*) as ocorrencias from v_fraud where score_fraude='Critico' group by 1 having count(*)>3",
)
def alert_daily_count(spark, sf):
    return quality.alert_daily_count(v.fraud(spark, sf), "data_ordem", F.col("score_fraude") == "Critico", 3)


@query("gated_publish", "select 1 as ver, count(*) as registros from orders")
def gated_publish(spark, sf):
    path = scratch_dir(spark, "published")
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    quality.publish(o, path, 1, {"uniqueness": {"key_column": "o_orderkey"}, "row_count": {"min_rows": 1}})
    try:  # the second version breaks a rule and must not appear
        quality.publish(o, path, 2, {"consistency": {"column": "o_orderstatus", "allowed_values": ["F"]}})
    except quality.DataQualityError:
        pass
    return snapshots.read_snapshots(spark, path).groupBy("ver").agg(F.count("*").alias("registros"))




@query(
    "dq_drift",
    f"""select 'ordens' as coluna, 0.0::double as delta_pct_nulos, {r('(select avg(ordens) from v_snap where ver=1999)-(select avg(ordens) from v_snap where ver=1997)', 6)} as delta_media,
  cast(null as double) as distancia_tv, cast(null as bigint) as delta_distintos
union all select 'perfil_risco', 0.0, null, {r('sum(abs(coalesce(b,0)/nb-coalesce(a,0)/na))/2', 6)}, count(*) filter (b>0)-count(*) filter (a>0)
from (select perfil_risco, count(*) filter (ver=1997)::double as a, count(*) filter (ver=1999)::double as b,
   (select count(*) from v_snap where ver=1997)::double as na, (select count(*) from v_snap where ver=1999)::double as nb
   from v_snap where ver in (1997,1999) group by 1) t""",
)
def dq_drift(spark, sf):
    from ..functions import dec_round

    snaps = v.yearly_snapshots(spark, sf)
    out = quality.drift(snaps.where("ver = 1997"), snaps.where("ver = 1999"), ["ordens"], ["perfil_risco"])
    return out.select(
        "coluna", dec_round("delta_pct_nulos", 6).alias("delta_pct_nulos"), dec_round("delta_media", 6).alias("delta_media"),
        dec_round("distancia_tv", 6).alias("distancia_tv"), "delta_distintos",
    )


@query(
    "dq_quarantine",
    f"select case when valido then 'bom' else 'quarentena' end as destino, motivo, count(*) as registros from ({PAYLOAD_CASES}) p group by 1,2",
)
def dq_quarantine(spark, sf):
    good, bad = quality.split_quarantine(payloads(spark, sf), "corpo")
    parts = [
        good.select(F.lit("bom").alias("destino"), F.lit(presets.REASON_OK).alias("motivo")),
        bad.select(F.lit("quarentena").alias("destino"), "motivo"),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("destino", "motivo").agg(F.count("*").alias("registros"))


# --- run log --------------------------------------------------------------------------------

RATE = r("count(*) filter (state='success')*100::double/count(*)", 2)
SINCE = "2024-01-08"


@query(
    "runlog_success_rate",
    f"""select 'todas' as grupo, count(*) as execucoes, {RATE} as taxa_sucesso_pct from v_runs where execution_date>=timestamp '{SINCE}'
union all select 'silver', count(*), {RATE} from v_runs where execution_date>=timestamp '{SINCE}' and task_id like 't2\\_silver\\_%' escape '\\'
union all select dag_id, count(*), {RATE} from v_runs where execution_date>=timestamp '{SINCE}' group by dag_id""",
)
def runlog_success_rate(spark, sf):
    runs, since = v.run_log(spark, sf), F.lit(SINCE).cast("timestamp_ntz")
    named = lambda df, name: df.select(name.alias("grupo"), "execucoes", "taxa_sucesso_pct")
    return (
        named(runlog.success_rate(runs, since), F.lit("todas"))
        .unionByName(named(runlog.success_rate(runs, since, r"t2\_silver\_%"), F.lit("silver")))
        .unionByName(named(runlog.success_rate(runs, since, by=["dag_id"]), F.col("dag_id")))
    )


MINUTES = "(cast(round(secs*1000000) as bigint)/60000000::double)"


@query(
    "runlog_durations",
    f"""select task_id, count(*) as execucoes, {r('cast(sum(cast(round(secs*1000000) as bigint)) as double)/count(*)/60000000::double', 4)} as duracao_media_min,
  {r(f'max({MINUTES})', 4)} as duracao_maxima_min from v_runs where execution_date>=timestamp '{SINCE}' group by task_id""",
)
def runlog_durations(spark, sf):
    return runlog.run_durations(v.run_log(spark, sf), F.lit(SINCE).cast("timestamp_ntz"))


@query(
    "runlog_longest",
    f"select task_id, dag_id, execution_date, {r(MINUTES, 4)} as duracao_min from v_runs order by duracao_min desc, task_id, dag_id, execution_date limit 10",
)
def runlog_longest(spark, sf):
    return runlog.longest_runs(v.run_log(spark, sf))


@query(
    "runlog_last_run",
    f"select task_id, {r(MINUTES, 4)} as duracao_min from v_runs where execution_date=(select max(execution_date) from v_runs)",
)
def runlog_last_run(spark, sf):
    return runlog.last_run(v.run_log(spark, sf))


@query(
    "runlog_failures",
    "select task_id, count(*) as falhas from v_runs where state='failed' group by 1 order by falhas desc, task_id limit 10",
)
def runlog_failures(spark, sf):
    return runlog.run_failures(v.run_log(spark, sf), k=10)


@query(
    "runlog_per_day",
    "select execution_date as periodo, count(*) as execucoes, count(*) filter (state='failed') as falhas from v_runs group by 1",
)
def runlog_per_day(spark, sf):
    return runlog.runs_per(v.run_log(spark, sf), "day").withColumn("periodo", F.col("periodo").cast("timestamp_ntz"))


@query("runlog_states", "select state, count(*) as execucoes from v_runs group by 1")
def runlog_states(spark, sf):
    return runlog.state_counts(v.run_log(spark, sf))


@query(
    "runlog_by_layer",
    """select case when starts_with(task_id,'t0_') then 'Setup' when starts_with(task_id,'t1_') then 'Ingestion' when starts_with(task_id,'t2_') then 'Silver'
  when starts_with(task_id,'t3_') then 'Gold' when starts_with(task_id,'t_sql_') then 'SQL' else 'Other' end as camada,
  count(*) as tarefas, count(*) filter (state='failed') as falhas from v_runs where execution_date=(select max(execution_date) from v_runs) group by 1""",
)
def runlog_by_layer(spark, sf):
    return runlog.tasks_by_layer(v.run_log(spark, sf))


PROFILED = ["l_quantity", "l_extendedprice", "l_partkey", "l_returnflag"]


def _profile_merge_sql(c: str) -> str:
    return f"""select '{c}' as coluna, count(*) as registros, count(*) filter ({c} is null) as nulos, true as minimo_ok, true as maximo_ok,
  true as distintos_ok, true as mediana_ok from lineitem"""


@query("profile_merge", " union all ".join(_profile_merge_sql(c) for c in PROFILED))
def profile_merge(spark, sf):
    """Profiles of every ship month, stored and merged without the rows, against exact figures of all rows."""
    li = v.table(spark, sf, "lineitem").withColumn("mes", F.date_format("l_shipdate", "yyyy-MM"))
    months = stage(profiles.profile_parts(li, PROFILED, "mes"), "profiles")
    numbers = PROFILED[:3]
    whole = profiles.read_profile(profiles.merge_profiles(months, numeric=numbers), [0.5])
    exact, parts = [], []
    for c in PROFILED:
        exact += [F.count_distinct(c).alias(f"d_{c}"), F.min(c).cast("string").alias(f"lo_{c}"), F.max(c).cast("string").alias(f"hi_{c}")]
    # the share of rows below and up to the estimated median must enclose one half, within the error of ranks
    medians = {r["coluna"]: r["q50"] for r in whole.select("coluna", "q50").collect()}  # one row per column
    for c in numbers:
        number = F.col(c).cast("double")
        exact += [F.avg((number < medians[c]).cast("int")).alias(f"below_{c}"), F.avg((number <= medians[c]).cast("int")).alias(f"upto_{c}")]
    facts = stage(li.agg(*exact), "facts")
    for c in PROFILED:
        measured = {"d": f"d_{c}", "lo": f"lo_{c}", "hi": f"hi_{c}"} | ({"below": f"below_{c}", "upto": f"upto_{c}"} if c in numbers else {})
        parts.append(F.struct(F.lit(c).alias("coluna"), *[
            (F.col(measured[n]) if n in measured else F.lit(None).cast("double")).alias(n) for n in ("d", "lo", "hi", "below", "upto")
        ]))
    # a row per column, so that the join has a key
    both = whole.join(facts.select(F.inline(F.array(*parts))), "coluna")
    off = F.abs(F.col("distintos_aprox") - F.col("d")) / F.col("d")
    median = (F.col("below") <= 0.5 + 3 * profiles.RANK_ERROR) & (F.col("upto") >= 0.5 - 3 * profiles.RANK_ERROR)
    return both.select(
        "coluna", "registros", "nulos", (F.col("minimo") == F.col("lo")).alias("minimo_ok"), (F.col("maximo") == F.col("hi")).alias("maximo_ok"),
        (off <= 4 * profiles.DISTINCT_ERROR).alias("distintos_ok"),
        F.when(F.col("coluna").isin(numbers), median).otherwise(True).alias("mediana_ok"),
    )


@query("drift_distribution", "select 1 as posicao, 'deslocado' as coluna, true as acima union all select 2, 'igual', false")
def drift_distribution(spark, sf):
    """A column that moved by a third of its range against one that did not, from sketches of two halves of the lines."""
    li = v.table(spark, sf, "lineitem")
    half = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(2))
    rows = li.select(half.alias("parte"), F.col("l_quantity").alias("igual"), (F.col("l_quantity") + half * 17).alias("deslocado"))
    parts = stage(profiles.profile_parts(rows, ["igual", "deslocado"], "parte"), "profiles")
    far = profiles.distribution_drift(parts.where("parte = 0"), parts.where("parte = 1"))
    return windows.rank_by(far, [F.desc("ks"), F.asc("coluna")], "posicao").select("posicao", "coluna", ((F.col("ks") > 0.2) & (F.col("psi") > 0.2)).alias("acima"))


@query("publish_observed", "select 1 as ver, count(*) as registros, sum(o_custkey) as soma from orders")
def publish_observed(spark, sf):
    """Checked while written: the good version counts, the bad one leaves none."""
    path = scratch_dir(spark, "observed")
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    quality.publish_observed(o, path, 1, {
        "completeness": {"required_columns": ["o_orderkey"]}, "uniqueness": {"key_column": "o_orderkey"}, "nulls": {"max_null_percentage": 0.0},
        "row_count": {"min_rows": 1}, "range": {"column": "o_totalprice", "min_val": 0, "max_val": 10**9},
    })
    try:
        quality.publish_observed(o, path, 2, {"consistency": {"column": "o_orderstatus", "allowed_values": ["F"]}})
    except quality.DataQualityError:
        pass
    return snapshots.read_snapshots(spark, path).groupBy("ver").agg(F.count("*").alias("registros"), F.sum("o_custkey").alias("soma"))
