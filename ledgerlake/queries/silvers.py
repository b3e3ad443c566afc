"""Silver shaping, bands, flags and lookups: P1-P14, P4, J9."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions import band, compare_label, flag
from ..operators.joins import map_codes
from ..plans import silver
from . import views as v
from .registry import query
from .views import ASOF, COMPANIES, SALT, SECTORS


@query("silver_bars", "select *, '2026-01-02' as data_extracao from v_bars")
def silver_bars(spark, sf):
    new = v.raw_bars(spark, sf).withColumn("data_extracao", F.lit("2026-01-02"))
    # an older extract of the same days with other closes, which must lose
    old = new.withColumn("close", F.col("close") + 1).withColumn("data_extracao", F.lit("2026-01-01"))
    landed = new.unionByName(old).withColumns({"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)})
    return silver.silver_bars(landed, ASOF, COMPANIES, SECTORS)


@query(
    "silver_series",
    f"""select data, indicador, valor, cast(year(data) as int) as ano, cast(month(data) as int) as mes,
  cast(quarter(data) as int) as trimestre, '{ASOF}' as data_processamento from v_series""",
)
def silver_series(spark, sf):
    text = v.series(spark, sf).withColumn("data", F.date_format("data", "dd/MM/yyyy"))
    new = text.withColumn("extracao", F.lit("2026-01-02"))
    old = text.withColumn("valor", F.col("valor") * 2).withColumn("extracao", F.lit("2026-01-01"))
    unreadable = text.withColumn("data", F.lit("n/d")).withColumn("extracao", F.lit("2026-01-02"))
    empty = text.withColumn("valor", F.lit(None).cast("double")).withColumn("extracao", F.lit("2026-01-03"))
    return silver.silver_series(new.unionByName(old).unionByName(unreadable).unionByName(empty), ASOF)


@query(
    "silver_yearly",
    f"select indicador, valor, cast(ano as varchar) as data, ano, '{ASOF}' as data_processamento from v_yearly",
)
def silver_yearly(spark, sf):
    old_shape = v.yearly(spark, sf).select("indicador", "valor", F.col("ano").cast("string").alias("data"))
    unreadable = old_shape.withColumn("data", F.lit("total"))
    return silver.silver_yearly(old_shape.unionByName(unreadable), ASOF)


@query(
    "bronze_customers",
    f"""select concat('CLI', CustomerId) as id_cliente, sha256(concat(CustomerId, '{SALT}')) as hash_cliente,
  sha256(concat(Surname, '{SALT}')) as sobrenome_masked, CreditScore as score_credito, Geography as pais, Gender as genero,
  Age as idade, Tenure as anos_cliente, Balance as saldo,
  case when Balance=0 then 'Sem saldo' when Balance<50000 then 'Baixo' when Balance<150000 then 'Medio' else 'Alto' end as faixa_saldo,
  NumOfProducts as num_produtos,
  case when CreditScore>=750 then 'Arrojado' when CreditScore>=600 then 'Moderado' else 'Conservador' end as perfil_risco,
  active as ativo, churn, EstimatedSalary as salario_estimado, '{ASOF}' as data_extracao from v_raw""",
)
def bronze_customers(spark, sf):
    return silver.bronze_customers(v.raw_customers(spark, sf), ASOF, SALT)


@query("silver_customers", f"select *, '{ASOF}' as data_processamento from v_clients")
def silver_customers(spark, sf):
    return v.clients(spark, sf).withColumn("data_processamento", F.lit(ASOF))


@query(
    "silver_orders",
    f"select *, cast(year(data_ordem) as int) as ano, cast(month(data_ordem) as int) as mes, '{ASOF}' as data_processamento from v_plain",
)
def silver_orders(spark, sf):
    text = v.plain_orders(spark, sf).withColumn("data_ordem", F.col("data_ordem").cast("string"))
    return silver.silver_orders(text, ASOF)


@query(
    "band_thresholds",
    """select c_custkey, case when b>8000 then 'Alto' when b>3000 then 'Medio' when b<=-500 then 'Negativo' else 'Normal' end as faixa,
  case when b is null then 'Sem dado' when b>=0 then 'Credor' else 'Devedor' end as sinal
from (select c_custkey, case when c_mktsegment='MACHINERY' then null else c_acctbal end as b from customer) t""",
)
def band_thresholds(spark, sf):
    c = v.table(spark, sf, "customer")
    b = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal"))
    return c.select(
        "c_custkey",
        band(b, [(">", 8000, "Alto"), (">", 3000, "Medio"), ("<=", -500, "Negativo")], "Normal").alias("faixa"),
        band(b, [(">=", 0, "Credor")], "Devedor", "Sem dado").alias("sinal"),
    )


@query(
    "flag_null_false",
    "select c_custkey, case when c_mktsegment<>'MACHINERY' and c_acctbal>0 then true else false end as credor from customer",
)
def flag_null_false(spark, sf):
    b = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal"))
    return v.table(spark, sf, "customer").select("c_custkey", flag(b > 0).alias("credor"))


@query(
    "map_codes",
    """select p_partkey, p_type, case p_type when 'ECONOMY' then 'Economia SA' when 'PROMO' then 'Promo SA'
  when 'LARGE' then 'Grande SA' when 'SMALL' then 'Pequena SA' else 'Desconhecido' end as empresa,
  coalesce(n_name, 'Outros') as origem from part left join nation on p_size=n_nationkey""",
)
def map_codes_query(spark, sf):
    p = v.table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    named = map_codes(p, "p_type", COMPANIES, "empresa", presets.COMPANY_DEFAULT)
    nations = v.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return map_codes(named, "p_size", nations, "origem", presets.SECTOR_DEFAULT).drop("p_size")


@query(
    "predicates_mix",
    """select o_orderkey from orders where (o_orderpriority like '1-%' or o_orderpriority in ('2-HIGH','3-MEDIUM'))
  and o_orderstatus not in ('P') and o_totalprice between 1000 and 200000 and o_custkey is not null""",
)
def predicates_mix(spark, sf):
    c = F.col
    return v.table(spark, sf, "orders").where(
        (c("o_orderpriority").like("1-%") | c("o_orderpriority").isin("2-HIGH", "3-MEDIUM"))
        & ~c("o_orderstatus").isin("P")
        & c("o_totalprice").between(1000, 200000)
        & c("o_custkey").isNotNull()
    ).select("o_orderkey")


@query(
    "compare_label",
    """select ticker, date, case when close>open then 'Alta' when close<open then 'Queda' else 'Estavel' end as tendencia
from v_bars""",
)
def compare_label_query(spark, sf):
    return v.bars(spark, sf).select("ticker", "date", compare_label("close", "open", presets.TREND).alias("tendencia"))


@query("dropna_subset", "select * from v_wide where selic is not null and cambio_usd_brl is not null")
def dropna_subset(spark, sf):
    from ..operators.aggregates import pivot_series

    wide = pivot_series(v.series(spark, sf), "data", presets.DAILY_SERIES)
    return wide.dropna(subset=["selic", "cambio_usd_brl"])


@query(
    "dedup_by_key",
    f"""select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey
  order by o_orderdate desc, o_orderkey desc) as rn from orders) t where rn=1""",
)
def dedup_by_key(spark, sf):
    from ..operators.joins import dedup_latest

    o = v.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return dedup_latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("distinct_rows", "select distinct l_orderkey, l_linenumber, l_returnflag from lineitem")
def distinct_rows(spark, sf):
    from ..operators import joins

    return joins.distinct_rows(v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))
