"""Scalar functions of section 2.9, hashing and masking."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fx
from . import views as v
from .registry import query
from .views import SALT, r


@query(
    "fn_date_parts",
    """select o_orderkey, cast(o_orderdate as date) as data, cast(year(o_orderdate) as int) as ano, cast(month(o_orderdate) as int) as mes,
  cast(quarter(o_orderdate) as int) as trimestre, cast(null as date) as ilegivel from orders""",
)
def fn_date_parts(spark, sf):
    o = v.table(spark, sf, "orders").withColumn("texto", F.date_format("o_orderdate", "dd/MM/yyyy"))
    d = F.try_to_date("texto", "dd/MM/yyyy")
    return o.select(
        "o_orderkey", d.alias("data"), F.year(d).alias("ano"), F.month(d).alias("mes"), F.quarter(d).alias("trimestre"),
        F.try_to_date("o_orderstatus", "dd/MM/yyyy").alias("ilegivel"),
    )


@query(
    "fn_ts_parts",
    """select event_id, ts, cast(hour(ts) as int) as hora, cast(minute(ts) as int) as minuto, cast(ts as date) as dia from events""",
)
def fn_ts_parts(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    e = v.table(spark, sf, "events").withColumn("t", F.try_to_timestamp(text))
    return e.select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), F.hour("t").alias("hora"), F.minute("t").alias("minuto"),
        F.to_date("t").alias("dia"),
    )


@query(
    "fn_date_arith",
    """select event_id, cast(date_diff('day', cast(ts as date), date '2024-03-01') as int) as dias, date_trunc('hour', ts)::timestamp as hora_cheia,
  date_trunc('day', ts)::timestamp as dia, cast(floor(epoch_us(ts)/60000000) as bigint) as minutos from events""",
)
def fn_date_arith(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return v.table(spark, sf, "events").select(
        "event_id",
        F.datediff(F.lit("2024-03-01").cast("date"), F.to_date("ts")).alias("dias"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora_cheia"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dia"),
        F.floor(F.unix_micros(ts) / 60_000_000).alias("minutos"),
    )


@query(
    "fn_math",
    f"""select l_orderkey, l_linenumber, l_partkey, {r('l_extendedprice/1000', 2)} as preco, {r('l_extendedprice/7', 0)} as inteiro,
  {r('l_extendedprice*l_discount', 4)} as desconto, abs(-l_quantity) as quantidade, {r('l_quantity/nullif(l_discount,0)', 6)} as razao,
  l_quantity/case when l_tax=0 then 1 else l_tax end as guardada from lineitem""",
)
def fn_math(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fx.dec_round(F.col("l_extendedprice") / 1000, 2).alias("preco"),
        fx.dec_round(F.col("l_extendedprice") / 7, 0).alias("inteiro"),
        fx.dec_round(F.col("l_extendedprice") * F.col("l_discount"), 4).alias("desconto"),
        F.abs(-F.col("l_quantity")).alias("quantidade"),
        fx.dec_round(fx.safe_div("l_quantity", "l_discount"), 6).alias("razao"),
        (F.col("l_quantity") / fx.guard_zero("l_tax")).alias("guardada"),
    )


@query(
    "fn_conditional",
    """select c_custkey, case when c_acctbal<0 then 'devedor' when c_acctbal=0 then 'zerado' else 'credor' end as situacao,
  coalesce(case when c_acctbal>5000 then c_acctbal end, 0.0::double) as acima, (c_acctbal>0)::int as positivo from customer""",
)
def fn_conditional(spark, sf):
    b = F.col("c_acctbal")
    return v.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(b < 0, "devedor").when(b == 0, "zerado").otherwise("credor").alias("situacao"),
        F.coalesce(F.when(b > 5000, b), F.lit(0.0)).alias("acima"),
        (b > 0).cast("int").alias("positivo"),
    )


@query(
    "fn_string",
    """select c_custkey, concat('CLI', c_custkey) as id_cliente, cast(length(c_name) as int) as tamanho, lower(c_name) as minusculo,
  replace(c_name,'#','_') as trocado, split_part(c_name,'#',2) as sufixo, c_name like 'Customer#%' as modelo from customer""",
)
def fn_string(spark, sf):
    c = v.table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        F.concat(F.lit("CLI"), F.col("c_custkey").cast("string")).alias("id_cliente"),
        F.length("c_name").alias("tamanho"),
        F.lower("c_name").alias("minusculo"),
        F.replace("c_name", F.lit("#"), F.lit("_")).alias("trocado"),
        F.get(F.split("c_name", "#"), 1).alias("sufixo"),
        F.col("c_name").like("Customer#%").alias("modelo"),
    )


@query("fn_sha2_salted", f"select c_custkey, sha256(concat(c_custkey, '{SALT}')) as hash_cliente from customer")
def fn_sha2_salted(spark, sf):
    return v.table(spark, sf, "customer").select("c_custkey", fx.salted_sha256("c_custkey", SALT).alias("hash_cliente"))


MASKS = """
select c_custkey, concat(substr(c_name,1,1), repeat('*', length(c_name)-1)) as nome,
  concat('***.', substr(lpad(cast(c_custkey as varchar),11,'0'),4,3), '.', substr(lpad(cast(c_custkey as varchar),11,'0'),7,3), '-**') as cpf,
  concat(substr(lower(c_mktsegment),1,2), '***@', lower(c_mktsegment), '.com') as email from customer"""


def _masked(spark, sf):
    digits = F.lpad(F.col("c_custkey").cast("string"), 11, "0")
    part = [F.substring(digits, 1, 3), F.substring(digits, 4, 3), F.substring(digits, 7, 3)]
    cpf = F.concat(part[0], F.lit("."), part[1], F.lit("."), part[2], F.lit("-"), F.substring(digits, 10, 2))
    segment = F.lower("c_mktsegment")
    raw = v.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("nome"), cpf.alias("cpf"),
        F.concat(segment, F.lit("@"), segment, F.lit(".com")).alias("email"),
    )
    return fx.mask(raw, {"nome": "name", "cpf": "cpf", "email": "email"})


@query("fn_mask", MASKS)
def fn_mask(spark, sf):
    return _masked(spark, sf)


@query("mask_columns", MASKS)
def mask_columns(spark, sf):
    return _masked(spark, sf)


@query(
    "pseudonymize",
    f"select sha256(concat(c_custkey, '{SALT}')) as c_custkey, sha256(concat(c_name, '{SALT}')) as c_name, c_acctbal from customer",
)
def pseudonymize(spark, sf):
    c = v.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return fx.pseudonymize(c, ["c_custkey", "c_name"], SALT)


@query(
    "fn_composed_id",
    f"""select o_orderkey, concat('ORD', sha256(concat(o_custkey, '{SALT}')), '-', strftime(o_orderdate,'%Y%m%d'), '-', lpad(cast(o_orderkey as varchar), 8, '0')) as id_ordem
from orders""",
)
def fn_composed_id(spark, sf):
    ident = F.concat(
        F.lit("ORD"), fx.salted_sha256("o_custkey", SALT), F.lit("-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"),
        F.format_string("%08d", F.col("o_orderkey")),
    )
    return v.table(spark, sf, "orders").select("o_orderkey", ident.alias("id_ordem"))


@query(
    "fn_try_cast",
    """select o_orderkey, try_cast(substr(o_orderpriority,1,1) as int) as prioridade, try_cast(o_orderstatus as double) as numero,
  cast(o_totalprice as varchar) is not null as texto from orders""",
)
def fn_try_cast(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("try_cast(substr(o_orderpriority, 1, 1) as int)").alias("prioridade"),
        F.expr("try_cast(o_orderstatus as double)").alias("numero"),
        F.col("o_totalprice").cast("string").isNotNull().alias("texto"),
    )
