"""Sources and sinks: S1-S16, K1-K8, M8, M10, M14, M15."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import retain
from ..plans.silver import enrich_trades
from ..sources import clustering, readers, snapshots, tables
from ..sources.scratch import scratch_dir
from . import views as v
from .registry import query
from .views import ASOF, STAMP


@query(
    "scan_parquet",
    "select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '1998-01-01' and o_orderstatus='F'",
)
def scan_parquet(spark, sf):
    df = tables.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"])
    recent = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("o_orderstatus") == "F")
    return df.where(recent).select("o_orderkey", "o_totalprice")


def _land_orders(spark, sf) -> str:
    """Orders landed as two daily extracts, split at 1998."""
    base = scratch_dir(spark, "landing")
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    old = F.year("o_orderdate") < 1998
    tables.write_landing(o.where(old), base, "2026-01-01")
    tables.write_landing(o.where(~old), base, "2026-01-02")
    return base


LANDED = """select o_orderkey, o_totalprice, case when year(o_orderdate)<1998 then '2026-01-01' else '2026-01-02' end as extracao
from orders"""


@query("scan_partitioned", LANDED)
def scan_partitioned(spark, sf):
    df = tables.read_landing(spark, _land_orders(spark, sf))
    return df.select("o_orderkey", "o_totalprice", F.col("extracao").cast("string").alias("extracao"))


@query("sink_landing", LANDED)
def sink_landing(spark, sf):
    base = _land_orders(spark, sf)
    again = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tables.write_landing(again.where(F.year("o_orderdate") >= 1998), base, "2026-01-02")  # same day again
    df = tables.read_landing(spark, base)
    return df.select("o_orderkey", "o_totalprice", F.col("extracao").cast("string").alias("extracao"))


def snapshot_table(spark, sf) -> DataFrame:
    """The yearly client snapshots stored with ``ver`` as partition key."""
    path = scratch_dir(spark, "snapshots")
    tables.write_partitioned(v.yearly_snapshots(spark, sf), path, ["ver"])
    return spark.read.parquet(path)


@query("scan_current_snapshot", "select * from v_snap where ver=(select max(ver) from v_snap)")
def scan_current_snapshot(spark, sf):
    return snapshots.current_snapshot(snapshot_table(spark, sf))


@query(
    "scan_sql_view",
    "select c_custkey, c_acctbal from customer where c_mktsegment='BUILDING' and c_acctbal>0",
)
def scan_sql_view(spark, sf):
    return spark.sql(
        "select c_custkey, c_acctbal from {c} where c_mktsegment = 'BUILDING' and c_acctbal > 0",
        c=v.table(spark, sf, "customer"),
    )


CSV_SCHEMA = (
    "CustomerId bigint, Surname string, CreditScore int, Geography string, Gender string, Age int, Tenure int, "
    "Balance double, NumOfProducts int, EstimatedSalary double, IsActiveMember int, Exited int"
)


@query(
    "scan_csv_mapped",
    """select CustomerId, Surname, CreditScore as score_credito, Geography as pais, Gender as genero, Age as idade,
  Tenure as anos_cliente, Balance as saldo, NumOfProducts as num_produtos, EstimatedSalary as salario_estimado,
  active::int as IsActiveMember, churn::int as Exited from v_raw""",
)
def scan_csv_mapped(spark, sf):
    from .. import presets

    path = scratch_dir(spark, "csv")
    v.raw_customers(spark, sf).write.csv(path, header=True)
    return readers.read_csv_mapped(spark, path, presets.CUSTOMER_CSV, CSV_SCHEMA)


@query(
    "scan_series_json",
    f"""select strftime(data,'%d/%m/%Y') as data, valor, 'selic' as indicador, '{ASOF}' as data_extracao, 'dev' as ambiente
from v_series where indicador='selic'""",
)
def scan_series_json(spark, sf):
    path = scratch_dir(spark, "series_json")
    rows = v.series(spark, sf).where(F.col("indicador") == "selic")
    point = F.struct(F.date_format("data", "dd/MM/yyyy").alias("data"), F.col("valor").cast("string").alias("valor"))
    # one payload per year: at most 366 points each
    payloads = rows.groupBy(F.year("data").alias("ano")).agg(F.to_json(F.collect_list(point)).alias("value"))
    payloads.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_series_json(spark, path, "selic", ASOF)


@query(
    "scan_nested_json",
    f"""select cast(ano as varchar) as ano, valor, indicador, '{ASOF}' as data_extracao, 'world_bank' as fonte, 'dev' as ambiente
from v_yearly where indicador='pib_anual'""",
)
def scan_nested_json(spark, sf):
    path = scratch_dir(spark, "nested_json")
    rows = v.yearly(spark, sf).where(F.col("indicador") == "pib_anual")
    item = F.struct(F.col("ano").cast("string").alias("date"), F.col("valor").alias("value"))
    # one payload per indicator: one point per year
    listed = rows.groupBy("indicador").agg(F.to_json(F.collect_list(item)).alias("items"))
    listed.select(F.concat(F.lit('[{"page":1},'), "items", F.lit("]")).alias("value")).write.text(path)
    return readers.read_nested_json(spark, path, "pib_anual", ASOF)


@query(
    "tag_extract",
    f"""select p_partkey as "part_key", p_name as "part_name", p_retailprice as "retail_price", '{ASOF}' as data_extracao, 'dev' as ambiente
from part""",
)
def tag_extract(spark, sf):
    named = v.table(spark, sf, "part").select(
        F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Part Name"),
        F.col("p_retailprice").alias("Retail Price"),
    )
    return readers.tag_extract(readers.normalize_headers(named), ASOF, "dev")


def envelopes(spark, sf) -> DataFrame:
    """Trades as captured: a JSON body in bytes next to the arrival time."""
    t = v.decoded_trades(v.table(spark, sf, "events"))
    body = F.to_json(F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "ticker", "preco", "quantidade", "tipo",
        F.lit("Corretora").alias("corretora"),
        F.col("id_transacao").cast("string").alias("id_transacao"),
    ))
    return t.select(body.cast("binary").alias("Body"), F.col("timestamp").alias("EnqueuedTimeUtc"))


ENVELOPE = "select timestamp, ticker, preco, quantidade, tipo, 'Corretora' as corretora, cast(id_transacao as varchar) as id_transacao from v_trades"


@query("json_envelope", ENVELOPE)
def json_envelope(spark, sf):
    decoded = readers.decode_envelope(envelopes(spark, sf))
    return decoded.withColumn("timestamp", F.to_timestamp("timestamp").cast("timestamp_ntz"))


PAYLOAD_CASES = """
select event_id, motivo, motivo='Schema válido' as valido from (select event_id, case event_type
  when 'view' then 'Schema válido' when 'error' then 'Preço deve ser numérico' when 'signup' then 'Campo obrigatório faltando: quantidade'
  when 'click' then 'Tipo inválido: click' else 'Quantidade deve ser inteiro' end as motivo from events) t"""


def payloads(spark, sf) -> DataFrame:
    """Trade payloads of which each event type but ``view`` breaks one rule."""
    e = v.table(spark, sf, "events")
    kind = F.col("event_type")
    text = F.concat(
        F.lit('{"timestamp":"'), F.col("ts").cast("string"), F.lit('","ticker":"'), kind, F.lit('","preco":'),
        F.when(kind == "error", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(
            F.col("value").cast("string")
        ),
        F.when(kind == "signup", F.lit("")).otherwise(F.concat(
            F.lit(',"quantidade":'), F.col("user_id").cast("string"),
            F.when(kind == "purchase", F.lit(".5")).otherwise(F.lit("")),
        )),
        F.lit(',"tipo":"'), F.when(kind == "click", F.lit("click")).otherwise(F.lit("compra")),
        F.lit('","corretora":"C","id_transacao":"'), F.col("event_id").cast("string"), F.lit('"}'),
    )
    return e.select("event_id", text.alias("corpo"))


@query("payload_validation", PAYLOAD_CASES)
def payload_validation(spark, sf):
    return readers.validate_payload(payloads(spark, sf), "corpo").select("event_id", "motivo", "valido")


@query(
    "union_extracts",
    """select s_name as nome, s_acctbal as saldo, cast(null as varchar) as segmento from supplier
union all select c_name, c_acctbal, c_mktsegment from customer""",
)
def union_extracts(spark, sf):
    s = v.table(spark, sf, "supplier").select(F.col("s_name").alias("nome"), F.col("s_acctbal").alias("saldo"))
    c = v.table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("saldo"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmento")
    )
    return readers.union_extracts(s, None, c)


# --- versions -------------------------------------------------------------------------------


@query(
    "cdc_read_inserts",
    """select cli, ordens, perfil_risco, 'insert' as _change_type, ver as _commit_version from v_snap a
where ver>1997 and not exists (select 1 from v_snap b where b.cli=a.cli and b.ver=a.ver-1)""",
)
def cdc_read_inserts(spark, sf):
    return snapshots.changes_since(snapshot_table(spark, sf), ["cli"], "ver", start=1997, keep_meta=True)


CHANGES = """
select a.cli, a.ordens, a.perfil_risco, 'insert' as _change_type, a.ver as _commit_version from v_snap a
  left join v_snap b on a.cli=b.cli and b.ver=a.ver-1 where b.cli is null
union all select b.cli, b.ordens, b.perfil_risco, 'update_preimage', a.ver from v_snap a join v_snap b
  on a.cli=b.cli and b.ver=a.ver-1 where (a.ordens, a.perfil_risco) is distinct from (b.ordens, b.perfil_risco)
union all select a.cli, a.ordens, a.perfil_risco, 'update_postimage', a.ver from v_snap a join v_snap b
  on a.cli=b.cli and b.ver=a.ver-1 where (a.ordens, a.perfil_risco) is distinct from (b.ordens, b.perfil_risco)
union all select b.cli, b.ordens, b.perfil_risco, 'delete', cast(b.ver+1 as int) from v_snap b left join v_snap a
  on a.cli=b.cli and a.ver=b.ver+1 where a.cli is null and b.ver<(select max(ver) from v_snap)"""


@query("cdc_read_all", CHANGES)
def cdc_read_all(spark, sf):
    kinds = (snapshots.INSERT, snapshots.PREIMAGE, snapshots.POSTIMAGE, snapshots.DELETE)
    return snapshots.changes_since(snapshot_table(spark, sf), ["cli"], "ver", types=kinds, keep_meta=True)


@query("snapshot_asof", "select * from v_snap where ver=1998")
def snapshot_asof(spark, sf):
    return snapshots.snapshot_asof(snapshot_table(spark, sf), "ver", 1998)


@query(
    "snapshot_history",
    f"""select v.ver, v.registros, coalesce(c.inseridos,0) as inseridos, coalesce(c.alterados,0) as alterados, coalesce(c.removidos,0) as removidos
from (select ver, count(*) as registros from v_snap group by ver) v left join (
 select _commit_version as ver, count(*) filter (_change_type='insert') as inseridos,
  count(*) filter (_change_type='update_postimage') as alterados, count(*) filter (_change_type='delete') as removidos
 from ({CHANGES}) x group by 1) c on v.ver=c.ver""",
)
def snapshot_history(spark, sf):
    return snapshots.snapshot_history(snapshot_table(spark, sf), ["cli"], "ver")


@query("agg_high_water", "select coalesce(max(ver),0) as ultima_versao from v_snap where perfil_risco='Arrojado'")
def agg_high_water(spark, sf):
    return snapshots.high_water(v.yearly_snapshots(spark, sf), "ver", F.col("perfil_risco") == "Arrojado")


@query(
    "cdc_consume",
    """select perfil_risco, count(*) as novos, cast(sum(ordens) as bigint) as ordens from (select * from v_snap a
 where ver>1999 and not exists (select 1 from v_snap b where b.cli=a.cli and b.ver=a.ver-1)) t group by 1""",
)
def cdc_consume(spark, sf):
    offsets = spark.range(1).select(F.lit("gold").alias("consumidor"), F.lit(1999).alias("versao"))

    def summary(rows):
        return rows.groupBy("perfil_risco").agg(F.count("*").alias("novos"), F.sum("ordens").alias("ordens"))

    result, _ = snapshots.consume_changes(snapshot_table(spark, sf), offsets, "gold", summary, ["cli"])
    return result


@query("compact_cluster", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def compact_cluster(spark, sf):
    path = scratch_dir(spark, "clustered")
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    snapshots.rewrite_clustered(o, path, ["o_custkey", "o_orderstatus"], 4)
    return spark.read.parquet(path)


@query("zorder_cluster", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem")
def zorder_cluster(spark, sf):
    """Lines clustered by part, supplier and date at once: every file covers a small box of all three."""
    path = scratch_dir(spark, "zordered")
    li = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    clustering.rewrite_zordered(li, path, ["l_partkey", "l_suppkey", "l_shipdate"], 16)
    return spark.read.parquet(path)


@query(
    "retention_filter",
    "select o_orderkey, o_totalprice from orders where cast(o_orderdate as date)>=date '2000-12-31' - interval 730 days",
)
def retention_filter(spark, sf):
    o = v.table(spark, sf, "orders").withColumn("dia", F.to_date("o_orderdate"))
    return retain(o, "dia", 730, "2000-12-31").select("o_orderkey", "o_totalprice")


# --- sinks ----------------------------------------------------------------------------------


@query("sink_overwrite", "select o_orderkey, cast(null as double) as o_totalprice, o_orderstatus from orders")
def sink_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    o = v.table(spark, sf, "orders")
    tables.write_overwrite(o.select("o_orderkey", "o_totalprice"), path)
    tables.write_overwrite(o.select("o_orderkey", "o_orderstatus"), path)
    return spark.read.parquet(path)


@query(
    "sink_partitioned",
    """select o_orderkey, case when year(o_orderdate)=2001 then -o_totalprice else o_totalprice end as o_totalprice,
  cast(year(o_orderdate) as int) as ano, cast(month(o_orderdate) as int) as mes from orders""",
)
def sink_partitioned(spark, sf):
    path = scratch_dir(spark, "partitioned")
    o = v.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes")
    )
    tables.write_partitioned(o, path)
    tables.write_partitioned(o.where("ano = 2001").withColumn("o_totalprice", -F.col("o_totalprice")), path)
    return spark.read.parquet(path)


def _schema(spark) -> str:
    """A catalog schema of its own under the scratch root."""
    path = scratch_dir(spark, "catalog")
    name = "ll_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{path}'")
    return name


@query("sink_managed", "select s_suppkey, s_name, s_acctbal from supplier")
def sink_managed(spark, sf):
    ref = f"{_schema(spark)}.fornecedores"
    tables.save_as_table(v.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), ref)
    return tables.read_table(spark, ref)


@query(
    "sink_register",
    "select o_orderkey, cast(year(o_orderdate) as int) as ano, o_orderstatus from orders where o_orderstatus='F'",
)
def sink_register(spark, sf):
    path = scratch_dir(spark, "external")
    o = v.table(spark, sf, "orders")
    tables.write_partitioned(o.select("o_orderkey", F.year("o_orderdate").alias("ano"), "o_orderstatus"), path, ["ano"])
    ref = f"{_schema(spark)}.pedidos"
    tables.register_external(spark, ref, path)
    return spark.sql(f"select o_orderkey, ano, o_orderstatus from {ref} where o_orderstatus = 'F'")


@query("sink_append", "select r_name as nome from region union all select n_name from nation")
def sink_append(spark, sf):
    path = scratch_dir(spark, "append")
    tables.write_append(v.table(spark, sf, "region").select(F.col("r_name").alias("nome")), path)
    tables.write_append(v.table(spark, sf, "nation").select(F.col("n_name").alias("nome")), path)
    return spark.read.parquet(path)


@query(
    "load_all_status",
    """select 'pedidos' as tabela, true as ok, (select count(*) from orders) as registros, cast(null as varchar) as erro
union all select 'ausente', false, null, 'AnalysisException' union all select 'clientes', true, (select count(*) from customer), null""",
)
def load_all_status(spark, sf):
    spec = {
        "pedidos": f"{sf}/orders.parquet",
        "ausente": f"{sf}/nao_existe.parquet",
        "clientes": f"{sf}/customer.parquet",
    }
    return tables.load_all(spark, spec, scratch_dir(spark, "catalogo"))


@query(
    "enrich_trades",
    f"""select timestamp, ticker, preco, quantidade, tipo, id_transacao, hora, minuto, valor_total,
  case when quantidade>8000 then 'Volume Alto' when quantidade>5000 then 'Volume Medio' else 'Normal' end as alerta_volume,
  case when preco>80 then 'Preco Alto' when preco<15 then 'Preco Baixo' else 'Normal' end as alerta_preco, '{STAMP}' as processado_em
from v_trades""",
)
def enrich(spark, sf):
    out = enrich_trades(v.decoded_trades(v.table(spark, sf, "events")), STAMP)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
