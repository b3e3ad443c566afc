"""Boundary rows of the gold analyses."""

import datetime as dt

import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake.operators.rules import Rule, apply_rules
from ledgerlake.plans import gold

D = "2024-06-01"


def test_order_rules(spark):
    orders = spark.createDataFrame(
        [
            ("a", 50.0, 9000, 200000.0, "Conservador"),
            ("a", 90.0, 9001, 200000.01, "Conservador"),
            ("a", 90.01, 100, 500000.0, "Arrojado"),
            ("a", 12.0, 100, 500000.01, "Arrojado"),
            ("a", 11.99, 9001, 500000.01, "Conservador"),
            ("none", 50.0, 100, 9e9, "Arrojado"),
        ],
        "hash_cliente string, preco double, quantidade long, valor_total double, perfil_risco string",
    )
    scores = spark.createDataFrame(
        [("a", 80.0, "Baixo Risco", 500000)], "hash_cliente string, score_risco double, categoria_risco string, limite_operacional int"
    )
    out = gold.fraud_orders(orders, scores, D)
    got = rows(out, "valor_total", "preco", "total_alertas", "score_fraude", "requer_revisao", "alerta_valor_alto")
    assert got == sorted([
        (200000.0, 50.0, 0, "Normal", False, False),
        (200000.01, 90.0, 2, "Alto", True, False),
        (500000.0, 90.01, 1, "Medio", False, False),
        (500000.01, 12.0, 1, "Medio", False, True),
        (500000.01, 11.99, 4, "Critico", True, True),
        (9e9, 50.0, 0, "Normal", False, False),
    ], key=repr)


def test_new_rule_is_one_entry(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    out = apply_rules(df, [Rule("um", "x = 1"), Rule("positivo", "x > 0")])
    assert rows(out, "um", "positivo", "total_alertas", "score_fraude") == [
        (False, False, 0, "Normal"), (True, True, 2, "Alto"),
    ]


def test_positions_and_score(spark):
    orders = spark.createDataFrame(
        [
            ("a", "T1", "compra", 10, 100.10, "executada"),
            ("a", "T1", "venda", 10, 100.10, "cancelada"),
            ("a", "T2", "venda", 5, 50.0, "pendente"),
            ("b", "T1", "outro", 1, 10.0, "executada"),
        ],
        "hash_cliente string, ticker string, tipo string, quantidade long, valor_total double, status string",
    )
    clients = spark.createDataFrame(
        [("a", "Arrojado", "Alto", 850)], "hash_cliente string, perfil_risco string, faixa_saldo string, score_credito int"
    )
    pos = gold.positions(orders, clients, D)
    assert rows(pos, "hash_cliente", "ticker", "quantidade_liquida", "valor_investido", "situacao", "perfil_risco") == [
        ("a", "T1", 0, 0.0, "Zerado", "Arrojado"),
        ("a", "T2", -5, -50.0, "Vendido a Descoberto", "Arrojado"),
        ("b", "T1", -1, 0.0, "Vendido a Descoberto", None),
    ]
    only = gold.positions(orders, clients, D, statuses=["executada"])
    assert rows(only, "hash_cliente", "ticker", "total_ordens") == [("a", "T1", 1), ("b", "T1", 1)]
    score = gold.risk_score(pos, D)
    # a: 1 of 3 cancelled = 33.33 % -> 60 points; 100*.4 + 100*.2 + 100*.2 + 60*.2
    assert rows(score, "hash_cliente", "taxa_cancelamento_pct", "score_risco", "categoria_risco", "limite_operacional") == [
        ("a", 33.33, 92.0, "Baixo Risco", 500000),
        ("b", 0.0, None, "Risco Critico", 10000),
    ]


def macro(spark, points, **kw):
    df = spark.createDataFrame(
        [(y, n, float(x)) for y, g, u in points for n, x in (("pib_anual", g), ("desemprego", u))],
        "ano int, indicador string, valor double",
    )
    return {r["ano"]: r for r in gold.macro_context(df, D, **kw).collect()}


def test_macro_labels(spark):
    got = macro(spark, [(2000, 100, 12), (2001, 110, 11), (2002, 110, 11), (2003, 107.8, 13), (2004, 108, 13.5), (2005, 105, 16)])
    first = got[2000]
    assert (first["pib_variacao_pct"], first["tendencia_pib"], first["tendencia_desemprego"]) == (
        None, "Queda Severa", "Piorando (Rápido)",
    )
    assert (first["cenario_macro"], first["alerta_risco"]) == ("Transicao", "Moderado")
    up = got[2001]
    assert (up["tendencia_pib"], up["tendencia_desemprego"], up["cenario_macro"]) == (
        "Crescimento Alto", "Melhorando", "Expansao Economica",
    )
    assert up["impacto_bolsa"].startswith("Positivo")
    flat = got[2002]
    assert (flat["tendencia_pib"], flat["tendencia_desemprego"], flat["cenario_macro"]) == ("Queda Moderada", "Piorando", "Transicao")
    down = got[2003]
    assert (down["pib_variacao_pct"], down["tendencia_pib"]) == (-2.0, "Queda Severa")
    assert (down["cenario_macro"], down["tendencia_desemprego"]) == ("Recessao", "Piorando (Rápido)")
    slow = got[2004]
    assert (slow["cenario_macro"], slow["impacto_bolsa"]) == ("Desaceleracao", "Negativo - Favora acoes defensivas")
    assert got[2005]["alerta_risco"] == "Alto"
    assert macro(spark, [(2000, 100, 12)], null_label="Sem base")[2000]["tendencia_pib"] == "Sem base"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_series_indicators(spark):
    series = [(day(0), "selic", 10.0), (day(7), "selic", 12.0), (day(8), "selic", 14.0), (day(8), "cambio_usd_brl", 5.0),
              (day(9), "cambio_usd_brl", 6.0), (day(0), "ipca", 2.0), (day(365), "ipca", 1.5), (day(366), "ipca", 0.5)]
    df = spark.createDataFrame(series, "data date, indicador string, valor double")
    got = {r["data"]: r for r in gold.series_indicators(df, D).collect()}
    assert got[day(7)]["selic_media_7d"] == 11.0  # day 0 is still inside
    assert got[day(8)]["selic_media_7d"] == 13.0  # day 0 has left
    assert got[day(0)]["selic_volatilidade_30d"] is None
    assert got[day(7)]["tendencia_selic"] == "Alta"
    assert got[day(9)]["cambio_variacao_pct"] == 9.09 and got[day(9)]["alerta_cambio"] == "Critico"
    assert got[day(365)]["ipca_acumulado_12m"] == 3.5 and got[day(365)]["alerta_inflacao"] == "Alto"
    assert got[day(366)]["ipca_acumulado_12m"] == 2.0 and got[day(366)]["alerta_inflacao"] == "Normal"


def test_zscore_edges(spark):
    cols = "date date, ticker string, empresa string, setor string, open double, close double, volume long, variacao_diaria_pct double"
    base = [(day(i), "flat", "e", "s", 1.0, 1.0, 1, 3.0) for i in range(3)]
    base += [(day(0), "single", "e", "s", 1.0, 1.0, 1, 9.0)]
    base += [(day(i), "spike", "e", "s", 1.0, 1.0, 1, 100.0 if i == 9 else 0.0) for i in range(10)]
    out = gold.anomalies(spark.createDataFrame(base, cols), D)
    got = {(r["ticker"], r["date"]): (r["zscore"], r["anomalia"], r["tipo_anomalia"]) for r in out.collect()}
    assert got["flat", day(0)] == (None, False, "Normal")
    assert got["single", day(0)] == (None, False, "Normal")
    assert got["spike", day(9)] == (2.846, True, "Alta Anormal")
    assert got["spike", day(0)][1:] == (False, "Normal")


def test_z_limit_is_exclusive(spark):
    from ledgerlake.operators.windows import label_z

    df = spark.createDataFrame([(2.0,), (-2.0,), (2.0001,), (-2.0001,), (None,)], "z double")
    out = label_z(df, "z", 2.0, "odd", "label")
    assert [tuple(r) for r in out.collect()] == [
        (2.0, False, "Normal"), (-2.0, False, "Normal"), (2.0001, True, "Alta Anormal"),
        (-2.0001, True, "Queda Anormal"), (None, False, "Normal"),
    ]


@pytest.fixture(scope="module")
def trades(spark):
    data = [("x", "A", 10, 20.0, 1000, "compra"), ("y", "A", 10, 22.0, 1000, "venda"), ("z", "B", 11, 95.0, 9001, "compra")]
    df = spark.createDataFrame(data, "id_transacao string, ticker string, hora int, preco double, quantidade long, tipo string")
    return df.withColumn("valor_total", F.col("preco") * F.col("quantidade")).withColumn(
        "timestamp", F.lit("2024-01-01 10:00:00").cast("timestamp")
    )


def bench(spark, *data):
    return spark.createDataFrame(
        list(data), "ticker string, empresa string, setor string, preco_medio double, volatilidade double, volume_medio double"
    )


def test_intraday(spark, trades):
    b = bench(spark, ("A", "e", "s", 20.0, 0.0, 0.0))
    volume = {r["ticker"]: r for r in gold.intraday_volume(trades, b, D).collect()}
    assert volume["A"]["pct_volume_diario"] == 200000.0 and volume["A"]["alerta_volume_intraday"] == "Critico"
    assert volume["A"]["pressao_compradora"] == "Neutro" and volume["B"]["pressao_compradora"] == "Compra"
    assert volume["B"]["pct_volume_diario"] is None and volume["B"]["alerta_volume_intraday"] == "Normal"
    odd = {r["ticker"]: r for r in gold.intraday_anomalies(trades, b, D).collect()}
    assert (odd["A"]["zscore_intraday"], odd["A"]["anomalia"]) == (1.0, False)  # deviation 0 divides by 1
    rank = {r["ticker"]: r for r in gold.ranking(trades, b, D).collect()}
    assert (rank["B"]["rank_volume"], rank["A"]["rank_volume"]) == (1, 2)
    assert (rank["A"]["variacao_vs_historico_pct"], rank["A"]["tendencia"]) == (5.0, "Alta")
    assert rank["B"]["tendencia"] == "Estavel"


@pytest.mark.parametrize("pct, label", [(15.0, "Normal"), (15.01, "Alto"), (30.0, "Alto"), (30.01, "Critico")])
def test_volume_cuts(spark, trades, pct, label):
    b = bench(spark, ("A", "e", "s", 20.0, 1.0, 2000 / pct * 100))
    out = gold.intraday_volume(trades.where("ticker = 'A'"), b, D).first()
    assert (out["pct_volume_diario"], out["alerta_volume_intraday"]) == (pct, label)


def test_trade_rules(spark, trades):
    b = bench(spark, ("A", "e", "s", 20.0, 5.0, 1.0))
    got = rows(gold.fraud_trades(trades, b, D), "id_transacao", "alerta_desvio_historico", "total_alertas", "score_fraude")
    assert got == [("x", False, 0, "Normal"), ("y", False, 0, "Normal"), ("z", False, 3, "Critico")]
    tight = bench(spark, ("A", "e", "s", 20.0, 4.99, 1.0))
    flagged = rows(gold.fraud_trades(trades, tight, D), "id_transacao", "alerta_desvio_historico")
    assert flagged == [("x", False), ("y", True), ("z", False)]


def test_partials_add_up(spark, trades):
    split = gold.hour_partials(trades.where("id_transacao = 'x'")).unionByName(
        gold.hour_partials(trades.where("id_transacao <> 'x'"))
    )
    assert rows(gold.merge_partials(split), "ticker", "hora", "n", "q", "v", "p_min", "p_max") == rows(
        gold.hour_partials(trades), "ticker", "hora", "n", "q", "v", "p_min", "p_max"
    )


def test_fx_single_row_has_no_correlation(spark):
    bars = spark.createDataFrame(
        [(day(0), "A", 10.0, 1.0, 5, 2024, 1)], "date date, ticker string, close double, variacao_diaria_pct double, volume long, ano int, mes int"
    )
    fx = spark.createDataFrame([(day(0), 5.0), (day(1), 5.1)], "date date, cambio double")
    out = gold.fx_correlation(bars, fx, D).first()
    assert (out["cambio_variacao_pct"], out["correlacao_cambio"], out["sensibilidade_cambio"]) == (None, None, "Baixa Correlacao")
