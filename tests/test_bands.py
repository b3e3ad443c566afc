"""Threshold boundaries: equal, just beside, NULL."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import presets
from ledgerlake.functions import band, compare_label, dec_round, exact_avg, flag, guard_zero, safe_div
from ledgerlake.plans import silver


def labels(spark, values, cuts, default, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(band("v", cuts, default)).collect()]


def test_score_band(spark):
    got = labels(spark, [549, 550, 649, 650, 749, 750, None], presets.SCORE_BAND, presets.SCORE_BAND_DEFAULT, "int")
    assert got == ["Ruim", "Regular", "Regular", "Bom", "Bom", "Excelente", "Ruim"]


def test_risk_profile(spark):
    got = labels(spark, [599, 600, 749, 750, None], presets.RISK_PROFILE, presets.RISK_PROFILE_DEFAULT, "int")
    assert got == ["Conservador", "Moderado", "Moderado", "Arrojado", "Conservador"]


def test_age_band(spark):
    got = labels(spark, [29, 30, 49, 50, None], presets.AGE_BAND, presets.AGE_BAND_DEFAULT, "int")
    assert got == ["Jovem", "Adulto", "Adulto", "Senior", "Senior"]


def test_balance_band(spark):
    values = [0.0, 49999.99, 50000.0, 149999.99, 150000.0, None]
    got = labels(spark, values, presets.BALANCE_BAND, presets.BALANCE_BAND_DEFAULT)
    assert got == ["Sem saldo", "Baixo", "Medio", "Medio", "Alto", "Alto"]


def test_trade_alerts(spark):
    volume = labels(spark, [5000, 5001, 8000, 8001, None], presets.VOLUME_ALERT, presets.NORMAL, "bigint")
    assert volume == ["Normal", "Volume Medio", "Volume Medio", "Volume Alto", "Normal"]
    price = labels(spark, [14.99, 15.0, 80.0, 80.01, None], presets.PRICE_ALERT, presets.NORMAL)
    assert price == ["Preco Baixo", "Normal", "Normal", "Preco Alto", "Normal"]


@pytest.mark.parametrize(
    "cuts, default, values, expected",
    [
        (presets.RISK_CATEGORY, presets.RISK_CATEGORY_DEFAULT, [29.99, 30.0, 49.99, 50.0, 69.99, 70.0],
         ["Risco Critico", "Risco Alto", "Risco Alto", "Risco Moderado", "Risco Moderado", "Baixo Risco"]),
        (presets.BEHAVIOUR_POINTS, presets.BEHAVIOUR_POINTS_DEFAULT, [19.99, 20.0, 49.99, 50.0, None], [100, 60, 60, 20, 20]),
        (presets.FX_SENSITIVITY, presets.FX_SENSITIVITY_DEFAULT, [0.51, 0.5, 0.2, -0.2, -0.21, -0.5, -0.51, None],
         ["Alta Positiva (Exportadora)", "Moderada Positiva", "Baixa Correlacao", "Baixa Correlacao", "Moderada Negativa",
          "Moderada Negativa", "Alta Negativa (Importadora)", "Baixa Correlacao"]),
        (presets.SEVERITY, presets.NORMAL, [0.0, 1.0, 2.0, 3.0, 4.0], ["Normal", "Medio", "Alto", "Critico", "Critico"]),
    ],
)
def test_preset_cuts(spark, cuts, default, values, expected):
    assert labels(spark, values, cuts, default) == expected


def test_null_label(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "v double")
    assert [r[0] for r in df.select(band("v", [(">", 0, "a")], "b", null_label="?")).collect()] == ["?", "a"]


def test_flag_and_compare(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(flag(F.col("a") > F.col("b"))).collect()] == [False, True, False, False]
    got = [r[0] for r in df.select(compare_label("a", "b", presets.TREND)).collect()]
    assert got == ["Queda", "Alta", "Estavel", "Estavel"]


def test_rounding_reads_the_decimal(spark):
    df = spark.createDataFrame([(0.285,), (-1.005,), (2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(dec_round("v", 2)).collect()] == [0.29, -1.01, 2.5, None]


def test_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, 0.25, None]
    assert [r[0] for r in df.select(guard_zero("b")).collect()] == [1.0, 4.0, 1.0]
    assert df.agg(exact_avg("a", 2)).first()[0] == 1.0


def test_silver_bars_drops_and_dedups(spark):
    raw = spark.createDataFrame(
        [
            ("PETR4.SA", "2024-01-02", 10.004, 11.0, 9.0, 10.5, 100, 0.0, 0.0, "2024-01-03"),
            ("PETR4.SA", "2024-01-02", 10.004, 11.0, 9.0, 10.6, 100, 0.0, 0.0, "2024-01-04"),
            ("XXXX3.SA", "2024-01-02", 0.0, 1.0, 0.0, 1.0, 5, 0.0, 0.0, "2024-01-04"),
            ("VALE3.SA", "2024-01-02", 1.0, 1.0, 1.0, None, 5, 0.0, 0.0, "2024-01-04"),
            ("VALE3.SA", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 0, 0.0, 0.0, "2024-01-04"),
        ],
        "ticker string, date string, open double, high double, low double, close double, volume long, "
        "dividends double, stock_splits double, data_extracao string",
    )
    got = {r["ticker"]: r for r in silver.silver_bars(raw, "2024-01-05").collect()}
    assert set(got) == {"PETR4.SA", "XXXX3.SA"}
    petr = got["PETR4.SA"]
    assert (petr["open"], petr["close"], petr["variacao_diaria_pct"], petr["amplitude_diaria"]) == (10.0, 10.6, 6.0, 2.0)
    assert (petr["empresa"], petr["setor"], petr["ano"], petr["trimestre"]) == ("Petrobras", "Commodities", 2024, 1)
    other = got["XXXX3.SA"]
    assert (other["empresa"], other["setor"], other["variacao_diaria_pct"]) == ("Desconhecido", "Outros", None)
    assert "dividends" not in petr.asDict()


def test_silver_yearly_needs_a_year(spark):
    with pytest.raises(ValueError):
        silver.silver_yearly(spark.createDataFrame([(1.0,)], "valor double"), "2024-01-01")
    df = spark.createDataFrame([("2020", 1.23456), ("total", 1.0), ("2021", None)], "data string, valor double")
    assert [(r["ano"], r["valor"]) for r in silver.silver_yearly(df, "2024-01-01").collect()] == [(2020, 1.2346)]
