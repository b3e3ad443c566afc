"""Bronze -> silver: typed, enriched, deduplicated tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import band, dec_round, mask_name, safe_div, salted_sha256
from ..operators.joins import dedup_latest, map_codes
from ..sources.readers import tag_extract

DATE_PARTS = {"ano": F.year, "mes": F.month, "trimestre": F.quarter}


def with_date_parts(df: DataFrame, date: str, parts=("ano", "mes", "trimestre")) -> DataFrame:
    return df.withColumns({p: DATE_PARTS[p](date) for p in parts})


def silver_bars(
    df: DataFrame,
    asof: str,
    companies: Mapping | DataFrame = presets.COMPANIES,
    sectors: Mapping | DataFrame = presets.SECTORS,
    dedup: bool = True,
) -> DataFrame:
    """Market bars: rounded OHLC, daily change and range, company and sector.

    Each landing repeats past days, so the newest extract of a (date, ticker) wins, by landing day and then by
    extraction stamp. Bars without a close or without volume are dropped after that: a correction to
    nothing does not bring the older bar back.
    """
    out = df.withColumn("date", F.to_date("date"))
    if dedup:
        newest = [c for c in ("extracao", "data_extracao") if c in df.columns]
        out = dedup_latest(out, ["date", "ticker"], newest)
    out = out.where(F.col("close").isNotNull() & (F.col("volume") > 0)).drop("extracao")
    out = with_date_parts(out, "date").withColumns({c: dec_round(c, 2) for c in ("open", "high", "low", "close")})
    change = safe_div(F.col("close") - F.col("open"), F.col("open")) * 100
    out = out.withColumns({
        "variacao_diaria_pct": dec_round(change, 4),
        "amplitude_diaria": dec_round(F.col("high") - F.col("low"), 2),
    })
    out = map_codes(out, "ticker", companies, "empresa", presets.COMPANY_DEFAULT)
    out = map_codes(out, "ticker", sectors, "setor", presets.SECTOR_DEFAULT)
    return out.withColumn("data_processamento", F.lit(asof)).drop("dividends", "stock_splits")


def silver_series(df: DataFrame, asof: str, round_to: int = 6, fmt: str = "dd/MM/yyyy") -> DataFrame:
    """Long series: text dates parsed, values rounded, one row per (date, indicator)."""
    out = (
        df.withColumn("data", F.try_to_date("data", fmt))
        .withColumn("valor", dec_round("valor", round_to))
        .where(F.col("valor").isNotNull() & F.col("data").isNotNull())
    )
    newest = [c for c in ("extracao", "data_extracao") if c in df.columns]
    out = dedup_latest(out, ["data", "indicador"], newest)
    return with_date_parts(out, "data").withColumn("data_processamento", F.lit(asof)).drop("extracao")


def silver_yearly(df: DataFrame, asof: str) -> DataFrame:
    """Yearly indicators; the year column is ``ano`` or, in older extracts, ``data``."""
    source = next((c for c in ("ano", "data") if c in df.columns), None)
    if source is None:
        raise ValueError("no year column (ano or data) in the extract")
    return (
        df.withColumn("ano", F.expr(f"try_cast({source} as int)"))
        .withColumn("valor", dec_round("valor", 4))
        .withColumn("data_processamento", F.lit(asof))
        .where(F.col("valor").isNotNull() & F.col("ano").isNotNull())
    )


def bronze_customers(df: DataFrame, asof: str, salt: str | None = None, masked: str = "hash") -> DataFrame:
    """Raw customer rows -> pseudonymised bronze rows.

    ``masked`` chooses how the surname is hidden: ``hash`` (salted) or ``letters`` (S****).
    """
    surname: Column = salted_sha256("Surname", salt) if masked == "hash" else mask_name("Surname")
    shaped = df.withColumnsRenamed(presets.CUSTOMER_CSV).select(
        F.concat(F.lit("CLI"), F.col("CustomerId").cast("string")).alias("id_cliente"),
        salted_sha256("CustomerId", salt).alias("hash_cliente"),
        surname.alias("sobrenome_masked"),
        "score_credito", "pais", "genero", "idade", "anos_cliente", "saldo",
        band("saldo", presets.BALANCE_BAND, presets.BALANCE_BAND_DEFAULT).alias("faixa_saldo"),
        "num_produtos",
        band("score_credito", presets.RISK_PROFILE, presets.RISK_PROFILE_DEFAULT).alias("perfil_risco"),
        F.coalesce(F.col("IsActiveMember") == 1, F.lit(False)).alias("ativo"),
        F.coalesce(F.col("Exited") == 1, F.lit(False)).alias("churn"),
        "salario_estimado",
    )
    return tag_extract(shaped, asof)


def silver_customers(df: DataFrame, asof: str) -> DataFrame:
    return df.withColumns({
        "faixa_etaria": band("idade", presets.AGE_BAND, presets.AGE_BAND_DEFAULT),
        "score_categoria": band("score_credito", presets.SCORE_BAND, presets.SCORE_BAND_DEFAULT),
        "data_processamento": F.lit(asof),
    })


def silver_orders(df: DataFrame, asof: str) -> DataFrame:
    out = df.withColumn("data_ordem", F.to_date("data_ordem"))
    return with_date_parts(out, "data_ordem", ("ano", "mes")).withColumn("data_processamento", F.lit(asof))


def enrich_trades(
    df: DataFrame,
    stamp: str,
    volume_cuts=tuple(presets.VOLUME_ALERT),
    price_cuts=tuple(presets.PRICE_ALERT),
) -> DataFrame:
    """Decoded trades -> typed trades with value and alerts. Works on batch and stream."""
    ts = F.col("timestamp")
    typed = df.withColumn(
        "timestamp", F.try_to_timestamp(ts) if dict(df.dtypes)["timestamp"] == "string" else ts.cast("timestamp")
    )
    return typed.withColumns({
        "hora": F.hour("timestamp"),
        "minuto": F.minute("timestamp"),
        "valor_total": dec_round(F.col("preco") * F.col("quantidade"), 2),
        "alerta_volume": band("quantidade", volume_cuts, presets.NORMAL),
        "alerta_preco": band("preco", price_cuts, presets.NORMAL),
        "processado_em": F.lit(stamp),
    })
