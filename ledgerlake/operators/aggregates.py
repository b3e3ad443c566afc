"""Grouped summaries. Every aggregate here combines map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_where, dec_round, exact_avg, null_count, safe_div
from ..sources.scratch import stage


def pivot_series(df: DataFrame, key: str, names: Sequence[str], series: str = "indicador", value: str = "valor"):
    """Long -> wide, one column per named series.

    The names are given, so no extra job looks for them; a cell seen twice takes its largest
    value instead of whichever came first.
    """
    return df.where(F.col(series).isin(*names)).groupBy(key).pivot(series, list(names)).agg(F.max(value))


def share_of_total(df: DataFrame, by: Sequence[str], count: str, pct: str, digits: int, *aggs: Column) -> DataFrame:
    """Rows per group and their share of all rows in percent, next to further aggregates.

    The groups are written once; the total is then a second look at that small result, not at
    the input.
    """
    groups = stage(df.groupBy(*by).agg(F.count("*").alias(count), *aggs), "shares")
    total = groups.agg(F.sum(count)).scalar()
    share = dec_round(F.col(count) * F.lit(100.0) / total, digits)
    rest = [c for c in groups.columns if c not in by and c != count]
    return groups.select(*by, count, share.alias(pct), *rest)


def flag_rate(df: DataFrame, by: Sequence[str], flag: str, value: Column, names: tuple[str, str, str, str]) -> DataFrame:
    """Rows, flagged rows, flagged share in percent, mean of ``value`` over flagged rows (NULL if none)."""
    rows, flagged, rate, mean = names
    n = count_where(F.col(flag))
    return df.groupBy(*by).agg(
        F.count("*").alias(rows),
        n.alias(flagged),
        dec_round(safe_div(n * F.lit(100.0), F.count("*")), 2).alias(rate),
        exact_avg(F.when(F.col(flag), value), 4).alias(mean),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs of every column in one pass, plus rows and the sum of all NULLs."""
    counts = df.agg(F.count("*").alias("total_registros"), *[null_count(c).alias(c) for c in df.columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    return counts.withColumn("total_nulos", total)


def row_count(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: tabela, registros."""
    parts = [
        df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("tabela"), "registros")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_counts(tables: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per layer over all its tables."""
    parts = [
        table_counts(group).select(F.lit(layer).alias("camada"), "registros") for layer, group in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("camada").agg(
        F.sum("registros").alias("total_registros")
    )


def changed_share(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row against all keys, in percent.

    Counting rows per key first leaves one row per key, so both distinct counts are plain counts.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("versoes"))
    changed, total = count_where(F.col("versoes") > 1), F.count("*")
    return per_key.agg(
        changed.alias("clientes_mudaram"),
        total.alias("total_clientes"),
        dec_round(safe_div(changed * F.lit(100.0), total), 2).alias("pct_com_mudanca"),
    )
