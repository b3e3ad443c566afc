"""Quality checks, table metrics, profiles, drift, alerts and gated publishing.

All row-level checks of a table are folded into one aggregation over one scan.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import presets
from ..functions import count_where, dec_round, null_count, safe_div
from ..sources.readers import validate_payload
from ..sources.scratch import stage
from ..sources.snapshots import write_snapshot
from ..sources.tables import mark_written, path_exists
from .joins import latest_slice

log = logging.getLogger(__name__)

REPORT = "verificacao string, coluna string, valor double, limite double, ok boolean"


class DataQualityError(Exception):
    pass


class SchemaDriftError(DataQualityError):
    pass


def _literal_rows(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), schema)


def check_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per required column: present or not. Reads the schema only."""
    have = set(df.columns)
    return _literal_rows(df, [(c, c in have) for c in cols], "coluna string, presente boolean")


def check_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Columns that are extra, missing or of another type than ``typeName()`` expected."""
    actual = {f.name: f.dataType.typeName() for f in df.schema.fields}
    rows = [(c, "extra", None, t) for c, t in actual.items() if c not in expected]
    rows += [(c, "ausente", t, None) for c, t in expected.items() if c not in actual]
    rows += [(c, "tipo", t, actual[c]) for c, t in expected.items() if c in actual and actual[c] != t]
    return _literal_rows(df, rows, "coluna string, problema string, esperado string, atual string")


def _outside(col: str, lo, hi) -> Column:
    return count_where((F.col(col) < lo) | (F.col(col) > hi))


def _not_allowed(col: str, values: Sequence[Any]) -> Column:
    return count_where(~F.col(col).isin(list(values)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that repeat."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    n = count_where(F.col("_n") > 1)
    return per_key.agg(n.alias("chaves_repetidas"), (n == 0).alias("ok"))


def _stack(one_row: DataFrame, cells: Sequence[tuple[Column, ...]], names: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate into one row per cell."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(cell, names)]) for cell in cells]
    return one_row.select(F.inline(F.array(*structs)))


def check_nulls(df: DataFrame, max_pct: float = 0.05) -> DataFrame:
    """NULL share per column; more than ``max_pct`` fails, an empty table passes."""
    counts = df.agg(F.count("*").alias("_rows"), *[null_count(c).alias(c) for c in df.columns])
    share = lambda c: F.coalesce(safe_div(F.col(c), F.col("_rows")), F.lit(0.0))
    cells = [(F.lit(c), F.col(c), share(c), share(c) <= max_pct) for c in df.columns]
    return _stack(counts, cells, ("coluna", "nulos", "pct_nulos", "ok"))


def check_rows(df: DataFrame, n: int = 1) -> DataFrame:
    return df.agg(F.count("*").alias("total")).select("total", (F.col("total") >= n).alias("ok"))


def check_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Values outside [lo, hi]; NULL passes."""
    n = _outside(col, lo, hi)
    return df.agg(n.alias("fora"), (n == 0).alias("ok"))


def check_allowed(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    """Values not in the list; NULL passes."""
    n = _not_allowed(col, values)
    return df.agg(n.alias("invalidos"), (n == 0).alias("ok"))


class _Plan(NamedTuple):
    """Checks as aggregates over all rows, sums of these over keys, and the cells of the report."""

    measures: dict[str, Column]
    second: dict[str, Column]
    cells: list[tuple[Column, ...]]
    unique_on: list[str] | None
    rows: str


def _planned(df: DataFrame, spec: Mapping[str, Mapping[str, Any]]) -> _Plan:
    measures: dict[str, Column] = {}
    second: dict[str, Column] = {}
    cells: list[tuple[Column, ...]] = []
    unique_on = None

    def measure(col: Column) -> str:
        name = f"_m{len(measures)}"
        measures[name] = col.alias(name)
        second[name] = F.sum(name).alias(name)
        return name

    def cell(check: str, column: str | None, value: Column, limit: float | None, ok: Column) -> None:
        cells.append((
            F.lit(check),
            F.lit(column).cast("string"),
            value.cast("double"),
            F.lit(limit).cast("double"),
            F.coalesce(ok, F.lit(False)),
        ))

    def each(params):
        return params if isinstance(params, (list, tuple)) else [params]

    rows = measure(F.count("*"))
    for check, params in spec.items():
        if check == "completeness":
            for c in params["required_columns"]:
                cell(check, c, F.lit(float(c in df.columns)), 1.0, F.lit(c in df.columns))
        elif check == "schema_drift":
            problems = check_schema_problems(df, params["expected_schema"])
            cell(check, None, F.lit(float(len(problems))), 0.0, F.lit(not problems))
        elif check == "uniqueness":
            keys = params["key_column"]
            unique_on = [keys] if isinstance(keys, str) else list(keys)
            cell(check, ",".join(unique_on), F.col("_repeated"), 0.0, F.col("_repeated") == 0)
        elif check == "nulls":
            limit = params.get("max_null_percentage", 0.05)
            for c in df.columns:
                share = F.coalesce(safe_div(F.col(measure(null_count(c))), F.col(rows)), F.lit(0.0))
                cell(check, c, share, limit, share <= limit)
        elif check == "row_count":
            n = params.get("min_rows", 1)
            cell(check, None, F.col(rows), n, F.col(rows) >= n)
        elif check == "range":
            for p in each(params):
                bad = F.col(measure(_outside(p["column"], p["min_val"], p["max_val"])))
                cell(check, p["column"], bad, 0.0, bad == 0)
        elif check == "consistency":
            for p in each(params):
                bad = F.col(measure(_not_allowed(p["column"], p["allowed_values"])))
                cell(check, p["column"], bad, 0.0, bad == 0)
        else:
            log.warning("unknown check %s", check)
    return _Plan(measures, second, cells, unique_on, rows)


_REPORT = ("verificacao", "coluna", "valor", "limite", "ok")


def run_checks(df: DataFrame, spec: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Report of the requested checks, one row each, in the order given.

    Known checks: completeness, schema_drift, uniqueness, nulls, row_count, range,
    consistency (the last two take one mapping or a list). Others are only logged. With a
    uniqueness check the rows are first combined per key, so it is still a single scan.
    """
    plan = _planned(df, spec)
    if plan.unique_on:
        per_key = df.groupBy(*plan.unique_on).agg(*plan.measures.values())
        repeated = count_where(F.col(plan.rows) > 1).alias("_repeated")
        totals = per_key.agg(repeated, *plan.second.values()).fillna(0)
    else:
        totals = df.agg(*plan.measures.values())
    return _stack(totals, plan.cells, _REPORT)


def check_schema_problems(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    actual = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return [c for c in {**actual, **expected} if actual.get(c) != expected.get(c)]


def raise_on_fail(report: DataFrame) -> None:
    """Raise for the first failed check of a report (a few rows: one per check)."""
    for row in report.collect():
        if not row["ok"]:
            error = SchemaDriftError if row["verificacao"] == "schema_drift" else DataQualityError
            raise error(f"{row['verificacao']} {row['coluna'] or ''}: {row['valor']} (limite {row['limite']})")


def publish(df: DataFrame, path: str, ver, checks: Mapping[str, Mapping[str, Any]]) -> str:
    """Check first, then commit a new version; a failed check leaves the table as it was.

    The rows are persisted so that the checks and the write share one computation.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        raise_on_fail(run_checks(df, checks))
        return write_snapshot(df, path, ver)
    finally:
        df.unpersist()


def publish_observed(df: DataFrame, path: str, ver, checks: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Write a new version once, check what was written while it was, and commit it if all checks hold.

    The measures are gathered by the write itself, so the rows are neither kept nor computed twice. Only a check of
    uniqueness reads again, and of the written files no more than the key. Without its success marker a folder is no
    version: a table that fails leaves none, and the next attempt replaces it. Returns the report.
    """
    spark = df.sparkSession
    dest = f"{path.rstrip('/')}/ver={ver}"
    if path_exists(spark, f"{dest}/_SUCCESS"):
        raise FileExistsError(f"version {dest} already exists")
    plan = _planned(df, checks)
    seen = Observation()
    df.observe(seen, *plan.measures.values()).write.mode("overwrite").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(dest)
    values = seen.get
    totals = spark.range(1).select(*[F.lit(values[name]).cast("double").alias(name) for name in plan.measures])
    if plan.unique_on:
        keys = spark.read.schema(df.schema).parquet(dest).groupBy(*plan.unique_on).agg(F.count("*").alias("_n"))
        totals = totals.withColumn("_repeated", F.lit(keys.where("_n > 1").count()))
    report = stage(_stack(totals, plan.cells, _REPORT), "report")
    raise_on_fail(report)
    mark_written(spark, dest)
    return report


def table_metrics(df: DataFrame, layer: str, table: str, asof: str, version: int = 0) -> DataFrame:
    """Rows, NULLs, duplicate rows and quality in percent from one scan.

    Rows are told apart by 128 bits of hash over their columns and their pattern of NULLs, so what is shuffled is
    a few numbers per distinct row, combined map-side first, and never the rows themselves.
    An empty table gives no row.
    """
    cols = df.columns
    empty = [F.col(c).isNull() for c in cols]
    nulls = reduce(lambda a, b: a + b, [e.cast("int") for e in empty])
    # hashes skip NULLs, so the pattern is hashed as well
    pattern = F.concat(*[F.when(e, "1").otherwise("0") for e in empty])
    marked = df.select(
        F.xxhash64(*cols, pattern).alias("_a"), F.xxhash64(pattern, *reversed(cols)).alias("_b"), nulls.alias("_nulls")
    )
    groups = marked.groupBy("_a", "_b").agg(F.count("*").alias("_n"), F.sum("_nulls").alias("_nulls"))
    totals = groups.agg(
        F.sum("_n").alias("total_registros"),
        F.sum("_nulls").alias("total_nulos"),
        (F.sum("_n") - F.count("*")).alias("total_duplicatas"),
    ).where(F.col("total_registros") > 0)
    quality = (1 - safe_div(F.col("total_nulos"), F.col("total_registros") * len(cols))) * 100
    return totals.select(
        F.lit(layer).alias("camada"),
        F.lit(table).alias("tabela"),
        F.lit(asof).alias("data_verificacao"),
        "total_registros",
        "total_nulos",
        "total_duplicatas",
        F.lit(version).cast("long").alias("versao_cdf"),
        dec_round(quality, 2).alias("qualidade_pct"),
    )


def monitor_all(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]], asof: str, versions: Mapping[str, int] | None = None
) -> DataFrame:
    """Metrics of tables named ``layer.table`` and the seconds each took; one that cannot be read or is empty is skipped.

    The result is appended to the history by the caller (``write_append``).
    """
    parts = []
    for name, df in tables.items():
        layer, table = name.split(".", 1)
        try:
            frame = df() if callable(df) else df
            row = table_metrics(frame, layer, table, asof, (versions or {}).get(name, 0))
            begun = time.monotonic()
            done = stage(row, "metrics")  # computed here, so a failure stays with its table
            parts.append(done.withColumn("tempo_seg", F.lit(round(time.monotonic() - begun, 3))))
        except Exception as exc:  # noqa: BLE001 - a broken table must not hide the others
            log.error("%s not monitored: %s", name, exc)
    if not parts:
        raise DataQualityError("no table could be monitored")
    return reduce(DataFrame.unionByName, parts)


def quality_status(metrics: DataFrame, latest_only: bool = True) -> DataFrame:
    """Status label per table: below 95 critical, below 99 or duplicates attention, else ok."""
    rows = latest_slice(metrics, "data_verificacao") if latest_only else metrics
    status = (
        F.when(F.col("qualidade_pct") < 95, presets.STATUS_CRITICAL)
        .when((F.col("qualidade_pct") < 99) | (F.col("total_duplicatas") > 0), presets.STATUS_ATTENTION)
        .otherwise(presets.STATUS_OK)
    )
    return rows.withColumn("status", status)


def alert_daily_count(df: DataFrame, day: str, cond: Column, more_than: int, by: Sequence[str] = ()) -> DataFrame:
    """Days (per group) on which more than ``more_than`` rows meet the condition."""
    counts = df.where(cond).groupBy(day, *by).agg(F.count("*").alias("ocorrencias"))
    return counts.where(F.col("ocorrencias") > more_than)


def quality_alerts(metrics: DataFrame, below: float = 99.0) -> DataFrame:
    return metrics.where(F.col("qualidade_pct") < below)


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct, min, max, mean and quartiles, in one aggregation.

    Distinct counts and quartiles are sketches unless ``exact`` asks for exact distincts
    (which then shuffles every column's values).
    """
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in _NUMERIC}
    aggs: list[Column] = [F.count("*").alias("_rows")]
    for c in cols:
        distinct = F.count_distinct(c) if exact else F.approx_count_distinct(c)
        aggs += [
            null_count(c).alias(f"{c}__n"),
            distinct.alias(f"{c}__d"),
            F.min(c).cast("string").alias(f"{c}__lo"),
            F.max(c).cast("string").alias(f"{c}__hi"),
        ]
        if c in numeric:
            aggs += [
                F.avg(c).alias(f"{c}__avg"),
                F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75]).alias(f"{c}__q"),
            ]
    nothing = F.lit(None).cast("double")

    def quartile(c: str, i: int) -> Column:
        return F.col(f"{c}__q")[i] if c in numeric else nothing

    cells = [
        (
            F.lit(c), F.col("_rows"), F.col(f"{c}__n"), F.col(f"{c}__d"), F.col(f"{c}__lo"), F.col(f"{c}__hi"),
            F.col(f"{c}__avg") if c in numeric else nothing, quartile(c, 0), quartile(c, 1), quartile(c, 2),
        )
        for c in cols
    ]
    names = ("coluna", "registros", "nulos", "distintos", "minimo", "maximo", "media", "q25", "q50", "q75")
    return _stack(df.agg(*aggs), cells, names)


_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def drift(old: DataFrame, new: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Per column: change of NULL share, of the mean (numbers) and total-variation distance (categories).

    One aggregation over both sides gives the statistics, a second one the category counts per
    (column, value); a dominant value is combined before the shuffle.
    """
    cols = [*numbers, *categories]
    both = old.select(*cols, F.lit(0).alias("_side")).unionByName(new.select(*cols, F.lit(1).alias("_side")))
    sides = (0, 1)

    def on(side: int, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    aggs = [F.count(on(s, F.lit(1))).alias(f"_rows{s}") for s in sides]
    for c in cols:
        aggs += [F.count(on(s, F.col(c))).alias(f"{c}__n{s}") for s in sides]
    for c in numbers:
        aggs += [F.avg(on(s, F.col(c))).alias(f"{c}__avg{s}") for s in sides]
    nothing = F.lit(None).cast("double")

    def null_share(c: str, s: int) -> Column:
        return 1 - safe_div(F.col(f"{c}__n{s}"), F.col(f"_rows{s}"))

    cells = [
        (
            F.lit(c),
            null_share(c, 1) - null_share(c, 0),
            F.col(f"{c}__avg1") - F.col(f"{c}__avg0") if c in numbers else nothing,
        )
        for c in cols
    ]
    stats = _stack(both.agg(*aggs), cells, ("coluna", "delta_pct_nulos", "delta_media"))
    if not categories:
        return stats.withColumn("distancia_tv", nothing).withColumn("delta_distintos", F.lit(None).cast("long"))
    long = both.select(
        "_side",
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("_v")) for c in categories
        ])),
    ).where(F.col("_v").isNotNull())
    per_value = long.groupBy("coluna", "_v").agg(
        *[F.count(on(s, F.lit(1))).alias(f"_c{s}") for s in sides]
    )
    sums = per_value.groupBy("coluna").agg(*[F.sum(f"_c{s}").alias(f"_t{s}") for s in sides])
    # one row per category column, hence the broadcast
    shares = per_value.join(F.broadcast(sums), "coluna").groupBy("coluna").agg(
        (F.sum(F.abs(
            F.coalesce(safe_div(F.col("_c1"), F.col("_t1")), F.lit(0.0))
            - F.coalesce(safe_div(F.col("_c0"), F.col("_t0")), F.lit(0.0))
        )) / 2).alias("distancia_tv"),
        (count_where(F.col("_c1") > 0) - count_where(F.col("_c0") > 0)).alias("delta_distintos"),
    )
    return stats.join(F.broadcast(shares), "coluna", "left")


def split_quarantine(df: DataFrame, payload: str, **spec) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows whose payload passes, and the others with reason and raw text."""
    checked = validate_payload(df, payload, **spec)
    good = checked.where("valido").drop("valido", "motivo")
    return good, checked.where(~F.col("valido")).drop("valido")


