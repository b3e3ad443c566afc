"""Reports over a run log: task_id, dag_id, state, execution_date, start_date, end_date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import count_where, dec_round, safe_div
from ..operators.joins import latest_slice
from ..operators.sets import top_k


def _since(df: DataFrame, since, like: str | None) -> DataFrame:
    out = df.where(F.col("execution_date") >= F.lit(since)) if since is not None else df
    return out.where(F.col("task_id").like(like)) if like else out


def _success_pct() -> Column:
    return dec_round(safe_div(count_where(F.col("state") == "success") * F.lit(100.0), F.count("*")), 2)


def _micros() -> Column:
    return F.unix_micros(F.col("end_date").cast("timestamp")) - F.unix_micros(F.col("start_date").cast("timestamp"))


def duration_minutes() -> Column:
    return _micros() / F.lit(60_000_000.0)


def success_rate(runs: DataFrame, since=None, like: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Share of successful runs in percent since a point in time, overall or per group."""
    rows = _since(runs, since, like)
    agg = (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.count("*").alias("execucoes"), _success_pct().alias("taxa_sucesso_pct")
    )
    return agg


def run_durations(runs: DataFrame, since=None, like: str | None = None, by: str = "task_id") -> DataFrame:
    """Runs, mean and longest duration in minutes per task (or pipeline)."""
    rows = _since(runs, since, like).where(F.col("end_date").isNotNull()).withColumn("_d", _micros())
    minute = F.lit(60_000_000.0)
    return rows.groupBy(by).agg(
        F.count("*").alias("execucoes"),
        dec_round(safe_div(F.sum("_d"), F.count("*")) / minute, 4).alias("duracao_media_min"),
        dec_round(F.max("_d") / minute, 4).alias("duracao_maxima_min"),
    )


def last_run(runs: DataFrame, like: str | None = None) -> DataFrame:
    """Tasks of the latest execution with their duration, longest first."""
    rows = latest_slice(_since(runs, None, like), "execution_date")
    return rows.select("task_id", dec_round(duration_minutes(), 4).alias("duracao_min")).orderBy(
        F.desc("duracao_min"), "task_id"
    )


def longest_runs(runs: DataFrame, since=None, k: int = 10) -> DataFrame:
    rows = _since(runs, since, None).where(F.col("end_date").isNotNull())
    timed = rows.select(
        "task_id", "dag_id", "execution_date", dec_round(duration_minutes(), 4).alias("duracao_min")
    )
    return top_k(timed, [F.desc("duracao_min"), "task_id", "dag_id", "execution_date"], k)


def run_failures(runs: DataFrame, since=None, like: str | None = None, k: int | None = None) -> DataFrame:
    """Failed runs per task, most failures first."""
    rows = _since(runs, since, like).where(F.col("state") == "failed")
    counts = rows.groupBy("task_id").agg(F.count("*").alias("falhas"))
    order = [F.desc("falhas"), "task_id"]
    return top_k(counts, order, k) if k else counts.orderBy(*order)


def runs_per(runs: DataFrame, unit: str, since=None, like: str | None = None) -> DataFrame:
    """Runs and failures per hour or day."""
    return (
        _since(runs, since, like)
        .groupBy(F.date_trunc(unit, "execution_date").alias("periodo"))
        .agg(F.count("*").alias("execucoes"), count_where(F.col("state") == "failed").alias("falhas"))
    )


def state_counts(runs: DataFrame, since=None) -> DataFrame:
    return _since(runs, since, None).groupBy("state").agg(F.count("*").alias("execucoes"))


def layer_of(col: str, layers=tuple(presets.TASK_LAYERS), default: str = presets.TASK_LAYER_DEFAULT) -> Column:
    out = None
    for prefix, label in layers:
        cond = F.col(col).startswith(prefix)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def tasks_by_layer(runs: DataFrame, layers=tuple(presets.TASK_LAYERS), latest_only: bool = True) -> DataFrame:
    """Tasks and failures per layer, read from the task-id prefix."""
    rows = latest_slice(runs, "execution_date") if latest_only else runs
    return rows.groupBy(layer_of("task_id", layers).alias("camada")).agg(
        F.count("*").alias("tarefas"), count_where(F.col("state") == "failed").alias("falhas")
    )
