"""Joins, dedup and lookups."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import label_map

#: Rows that a side with a proven bound may have to be broadcast.
BROADCAST_ROWS = 500_000


def guarded_join(
    fact: DataFrame, dim: DataFrame, on, how: str = "left", rows: int | None = None, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``dim`` only where the caller proves that it has at most ``rows`` rows, and these are within ``max_rows``.

    A bound follows from how a side is made: a limit, a fixed list, one row per value of a bounded list, or a count of
    a stored table. Without one, or beyond the limit, the join carries no hint: the planner broadcasts by the size of
    the files it reads, and AQE by measured sizes; else it shuffles, and AQE splits a key that holds a large part of ``fact``.
    """
    if rows is not None and rows <= max_rows:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


def join_left_reject(left: DataFrame, right: DataFrame, on, value: str) -> DataFrame:
    """Left join whose rows without ``value`` are dropped; the planner turns it into an inner join."""
    return left.join(right, on, "left").dropna(subset=[value])


def latest_slice(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` has its maximum."""
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def having_keys(df: DataFrame, keys: Sequence[str], more_than: int = 1) -> DataFrame:
    """Rows of the keys that occur more than ``more_than`` times (semi join)."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > more_than)
    return df.join(repeated.select(*keys), list(keys), "left_semi")


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one greatest by ``order_by``, remaining columns breaking ties.

    An aggregate, not a window: each task keeps one candidate per key before the shuffle, so
    a key with very many copies never meets in one place.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def map_codes(
    df: DataFrame, col: str, mapping: Mapping | DataFrame, out: str, default: str
) -> DataFrame:
    """Code -> label. A dict becomes an expression; a table (code, label) is a guarded join."""
    if isinstance(mapping, Mapping):
        return df.withColumn(out, label_map(col, mapping, default))
    code, label = mapping.columns
    table = mapping.select(F.col(code).alias(col), F.col(label).alias(out))
    return guarded_join(df, table, col, "left").withColumn(out, F.coalesce(out, F.lit(default)))


def scd2_asof_join(
    events: DataFrame,
    hist: DataFrame,
    key: str,
    ts: str,
    start: str = "data_inicio",
    end: str = "data_fim",
    slot_days: int = 30,
) -> DataFrame:
    """Attributes valid on the event's date: ``start <= date < end``, no match gives NULLs.

    Time is cut into slots. Versions are first matched with the (key, slot) pairs that have
    events, which are few whatever the number of events; the events then join on (key, slot).
    A key with very many events is thereby spread over its slots.
    """
    slot = F.floor(F.unix_date(F.col(ts).cast("date")) / slot_days)
    ev = events.withColumn("_slot", slot)
    slots = ev.select(key, "_slot").where(F.col("_slot").isNotNull()).distinct()
    first_day = F.date_from_unix_date((F.col("_slot") * slot_days).cast("int"))
    next_day = F.date_from_unix_date(((F.col("_slot") + 1) * slot_days).cast("int"))
    versions = slots.join(hist, key).where((F.col(start) < next_day) & (F.col(end) > first_day))
    day = F.col(f"e.{ts}").cast("date")
    attrs = [F.col(f"v.{c}") for c in hist.columns if c != key]
    return (
        ev.alias("e")
        .join(
            versions.alias("v"),
            (F.col(f"e.{key}") == F.col(f"v.{key}"))
            & (F.col("e._slot") == F.col("v._slot"))
            & (F.col(f"v.{start}") <= day)
            & (day < F.col(f"v.{end}")),
            "left",
        )
        .select(*[F.col(f"e.{c}") for c in events.columns], *attrs)
    )


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """Physical plan text as ``explain`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def explain_has(df: DataFrame, text: str) -> bool:
    return text in plan_text(df)


def having_count(df: DataFrame, keys: Sequence[str], cond: Column, n: str = "n") -> DataFrame:
    """Group sizes that meet ``cond``."""
    return df.groupBy(*keys).agg(F.count("*").alias(n)).where(cond)
