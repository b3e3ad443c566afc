"""Aggregates kept up to date from row changes: inserts, updates and deletes.

A change counts with a sign: a row that came +1, a row that went -1 (an update is both). Counts and sums of a group follow
from the signed sums of its changes alone. A least or greatest value also does, unless the value that held it
went: only such groups are looked up again in the current rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import SUM_TYPE
from ..sources.scratch import stage
from ..sources.snapshots import CHANGE_TYPE, DELETE, INSERT, POSTIMAGE, PREIMAGE

#: Every kind of change; ``changes_since`` has to be asked for all of them, with their kind.
ALL_CHANGES = (INSERT, PREIMAGE, POSTIMAGE, DELETE)
COUNT = "registros"


@dataclass(frozen=True)
class Totals:
    """What is kept per group: its rows, exact sums (NULL if no value is known), least and greatest values."""

    by: Sequence[str]
    sums: Sequence[str] = ()
    extremes: Sequence[str] = ()

    @property
    def columns(self) -> list[str]:
        sums = [f"{kind}_{c}" for c in self.sums for kind in ("soma", "n")]
        return [*self.by, COUNT, *sums, *[f"{kind}_{c}" for c in self.extremes for kind in ("min", "max")]]


def _exact(col: Column) -> Column:
    return col.cast(SUM_TYPE)


def _wide(col: Column) -> Column:
    return col.cast("decimal(38,10)")


def totals_of(df: DataFrame, spec: Totals) -> DataFrame:
    """The totals from all rows."""
    return df.groupBy(*spec.by).agg(
        F.count(F.lit(1)).alias(COUNT),
        *[x for c in spec.sums for x in (_wide(F.sum(_exact(F.col(c)))).alias(f"soma_{c}"), F.count(c).alias(f"n_{c}"))],
        *[x for c in spec.extremes for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))],
    )


def signed_totals(changes: DataFrame, spec: Totals, kind: str = CHANGE_TYPE) -> DataFrame:
    """Per group touched: signed counts and sums, and the extremes of rows that came (``min_``) and went (``-min_``)."""
    came = F.col(kind).isin(INSERT, POSTIMAGE)
    sign = F.when(came, 1).otherwise(-1)
    aggs = [F.sum(sign).alias(COUNT)]
    for c in spec.sums:
        aggs += [
            _wide(F.coalesce(F.sum(_exact(F.when(came, F.col(c)))), F.lit(0)) - F.coalesce(F.sum(_exact(F.when(~came, F.col(c)))), F.lit(0))).alias(f"soma_{c}"),
            F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}"),
        ]
    for c in spec.extremes:
        for name, fn in (("min", F.min), ("max", F.max)):
            aggs += [fn(F.when(came, F.col(c))).alias(f"{name}_{c}"), fn(F.when(~came, F.col(c))).alias(f"-{name}_{c}")]
    return changes.groupBy(*spec.by).agg(*aggs)


def maintain(state: DataFrame | None, changes: DataFrame, spec: Totals, current: DataFrame) -> DataFrame:
    """The totals after ``changes`` (all kinds, with their kind), from the totals before them.

    ``current`` are the rows after the changes. It is read only if an extreme went, and then only for those groups.
    Groups without changes pass through; groups without rows go. Group columns may be NULL.
    """
    delta = stage(signed_totals(changes, spec), "signed-totals")
    if state is None:
        state = totals_of(current.limit(0), spec)
    touched = [F.col(f"d.{c}") for c in spec.by]
    old, new = state.select(*spec.columns).alias("s"), delta.alias("d")
    on = [F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")) for c in spec.by]
    untouched = old.join(new, on, "left_anti")
    joined = new.join(old, on, "left").where(F.col(f"d.{COUNT}") + F.coalesce(f"s.{COUNT}", F.lit(0)) > 0)

    def total(c: str) -> Column:
        return F.coalesce(F.col(f"s.{c}"), F.lit(0)) + F.col(f"d.{c}")

    columns = [total(COUNT).alias(COUNT)]
    for c in spec.sums:
        columns += [F.when(total(f"n_{c}") > 0, _wide(total(f"soma_{c}"))).alias(f"soma_{c}"), total(f"n_{c}").alias(f"n_{c}")]
    gone = F.lit(False)
    for c in spec.extremes:
        for name, best in (("min", F.least), ("max", F.greatest)):
            held, came, went = (F.col(x) for x in (f"s.{name}_{c}", f"d.{name}_{c}", f"d.`-{name}_{c}`"))
            now = best(held, came)
            columns.append(now.alias(f"{name}_{c}"))
            # a value as good as the best went, which may also be one that came with these changes
            gone = gone | F.coalesce(best(went, now) == went, F.lit(False))
    merged = stage(joined.select(*touched, *columns, gone.alias("_gone")), "merged-totals")
    out = untouched.unionByName(merged.where("not _gone").drop("_gone"))
    lost = merged.where("_gone")
    if not spec.extremes or lost.isEmpty():
        return out
    again = current.alias("c").join(lost.select(*spec.by).alias("g"), [F.col(f"c.{c}").eqNullSafe(F.col(f"g.{c}")) for c in spec.by], "left_semi")
    found = totals_of(again, spec).alias("f")
    repaired = lost.alias("l").join(found, [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in spec.by], "left").select(
        *[F.col(f"{'f' if c.startswith(('min_', 'max_')) and c[4:] in spec.extremes else 'l'}.{c}").alias(c) for c in spec.columns]
    )
    return out.unionByName(repaired)
