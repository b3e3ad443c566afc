"""Sorting for display, top-k, unions and set differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .joins import guarded_join


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def rank_of(col: str, order: Sequence[str]) -> Column:
    """Position of a label in ``order`` (1-based); labels not listed come last."""
    rank = reduce(
        lambda acc, item: acc.when(F.col(col) == item[1], item[0] + 1),
        enumerate(order[1:], start=1),
        F.when(F.col(col) == order[0], 1),
    )
    return rank.otherwise(len(order) + 1)


def sort_by_rank(df: DataFrame, col: str, order: Sequence[str], *then: Column | str) -> DataFrame:
    return df.orderBy(rank_of(col, order), *then)


def union_layers(layers: Mapping[str, DataFrame], label: str = "camada") -> DataFrame:
    """Union of differently shaped tables, missing columns NULL, tagged with the layer name."""
    tagged = [df.select(F.lit(name).alias(label), "*") for name, df in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def reconcile_counts(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row groups whose multiplicity differs, with both counts: one aggregation for both sides.

    Equal rows are collapsed before the shuffle, so a row repeated very often stays cheap.
    """
    cols = list(cols or a.columns)
    both = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    sums = both.groupBy(*cols).agg(F.sum("_a").alias("em_a"), F.sum("_b").alias("em_b"))
    return sums.where(F.col("em_a") != F.col("em_b"))


def _replicate(df: DataFrame, count: Column, cols: Sequence[str], chunk: int = 1_000_000) -> DataFrame:
    """``count`` copies of each row. Large counts are cut into chunks that are spread over tasks."""
    parts = df.select(*cols, count.alias("_n")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk)))
    )
    size = F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_part") * chunk)
    spread = parts.hint("rebalance")
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(*cols)


def reconcile(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (with multiplicity) only in ``a`` and only in ``b``."""
    cols = list(cols or a.columns)
    counts = reconcile_counts(a, b, cols)
    surplus = F.col("em_a") - F.col("em_b")
    return (
        _replicate(counts.where(surplus > 0), surplus, cols),
        _replicate(counts.where(surplus < 0), -surplus, cols),
    )


def leaf_sums(df: DataFrame, keys: Sequence[str], cols: Sequence[str], leaves: int, window: Column | None = None) -> DataFrame:
    """Per leaf (window and slot of the key): rows and order-free sums of their hashes, combined in the tasks."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(leaves))
    pattern = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])  # hashes skip NULLs
    marked = df.select(
        (window if window is not None else F.lit(None).cast("string")).cast("string").alias("janela"), slot.alias("faixa"),
        F.xxhash64(pattern, *cols).alias("_x"), F.xxhash64(*reversed(cols), pattern).alias("_y"),
    )
    wide = "decimal(38,0)"
    return marked.groupBy("janela", "faixa").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_x").cast("decimal(20,0)")).cast(wide).alias("x"), F.sum(F.col("_y").cast("decimal(20,0)")).cast(wide).alias("y")
    )


def differing_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """Leaves whose sums differ."""
    both = a.select("janela", "faixa", "n", "x", "y").unionByName(b.select("janela", "faixa", *[(-F.col(c)).alias(c) for c in ("n", "x", "y")]))
    off = lambda df: df.where((F.col("n") != 0) | (F.col("x") != 0) | (F.col("y") != 0))
    return off(both.groupBy("janela", "faixa").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y")])).select("janela", "faixa")


def reconcile_tree(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None, leaves: int = 4096, window: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows only in ``a``, rows only in ``b`` (with multiplicity), and the leaves in which they are.

    Both sides are summed up per leaf, a slot of the key within a window of time, say; only rows of leaves whose
    sums differ are compared. Equal tables shuffle sums alone. Sums are of two hashes of 64 bits: unequal leaves pass
    for equal with a chance of about 2^-128.
    """
    cols = list(cols or a.columns)
    found = stage(differing_leaves(leaf_sums(a, keys, cols, leaves, window), leaf_sums(b, keys, cols, leaves, window)), "leaves")
    if found.isEmpty():
        return a.select(*cols).limit(0), b.select(*cols).limit(0), found
    # at most one row per window and slot; their number is counted before it is hinted
    n = found.count()

    def within(df: DataFrame) -> DataFrame:
        leaf = df.withColumns({
            "_janela": (window if window is not None else F.lit(None).cast("string")).cast("string"), "_faixa": F.pmod(F.xxhash64(*keys), F.lit(leaves)),
        })
        on = F.col("_janela").eqNullSafe(F.col("janela")) & (F.col("_faixa") == F.col("faixa"))
        return guarded_join(leaf, found, on, "left_semi", rows=n).select(*cols)

    only_a, only_b = reconcile(within(a), within(b), cols)
    return only_a, only_b, found
