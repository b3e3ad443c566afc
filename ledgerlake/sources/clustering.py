"""Files clustered by several columns at once, along a Z-shaped curve through their ranks.

Sorting by one column leaves the others scattered over all files. Here each column is cut into ranks of about equal size, the
bits of the ranks are interleaved, and rows are range-partitioned by the result: a file covers a small box, so its minima and
maxima are narrow in every column and a filter on any of them skips files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a rank; a curve over up to eight columns fits a bigint.
BITS = 7


def as_number(df: DataFrame, col: str) -> Column:
    """A column as a number in the same order; strings by their first six bytes."""
    kind = dict(df.dtypes)[col]
    value = F.col(f"`{col}`")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def rank_bounds(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """Per column the values that part its ranks, from one approximate aggregate: 2^bits - 1 numbers each."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(as_number(df, c), shares, 20 * parts) for c in cols]).first()
    return [list(bounds) if bounds else [0.0] * (parts - 1) for bounds in found]


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number from the bits of all ranks, the highest bits of each first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return out


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``_z``; ranks are columns on the way, so that halving does not repeat itself in the plan."""
    if not 0 < len(cols) <= 63 // bits:
        raise ValueError(f"between 1 and {63 // bits} columns")
    bounds = rank_bounds(df, cols, bits)
    names = [f"_rank{i}" for i in range(len(cols))]
    for name, col, held in zip(names, cols, bounds):
        number = f"{name}_of"
        df = df.withColumn(number, as_number(df, col)).withColumn(name, F.lit(0))
        values = F.array(*[F.lit(float(b)) for b in held])
        for step in (1 << i for i in reversed(range(bits))):
            up = F.col(number) >= F.element_at(values, (F.col(name) + step).cast("int"))
            df = df.withColumn(name, F.col(name) + F.when(up, step).otherwise(0))
        df = df.drop(number)
    return df.withColumn("_z", interleaved([F.col(n) for n in names], bits)).drop(*names)


def rewrite_zordered(df: DataFrame, path: str, cols: Sequence[str], n_files: int, bits: int = BITS) -> None:
    """Compact into about ``n_files`` files, clustered by all of ``cols``.

    A row hash follows the curve in the range key, so a box that holds a large part of the rows is cut over files too.
    """
    (
        zorder_key(df, cols, bits)
        .withColumn("_spread", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        .repartitionByRange(n_files, "_z", "_spread")
        .sortWithinPartitions("_z")
        .drop("_z", "_spread")
        .write.mode("errorifexists")
        .parquet(path)
    )
