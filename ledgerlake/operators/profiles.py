"""Column profiles that merge: sketches kept per day, read together without the rows, and the distance of two of them.

A profile row holds, per part (a day, say) and column, exact counts and extremes, a sketch of the distinct values and, for
numbers, a sketch of their distribution. Rows of several days merge into one of the same kind.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of the sketches: 2^12 registers (standard error 1.6 %), and ranks to about 1 %.
HLL_BITS = 12
KLL_K = 400
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 0.01

PROFILE = "coluna string, registros bigint, nulos bigint, minimo string, maximo string, distintos binary, distribuicao binary"
_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def profile_parts(df: DataFrame, cols: Sequence[str], part: str | None = None) -> DataFrame:
    """One row per value of ``part`` and column; all columns in one aggregation that combines in the tasks."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        numeric = types[c] in _NUMERIC
        as_number = F.col(c).cast("double")
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias(f"_d{i}"),
            (F.kll_sketch_agg_double(as_number, KLL_K) if numeric else F.max(F.lit(None).cast("binary"))).alias(f"_q{i}"),
        ]
    keys = [part] if part else []
    totals = df.groupBy(*keys).agg(*aggs)
    names = ("coluna", "registros", "nulos", "minimo", "maximo", "distintos", "distribuicao")
    cells = [
        F.struct(*[x.alias(n) for x, n in zip(
            (F.lit(c), F.col("_rows"), *[F.col(f"_{k}{i}") for k in ("n", "lo", "hi", "d", "q")]), names
        )])
        for i, c in enumerate(cols)
    ]
    return totals.select(*keys, F.inline(F.array(*cells)))


def merge_profiles(parts: DataFrame, by: Sequence[str] = ("coluna",), numeric: Sequence[str] = ()) -> DataFrame:
    """Profiles of several parts as one per column (and ``by``). ``numeric``: columns whose extremes compare as numbers."""
    number = F.col("coluna").isin(list(numeric)) if numeric else F.lit(False)

    def extreme(name: str, fn) -> Column:
        as_number = fn(F.when(number, F.struct(F.try_to_number(F.col(name), F.lit("S999999999999999999D9999999999")).alias("v"), F.col(name).alias("s"))))
        return F.coalesce(as_number["s"], fn(F.when(~number, F.col(name)))).alias(name)

    return parts.groupBy(*by).agg(
        F.sum("registros").alias("registros"), F.sum("nulos").alias("nulos"), extreme("minimo", F.min), extreme("maximo", F.max),
        F.hll_union_agg("distintos").alias("distintos"), F.kll_merge_agg_double("distribuicao").alias("distribuicao"),
    )


def read_profile(profile: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimates of a profile: distinct values and quantiles (NULL where there is no number)."""
    known = F.coalesce(F.kll_sketch_get_n_double("distribuicao"), F.lit(0)) > 0
    return profile.select(
        *[c for c in profile.columns if c not in ("distintos", "distribuicao")],
        F.hll_sketch_estimate("distintos").alias("distintos_aprox"),
        *[F.when(known, F.kll_sketch_get_quantile_double("distribuicao", F.lit(float(q)))).alias(f"q{round(q * 100)}") for q in shares],
    )


def distribution_drift(old: DataFrame, new: DataFrame, cells: int = 20) -> DataFrame:
    """Per numeric column the distance of two profiles: ``ks``, the greatest difference of ranks, and ``psi``.

    Both are taken at the old profile's quantiles, which part it into ``cells`` of equal weight; only sketches are read.
    """
    a = old.select("coluna", F.col("distribuicao").alias("_old"))
    b = new.select("coluna", F.col("distribuicao").alias("_new"))
    both = a.join(b, "coluna").where(
        (F.coalesce(F.kll_sketch_get_n_double("_old"), F.lit(0)) > 0) & (F.coalesce(F.kll_sketch_get_n_double("_new"), F.lit(0)) > 0)
    )
    shares = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    # ``cells`` numbers per column; a rank has to be asked for a literal
    cuts = both.select("coluna", F.kll_sketch_get_quantile_double("_old", shares).alias("at")).collect()

    def ranks_of(sketch: str, at: Sequence[float]) -> Column:
        return F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(float(x)) for x in at])), F.array(F.lit(1.0)))

    none = F.array().cast("array<double>")
    ranks = both.select("coluna", *[
        reduce(lambda rest, r: F.when(F.col("coluna") == r["coluna"], ranks_of(sketch, r["at"])).otherwise(rest), cuts, none).alias(name)
        for sketch, name in (("_old", "_a"), ("_new", "_b"))
    ])
    least = F.lit(1e-4)

    def share(col: str, i: int) -> Column:
        return F.greatest(F.col(col)[i + 1] - F.col(col)[i], least)

    psi = reduce(lambda x, y: x + y, [(share("_b", i) - share("_a", i)) * F.log(share("_b", i) / share("_a", i)) for i in range(cells)])
    ks = F.array_max(F.transform(F.arrays_zip("_a", "_b"), lambda z: F.abs(z["_a"] - z["_b"])))
    return ranks.select("coluna", ks.alias("ks"), psi.alias("psi"))
