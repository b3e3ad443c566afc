"""Column builders. All of them are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
}

# Doubles are summed as decimals: exact, so a result does not depend on task order.
SUM_TYPE = "decimal(28,10)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec_round(c, digits: int) -> Column:
    """Round half up on the decimal reading of the value, returned as double.

    One rounding step only: reading the value at a fixed scale first would round it twice.
    """
    return F.round(_col(c), digits).cast("double")


def dec_sum(c, digits: int = 2) -> Column:
    """Exact sum of a money column, rounded, as double."""
    return F.round(F.sum(_col(c).cast(SUM_TYPE)), digits).cast("double")


def exact_avg(c, digits: int | None = None) -> Column:
    """Mean from an exact decimal sum; independent of the order rows arrive in."""
    c = _col(c)
    mean = F.try_divide(F.sum(c.cast(SUM_TYPE)).cast("double"), F.count(c))
    return mean if digits is None else dec_round(mean, digits)


def safe_div(a, b) -> Column:
    """a / b as double, NULL when b is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def guard_zero(c) -> Column:
    """The value, or 1 where it is zero (for use as a divisor)."""
    c = _col(c)
    return F.when(c == 0, 1).otherwise(c)


def band(c, cuts: Iterable[tuple], default, null_label=None) -> Column:
    """First label whose (operator, limit) holds; NULL input falls to the default.

    ``null_label`` gives NULL inputs a label of their own instead.
    """
    c = _col(c)
    out = F.when(c.isNull(), F.lit(null_label)) if null_label is not None else None
    for op, limit, label in cuts:
        cond, value = _OPS[op](c, F.lit(limit)), F.lit(label)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def label_map(c, mapping: Mapping, default) -> Column:
    """Small constant lookup as an expression: no join, unknown and NULL give the default."""
    c = _col(c)
    out = None
    for key, value in mapping.items():
        cond = c == F.lit(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def flag(pred) -> Column:
    """Boolean flag: an unknown predicate counts as false."""
    pred = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(pred, F.lit(False))


def compare_label(a, b, labels: tuple[str, str, str]) -> Column:
    """labels[0] where a > b, labels[1] where a < b, else labels[2] (also for NULL)."""
    a, b = _col(a), _col(b)
    return F.when(a > b, labels[0]).when(a < b, labels[1]).otherwise(labels[2])


def count_where(pred) -> Column:
    return F.count(F.when(pred, F.lit(1)))


def sum_where(pred, c) -> Column:
    """sum(when(pred, c) else 0), exact for money columns (decimal result)."""
    return F.coalesce(F.sum(F.when(pred, _col(c).cast(SUM_TYPE))), F.lit(0).cast("decimal(38,10)"))


def signed_sum(pred, c) -> Column:
    """Rows meeting ``pred`` count positive, every other row negative."""
    c = _col(c)
    return F.sum(F.when(pred, c).otherwise(-c))


def null_count(c) -> Column:
    return F.count(F.when(_col(c).isNull(), F.lit(1)))


def share_pct(part, whole, digits: int = 2) -> Column:
    """part / whole in percent, NULL on an empty whole."""
    return dec_round(safe_div(_col(part).cast("double") * 100, whole), digits)
