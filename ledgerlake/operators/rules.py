"""Rule engine shared by batch and stream: a list of predicates becomes flags and a severity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import band, flag


class Rule(NamedTuple):
    """A flag column and the SQL predicate that raises it (NULL does not raise it)."""

    name: str
    predicate: str


DEFAULT_ORDER_RULES = [Rule(*r) for r in presets.ORDER_RULES.items()]
DEFAULT_TRADE_RULES = [Rule(*r) for r in presets.TRADE_RULES.items()]


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    bands: Sequence[tuple] = tuple(presets.SEVERITY),
    default: str = presets.NORMAL,
    review_at: int = 2,
    total: str = "total_alertas",
    severity: str = "score_fraude",
    review: str = "requer_revisao",
) -> DataFrame:
    """Add one boolean per rule, their sum, the severity label and the review flag."""
    flagged = df.withColumns({r.name: flag(r.predicate) for r in rules})
    points = reduce(lambda a, b: a + b, [F.col(r.name).cast("int") for r in rules], F.lit(0))
    return flagged.withColumn(total, points).withColumns({
        severity: band(total, bands, default),
        review: F.col(total) >= review_at,
    })
