"""Registered queries: key -> Spark callable and, where SQL can say it, an oracle."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "load"]


def load() -> None:
    """Import every query module so that it registers its keys."""
    from . import (  # noqa: F401
        aggregations,
        functions,
        golds,
        histories,
        joins,
        qualities,
        reports,
        scans,
        silvers,
        streams,
        windows,
    )
