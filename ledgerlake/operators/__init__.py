from . import aggregates, history, joins, quality, rules, sets, windows

__all__ = ["aggregates", "history", "joins", "quality", "rules", "sets", "windows"]
