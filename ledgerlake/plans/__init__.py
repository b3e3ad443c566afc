from . import gold, reports, runlog, silver

__all__ = ["gold", "reports", "runlog", "silver"]
