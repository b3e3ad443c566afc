from . import readers, scratch, snapshots, tables

__all__ = ["readers", "scratch", "snapshots", "tables"]
