from . import trades

__all__ = ["trades"]
