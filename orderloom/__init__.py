"""Order-to-cash analytics on Spark: change detection, wide table, keyed replace, KPIs."""

from orderloom.settings import Settings

__all__ = ["Settings"]
