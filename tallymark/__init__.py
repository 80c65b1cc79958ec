"""tallymark: reconciling two-sided trade declarations, and cleaning large tables, on Spark."""

__version__ = "0.1.0"
