"""Data quality and reconciliation of healthcare claims, as Spark DataFrames."""

from claimgauge.functions.run_stamp import RunMeta
from claimgauge.sources.tables import Sources

__all__ = ["RunMeta", "Sources"]
