"""Content-metrics analytics on Spark: cleansing, enrichment, snapshots and reports."""

__version__ = "0.1.0"
