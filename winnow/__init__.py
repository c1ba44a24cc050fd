"""Data-quality and enrichment operators for hand-collected fact tables, on Spark."""
