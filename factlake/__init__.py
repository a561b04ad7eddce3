"""factlake: a Spark-native engine for company filings and reported financial facts.

Landed gzip-JSON envelopes and fixed-width index files are refined through
bronze, silver and gold DataFrames with declared schemas; data-quality checks,
SCD-2 history, idempotent merges and restatement detection are all expressed
as built-in Spark SQL expressions so that Catalyst and AQE plan the work.
"""

__all__ = ["session", "contracts"]
