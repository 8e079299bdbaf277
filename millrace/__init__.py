"""Millrace: lakehouse data operators and table flows on plain PySpark.

Everything is written on the public DataFrame, SQL and Structured Streaming
APIs over parquet, so it runs on any Spark 4 cluster without extra jars.
"""

__version__ = "0.1.0"
