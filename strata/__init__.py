"""strata: layered (bronze -> silver -> gold) song analytics on PySpark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, so Catalyst plans it and the same code runs in batch and in
Structured Streaming.
"""

__all__ = ["functions", "operators", "sources", "sinks", "plans", "streaming"]
