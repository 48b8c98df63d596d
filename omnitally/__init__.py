"""omnitally: multi-channel retail analytics expressed as Spark DataFrame jobs.

Raw orders, payments and bookings are normalised into a star schema, rolled up into a
daily KPI table (date x channel x location) and served through period, ranking, trend,
quality and reconciliation queries. Everything is built from ``pyspark.sql.functions``,
``Window`` and Structured Streaming; there are no Python UDFs.
"""

from omnitally.session import get_spark

__all__ = ["get_spark"]
