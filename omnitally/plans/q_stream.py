"""Streaming jobs run to completion (availableNow) and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.plans.catalog import register
from omnitally.streaming import ingest as ST


@register("stream_ingest", """
WITH d AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source,
         'webhook_' || CASE event_type WHEN 'click' THEN 'webhook_orders_create'
                                       WHEN 'view' THEN 'webhook_orders_updated'
                                       WHEN 'purchase' THEN 'backfill_checkpoint'
                                       WHEN 'signup' THEN 'mv_refresh'
                                       ELSE 'resync_' || ['shop', 'pos', 'booking'][user_id % 3 + 1] END AS type,
         CASE WHEN event_id % 97 = 0 THEN 'failed' WHEN event_type = 'error' THEN 'warning' ELSE 'success' END AS result,
         ts, props AS payload
  FROM events)
SELECT id, source, type, 'processing' AS status, ts, payload FROM d
UNION ALL SELECT id, source, type, result, ts + INTERVAL 1 SECOND, payload FROM d""")
def q_stream_ingest(spark, sf_dir):
    """Verify -> parse -> audit 'processing' -> route -> audit result."""
    path = ST.run_ingest(spark, sf_dir)
    return spark.read.parquet(path).select("id", "source", "type", "status", "ts", "payload")


@register("stream_upsert_orders", """
SELECT 'shop_order_' || CAST(o_orderkey AS VARCHAR) AS id, '#' || CAST(o_orderkey AS VARCHAR) AS name,
       CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS DECIMAL(14,2)) AS gross_total,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 200 ELSE 0 END AS DECIMAL(14,2)) AS refunds_total,
       CAST((SELECT COUNT(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS BIGINT) AS n_lines
FROM orders o""")
def q_stream_upsert_orders(spark, sf_dir):
    """Order events normalised and upserted by id in foreachBatch."""
    path = ST.run_upsert_orders(spark, sf_dir)
    return ST.current_orders(spark, path).select("id", "name", "gross_total", "refunds_total", "n_lines")


@register("stream_dedupe", "SELECT event_id, event_type, value FROM events")
def q_stream_dedupe(spark, sf_dir):
    """Every event delivered twice; duplicates dropped by event id."""
    path = ST.run_dedupe(spark, sf_dir)
    return spark.read.parquet(path).select("event_id", "event_type", "value")


_SRC = "['shop', 'pos', 'booking'][user_id % 3 + 1]"


@register("stream_daily_totals", f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, {_SRC} AS source, COUNT(*) AS deliveries,
       CAST(SUM(CAST(value AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS revenue
FROM events GROUP BY 1, 2""")
def q_stream_daily_totals(spark, sf_dir):
    """Live daily totals per channel: 1-day tumbling windows with a watermark."""
    path = ST.run_daily_totals(spark, sf_dir)
    return ST.daily_totals(spark, path).select("day", "source", "deliveries", "revenue")


@register("stream_daily_visitors")
def q_stream_daily_visitors(spark, sf_dir):
    """Approximate distinct users per day and channel (exact distinct counts are not
    supported in streaming aggregations, so approx_count_distinct is used)."""
    path = ST.run_daily_totals(spark, sf_dir)
    return ST.daily_totals(spark, path).select("day", "source", "approx_users")


@register("stream_counts_by_topic", """
SELECT ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source,
       CASE event_type WHEN 'click' THEN 'webhook_orders_create' WHEN 'view' THEN 'webhook_orders_updated'
                       WHEN 'purchase' THEN 'backfill_checkpoint' WHEN 'signup' THEN 'mv_refresh'
                       ELSE 'resync_' || ['shop', 'pos', 'booking'][user_id % 3 + 1] END AS topic,
       COUNT(*) AS n
FROM events GROUP BY 1, 2""")
def q_stream_counts_by_topic(spark, sf_dir):
    """T2 as a stream: deliveries per source and topic."""
    return ST.topic_counts(spark, ST.run_topic_counts(spark, sf_dir)).select("source", "topic", "n")
