"""Audit, checkpoints, health and traffic (SURVEY 2.1 S12, 2.3 F1/F8-F12/F14/F17/F18,
2.5 A17/A18/A21, 2.6 W4, 2.10 I7, 2.11 T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions import security as SEC
from omnitally.functions.expr import half_up
from omnitally.operators import audit as A
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.q_quality import SECRET
from omnitally.sources import star
from omnitally.sources.tables import read

NOW = f"{star.EVENT_AS_OF} 00:00:00"
_AUD = S.with_(S.INGEST_AUDIT)


def _audit(spark, sf_dir):
    return star.ingest_audit(spark, sf_dir)


@register("audit_latest", _AUD + """
, hist AS (
  SELECT id, source, type, 'processing' AS status, ts FROM ingest_audit
  UNION ALL SELECT id, source, type, status, ts + INTERVAL 1 SECOND FROM ingest_audit)
SELECT id, arg_max(status, ts) AS status, max(ts) AS ts FROM hist GROUP BY id""")
def q_audit_latest(spark, sf_dir):
    """Current status = latest row per audit id in the append-only history."""
    h = A.status_history(_audit(spark, sf_dir))
    return A.latest_per_key(h, ["id"], "ts", ["status", "ts"])


@register("audit_recent_resyncs", _AUD + """
SELECT id, source, type, status, ts FROM ingest_audit
WHERE type IN ('resync_shop', 'resync_pos', 'resync_booking') ORDER BY ts DESC, id DESC LIMIT 10""")
def q_audit_recent_resyncs(spark, sf_dir):
    """F8 + L5: newest 10 audit rows whose type is in a list."""
    a = _audit(spark, sf_dir).filter(F.col("type").isin("resync_shop", "resync_pos", "resync_booking"))
    return a.orderBy(F.col("ts").desc(), F.col("id").desc()).limit(10).select("id", "source", "type", "status", "ts")


@register("checkpoint_by_location", _AUD + """
SELECT id, source, ts FROM ingest_audit
WHERE type = 'backfill_checkpoint' AND json_extract_string(payload, '$.k') = '42'""")
def q_checkpoint_by_location(spark, sf_dir):
    """JSON-path equality on the audit payload."""
    a = _audit(spark, sf_dir)
    return a.filter((F.col("type") == "backfill_checkpoint") & (F.get_json_object("payload", "$.k") == "42")) \
        .select("id", "source", "ts")


@register("audit_webhooks", _AUD + """
SELECT type, status, COUNT(*) AS n FROM ingest_audit WHERE type LIKE 'webhook_%' GROUP BY type, status""")
def q_audit_webhooks(spark, sf_dir):
    """LIKE 'webhook_%' (the underscore is a LIKE wildcard, as in the reference)."""
    return _audit(spark, sf_dir).filter(F.col("type").like("webhook_%")).groupBy("type", "status") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("audit_24h", _AUD + f"""
SELECT id, type, status, ts FROM ingest_audit
WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '{NOW}' ORDER BY ts DESC""")
def q_audit_24h(spark, sf_dir):
    """the last 24 hours before as_of, newest first."""
    a = _audit(spark, sf_dir)
    return a.filter((F.col("ts") >= F.expr(f"timestamp_ntz'{NOW}' - interval 24 hours"))
                    & (F.col("ts") <= F.lit(NOW).cast("timestamp_ntz"))) \
        .orderBy(F.col("ts").desc()).select("id", "type", "status", "ts")


@register("audit_failures", _AUD + "SELECT id, source, type, ts FROM ingest_audit WHERE status = 'failed' ORDER BY ts DESC")
def q_audit_failures(spark, sf_dir):
    """failed rows, newest first (the code writes 'failed')."""
    return _audit(spark, sf_dir).filter(F.col("status") == "failed").orderBy(F.col("ts").desc()) \
        .select("id", "source", "type", "ts")


@register("stale_events", S.with_(S.FACT_EVENT) + f"""
SELECT id, event_type, starts_at, updated_at FROM fact_event
WHERE updated_at < TIMESTAMP '{NOW}' - INTERVAL 7 DAY AND starts_at > TIMESTAMP '{NOW}'""")
def q_stale_events(spark, sf_dir):
    """future events not updated for 7 days."""
    e = star.fact_event(spark, sf_dir)
    now = F.lit(NOW).cast("timestamp_ntz")
    return e.filter((F.col("updated_at") < F.expr(f"timestamp_ntz'{NOW}' - interval 7 days")) & (F.col("starts_at") > now)) \
        .select("id", "event_type", "starts_at", "updated_at")


@register("audit_throttled", _AUD + """
SELECT id, source, ts, CAST(json_extract_string(payload, '$.k') AS INTEGER) AS k FROM ingest_audit
WHERE json_extract_string(payload, '$.k') IS NOT NULL ORDER BY ts DESC, id DESC LIMIT 20""")
def q_audit_throttled(spark, sf_dir):
    """newest 20 audit rows whose payload carries the key."""
    a = _audit(spark, sf_dir).withColumn("k", F.get_json_object("payload", "$.k"))
    return a.filter(F.col("k").isNotNull()).orderBy(F.col("ts").desc(), F.col("id").desc()).limit(20) \
        .select("id", "source", "ts", F.col("k").cast("int").alias("k"))


@register("audit_by_payload", _AUD + """
SELECT * FROM (SELECT 'newest' AS part, id, payload, ts FROM ingest_audit WHERE type = 'webhook_orders_create'
               ORDER BY ts DESC, id DESC LIMIT 5)
UNION ALL
SELECT 'matching', id, payload, ts FROM ingest_audit
WHERE type LIKE 'resync%' AND json_extract_string(payload, '$.k') = '7'""")
def q_audit_by_payload(spark, sf_dir):
    """newest 5 payloads of one event type, and resync rows whose payload value matches."""
    a = _audit(spark, sf_dir)
    newest = a.filter(F.col("type") == "webhook_orders_create").orderBy(F.col("ts").desc(), F.col("id").desc()) \
        .limit(5).select(F.lit("newest").alias("part"), "id", "payload", "ts")
    match = a.filter(F.col("type").startswith("resync") & (F.get_json_object("payload", "$.k") == "7")) \
        .select(F.lit("matching").alias("part"), "id", "payload", "ts")
    return newest.unionByName(match)


@register("last_refresh", _AUD + "SELECT max(ts) AS last_refresh FROM ingest_audit WHERE type = 'mv_refresh'")
def q_last_refresh(spark, sf_dir):
    """Time of the last KPI refresh."""
    return _audit(spark, sf_dir).filter(F.col("type") == "mv_refresh").agg(F.max("ts").alias("last_refresh"))


@register("source_health", _AUD + f"""
SELECT source, max(ts) AS last_event_at,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) AS events_24h,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND status = 'failed') AS errors_24h,
       CASE WHEN COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) = 0 THEN 'error'
            WHEN COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND status = 'failed') > 0 THEN 'warning'
            ELSE 'healthy' END AS status
FROM ingest_audit WHERE ts <= TIMESTAMP '{NOW}' GROUP BY source""")
def q_source_health(spark, sf_dir):
    """Per-source health from the audit table."""
    return A.source_health(_audit(spark, sf_dir), NOW)


@register("latest_checkpoint", _AUD + """
SELECT source, arg_max(id, ts) AS id, max(ts) AS ts, arg_max(payload, ts) AS payload
FROM ingest_audit WHERE type = 'backfill_checkpoint' GROUP BY source""")
def q_latest_checkpoint(spark, sf_dir):
    """W4 + I7: the latest backfill checkpoint per source."""
    a = _audit(spark, sf_dir).filter(F.col("type") == "backfill_checkpoint")
    return A.latest_per_key(a, ["source"], "ts", ["id", "ts", "payload"])


@register("event_counts_by_topic", _AUD + "SELECT source, type AS topic, COUNT(*) AS n FROM ingest_audit GROUP BY source, type")
def q_event_counts_by_topic(spark, sf_dir):
    """T2 (batch form): deliveries per source and topic."""
    return _audit(spark, sf_dir).groupBy("source", F.col("type").alias("topic")).agg(F.count(F.lit(1)).alias("n"))


_TRAFFIC = """
SELECT CAST(ts AS DATE) AS date, COUNT(DISTINCT user_id) AS visitors,
       COUNT(*) FILTER (WHERE event_type = 'view') AS page_views
FROM events GROUP BY 1"""


def _traffic(spark, sf_dir):
    e = read(spark, sf_dir, "events", "ts", "user_id", "event_type")
    # Distinct visitors per day: (date, user) pairs first, so the distinct count is a
    # plain aggregate over pre-reduced rows instead of an Expand next to the view count.
    pairs = e.groupBy(F.to_date("ts").alias("date"), "user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("v"))
    return pairs.groupBy("date").agg(F.count(F.lit(1)).alias("visitors"), F.sum("v").cast("bigint").alias("page_views"))


@register("traffic_daily", _TRAFFIC)
def q_traffic_daily(spark, sf_dir):
    """Visitors (distinct users) and page views per day."""
    return _traffic(spark, sf_dir)


@register("traffic_summary", f"""
WITH d AS ({_TRAFFIC})
SELECT CAST((2 * SUM(visitors) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) AS avg_visitors,
       CAST(SUM(page_views) AS BIGINT) AS total_views FROM d""")
def q_traffic_summary(spark, sf_dir):
    """Rounded mean daily visitors and total page views."""
    d = _traffic(spark, sf_dir).agg(F.sum("visitors").alias("s"), F.count(F.lit(1)).alias("n"),
                                    F.sum("page_views").alias("pv"))
    return d.select(half_up("s", "n").alias("avg_visitors"), F.col("pv").cast("bigint").alias("total_views"))


@register("verify_signature", """
SELECT ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source, event_id % 97 <> 0 AS valid, COUNT(*) AS n
FROM events GROUP BY 1, 2""")
def q_verify_signature(spark, sf_dir):
    """HMAC check on raw deliveries; shop base64(body), pos base64(url + body),
    booking hex(body). Deliveries signed with a rotated secret (every 97th) must fail and
    all others must pass -- that rule is what the oracle encodes."""
    e = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts")
    src = F.element_at(F.array(*[F.lit(s) for s in star.AUDIT_SOURCES]), (F.col("user_id") % 3 + 1).cast("int"))
    env = e.select(src.alias("source"), F.col("event_id"),
                   F.to_json(F.struct("event_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))).alias("body"))
    url = F.lit("https://example.invalid/hooks/pos")
    signer = F.when(F.col("event_id") % 97 == 0, F.lit("rotated-secret")).otherwise(F.lit(SECRET))

    def sign(secret):
        return F.when(F.col("source") == "shop", SEC.hmac_sha256_b64(F.col("body"), secret)) \
            .when(F.col("source") == "pos", SEC.hmac_sha256_b64(F.concat(url, F.col("body")), secret)) \
            .otherwise(SEC.hmac_sha256_hex(F.col("body"), secret))
    env = env.withColumn("signature", F.when(signer == SECRET, sign(SECRET)).otherwise(sign("rotated-secret")))
    ok = F.when(F.col("source") == "shop", SEC.verify_signature(F.col("body"), F.col("signature"), SECRET)) \
        .when(F.col("source") == "pos", SEC.verify_signature(F.col("body"), F.col("signature"), SECRET, prefix=url)) \
        .otherwise(SEC.verify_signature(F.col("body"), F.col("signature"), SECRET, encoding="hex"))
    return env.withColumn("valid", ok).groupBy("source", "valid").agg(F.count(F.lit(1)).alias("n"))
