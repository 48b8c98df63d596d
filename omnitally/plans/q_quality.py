"""Consistency checks, validation, masking and redaction (SURVEY 2.3 F6/F15, 2.4 J7,
2.5 A15/A26, 2.2 P13-P15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions import security as SEC
from omnitally.operators import quality as Q
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.q_core import kpi_table
from omnitally.plans.q_normalize import IDENTITY_SQL, PAY_CTE
from omnitally.sources import landed as L
from omnitally.sources import star
from omnitally.sources.tables import read

SECRET = "local-test-secret"  # parameter; deployments pass their own
TS_WINDOW = ("1998-01-01", "1998-01-31")
_FACTS = S.with_(S.fact_order(), S.FACT_ORDER_LINE)


@register("orphan_lines", _FACTS + f"""
SELECT fol.id, fol.order_id FROM fact_order_line fol
WHERE NOT EXISTS (SELECT 1 FROM fact_order fo WHERE fo.id = fol.order_id
                  AND CAST(fo.created_at AS DATE) <= DATE '{star.ORDER_AS_OF}')""")
def q_orphan_lines(spark, sf_dir):
    """Lines without an order in the order snapshot taken at as_of (later orders had
    not landed yet), as a left anti join."""
    o = star.fact_order(spark, sf_dir, location=False).filter(F.to_date("created_at") <= F.lit(star.ORDER_AS_OF).cast("date"))
    return Q.orphan_lines(star.fact_order_line(spark, sf_dir, product=False), o).select("id", "order_id")


@register("duplicate_orders", _FACTS + "SELECT id, COUNT(*) AS occurrences FROM fact_order GROUP BY id HAVING COUNT(*) > 1")
def q_duplicate_orders(spark, sf_dir):
    """Order ids that occur more than once."""
    return Q.duplicate_keys(star.fact_order(spark, sf_dir, location=False))


@register("duplicate_events", S.with_(S.FACT_EVENT) + "SELECT id, COUNT(*) AS occurrences FROM fact_event GROUP BY id HAVING COUNT(*) > 1")
def q_duplicate_events(spark, sf_dir):
    """Event ids that occur more than once."""
    return Q.duplicate_keys(star.fact_event(spark, sf_dir))


@register("duplicate_line_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_duplicate_line_keys(spark, sf_dir):
    """A15 on the natural line key (order, line number), which is not unique in the input."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("occurrences")) \
        .filter(F.col("occurrences") > 1)


@register("unique_violations", S.with_(S.kpi_ctes()) + """
, ident AS (""" + IDENTITY_SQL + """)
SELECT 'kpi_cell' AS check_name, CAST(COUNT(*) AS BIGINT) AS violations FROM (
  SELECT date, channel_id, COALESCE(location_id, '') FROM kpi GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)
UNION ALL
SELECT 'fact_order_id', CAST(COUNT(*) AS BIGINT) FROM (SELECT id FROM fact_order GROUP BY id HAVING COUNT(*) > 1)
UNION ALL
SELECT 'shop_customer_id', CAST(COUNT(*) AS BIGINT) FROM (
  SELECT shop_customer_id FROM ident WHERE shop_customer_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL
SELECT 'booking_guest_id', CAST(COUNT(*) AS BIGINT) FROM (
  SELECT booking_guest_id FROM ident WHERE booking_guest_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)""")
def q_unique_violations(spark, sf_dir):
    """Uniqueness PostgreSQL would enforce: KPI cell (date, channel,
    coalesce(location, '')), the order key, and each channel's customer id belonging to
    one identity hash."""
    k = kpi_table(spark, sf_dir).select("date", "channel_id", F.coalesce("location_id", F.lit("")).alias("loc"))

    def violations(df, keys, name):
        return df.groupBy(*keys).count().filter(F.col("count") > 1) \
            .agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
    # Both channels' ids in one pass over the identities; a global aggregate gives a row without any.
    names = ["shop_customer_id", "booking_guest_id"]
    ident = Q.customer_identity(L.shop_orders(spark, sf_dir, lines=False), L.bookings(spark, sf_dir))
    ids = ident.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("id")) for n in names])).alias("x")) \
        .select("x.*").filter("id IS NOT NULL").groupBy("check_name", "id").count().filter(F.col("count") > 1) \
        .agg(F.array(*[F.struct(F.lit(n).alias("check_name"), F.count_if(F.col("check_name") == n).alias("violations")) for n in names]).alias("r"))
    return violations(k, ["date", "channel_id", "loc"], "kpi_cell") \
        .unionByName(violations(star.fact_order(spark, sf_dir, location=False), ["id"], "fact_order_id")) \
        .unionByName(ids.select(F.inline("r")))


_EMAIL, _DATE = Q.EMAIL_RE, Q.DATE_RE
CHANNELS = ["shop", "pos", "booking", "all"]  # request enum (dtc is a channel but not accepted)


@register("validate_rows", rf"""
WITH r AS (
  SELECT event_id AS id,
         CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%Y-%m-%d') END AS start_date,
         strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS end_date,
         ['shop', 'pos', 'booking', 'all', 'dtc'][user_id % 5 + 1] AS channel,
         'user' || CAST(user_id AS VARCHAR) || '@example.com' AS r1,
         CASE WHEN user_id % 11 = 0 THEN 'user' || CAST(user_id AS VARCHAR) ELSE 'ops@example.com' END AS r2
  FROM events)
SELECT id, CASE WHEN NOT regexp_full_match(start_date, '{_DATE}') THEN 'start_date'
                WHEN NOT regexp_full_match(end_date, '{_DATE}') THEN 'end_date'
                WHEN channel NOT IN ('shop', 'pos', 'booking', 'all') THEN 'channel'
                WHEN NOT (regexp_full_match(r1, '{_EMAIL}') AND regexp_full_match(r2, '{_EMAIL}')) THEN 'recipients'
           END AS reason,
       CASE WHEN regexp_full_match(start_date, '{_DATE}') AND regexp_full_match(end_date, '{_DATE}')
             AND channel IN ('shop', 'pos', 'booking', 'all')
             AND regexp_full_match(r1, '{_EMAIL}') AND regexp_full_match(r2, '{_EMAIL}') THEN true ELSE false END AS valid
FROM r""")
def q_validate_rows(spark, sf_dir):
    """Request validation as a data-quality split; invalid rows keep a reason
    instead of failing the batch."""
    e = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    u = F.col("user_id")
    r = e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("start_date"),
        F.date_format(F.expr("timestampadd(DAY, 1, ts)"), "yyyy-MM-dd").alias("end_date"),
        F.element_at(F.array(*[F.lit(c) for c in ["shop", "pos", "booking", "all", "dtc"]]), (u % 5 + 1).cast("int"))
         .alias("channel"),
        F.array(F.concat(F.lit("user"), u.cast("string"), F.lit("@example.com")),
                F.when(u % 11 == 0, F.concat(F.lit("user"), u.cast("string"))).otherwise(F.lit("ops@example.com")))
         .alias("recipients"))
    return Q.validate_requests(r, CHANNELS).select("id", "reason", "valid")


@register("mask_columns", S.with_(PAY_CTE) + """
SELECT payment_id,
       '***' AS order_key,
       CASE WHEN email IS NOT NULL AND length(email) > 4 THEN '***' || right(email, 4) ELSE '***' END AS buyer_email,
       '***' AS card_last4,
       CASE WHEN l_suppkey % 2 = 0 THEN '***' ELSE '***CARD' END AS card_brand,
       amt AS amount_cents
FROM pay""")
def q_mask_columns(spark, sf_dir):
    """Masking driven by column names (key, email, card, ...)."""
    p = L.pos_payments(spark, sf_dir)
    flat = p.select(F.col("id").alias("payment_id"),
                    F.regexp_extract("orderId", r"(\d+)$", 1).cast("bigint").alias("order_key"),
                    F.col("buyerEmailAddress").alias("buyer_email"),
                    F.col("cardDetails.card.last4").alias("card_last4"),
                    F.col("cardDetails.card.cardBrand").alias("card_brand"),
                    F.col("amountMoney.amount").alias("amount_cents"))
    return SEC.mask_columns(flat)


@register("redact_errors", S.with_(S.INGEST_AUDIT) + r"""
SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(error,
         'key=[^&\s]+', 'key=***', 'gi'), 'token=[^&\s]+', 'token=***', 'gi'),
         'password=[^&\s]+', 'password=***', 'gi'), 'secret=[^&\s]+', 'secret=***', 'gi') AS error
FROM ingest_audit WHERE error IS NOT NULL""")
def q_redact_errors(spark, sf_dir):
    """Secrets in stored error texts replaced by ***."""
    a = star.ingest_audit(spark, sf_dir).filter(F.col("error").isNotNull())
    return a.select("id", SEC.redact(F.col("error")).alias("error"))


def _hmac_sql(msg: str, secret: str) -> str:
    """SQL twin of security.hmac_sha256_hex (RFC 2104 over sha256 of bytes)."""
    ipad, opad = SEC._pads(secret)
    return f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || encode({msg}))))"


_KEYED_NORM = (r"regexp_replace(lower(CASE WHEN o_custkey % 3 = 0 THEN '+1 555 ' || CAST(o_custkey AS VARCHAR) "
               r"ELSE '  Customer' || CAST(o_custkey AS VARCHAR) || '@Example.COM' || chr(9) END), '^\s+|\s+$', '', 'g')")


@register("customer_hash_keyed", f"""
SELECT DISTINCT 'gid://shop/Customer/' || CAST(o_custkey AS VARCHAR) AS customer_id,
       substr({_hmac_sql(_KEYED_NORM, SECRET)}, 1, 16) AS keyed_hash
FROM orders WHERE o_custkey % 10 <> 0""")
def q_customer_hash_keyed(spark, sf_dir):
    """Keyed (HMAC) variant of the PII hash over shop customer emails/phones."""
    raw = L.shop_orders(spark, sf_dir).filter(F.col("customer").isNotNull())
    v = F.coalesce(F.nullif(F.col("customer.email"), F.lit("")), F.col("customer.phone"))
    return raw.select(F.col("customer.id").alias("customer_id"), SEC.keyed_hash(v, SECRET).alias("keyed_hash")).distinct()


@register("filter_ts_window", _FACTS + f"""
SELECT id, created_at FROM fact_order
WHERE created_at >= TIMESTAMP '{TS_WINDOW[0]}' AND created_at < TIMESTAMP '{TS_WINDOW[1]}' + INTERVAL 1 DAY""")
def q_filter_ts_window(spark, sf_dir):
    """timestamp window to the end of the last day, half-open (no lost sub-second)."""
    o = star.fact_order(spark, sf_dir, location=False)
    lo = F.lit(TS_WINDOW[0]).cast("timestamp_ntz")
    hi = F.date_add(F.lit(TS_WINDOW[1]).cast("date"), 1).cast("timestamp_ntz")
    return o.filter((F.col("created_at") >= lo) & (F.col("created_at") < hi)).select("id", "created_at")


@register("validate_payloads", """
SELECT event_id AS id, ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source,
       CASE WHEN event_id % 13 = 0 THEN 'body'
            WHEN user_id % 3 = 0 THEN CASE event_type WHEN 'error' THEN 'id' WHEN 'view' THEN 'created_at' END
            WHEN user_id % 3 = 1 THEN CASE event_type WHEN 'error' THEN 'type' WHEN 'view' THEN 'data' END
            ELSE CASE event_type WHEN 'error' THEN 'event_type' WHEN 'view' THEN 'data' END END AS reason
FROM events""")
def q_validate_payloads(spark, sf_dir):
    """required fields of the three sources' deliveries; missing ids, types, data and cut bodies are named."""
    e = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    kind, n = F.col("event_type"), F.col("user_id") % 3
    none = F.lit(None).cast("string")
    has = F.when(kind != "error", kind)
    shop = F.to_json(F.struct(F.when(kind != "error", F.col("event_id")).alias("id"),
                              F.when(kind != "view", F.lit("2024-01-01")).otherwise(none).alias("created_at")))
    shop = F.when(kind == "view", F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"created_at":5}'))).otherwise(shop)
    data = F.when(kind != "view", F.struct(F.struct(F.col("value").alias("value")).alias("object")))
    pos = F.to_json(F.struct(has.alias("type"), data.alias("data")))
    booking = F.when(kind == "signup", F.to_json(F.struct(has.alias("type"), data.alias("data")))) \
        .otherwise(F.to_json(F.struct(has.alias("event_type"), data.alias("data"))))
    body = F.when(n == 0, shop).when(n == 1, pos).otherwise(booking)
    body = F.when(F.col("event_id") % 13 == 0, F.substring(body, 1, 5)).otherwise(body)
    rows = e.select(F.col("event_id").alias("id"), F.element_at(F.array(*[F.lit(x) for x in star.AUDIT_SOURCES]), (n + 1).cast("int"))
                    .alias("source"), body.alias("body"))
    return Q.validate_payloads(rows).select("id", "source", "reason")
