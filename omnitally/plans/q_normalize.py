"""Landed-record scans and normalisers (SURVEY 2.1 S3-S8, 2.2 P1-P12/P14-P16, 2.4 J5/J6/J11/J12,
2.5 A9/A13/A14, 2.3 F6/F13, 2.8 U2, 2.10 I9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY, customer_hash, external_id, minor_to_money, utc_ts
from omnitally.operators import normalize as N
from omnitally.operators import quality as Q
from omnitally.plans import jobs
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.session import ensure_checkpoint_dir
from omnitally.sources import landed as L
from omnitally.sources.tables import read

WINDOW = ("1998-01-01", "1998-03-31")
POS_SCAN_LOCATIONS = ["L1", "L2", "L3"]


def H(x: str) -> str:
    """SQL twin of functions.expr.pii_hash."""
    return (f"CASE WHEN ({x}) IS NULL OR ({x}) = '' THEN NULL ELSE "
            rf"substr(sha256(regexp_replace(lower({x}), '^\s+|\s+$', '', 'g')), 1, 32) END")


def M(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(14,2))"


_CENTS = "CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT)"
_TOTAL = "CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS BIGINT)"
_LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_SKU = "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE 'P' || CAST(l_partkey AS VARCHAR) END"
_SHOP_HASH = (f"CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 3 = 0 THEN {H(chr(39) + '+1 555 ' + chr(39) + ' || CAST(o_custkey AS VARCHAR)')} "
              f"ELSE {H(chr(39) + '  Customer' + chr(39) + ' || CAST(o_custkey AS VARCHAR) || ' + chr(39) + '@Example.COM' + chr(39) + ' || chr(9)')} END")
_BUYER = "' Buyer' || CAST(o_custkey AS VARCHAR) || '@Shop.Example '"

# Payments (one per line) with their order's location and buyer: the SQL twin of landed.pos_payments.
PAY_CTE = f"""
pay AS (
  SELECT l.*, 'SQ' || CAST(l.l_orderkey AS VARCHAR) AS order_id,
         'PAY' || {_LINE_KEY} || '-' || CAST({_CENTS} AS VARCHAR) AS payment_id,
         strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS created,
         {_CENTS} AS amt,
         l.l_linestatus = 'F' AS done,
         {_CENTS} * 29 // 1000 + 30 AS fee,
         CASE WHEN l.l_returnflag = 'R' THEN {_CENTS} // 10 END AS refunded,
         CASE WHEN l.l_partkey % 2 = 0 THEN {_BUYER} END AS email,
         'L' || CAST(c.c_nationkey AS VARCHAR) AS location
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
per_order AS (
  SELECT order_id, COUNT(*) AS n_payments,
         COALESCE(SUM(CASE WHEN done THEN amt END), 0) AS paid_cents,
         COALESCE(SUM(CASE WHEN done THEN fee END), 0) AS fee_cents,
         COALESCE(SUM(CASE WHEN done THEN COALESCE(refunded, 0) END), 0) AS refunded_cents,
         arg_min(email, (created, payment_id)) FILTER (WHERE email IS NOT NULL) AS buyer_email
  FROM pay GROUP BY order_id
),
pos_o AS (
  SELECT 'SQ' || CAST(o.o_orderkey AS VARCHAR) AS id, o.*, 'L' || CAST(c.c_nationkey AS VARCHAR) AS location,
         {_TOTAL} AS total_cents
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

POS_ORDERS_SQL = f"""
SELECT 'pos_order_' || p.id AS id, 'pos' AS channel_id, 'pos_location_' || p.location AS location_id,
       p.o_orderdate AS created_at, p.o_orderdate AS updated_at, {H('po.buyer_email')} AS customer_hash,
       {M('p.total_cents')} AS gross_total,
       CAST({M('p.total_cents')} - {M('COALESCE(po.refunded_cents, 0)')} AS DECIMAL(14,2)) AS net_total,
       {M("CASE WHEN p.o_orderstatus = 'O' THEN 0 ELSE p.total_cents // 12 END")} AS tax_total,
       {M("CASE WHEN p.o_orderstatus = 'F' THEN p.total_cents // 50 ELSE 0 END")} AS discount_total,
       {M('COALESCE(po.refunded_cents, 0)')} AS refunds_total,
       {M('COALESCE(po.fee_cents, 0)')} AS fees_total
FROM pos_o p LEFT JOIN per_order po ON p.id = po.order_id"""

SHOP_ORDERS_SQL = f"""
SELECT 'shop_order_' || CAST(o_orderkey AS VARCHAR) AS id, 'shop' AS channel_id, 'online-shop' AS location_id,
       o_orderdate AS created_at, o_orderdate AS updated_at, {_SHOP_HASH} AS customer_hash,
       CAST(o_totalprice AS DECIMAL(14,2)) AS gross_total,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) - CASE WHEN o_orderstatus = 'P' THEN 100 ELSE 0 END AS DECIMAL(14,2)) AS net_total,
       CAST(0 AS DECIMAL(14,2)) AS tax_total, CAST(0 AS DECIMAL(14,2)) AS discount_total,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 100 ELSE 0 END AS DECIMAL(14,2)) AS refunds_total
FROM orders"""

_EXP_TYPE = ("CASE event_type WHEN 'click' THEN 'tour' WHEN 'view' THEN 'tasting' WHEN 'purchase' THEN 'experience' "
             "WHEN 'signup' THEN 'tour' WHEN 'error' THEN 'private' END")
_GUEST_HASH = (f"CASE WHEN user_id % 4 = 0 THEN {H(chr(39) + '+1 555 ' + chr(39) + ' || CAST(user_id AS VARCHAR)')} "
               f"ELSE {H(chr(39) + 'Customer' + chr(39) + ' || CAST(user_id AS VARCHAR) || ' + chr(39) + '@Example.COM' + chr(39))} END")
EVENTS_SQL = f"""
SELECT 'booking_bk_' || CAST(event_id AS VARCHAR) AS id, {_EXP_TYPE} AS event_type,
       date_trunc('second', ts) AS starts_at,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE CAST(ts AS DATE) + CAST(date_trunc('second', ts + INTERVAL 2 HOUR) AS TIME) END AS ends_at,
       CAST(user_id % 6 + 1 AS INTEGER) AS attendees, CAST(value AS DECIMAL(14,2)) AS revenue,
       CAST(CASE WHEN event_type = 'click' THEN 0 ELSE user_id % 20 END AS DECIMAL(14,2)) AS add_on_sales,
       {_GUEST_HASH} AS customer_hash, 'G' || CAST(user_id AS VARCHAR) AS guest_id,
       CASE event_type WHEN 'error' THEN 'cancelled' WHEN 'purchase' THEN 'completed' ELSE 'confirmed' END AS status
FROM events"""


def _pos(spark, sf_dir, location=True):
    payments = L.pos_payments(spark, sf_dir, location=False)
    return L.pos_orders(spark, sf_dir, lines=False, location=location), payments, N.payments_per_order(payments)


def landed(spark, sf_dir, kind, quarantine=None):
    """Records of one kind as they land: JSON lines, every 50th followed by a copy that was cut off."""
    make = {"pos_order": lambda: L.pos_orders(spark, sf_dir, lines=False), "pos_payment": lambda: L.pos_payments(spark, sf_dir),
            "booking": lambda: L.bookings(spark, sf_dir), "experience": lambda: L.experiences(spark, sf_dir)}[kind]
    path = jobs.new_table_dir(spark, f"landed_{kind}")
    rows = make()
    number = F.regexp_extract("id", r"(\d+)", 1)
    L.land(rows, path, F.when(number != "", number.cast("bigint") % 50 == 0).otherwise(F.lit(True)))
    return L.scan(spark, path, kind, quarantine or f"{path}-quarantine")


# --- scans ------------------------------------------------------------------------------

@register("scan_shop_orders", f"""
SELECT 'gid://shop/Order/' || CAST(o_orderkey AS VARCHAR) AS id, '#' || CAST(o_orderkey AS VARCHAR) AS name,
       o_orderdate AS created_at, CAST(o_totalprice AS DECIMAL(14,2)) AS total,
       CAST((SELECT COUNT(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS BIGINT) AS n_lines,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS BIGINT) AS n_transactions
FROM orders o
WHERE o_orderdate >= TIMESTAMP '{WINDOW[0]}' AND o_orderdate < TIMESTAMP '{WINDOW[1]}' + INTERVAL 1 DAY""")
def q_scan_shop_orders(spark, sf_dir):
    """S3: landed JSON text parsed with the explicit schema, then the created-at window.
    (Half-open end of day, see README.)"""
    text = L.shop_orders(spark, sf_dir).select(F.to_json(F.struct("*")).alias("body"))
    r = text.select(L.parse(F.col("body"), "shop_order").alias("r")).select("r.*")
    created = utc_ts("createdAt")
    r = r.filter((created >= F.lit(WINDOW[0]).cast("timestamp_ntz"))
                 & (created < F.date_add(F.lit(WINDOW[1]).cast("date"), 1).cast("timestamp_ntz")))
    found = r.select(
        "id", "page", "name", created.alias("created_at"), F.col("totalPriceSet.shopMoney.amount").cast(MONEY).alias("total"),
        F.size("lineItems.edges").cast("bigint").alias("n_lines"),
        F.size("transactions.edges").cast("bigint").alias("n_transactions"))
    # The pages of an order are counted together, and a global sort reads its input twice: the parsed rows are stored first.
    ensure_checkpoint_dir(spark)
    found = N.with_all_pages(found.checkpoint(eager=True), "id", "n_lines")
    return found.checkpoint(eager=True).orderBy("created_at")


@register("scan_pos_orders", S.with_(PAY_CTE) + f"""
SELECT id, location AS location_id, o_orderdate AS created_at, total_cents
FROM pos_o WHERE location IN ('L1', 'L2', 'L3')
  AND o_orderdate >= TIMESTAMP '{WINDOW[0]}' AND o_orderdate < TIMESTAMP '{WINDOW[1]}' + INTERVAL 1 DAY""")
def q_scan_pos_orders(spark, sf_dir):
    """Location IN list, created in window, sorted by created ascending; landed JSON with malformed lines."""
    o = landed(spark, sf_dir, "pos_order")
    created = utc_ts("createdAt")
    o = o.filter(F.col("locationId").isin(POS_SCAN_LOCATIONS)
                 & (created >= F.lit(WINDOW[0]).cast("timestamp_ntz"))
                 & (created < F.date_add(F.lit(WINDOW[1]).cast("date"), 1).cast("timestamp_ntz")))
    return o.orderBy(created).select("id", F.col("locationId").alias("location_id"), created.alias("created_at"),
                                     F.col("totalMoney.amount").alias("total_cents"))


@register("scan_pos_payments", S.with_(PAY_CTE) + f"""
SELECT payment_id AS id, order_id, location AS location_id, l_shipdate AS created_at, amt AS amount_cents
FROM pay WHERE location IN ('L1', 'L2', 'L3')
  AND l_shipdate >= TIMESTAMP '{WINDOW[0]}' AND l_shipdate < TIMESTAMP '{WINDOW[1]}' + INTERVAL 1 DAY""")
def q_scan_pos_payments(spark, sf_dir):
    """Payments by location and time window, from landed JSON with malformed lines."""
    p = landed(spark, sf_dir, "pos_payment")
    created = utc_ts("createdAt")
    p = p.filter(F.col("locationId").isin(POS_SCAN_LOCATIONS)
                 & (created >= F.lit(WINDOW[0]).cast("timestamp_ntz"))
                 & (created < F.date_add(F.lit(WINDOW[1]).cast("date"), 1).cast("timestamp_ntz")))
    return p.select("id", F.col("orderId").alias("order_id"), F.col("locationId").alias("location_id"),
                    created.alias("created_at"), F.col("amountMoney.amount").alias("amount_cents"))


@register("scan_bookings", """
SELECT 'bk_' || CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d') AS event_date,
       CAST(user_id % 6 + 1 AS INTEGER) AS guests_count, CAST(value AS DECIMAL(14,2)) AS total_price
FROM events
WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-20'
  AND event_type NOT IN ('error', 'purchase')""")
def q_scan_bookings(spark, sf_dir):
    """Bookings in a date range with an optional status filter (all pages at once)."""
    b = landed(spark, sf_dir, "booking")
    b = b.filter(F.col("event_date").between("2024-01-10", "2024-01-20") & (F.col("status") == "confirmed"))
    return b.select("id", "event_date", "guests_count", "total_price")


@register("scan_experiences", """
WITH x AS (SELECT DISTINCT 'exp_' || event_type AS id,
                  CASE WHEN event_type = 'error' THEN 'inactive' ELSE 'active' END AS status FROM events)
SELECT status, COUNT(*) AS experiences FROM x GROUP BY status
UNION ALL SELECT 'all', COUNT(*) FROM x""")
def q_scan_experiences(spark, sf_dir):
    """Experiences by status (active / inactive / all); counted, stored nowhere."""
    x = landed(spark, sf_dir, "experience")
    by = x.groupBy("status").agg(F.count(F.lit(1)).alias("experiences"))
    return by.unionByName(x.agg(F.count(F.lit(1)).alias("experiences")).select(F.lit("all").alias("status"), "experiences"))


@register("quarantined_lines", """
SELECT 'pos_order' AS kind, COUNT(*) AS lines FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT 'pos_payment', COUNT(*) FROM lineitem WHERE l_orderkey % 50 = 0
UNION ALL SELECT 'booking', COUNT(*) FROM events WHERE event_id % 50 = 0
UNION ALL SELECT 'experience', COUNT(DISTINCT event_type) FROM events""")
def q_quarantined_lines(spark, sf_dir):
    """Malformed lines of all scans, kept with their text while the rest of each load goes on."""
    from omnitally.plans import jobs
    path = jobs.new_table_dir(spark, "quarantine")
    for kind in ("pos_order", "pos_payment", "booking", "experience"):
        landed(spark, sf_dir, kind, path)
    return spark.read.parquet(path).groupBy("kind").agg(F.count("line").alias("lines"))


@register("fee_by_path", f"""
SELECT 'PAY' || {_LINE_KEY} || '-' || CAST({_CENTS} AS VARCHAR) AS payment_id, {_CENTS} * 29 // 1000 + 30 AS fee_cents
FROM lineitem""")
def q_fee_by_path(spark, sf_dir):
    """JSON path with an index: the first fee of the first payment of a kept pos payload."""
    p = L.pos_payments(spark, sf_dir, location=False, buyer=False)
    raw = p.select("id", F.to_json(F.struct(F.array(F.struct("id", "processingFee")).alias("payments"))).alias("raw"))
    return raw.select(F.col("id").alias("payment_id"),
                      F.get_json_object("raw", "$.payments[0].processingFee[0].amountMoney.amount").cast("bigint").alias("fee_cents"))


@register("pos_locations", """
SELECT 'L' || CAST(n_nationkey AS VARCHAR) AS id,
       COALESCE(CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END, 'Unnamed Location') AS name
FROM nation""")
def q_pos_locations(spark, sf_dir):
    """Location listing; missing names become 'Unnamed Location'."""
    return L.pos_locations(spark, sf_dir).select("id", F.coalesce("name", F.lit("Unnamed Location")).alias("name"))


# --- shop normalisers -------------------------------------------------------------------

@register("norm_shop_orders", SHOP_ORDERS_SQL)
def q_norm_shop_orders(spark, sf_dir):
    """P1 + P9 + P10."""
    return N.shop_orders(L.shop_orders(spark, sf_dir, lines=False))


@register("norm_shop_lines", f"""
SELECT 'shop_lineitem_' || {_LINE_KEY} AS id, 'shop_order_' || CAST(l_orderkey AS VARCHAR) AS order_id, {_SKU} AS sku,
       p_name AS product_title, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE p_type END AS category,
       CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def q_norm_shop_lines(spark, sf_dir):
    """P2."""
    return N.shop_lines(L.shop_orders(spark, sf_dir))


@register("norm_shop_tenders", """
SELECT 'shop_order_' || CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_custkey % 2 = 0 THEN 'card' ELSE 'cash' END AS gateway,
       CAST(o_totalprice AS DECIMAL(14,2)) AS amount
FROM orders WHERE o_orderstatus <> 'O'""")
def q_norm_shop_tenders(spark, sf_dir):
    """kind = SALE and status = SUCCESS only."""
    raw = L.shop_orders(spark, sf_dir, lines=False)
    x = raw.select(external_id("id", N.SHOP).alias("order_id"), F.explode(N.shop_tenders(raw)).alias("t"))
    return x.select("order_id", "t.gateway", "t.amount")


@register("norm_shop_events", """
SELECT 'shop_order_' || CAST(o_orderkey AS VARCHAR) AS id, '#' || CAST(o_orderkey AS VARCHAR) AS name,
       CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS DECIMAL(14,2)) AS gross_total,
       CAST(0 AS DECIMAL(14,2)) AS tax_total, CAST(0 AS DECIMAL(14,2)) AS discount_total,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 200 ELSE 0 END AS DECIMAL(14,2)) AS refunds_total,
       CAST((SELECT COUNT(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS BIGINT) AS n_lines,
       CAST(COALESCE((SELECT SUM(CAST(CAST(p.p_retailprice AS DECIMAL(14,2)) * CAST(l.l_quantity AS INTEGER) AS DECIMAL(14,2)))
                      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_orderkey = o.o_orderkey), 0)
            AS DECIMAL(18,2)) AS lines_total,
       CAST(CASE WHEN o_orderstatus = 'O' AND o_custkey % 4 <> 1 THEN 0 ELSE 1 END AS BIGINT) AS sale_tenders,
       CAST(CASE WHEN o_orderstatus = 'O' AND o_custkey % 4 <> 1 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(14,2)) END
            AS DECIMAL(18,2)) AS tendered,
       CASE WHEN o_custkey % 2 = 0 THEN 'unknown' ELSE 'cash' END AS gateway
FROM orders o""")
def q_norm_shop_events(spark, sf_dir):
    """P4 (+P5): flat order events reshaped with their defaults."""
    return N.shop_events(L.shop_events(spark, sf_dir))


@register("shop_total_refunded", """
SELECT o_orderkey AS order_id, CAST(CASE WHEN o_orderstatus = 'P' THEN 200 ELSE 0 END AS DECIMAL(14,2)) AS total_refunded
FROM orders""")
def q_shop_total_refunded(spark, sf_dir):
    """P5: sum of refund amounts per order event, 0 when there are none."""
    return L.shop_events(spark, sf_dir, lines=False).select(F.col("id").alias("order_id"),
                                                             N.total_refunded().alias("total_refunded"))


# --- pos normalisers ---------------------------------------------------------------------

@register("payments_to_orders", S.with_(PAY_CTE) + f"""
SELECT p.id AS order_id, CAST(COALESCE(po.n_payments, 0) AS BIGINT) AS n_payments,
       {M('COALESCE(po.paid_cents, 0)')} AS total_paid, {M('COALESCE(po.fee_cents, 0)')} AS total_fees,
       {M('COALESCE(po.refunded_cents, 0)')} AS total_refunded
FROM pos_o p LEFT JOIN per_order po ON p.id = po.order_id""")
def q_payments_to_orders(spark, sf_dir):
    """A9 + J5: payments grouped per order, then looked up; orders without payments kept."""
    o, _, per = _pos(spark, sf_dir, location=False)
    o = N.first_page(o)
    j = o.select("id").join(per, o.id == per.order_id, "left")
    return j.select(F.col("id").alias("order_id"), F.coalesce("n_payments", F.lit(0)).cast("bigint").alias("n_payments"),
                    minor_to_money(F.coalesce("paid_cents", F.lit(0))).alias("total_paid"),
                    minor_to_money(F.coalesce("fee_cents", F.lit(0))).alias("total_fees"),
                    minor_to_money(F.coalesce("refunded_cents", F.lit(0))).alias("total_refunded"))


@register("norm_pos_orders", S.with_(PAY_CTE) + POS_ORDERS_SQL)
def q_norm_pos_orders(spark, sf_dir):
    """P6."""
    o, _, per = _pos(spark, sf_dir)
    return N.pos_orders(o, per)


@register("norm_pos_lines", f"""
SELECT 'pos_lineitem_' || {_LINE_KEY} AS id, 'pos_order_SQ' || CAST(l_orderkey AS VARCHAR) AS order_id, {_SKU} AS sku,
       CASE WHEN l_partkey % 2 = 0 THEN p_name ELSE p_name || ' - ' || p_brand END AS product_title,
       CAST(NULL AS VARCHAR) AS category, CAST(l_quantity AS INTEGER) AS qty,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def q_norm_pos_lines(spark, sf_dir):
    """P7."""
    return N.pos_lines(L.pos_orders(spark, sf_dir, location=False))


@register("norm_pos_tenders", S.with_(PAY_CTE) + f"""
SELECT 'pos_order_' || order_id AS order_id, payment_id, CASE WHEN done THEN 'COMPLETED' ELSE 'APPROVED' END AS status,
       'CARD' AS source_type, {M('amt')} AS amount,
       CASE WHEN l_suppkey % 2 = 0 THEN 'VISA' ELSE 'MASTERCARD' END AS card_brand,
       lpad(CAST(l_suppkey % 10000 AS VARCHAR), 4, '0') AS last4, {M('fee')} AS fee_total,
       'INITIAL ' || CAST({M('fee')} AS VARCHAR) AS fees
FROM pay""")
def q_norm_pos_tenders(spark, sf_dir):
    """Tenders with their fee list (shown as text, type and amount of every fee)."""
    t = N.pos_tenders(L.pos_payments(spark, sf_dir, location=False, buyer=False))
    return t.withColumn("fees", F.array_join(F.transform("fees", lambda f: F.concat_ws(" ", f["type"], f["amount"].cast("string"))), ", "))


@register("recon_pos_net", S.with_(PAY_CTE) + f"""
, lastp AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY created DESC, payment_id DESC) AS rn
                           FROM pay) WHERE rn = 1)
SELECT p.id AS order_id, lp.payment_id AS last_payment_id, {M('p.total_cents')} AS gross_total,
       {M('COALESCE(lp.refunded, 0)')} AS last_refunded,
       CAST({M('p.total_cents')} - {M('COALESCE(lp.refunded, 0)')} AS DECIMAL(14,2)) AS source_net
FROM pos_o p LEFT JOIN lastp lp ON p.id = lp.order_id""")
def q_recon_pos_net(spark, sf_dir):
    """reconcile's payment map -- the last payment per order wins, any status."""
    o = L.pos_orders(spark, sf_dir, lines=False, location=False)
    lp = N.last_payment(L.pos_payments(spark, sf_dir, location=False))
    j = o.join(lp.select("orderId", F.col("id").alias("pid"), "refundedMoney"), o.id == lp.orderId, "left")
    gross = minor_to_money("totalMoney.amount")
    ref = minor_to_money(F.coalesce("refundedMoney.amount", F.lit(0)))
    return j.select(F.col("id").alias("order_id"), F.col("pid").alias("last_payment_id"), gross.alias("gross_total"),
                    ref.alias("last_refunded"), (gross - ref).cast(MONEY).alias("source_net"))


@register("fee_discrepancy", S.with_(PAY_CTE) + f"""
, n AS ({POS_ORDERS_SQL})
SELECT id AS order_id, CAST(gross_total - net_total AS DECIMAL(14,2)) AS implied_fee, fees_total AS recorded_fee,
       CAST((gross_total - net_total) - fees_total AS DECIMAL(14,2)) AS difference
FROM n WHERE abs((gross_total - net_total) - fees_total) > 0.01""")
def q_fee_discrepancy(spark, sf_dir):
    """orders whose (gross - net) differs from the recorded processing fees by > 0.01."""
    o, _, per = _pos(spark, sf_dir, location=False)
    return Q.fee_discrepancy(N.pos_orders(o, per))


# --- identity and hashes ------------------------------------------------------------------

@register("customer_hash", f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN {H(chr(39) + '+1 (555) ' + chr(39) + ' || CAST(c_custkey AS VARCHAR)')}
                       WHEN c_custkey % 3 = 1 THEN {H(chr(39) + ' ' + chr(39) + ' || chr(9) || ' + chr(39) + 'User' + chr(39) + ' || CAST(c_custkey AS VARCHAR) || ' + chr(39) + '@Mail.Example ' + chr(39))}
                       ELSE {H(chr(39) + '+1 (555) ' + chr(39) + ' || CAST(c_custkey AS VARCHAR)')} END AS customer_hash
FROM customer""")
def q_customer_hash(spark, sf_dir):
    """Email preferred (lower, trim all whitespace, SHA-256, first 32), else phone."""
    c = read(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey")
    email = F.when(k % 3 == 0, F.lit(None).cast("string")) \
        .when(k % 3 == 1, F.concat(F.lit(" \tUser"), k.cast("string"), F.lit("@Mail.Example "))).otherwise(F.lit(""))
    phone = F.concat(F.lit("+1 (555) "), k.cast("string"))
    return c.select("c_custkey", customer_hash(email, phone).alias("customer_hash"))


@register("external_id", """
WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR)
                                   ELSE 'gid://shop/' || CASE WHEN o_orderkey % 2 = 0 THEN 'Order' ELSE 'DraftOrder' END
                                        || '/' || CAST(o_orderkey AS VARCHAR) END AS gid FROM orders)
SELECT o_orderkey, 'shop_' || COALESCE(lower(string_split(gid, '/')[4]), 'unknown') || '_'
       || COALESCE(string_split(gid, '/')[5], gid) AS external_id
FROM g""")
def q_external_id(spark, sf_dir):
    """P10: gid://x/Type/123 -> shop_type_123, with defaults for ids without slashes."""
    o = read(spark, sf_dir, "orders", "o_orderkey")
    k = F.col("o_orderkey")
    gid = F.when(k % 5 == 0, k.cast("string")).otherwise(F.concat(
        F.lit("gid://shop/"), F.when(k % 2 == 0, F.lit("Order")).otherwise(F.lit("DraftOrder")), F.lit("/"), k.cast("string")))
    return o.select("o_orderkey", external_id(gid, N.SHOP).alias("external_id"))


@register("norm_events", EVENTS_SQL)
def q_norm_events(spark, sf_dir):
    """P11 (+P12): bookings into fact_event."""
    return N.booking_events(L.bookings(spark, sf_dir))


@register("event_type", f"""
SELECT 'bk_' || CAST(event_id AS VARCHAR) AS id, {_EXP_TYPE} AS event_type FROM events""")
def q_event_type(spark, sf_dir):
    """Category, else tour/experience from the name ('' counts as missing)."""
    b = L.bookings(spark, sf_dir)
    return b.select("id", N.event_type("experience.name", "experience.category").alias("event_type"))


IDENTITY_SQL = f"""
WITH u AS (
  SELECT DISTINCT {_SHOP_HASH} AS customer_hash, 'shop' AS channel,
         'gid://shop/Customer/' || CAST(o_custkey AS VARCHAR) AS cid
  FROM orders WHERE o_custkey % 10 <> 0
  UNION ALL
  SELECT DISTINCT {_GUEST_HASH}, 'booking', 'G' || CAST(user_id AS VARCHAR) FROM events)
SELECT customer_hash, MAX(CASE WHEN channel = 'shop' THEN cid END) AS shop_customer_id,
       CAST(NULL AS VARCHAR) AS pos_customer_id, MAX(CASE WHEN channel = 'booking' THEN cid END) AS booking_guest_id
FROM u WHERE customer_hash IS NOT NULL GROUP BY customer_hash"""


@register("customer_identity", IDENTITY_SQL)
def q_customer_identity(spark, sf_dir):
    """Identity bridge, one row per hash with one id column per channel."""
    return Q.customer_identity(L.shop_orders(spark, sf_dir, lines=False), L.bookings(spark, sf_dir))


@register("all_orders", S.with_(PAY_CTE) + f"""
SELECT id, channel_id, location_id, created_at, customer_hash, gross_total, net_total FROM ({SHOP_ORDERS_SQL})
UNION ALL
SELECT id, channel_id, location_id, created_at, customer_hash, gross_total, net_total FROM ({POS_ORDERS_SQL})""")
def q_all_orders(spark, sf_dir):
    """Every source's normalised orders in one fact (unionByName)."""
    cols = ["id", "channel_id", "location_id", "created_at", "customer_hash", "gross_total", "net_total"]
    shop = N.shop_orders(L.shop_orders(spark, sf_dir, lines=False)).select(*cols)
    o, _, per = _pos(spark, sf_dir)
    return shop.unionByName(N.pos_orders(o, per).select(*cols))


@register("raw_payload")
def q_raw_payload(spark, sf_dir):
    """Source payload kept beside the facts. pos keeps {order, payments, fees}: the
    order record (with its fee total) and each payment record are retained as JSON rows
    keyed by the order id, so no order's payments are ever gathered into one value."""
    p = L.pos_payments(spark, sf_dir)  # whole records, location and buyer included
    fees = N.payments_per_order(p).select("order_id", "fee_cents")
    # The fee totals, one row per order, are stored first, so that the shuffles behind them are gone when those of the
    # line lists and payments are written.
    path = jobs.new_table_dir(spark, "raw_payload_fees")
    with jobs.released_shuffles(spark):
        fees.write.parquet(path)
    o = L.pos_orders(spark, sf_dir, beside=spark.read.schema(fees.schema).parquet(path))
    orders = o.select(
        F.lit("order").alias("record_type"), F.col("id"), F.col("id").alias("order_id"),
        F.to_json(F.struct(F.struct(*[c for c in o.columns if c != "fee_cents"]).alias("order"),
                           minor_to_money(F.coalesce("fee_cents", F.lit(0))).alias("fees"))).alias("raw_json"))
    payments = p.select(F.lit("payment").alias("record_type"), "id", F.col("orderId").alias("order_id"),
                        F.to_json(F.struct("*")).alias("raw_json"))
    return orders.unionByName(payments)
