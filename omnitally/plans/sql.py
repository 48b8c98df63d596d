"""DuckDB SQL building blocks for the oracles: the same star binding, written in SQL."""

from __future__ import annotations

from omnitally.sources.star import DENSE_ANCHOR, DENSE_DAYS, REFUND_ON_PENDING


def ratio_2dp(num_cents: str, den: str) -> str:
    """num/den to 2 decimals as DECIMAL(14,2); 0 when den <= 0. The quotient is cut to whole
    cents, a remainder of half or more adds one, and the sign is put back last."""
    n, d = f"abs(CAST({num_cents} AS BIGINT))", f"({den})"
    up = f"{n} // {d} + CASE WHEN {n} % {d} >= {d} - {n} % {d} THEN 1 ELSE 0 END"
    return (f"CAST(CASE WHEN {d} > 0 THEN sign(CAST({num_cents} AS BIGINT)) * CAST({up} AS DECIMAL(18,0)) * 0.01 "
            f"ELSE 0 END AS DECIMAL(14,2))")


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def pct(part_cents: str, total_cents: str) -> str:
    return (f"CASE WHEN ({total_cents}) > 0 THEN (100.0 * CAST({part_cents} AS DOUBLE)) "
            f"/ CAST({total_cents} AS DOUBLE) ELSE 0.0 END")


def growth(cur: str, prev: str) -> str:
    return (f"CASE WHEN CAST({prev} AS DOUBLE) > 0 THEN ((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) "
            f"/ CAST({prev} AS DOUBLE)) * 100.0 ELSE 0.0 END")


def _created(dense: bool) -> str:
    if not dense:
        return "o.o_orderdate"
    return (f"TIMESTAMP '{DENSE_ANCHOR} 00:00:00' - to_days(CAST(o.o_orderkey % {DENSE_DAYS} AS INTEGER)) "
            f"+ to_hours(CAST(o.o_orderkey * 7 % 24 AS INTEGER))")


def fact_order(dense: bool = False) -> str:
    loc = "n.n_regionkey" if dense else "c.c_nationkey"
    join_n = "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey" if dense else ""
    return f"""
fact_order AS (
  SELECT o.o_orderkey AS id,
         substr(o.o_orderpriority, 1, 1) AS channel_id,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE CAST({loc} AS VARCHAR) END AS location_id,
         {_created(dense)} AS created_at,
         {_created(dense)} AS updated_at,
         CASE WHEN o.o_custkey % 10 = 0 THEN NULL
              ELSE substr(sha256(CAST(o.o_custkey AS VARCHAR)), 1, 32) END AS customer_hash,
         CAST(o.o_totalprice AS DECIMAL(14,2)) AS gross_total,
         CAST(CAST(o.o_totalprice AS DECIMAL(14,2))
              - CAST(CASE WHEN o.o_orderstatus = 'P' THEN {REFUND_ON_PENDING} ELSE 0 END AS DECIMAL(14,2))
              AS DECIMAL(14,2)) AS net_total,
         CAST(0 AS DECIMAL(14,2)) AS tax_total,
         CAST(0 AS DECIMAL(14,2)) AS discount_total,
         CAST(CASE WHEN o.o_orderstatus = 'P' THEN {REFUND_ON_PENDING} ELSE 0 END AS DECIMAL(14,2)) AS refunds_total,
         o.o_orderstatus AS status,
         o.o_custkey AS customer_key
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  {join_n}
)"""


FACT_ORDER_LINE = """
fact_order_line AS (
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                   CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT)) AS id,
         l.l_orderkey AS order_id,
         CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE 'P' || CAST(l.l_partkey AS VARCHAR) END AS sku,
         p.p_name AS product_title,
         CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE p.p_type END AS category,
         CAST(l.l_quantity AS INTEGER) AS qty,
         CAST(l.l_extendedprice AS DECIMAL(14,2)) AS line_total
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

DIM_CHANNEL = """
dim_channel AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS id, substr(o_orderpriority, 3) AS name FROM orders
)"""


def dim_location(dense: bool = False) -> str:
    if dense:
        return """
dim_location AS (SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name, 'any' AS channel FROM region)"""
    return """
dim_location AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'any' AS channel FROM nation)"""


FACT_EVENT = """
fact_event AS (
  SELECT event_id AS id, event_type, ts AS starts_at, ts + INTERVAL 2 HOUR AS ends_at,
         CAST(user_id % 6 + 1 AS INTEGER) AS attendees,
         CAST(value AS DECIMAL(14,2)) AS revenue, CAST(0 AS DECIMAL(14,2)) AS add_on_sales,
         ts - to_days(CAST(user_id % 30 AS INTEGER)) AS updated_at, user_id
  FROM events
)"""

INGEST_AUDIT = """
ingest_audit AS (
  SELECT event_id AS id,
         ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source,
         CASE event_type WHEN 'click' THEN 'webhook_orders_create'
                         WHEN 'view' THEN 'webhook_orders_updated'
                         WHEN 'purchase' THEN 'backfill_checkpoint'
                         WHEN 'signup' THEN 'mv_refresh'
                         ELSE 'resync_' || ['shop', 'pos', 'booking'][user_id % 3 + 1] END AS type,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         ts, props AS payload,
         CASE WHEN event_type = 'error' THEN 'upstream rejected: token=' || CAST(user_id AS VARCHAR)
              || 'abc&key=k' || CAST(event_id AS VARCHAR) || ' password=Secret' || CAST(user_id AS VARCHAR)
              || ' retry later' END AS error
  FROM events
)"""


#: How many items and categories a cell lists, and the label of a missing category.
_LISTED = {"item": 10, "category": 5}
_NO_CATEGORY = "Uncategorized"


def _best(part: str, k: int, text: str, order: str) -> str:
    """The first k entries of a cell's list as one text, entries in the given order."""
    return f"array_to_string(list({text} ORDER BY {order}) FILTER (part = '{part}')[1:{k}], '|')"


def kpi_ctes(dense: bool = False) -> str:
    """CTEs fact_order, fact_order_line, basket, sold, shelf and kpi.

    basket sums the lines of each order; sold rolls lines up per cell and product; shelf
    holds a cell's products and categories as rows of one shape; kpi puts orders and
    shelf rows of a cell into one grouping, whose null location is a group like any other.
    """
    item = "sku || ':' || label || ':' || pieces || ':' || CAST(money AS DECIMAL(18,2))"
    category = "label || ':' || CAST(money AS DECIMAL(18,2)) || ':' || pieces"
    return f"""{fact_order(dense)},
{FACT_ORDER_LINE},
basket AS (SELECT order_id, COUNT(*) AS n, SUM(qty) AS pieces FROM fact_order_line GROUP BY order_id),
sold AS (
  SELECT o.created_at::DATE AS date, o.channel_id, o.location_id, l.sku, l.product_title,
         COALESCE(l.category, '{_NO_CATEGORY}') AS category, SUM(l.qty)::BIGINT AS pieces, SUM(l.line_total) AS money
  FROM fact_order_line l, fact_order o WHERE o.id = l.order_id GROUP BY ALL),
shelf AS (
  SELECT date, channel_id, location_id, 'item' AS part, sku, product_title AS label,
         SUM(pieces)::BIGINT AS pieces, SUM(money) AS money
  FROM sold WHERE sku IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT date, channel_id, location_id, 'category', NULL, category, SUM(pieces)::BIGINT, SUM(money)
  FROM sold GROUP BY ALL),
kpi AS (
  SELECT date, channel_id, location_id, SUM(net)::DECIMAL(14,2) AS sales, COUNT(net) AS txns,
         COALESCE(SUM(units), 0)::BIGINT AS units,
         {ratio_2dp('SUM(net) * 100', 'COUNT(net)')} AS aov,
         {ratio_2dp('COALESCE(SUM(n), 0) * 100', 'COUNT(DISTINCT customer_hash)')} AS items_per_customer,
         COALESCE({_best('item', _LISTED['item'], item, 'money DESC, sku, label')}, '') AS top_items,
         COALESCE({_best('category', _LISTED['category'], category, 'money DESC, label')}, '') AS top_categories
  FROM (
    SELECT o.created_at::DATE AS date, o.channel_id, o.location_id, o.net_total AS net, o.customer_hash, b.n,
           b.pieces AS units, 'order' AS part, NULL AS sku, NULL AS label, NULL::BIGINT AS pieces, NULL AS money
    FROM fact_order o LEFT JOIN basket b ON b.order_id = o.id
    UNION ALL
    SELECT date, channel_id, location_id, NULL, NULL, NULL, NULL, part, sku, label, pieces, money FROM shelf)
  GROUP BY date, channel_id, location_id
)"""


def listed(part: str) -> str:
    """A cell's listed items or categories, one row each with its place."""
    order = "money DESC, sku, label" if part == "item" else "money DESC, label"
    return (f"(SELECT *, ROW_NUMBER() OVER (PARTITION BY date, channel_id, location_id ORDER BY {order}) AS place "
            f"FROM shelf WHERE part = '{part}' QUALIFY place <= {_LISTED[part]})")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
