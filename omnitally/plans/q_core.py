"""Star schema, KPI build, joins and daily aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY_SUM, surrogate_id
from omnitally.operators import calendar as C
from omnitally.operators import kpi as K
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.sources import star
from omnitally.sources.tables import read


def _facts(spark, sf_dir, dense=False, product=True):
    return star.fact_order(spark, sf_dir, dense), star.fact_order_line(spark, sf_dir, product)


def kpi_table(spark, sf_dir, dense=False):
    o, l = _facts(spark, sf_dir, dense)
    return K.build_kpi_daily(o, l)


@register("kpi_daily", S.with_(S.kpi_ctes()) + "SELECT * FROM kpi")
def q_kpi_daily(spark, sf_dir):
    """Flagship: the daily KPI table (ranked arrays rendered as text)."""
    return K.kpi_text(kpi_table(spark, sf_dir))


@register("kpi_daily_dense", S.with_(S.kpi_ctes(dense=True)) + "SELECT * FROM kpi")
def q_kpi_daily_dense(spark, sf_dir):
    """Flagship on the dense binding (folded dates: many orders and skus per cell)."""
    return K.kpi_text(kpi_table(spark, sf_dir, dense=True))


# --- dimensions (S1, S2) -------------------------------------------------------------

def dim_date_df(spark, sf_dir):
    o = read(spark, sf_dir, "orders", "o_orderdate")
    return C.dim_date(o.agg(F.max(F.year("o_orderdate")).alias("year")))


DIM_DATE_SQL = """
dim_date AS (
  SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, CAST(dayofweek(d) AS INTEGER) AS day,
         CAST(ceil(dayofyear(d + CAST(6 - dayofweek(d) AS INTEGER)) / 7) AS INTEGER) AS week,
         dayofweek(d) IN (0, 6) AS is_weekend, CAST(day(d) AS INTEGER) AS day_of_month
  FROM (SELECT CAST(unnest(generate_series(make_date(y - 3, 1, 1), make_date(y + 1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS y FROM orders))
)"""


@register("dim_date", S.with_(DIM_DATE_SQL) + "SELECT * FROM dim_date")
def q_dim_date(spark, sf_dir):
    """Date dimension, Jan 1 of (year-3) to Dec 31 of (year+1) of the latest order year."""
    return dim_date_df(spark, sf_dir)


@register("dim_channel", S.with_(S.DIM_CHANNEL) + "SELECT * FROM dim_channel")
def q_dim_channel(spark, sf_dir):
    """Channel dimension (id, name) from the order priorities."""
    return star.dim_channel(spark, sf_dir)


@register("dim_location", S.with_(S.dim_location()) + "SELECT * FROM dim_location")
def q_dim_location(spark, sf_dir):
    """Location dimension (id, name, channel) from the nations."""
    return star.dim_location(spark, sf_dir)


# --- A1-A5 as separate queries --------------------------------------------------------

_KPI = S.with_(S.kpi_ctes())
_KPI_DENSE = S.with_(S.kpi_ctes(dense=True))


@register("order_line_counts", _KPI + """
SELECT o.created_at::DATE AS date, o.channel_id, o.location_id, o.id AS order_id, o.net_total, o.customer_hash,
       COALESCE(b.n, 0) AS line_item_count FROM fact_order o LEFT JOIN basket b ON b.order_id = o.id""")
def q_order_line_counts(spark, sf_dir):
    """A1: one row per order with its line count (0 without lines)."""
    o, l = _facts(spark, sf_dir, product=False)
    return K.order_line_counts(o, l).drop("units")


@register("daily_aggregates", _KPI + """
SELECT o.created_at::DATE AS date, o.channel_id, o.location_id, SUM(o.net_total)::DECIMAL(18,2) AS sales,
       COUNT(*) AS txns, COUNT(DISTINCT o.customer_hash) AS unique_customers,
       COALESCE(SUM(b.n), 0)::BIGINT AS total_line_items
FROM fact_order o LEFT JOIN basket b ON b.order_id = o.id GROUP BY ALL""")
def q_daily_aggregates(spark, sf_dir):
    """A2: per cell sales, transactions, distinct customers and line total."""
    o, l = _facts(spark, sf_dir, product=False)
    return K.daily_aggregates(K.order_line_counts(o, l)).drop("units")


@register("daily_units", _KPI + "SELECT date, channel_id, location_id, SUM(pieces)::BIGINT AS units FROM sold GROUP BY ALL")
def q_daily_units(spark, sf_dir):
    """A3: per cell units over orders JOIN lines."""
    o, l = _facts(spark, sf_dir, product=False)
    so = K.slim_orders(o)
    return l.join(so, l.order_id == so.id).groupBy(*star.CELL) \
        .agg(F.sum("qty").cast("bigint").alias("units"))


@register("top_items_daily", _KPI_DENSE + f"""
SELECT date, channel_id, location_id, place AS item_rank, sku, label AS product_title, pieces AS qty,
       money::DECIMAL(18,2) AS revenue FROM {S.listed('item')}""")
def q_top_items_daily(spark, sf_dir):
    """Best 10 items per cell by revenue (flattened with rank)."""
    o, l = _facts(spark, sf_dir, dense=True)
    return K.rank_items(K.item_category_totals(o, l)).drop("lines")


@register("top_categories_daily", _KPI_DENSE + f"""
SELECT date, channel_id, location_id, place AS category_rank, label AS category, money::DECIMAL(18,2) AS revenue,
       pieces AS units FROM {S.listed('category')}""")
def q_top_categories_daily(spark, sf_dir):
    """Best 5 categories per cell by revenue (flattened with rank)."""
    o, l = _facts(spark, sf_dir, dense=True)
    return K.rank_categories(K.item_category_totals(o, l))


# --- joins (J1-J3, J13-J15) -------------------------------------------------------------

_FACTS = S.with_(S.fact_order(), S.FACT_ORDER_LINE)


def _order_line_join(spark, sf_dir, how):
    o, l = _facts(spark, sf_dir)
    o = o.select("id", "channel_id")
    l = l.select(F.col("id").alias("line_id"), "order_id", "sku", "qty", "line_total")
    return o.join(l, o.id == l.order_id, how).select(
        F.col("id").alias("order_id"), "channel_id", "line_id", "sku", "qty", "line_total")


@register("join_orders_lines_left", _FACTS + """
SELECT fo.id AS order_id, fo.channel_id, fol.id AS line_id, fol.sku, fol.qty, fol.line_total
FROM fact_order fo LEFT JOIN fact_order_line fol ON fo.id = fol.order_id""")
def q_join_orders_lines_left(spark, sf_dir):
    """Orders LEFT JOIN lines (orders without lines kept)."""
    return _order_line_join(spark, sf_dir, "left")


@register("join_orders_lines", _FACTS + """
SELECT fo.id AS order_id, fo.channel_id, fol.id AS line_id, fol.sku, fol.qty, fol.line_total
FROM fact_order fo JOIN fact_order_line fol ON fo.id = fol.order_id""")
def q_join_orders_lines(spark, sf_dir):
    """Orders JOIN lines."""
    return _order_line_join(spark, sf_dir, "inner")


@register("join_null_safe", _KPI + """
SELECT o.created_at::DATE AS date, o.channel_id, o.location_id, SUM(o.net_total)::DECIMAL(18,2) AS sales,
       SUM(b.pieces)::BIGINT AS units
FROM fact_order o LEFT JOIN basket b ON b.order_id = o.id GROUP BY ALL""")
def q_join_null_safe(spark, sf_dir):
    """Cell aggregates LEFT JOIN cell units on a null-safe location key."""
    da = q_daily_aggregates(spark, sf_dir).alias("da")
    du = q_daily_units(spark, sf_dir).alias("du")
    cond = ((F.col("da.date") == F.col("du.date")) & (F.col("da.channel_id") == F.col("du.channel_id"))
            & F.col("da.location_id").eqNullSafe(F.col("du.location_id")))
    return da.join(du, cond, "left").select("da.date", "da.channel_id", "da.location_id", "da.sales", "du.units")


@register("orders_with_location", S.with_(S.fact_order(), S.dim_location()) + """
SELECT fo.id AS order_id, fo.location_id, dl.name AS location_name
FROM fact_order fo LEFT JOIN dim_location dl ON fo.location_id = dl.id""")
def q_orders_with_location(spark, sf_dir):
    """Orders LEFT JOIN the location dimension."""
    o = star.fact_order(spark, sf_dir)
    dl = star.dim_location(spark, sf_dir).select(F.col("id").alias("loc_id"), F.col("name").alias("location_name"))
    return o.join(dl, o.location_id == dl.loc_id, "left") \
        .select(F.col("id").alias("order_id"), "location_id", "location_name")


@register("sales_by_calendar", S.with_(S.fact_order()) + """
SELECT CAST(year(created_at) AS INTEGER) AS year, CAST(quarter(created_at) AS INTEGER) AS quarter,
       dayofweek(created_at) IN (0, 6) AS is_weekend, CAST(SUM(net_total) AS DECIMAL(18,2)) AS sales, COUNT(*) AS txns
FROM fact_order GROUP BY ALL""")
def q_sales_by_calendar(spark, sf_dir):
    """Every order joined to a date dimension over the orders' whole range."""
    o = star.fact_order(spark, sf_dir, location=False).withColumn("date", F.to_date("created_at"))
    years = read(spark, sf_dir, "orders", "o_orderdate").agg(
        F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"))
    return o.join(C.date_attributes(C.days_of_years(years)), "date").groupBy("year", "quarter", "is_weekend").agg(
        F.sum("net_total").cast(MONEY_SUM).alias("sales"), F.count(F.lit(1)).alias("txns"))


@register("fk_violations", S.with_(S.fact_order(), S.FACT_ORDER_LINE, S.dim_location()) + """
SELECT 'order_channel' AS check_name, COUNT(*) AS violations
  FROM fact_order fo WHERE fo.channel_id NOT IN ('1', '2', '3', '4', '5')
UNION ALL
SELECT 'order_location', COUNT(*) FROM fact_order fo
  WHERE fo.location_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_location dl WHERE dl.id = fo.location_id)
UNION ALL
SELECT 'line_order', COUNT(*) FROM fact_order_line fol
  WHERE NOT EXISTS (SELECT 1 FROM fact_order fo WHERE fo.id = fol.order_id)""")
def q_fk_violations(spark, sf_dir):
    """Foreign keys Spark does not enforce, checked with anti joins."""
    o, l = _facts(spark, sf_dir)
    dc, dl = star.static_channels(spark), star.dim_location(spark, sf_dir)

    def count(df, name):
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
    a = count(o.join(dc, o.channel_id == dc.id, "left_anti"), "order_channel")
    b = count(o.filter(F.col("location_id").isNotNull()).join(dl, o.location_id == dl.id, "left_anti"),
              "order_location")
    c = count(l.join(o.select("id"), l.order_id == o.id, "left_anti"), "line_order")
    return a.unionByName(b).unionByName(c)


@register("lookup_orders", _FACTS + """
SELECT fo.id, fo.channel_id, fo.created_at, fo.net_total FROM fact_order fo
WHERE fo.id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_lookup_orders(spark, sf_dir):
    """Point lookups for a batch of keys (orders with a returned line) as a semi join."""
    o = star.fact_order(spark, sf_dir, location=False)
    keys = read(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag") \
        .filter(F.col("l_returnflag") == "R").select("l_orderkey")
    return o.join(keys, o.id == keys.l_orderkey, "left_semi").select("id", "channel_id", "created_at", "net_total")


@register("surrogate_ids", """
SELECT l_orderkey AS order_id, sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS line_key
FROM lineitem""")
def q_surrogate_ids(spark, sf_dir):
    """Repeatable line keys from the natural key."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     surrogate_id("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_key"))


@register("table_counts", S.with_(S.fact_order(), S.FACT_ORDER_LINE, S.FACT_EVENT, S.INGEST_AUDIT) + """
SELECT 'fact_order' AS table_name, COUNT(*) AS row_count FROM fact_order
UNION ALL SELECT 'fact_order_line', COUNT(*) FROM fact_order_line
UNION ALL SELECT 'fact_event', COUNT(*) FROM fact_event
UNION ALL SELECT 'ingest_audit', COUNT(*) FROM ingest_audit""")
def q_table_counts(spark, sf_dir):
    """Row count per table, UNION ALL."""
    parts = [("fact_order", star.fact_order(spark, sf_dir, location=False)),
             ("fact_order_line", star.fact_order_line(spark, sf_dir, product=False)),
             ("fact_event", star.fact_event(spark, sf_dir)), ("ingest_audit", star.ingest_audit(spark, sf_dir))]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out
