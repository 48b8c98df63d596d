"""Channel performance, range rankings, shares and trends (SURVEY 2.5 A8/A10-A12/A20/A24/A25,
2.6 W2/W3, 2.7 L1-L4, P17, S14)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY_SUM, cents, pct, ratio_2dp, ratio_dp
from omnitally.operators import period as P
from omnitally.operators import rank as R
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.store import kpi_view
from omnitally.plans.q_period import RANGE, WEEK_CUR, WEEK_PREV
from omnitally.sources import star

_KPI = S.with_(S.kpi_ctes(dense=True), S.DIM_CHANNEL)
_IN_RANGE = f"date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"


def _kpi(spark, sf_dir, arrays=False):
    k = kpi_view(spark, sf_dir, dense=True)
    k = k if arrays else k.drop("top_items", "top_categories")
    return P.in_period(k, *RANGE)


@register("channel_performance", _KPI + f"""
, g AS (SELECT channel_id, CAST(SUM(sales) AS DECIMAL(18,2)) AS sales, CAST(SUM(txns) AS BIGINT) AS txns,
               CAST(SUM(units) AS BIGINT) AS units, SUM(aov) AS sa, COUNT(aov) AS na
        FROM kpi WHERE {_IN_RANGE} GROUP BY channel_id)
SELECT g.channel_id, COALESCE(dc.name, g.channel_id) AS channel_name, sales, txns, units,
       {S.ratio_2dp('sa * 100', 'na')} AS aov,
       {S.pct(S.cents('sales'), f"SUM({S.cents('sales')}) OVER ()")} AS percent_of_total
FROM g LEFT JOIN dim_channel dc ON g.channel_id = dc.id""")
def q_channel_performance(spark, sf_dir):
    """Channel comparison with names and share of sales."""
    return R.channel_performance(_kpi(spark, sf_dir), star.static_channels(spark))


_RANKED_ITEMS_IN_RANGE = (f"SELECT sku, label AS product_title, pieces AS qty, money AS revenue FROM {S.listed('item')} "
                          f"WHERE {_IN_RANGE}")
_RANKED_CATS_IN_RANGE = (f"SELECT label AS category, money AS revenue, pieces AS units FROM {S.listed('category')} "
                         f"WHERE {_IN_RANGE}")
_TOP_ITEMS_SQL = f"""
SELECT sku, product_title, CAST(SUM(qty) AS BIGINT) AS qty, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue
FROM ({_RANKED_ITEMS_IN_RANGE}) GROUP BY sku, product_title
ORDER BY revenue DESC, sku, product_title LIMIT 10"""


@register("top_items", _KPI + _TOP_ITEMS_SQL)
def q_top_items(spark, sf_dir):
    """A10/L1 faithful: range top 10 from the stored daily top-10 arrays."""
    return R.top_items_from_kpi(_kpi(spark, sf_dir, arrays=True))


@register("top_categories", _KPI + f"""
SELECT category, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue, CAST(SUM(units) AS BIGINT) AS units
FROM ({_RANKED_CATS_IN_RANGE}) GROUP BY category ORDER BY revenue DESC, category LIMIT 5""")
def q_top_categories(spark, sf_dir):
    """A11 faithful: range top 5 from the stored daily top-5 arrays."""
    return R.top_categories_from_kpi(_kpi(spark, sf_dir, arrays=True))


_LINES_IN_RANGE = f"""
SELECT fol.* FROM fact_order_line fol
WHERE fol.order_id IN (SELECT id FROM fact_order WHERE CAST(created_at AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}')"""


@register("top_items_exact", _KPI + f"""
SELECT sku, product_title, CAST(SUM(qty) AS BIGINT) AS qty, CAST(SUM(line_total) AS DECIMAL(18,2)) AS revenue
FROM ({_LINES_IN_RANGE}) WHERE sku IS NOT NULL GROUP BY sku, product_title
ORDER BY revenue DESC, sku, product_title LIMIT 10""")
def q_top_items_exact(spark, sf_dir):
    """A10 exact: range top 10 computed from the lines (no daily truncation)."""
    return R.top_items_exact(star.fact_order(spark, sf_dir, dense=True), star.fact_order_line(spark, sf_dir), *RANGE)


@register("top_categories_exact", _KPI + f"""
SELECT COALESCE(category, 'Uncategorized') AS category, CAST(SUM(line_total) AS DECIMAL(18,2)) AS revenue,
       CAST(SUM(qty) AS BIGINT) AS units
FROM ({_LINES_IN_RANGE}) GROUP BY 1 ORDER BY revenue DESC, category LIMIT 5""")
def q_top_categories_exact(spark, sf_dir):
    """A11 exact: range top 5 categories computed from the lines."""
    return R.top_categories_exact(star.fact_order(spark, sf_dir, dense=True), star.fact_order_line(spark, sf_dir),
                                  *RANGE)


@register("top_items_ranked", _KPI + f"SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, sku, product_title) AS BIGINT) AS rank FROM ({_TOP_ITEMS_SQL})")
def q_top_items_ranked(spark, sf_dir):
    """Rank numbers on the (10-row) top items list."""
    t = R.top_items_from_kpi(_kpi(spark, sf_dir, arrays=True))
    return R.with_rank(t, [F.col("revenue").desc(), "sku", "product_title"])


@register("top_items_by_units", _KPI + f"""
SELECT * FROM ({_TOP_ITEMS_SQL}) ORDER BY qty DESC, sku, product_title LIMIT 8""")
def q_top_items_by_units(spark, sf_dir):
    """L3: the top items list re-sorted by units, first 8."""
    t = R.top_items_from_kpi(_kpi(spark, sf_dir, arrays=True))
    return t.orderBy(F.col("qty").desc(), "sku", "product_title").limit(8)


@register("category_share", _KPI + f"""
, c AS (SELECT category, CAST(SUM(revenue) AS DECIMAL(18,2)) AS revenue, CAST(SUM(units) AS BIGINT) AS units
        FROM ({_RANKED_CATS_IN_RANGE}) GROUP BY category)
SELECT category, revenue, units, {S.ratio_2dp(S.cents('revenue'), 'units')} AS avg_price,
       {S.pct(S.cents('revenue'), f"SUM({S.cents('revenue')}) OVER ()")} AS share
FROM c""")
def q_category_share(spark, sf_dir):
    """W2 + P17: category share of revenue and average price (revenue / units, 0 if none)."""
    k = _kpi(spark, sf_dir, arrays=True)
    x = k.select(F.explode("top_categories").alias("c")).select("c.*")
    g = x.groupBy("category").agg(F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
                                  F.sum("units").cast("bigint").alias("units"))
    return g.select("category", "revenue", "units", ratio_2dp(cents("revenue"), "units").alias("avg_price"),
                    pct(cents("revenue"), F.sum(cents("revenue")).over(Window.partitionBy())).alias("share"))


_TREND_SQL = f"""
SELECT date, CAST(SUM(sales) AS DECIMAL(18,2)) AS sales, CAST(SUM(txns) AS BIGINT) AS txns,
       CAST(SUM(units) AS BIGINT) AS units
FROM kpi WHERE {_IN_RANGE} GROUP BY date"""


@register("daily_trend", _KPI + _TREND_SQL)
def q_daily_trend(spark, sf_dir):
    """Per-date totals, ascending."""
    return R.daily_trend(_kpi(spark, sf_dir)).orderBy("date")


@register("daily_trend_channel", _KPI + f"""
SELECT date, CAST(SUM(sales) AS DECIMAL(18,2)) AS revenue, CAST(SUM(txns) AS BIGINT) AS orders
FROM kpi WHERE {_IN_RANGE} AND channel_id = '1' GROUP BY date""")
def q_daily_trend_channel(spark, sf_dir):
    """Revenue and orders by date for one channel."""
    k = P.in_period(kpi_view(spark, sf_dir, dense=True).drop("top_items", "top_categories"), *RANGE, channel="1")
    return k.groupBy("date").agg(F.sum("sales").cast(MONEY_SUM).alias("revenue"),
                                 F.sum("txns").cast("bigint").alias("orders"))


@register("trend_last7", _KPI + f"SELECT * FROM ({_TREND_SQL}) ORDER BY date DESC LIMIT 7")
def q_trend_last7(spark, sf_dir):
    """L4: the last 7 days of the trend, returned in ascending order."""
    t = R.daily_trend(_kpi(spark, sf_dir)).orderBy(F.col("date").desc()).limit(7)
    return t.orderBy("date")


@register("report_ratios", _KPI + f"""
SELECT date, sales, txns, units,
       CAST(CASE WHEN txns > 0 THEN CAST((2 * units * 10 + txns) // (2 * txns) AS DECIMAL(18,0)) * 0.1 ELSE 0 END
            AS DECIMAL(18,1)) AS units_per_txn,
       {S.ratio_2dp(S.cents('sales'), 'txns')} AS daily_aov
FROM ({_TREND_SQL})""")
def q_report_ratios(spark, sf_dir):
    """Units per transaction (1 dp) and daily AOV, 0 when there are no transactions."""
    t = R.daily_trend(_kpi(spark, sf_dir))
    return t.select("date", "sales", "txns", "units", ratio_dp("units", "txns", 1).alias("units_per_txn"),
                    ratio_2dp(cents("sales"), "txns").alias("daily_aov"))


@register("customers_by_region", S.with_(S.fact_order(dense=True), S.dim_location(dense=True)) + """
, c AS (SELECT COALESCE(dl.name, 'Unknown') AS region, COUNT(DISTINCT fo.customer_hash) AS customers
        FROM fact_order fo LEFT JOIN dim_location dl ON fo.location_id = dl.id GROUP BY 1)
SELECT region, CAST(customers AS BIGINT) AS customers,
       CASE WHEN MAX(customers) OVER () > 0 THEN 100.0 * CAST(customers AS DOUBLE) / CAST(MAX(customers) OVER () AS DOUBLE)
            ELSE 0.0 END AS pct_of_max
FROM c ORDER BY customers DESC, region LIMIT 8""")
def q_customers_by_region(spark, sf_dir):
    """Distinct customers per region, top 8, bar length = share of the largest."""
    o = star.fact_order(spark, sf_dir, dense=True)
    dl = star.dim_location(spark, sf_dir, dense=True).select(F.col("id").alias("lid"), F.col("name"))
    j = o.join(dl, o.location_id == dl.lid, "left")
    g = j.groupBy(F.coalesce("name", F.lit("Unknown")).alias("region")) \
        .agg(F.countDistinct("customer_hash").cast("bigint").alias("customers"))
    mx = F.max("customers").over(Window.partitionBy())
    out = g.select("region", "customers", F.when(mx > 0, F.lit(100.0) * F.col("customers").cast("double")
                                                 / mx.cast("double")).otherwise(F.lit(0.0)).alias("pct_of_max"))
    return out.orderBy(F.col("customers").desc(), "region").limit(8)


@register("report_summary", _KPI + f"""
, cur AS (SELECT CAST(COALESCE(SUM(sales), 0) AS DECIMAL(18,2)) AS sales, CAST(COALESCE(SUM(txns), 0) AS BIGINT) AS txns,
                 CAST(COALESCE(SUM(units), 0) AS BIGINT) AS units,
                 {S.ratio_2dp('COALESCE(SUM(aov) * 100, 0)', 'COUNT(aov)')} AS aov
          FROM kpi WHERE date BETWEEN DATE '{WEEK_CUR[0]}' AND DATE '{WEEK_CUR[1]}'),
prev AS (SELECT CAST(COALESCE(SUM(sales), 0) AS DECIMAL(18,2)) AS sales, CAST(COALESCE(SUM(txns), 0) AS BIGINT) AS txns,
                {S.ratio_2dp('COALESCE(SUM(aov) * 100, 0)', 'COUNT(aov)')} AS aov
         FROM kpi WHERE date BETWEEN DATE '{WEEK_PREV[0]}' AND DATE '{WEEK_PREV[1]}')
SELECT 'weekly' AS period, DATE '{WEEK_CUR[0]}' AS start_date, DATE '{WEEK_CUR[1]}' AS end_date,
       DATE '{WEEK_PREV[0]}' AS comp_start_date, DATE '{WEEK_PREV[1]}' AS comp_end_date,
       cur.sales, cur.txns, cur.units, cur.aov,
       {S.growth('cur.sales', 'prev.sales')} AS sales_growth, {S.growth('cur.txns', 'prev.txns')} AS txns_growth,
       {S.growth('cur.aov', 'prev.aov')} AS aov_growth
FROM cur, prev""")
def q_report_summary(spark, sf_dir):
    """Report metadata + summary (weekly report ending on as_of, with growth)."""
    kpi = kpi_view(spark, sf_dir, dense=True).drop("top_items", "top_categories")
    # One scan with conditional aggregates for both periods (no join of one-row frames).
    g = P.period_growth(kpi, *WEEK_CUR, *WEEK_PREV, with_units=True)
    return g.select(
        F.lit("weekly").alias("period"), F.lit(WEEK_CUR[0]).cast("date").alias("start_date"),
        F.lit(WEEK_CUR[1]).cast("date").alias("end_date"), F.lit(WEEK_PREV[0]).cast("date").alias("comp_start_date"),
        F.lit(WEEK_PREV[1]).cast("date").alias("comp_end_date"),
        F.col("sales_current").alias("sales"), F.col("txns_current").alias("txns"),
        F.col("units_current").alias("units"),
        F.col("aov_current").alias("aov"), "sales_growth", "txns_growth", "aov_growth")

