"""Period KPIs, bounds, growth and trends (SURVEY 2.3 F2-F5/F16, 2.5 A7/A19/A22/A23,
2.6 W5, 2.12 D1-D4, S13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY_SUM, cents, ratio_2dp
from omnitally.operators import period as P
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.store import kpi_view
from omnitally.sources import star

AS_OF = star.ORDER_AS_OF  # 2001-06-15, a Friday
RANGE = ("2001-05-01", "2001-05-31")
WEEK_CUR = ("2001-06-09", "2001-06-15")   # report 'weekly' ending on AS_OF
WEEK_PREV = ("2001-06-02", "2001-06-08")  # comparison period just before

_KPI = S.with_(S.kpi_ctes(dense=True))


def _agg_sql(where: str) -> str:
    return _KPI + f"""
SELECT CAST(COALESCE(SUM(sales), 0) AS DECIMAL(18,2)) AS sales,
       CAST(COALESCE(SUM(txns), 0) AS BIGINT) AS txns,
       CAST(COALESCE(SUM(units), 0) AS BIGINT) AS units,
       {S.ratio_2dp('COALESCE(SUM(aov) * 100, 0)', 'COUNT(aov)')} AS aov,
       {S.ratio_2dp('COALESCE(SUM(items_per_customer) * 100, 0)', 'COUNT(items_per_customer)')} AS items_per_customer,
       {S.ratio_2dp('COALESCE(SUM(sales) * 100, 0)', 'COALESCE(SUM(txns), 0)')} AS aov_weighted
FROM kpi WHERE {where}"""


def _dense(spark, sf_dir):
    return kpi_view(spark, sf_dir, dense=True).drop("top_items", "top_categories")


@register("kpi_today", _agg_sql(f"date = DATE '{AS_OF}'"))
def q_kpi_today(spark, sf_dir):
    """F4 + A7: today's cells (as_of)."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), AS_OF, AS_OF))


@register("kpi_wtd", _agg_sql(f"date >= CAST(date_trunc('week', DATE '{AS_OF}') AS DATE)"))
def q_kpi_wtd(spark, sf_dir):
    """date >= Monday of as_of's week, no upper bound (as in the reference)."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), P.period_start("wtd", F.lit(AS_OF).cast("date"))))


@register("kpi_mtd", _agg_sql(f"date >= CAST(date_trunc('month', DATE '{AS_OF}') AS DATE)"))
def q_kpi_mtd(spark, sf_dir):
    """F5 + A7: month to date (date >= first of as_of's month, no upper bound)."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), P.period_start("mtd", F.lit(AS_OF).cast("date"))))


@register("kpi_ytd", _agg_sql(f"date >= CAST(date_trunc('year', DATE '{AS_OF}') AS DATE)"))
def q_kpi_ytd(spark, sf_dir):
    """F5 + A7: year to date (date >= Jan 1 of as_of's year, no upper bound)."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), P.period_start("ytd", F.lit(AS_OF).cast("date"))))


@register("kpi_range", _agg_sql(f"date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"))
def q_kpi_range(spark, sf_dir):
    """A7 over a custom inclusive range."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), *RANGE))


@register("kpi_range_channel", _agg_sql(f"date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND channel_id = '2'"))
def q_kpi_range_channel(spark, sf_dir):
    """F2 + F3 + A7: custom range for one channel."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), *RANGE, channel="2"))


@register("kpi_by_location", _agg_sql(f"date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND location_id = '3'"))
def q_kpi_by_location(spark, sf_dir):
    """F16: location filter (declared in the reference UI, wired here)."""
    return P.period_aggregates(P.in_period(_dense(spark, sf_dir), *RANGE, location="3"))


@register("filter_date_range", _KPI + f"""
SELECT date, channel_id, location_id, sales, txns, units, aov FROM kpi
WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def q_filter_date_range(spark, sf_dir):
    """inclusive date range on the KPI table."""
    return P.in_period(_dense(spark, sf_dir), *RANGE).select(
        "date", "channel_id", "location_id", "sales", "txns", "units", "aov")


@register("filter_channel", _KPI + f"""
SELECT date, channel_id, location_id, sales, txns FROM kpi
WHERE date >= DATE '{RANGE[0]}' AND channel_id = '1'""")
def q_filter_channel(spark, sf_dir):
    """optional channel equality ('all' or absent means no filter)."""
    return P.in_period(_dense(spark, sf_dir), RANGE[0], channel="1").select(
        "date", "channel_id", "location_id", "sales", "txns")


@register("kpi_latest", _KPI + """
SELECT date, channel_id, location_id, sales, txns FROM kpi
ORDER BY date DESC, channel_id, location_id NULLS FIRST LIMIT 10""")
def q_kpi_latest(spark, sf_dir):
    """Newest 10 KPI rows (a top-k report)."""
    return _dense(spark, sf_dir).orderBy(F.col("date").desc(), "channel_id", F.col("location_id").asc_nulls_first()) \
        .limit(10).select("date", "channel_id", "location_id", "sales", "txns")


_DATES = "SELECT DISTINCT CAST(created_at AS DATE) AS as_of FROM fact_order"


@register("period_bounds", S.with_(S.fact_order(dense=True)) + f"""
SELECT as_of, period, start_date, as_of AS end_date FROM (
  SELECT as_of, 'today' AS period, as_of AS start_date FROM ({_DATES})
  UNION ALL SELECT as_of, 'wtd', CAST(date_trunc('week', as_of) AS DATE) FROM ({_DATES})
  UNION ALL SELECT as_of, 'mtd', CAST(date_trunc('month', as_of) AS DATE) FROM ({_DATES})
  UNION ALL SELECT as_of, 'ytd', CAST(date_trunc('year', as_of) AS DATE) FROM ({_DATES})
  UNION ALL SELECT as_of, 'custom', CAST(date_trunc('month', as_of) AS DATE) FROM ({_DATES}))""")
def q_period_bounds(spark, sf_dir):
    """D1 for every order date present in the data."""
    o = star.fact_order(spark, sf_dir, dense=True, location=False)
    return P.period_bounds(o.select(F.to_date("created_at").alias("as_of")).distinct())


@register("report_bounds", S.with_(S.fact_order(dense=True)) + f"""
SELECT as_of, period, as_of - n AS start_date, as_of AS end_date,
       as_of - n - (n + 1) AS comp_start_date, as_of - n - 1 AS comp_end_date
FROM ({_DATES}) d, (VALUES ('daily', 0), ('weekly', 6), ('monthly', 29)) p(period, n)""")
def q_report_bounds(spark, sf_dir):
    """D2 + D3 for every order date present in the data."""
    o = star.fact_order(spark, sf_dir, dense=True, location=False)
    return P.report_bounds(o.select(F.to_date("created_at").alias("as_of")).distinct())


@register("period_growth", _KPI + f"""
, a AS (
  SELECT SUM(CASE WHEN date BETWEEN DATE '{WEEK_CUR[0]}' AND DATE '{WEEK_CUR[1]}' THEN sales END) AS sc,
         SUM(CASE WHEN date BETWEEN DATE '{WEEK_PREV[0]}' AND DATE '{WEEK_PREV[1]}' THEN sales END) AS sp,
         SUM(CASE WHEN date BETWEEN DATE '{WEEK_CUR[0]}' AND DATE '{WEEK_CUR[1]}' THEN txns END) AS tc,
         SUM(CASE WHEN date BETWEEN DATE '{WEEK_PREV[0]}' AND DATE '{WEEK_PREV[1]}' THEN txns END) AS tp,
         SUM(CASE WHEN date BETWEEN DATE '{WEEK_CUR[0]}' AND DATE '{WEEK_CUR[1]}' THEN aov END) AS ac,
         COUNT(CASE WHEN date BETWEEN DATE '{WEEK_CUR[0]}' AND DATE '{WEEK_CUR[1]}' THEN aov END) AS nc,
         SUM(CASE WHEN date BETWEEN DATE '{WEEK_PREV[0]}' AND DATE '{WEEK_PREV[1]}' THEN aov END) AS ap,
         COUNT(CASE WHEN date BETWEEN DATE '{WEEK_PREV[0]}' AND DATE '{WEEK_PREV[1]}' THEN aov END) AS np
  FROM kpi),
b AS (
  SELECT CAST(COALESCE(sc, 0) AS DECIMAL(18,2)) AS sales_current, CAST(COALESCE(sp, 0) AS DECIMAL(18,2)) AS sales_previous,
         CAST(COALESCE(tc, 0) AS BIGINT) AS txns_current, CAST(COALESCE(tp, 0) AS BIGINT) AS txns_previous,
         {S.ratio_2dp('COALESCE(ac * 100, 0)', 'nc')} AS aov_current,
         {S.ratio_2dp('COALESCE(ap * 100, 0)', 'np')} AS aov_previous
  FROM a)
SELECT sales_current, sales_previous, {S.growth('sales_current', 'sales_previous')} AS sales_growth,
       txns_current, txns_previous, {S.growth('txns_current', 'txns_previous')} AS txns_growth,
       aov_current, aov_previous, {S.growth('aov_current', 'aov_previous')} AS aov_growth
FROM b""")
def q_period_growth(spark, sf_dir):
    """Weekly report growth vs the previous 7 days."""
    return P.period_growth(_dense(spark, sf_dir), *WEEK_CUR, *WEEK_PREV)


@register("trend_hourly", S.with_(S.fact_order(dense=True)) + f"""
SELECT b.bucket, strftime(b.bucket, '%H:%M') AS label,
       CAST(COALESCE(v.sales, 0) AS DECIMAL(18,2)) AS sales, CAST(COALESCE(v.txns, 0) AS BIGINT) AS txns
FROM (SELECT unnest(generate_series(TIMESTAMP '{AS_OF} 00:00:00', TIMESTAMP '{AS_OF} 23:00:00', INTERVAL 1 HOUR)) AS bucket) b
LEFT JOIN (SELECT date_trunc('hour', created_at) AS h, SUM(net_total) AS sales, COUNT(*) AS txns
           FROM fact_order WHERE CAST(created_at AS DATE) = DATE '{AS_OF}' GROUP BY 1) v ON b.bucket = v.h""")
def q_trend_hourly(spark, sf_dir):
    """D4 'today': 24 hourly buckets, zero-filled, from order timestamps."""
    o = star.fact_order(spark, sf_dir, dense=True).filter(F.to_date("created_at") == F.lit(AS_OF).cast("date"))
    v = o.groupBy(F.date_trunc("hour", "created_at").cast("timestamp_ntz").alias("h")).agg(
        F.sum("net_total").cast(MONEY_SUM).alias("sales"), F.count(F.lit(1)).alias("txns"))
    out = P.zero_filled(P.calendar_buckets(spark, f"{AS_OF} 00:00:00", 24, "hour"), v, "h", ["sales", "txns"])
    return out.withColumn("label", P.bucket_label(F.col("bucket"), "today"))


def _daily_sql(start_expr: str, days: str, label: str) -> str:
    fmt = "%a" if label == "wtd" else "%b %-d"
    return f"""
SELECT '{label}' AS period, b.bucket, strftime(b.bucket, '{fmt}') AS label,
       CAST(COALESCE(v.sales, 0) AS DECIMAL(18,2)) AS sales,
       CAST(COALESCE(v.txns, 0) AS BIGINT) AS txns, CAST(COALESCE(v.units, 0) AS BIGINT) AS units
FROM (SELECT CAST(unnest(generate_series({start_expr}, {start_expr} + INTERVAL ({days}) DAY, INTERVAL 1 DAY)) AS DATE) AS bucket) b
LEFT JOIN (SELECT date, SUM(sales) AS sales, SUM(txns) AS txns, SUM(units) AS units FROM kpi GROUP BY date) v
  ON b.bucket = v.date"""


@register("trend_daily", _KPI + _daily_sql(f"CAST(date_trunc('week', DATE '{AS_OF}') AS DATE)", "6", "wtd")
          + "\nUNION ALL\n" + _daily_sql(f"CAST(date_trunc('month', DATE '{AS_OF}') AS DATE)",
                                         f"day(DATE '{AS_OF}') - 1", "mtd"))
def q_trend_daily(spark, sf_dir):
    """D4 'wtd' (Monday..Sunday, 7 buckets) and 'mtd' (1st..as_of), zero-filled."""
    monday = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=dt.date.fromisoformat(AS_OF).weekday())
    kpi = P.in_period(_dense(spark, sf_dir), str(min(monday, dt.date.fromisoformat(AS_OF).replace(day=1))),
                      str(max(monday + dt.timedelta(days=6), dt.date.fromisoformat(AS_OF))))
    v = kpi.groupBy("date").agg(F.sum("sales").cast(MONEY_SUM).alias("sales"),
                                F.sum("txns").cast("bigint").alias("txns"),
                                F.sum("units").cast("bigint").alias("units"))
    monday = P.period_start("wtd", F.lit(AS_OF).cast("date"))
    first = P.period_start("mtd", F.lit(AS_OF).cast("date"))
    b_w = spark.range(1).select(F.explode(F.sequence(monday, F.date_add(monday, 6))).alias("bucket"))
    b_m = spark.range(1).select(F.explode(F.sequence(first, F.lit(AS_OF).cast("date"))).alias("bucket"))
    w = P.zero_filled(b_w, v, "date", ["sales", "txns", "units"]).select(
        F.lit("wtd").alias("period"), "*", P.bucket_label(F.col("bucket"), "wtd").alias("label"))
    m = P.zero_filled(b_m, v, "date", ["sales", "txns", "units"]).select(
        F.lit("mtd").alias("period"), "*", P.bucket_label(F.col("bucket"), "mtd").alias("label"))
    return w.unionByName(m)


@register("trend_monthly", _KPI + f"""
SELECT b.bucket, strftime(b.bucket, '%b') AS label,
       CAST(COALESCE(v.sales, 0) AS DECIMAL(18,2)) AS sales, CAST(COALESCE(v.txns, 0) AS BIGINT) AS txns,
       CAST(COALESCE(v.units, 0) AS BIGINT) AS units
FROM (SELECT CAST(unnest(generate_series(DATE '{AS_OF[:4]}-01-01', DATE '{AS_OF[:4]}-12-01', INTERVAL 1 MONTH)) AS DATE) AS bucket) b
LEFT JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS m, SUM(sales) AS sales, SUM(txns) AS txns, SUM(units) AS units
           FROM kpi WHERE year(date) = {AS_OF[:4]} GROUP BY 1) v ON b.bucket = v.m""")
def q_trend_monthly(spark, sf_dir):
    """D4 'ytd': 12 monthly buckets of as_of's year, zero-filled."""
    kpi = P.in_period(_dense(spark, sf_dir), f"{AS_OF[:4]}-01-01", f"{AS_OF[:4]}-12-31")
    v = kpi.groupBy(F.trunc("date", "month").alias("m")).agg(
        F.sum("sales").cast(MONEY_SUM).alias("sales"), F.sum("txns").cast("bigint").alias("txns"),
        F.sum("units").cast("bigint").alias("units"))
    out = P.zero_filled(P.calendar_buckets(spark, f"{AS_OF[:4]}-01-01", 12, "month", as_date=True), v, "m",
                        ["sales", "txns", "units"])
    return out.withColumn("label", P.bucket_label(F.col("bucket"), "ytd"))


@register("period_customers", S.with_(S.kpi_ctes(dense=True)) + f"""
, c AS (SELECT COUNT(DISTINCT customer_hash) AS customers FROM fact_order
        WHERE CAST(created_at AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'),
u AS (SELECT CAST(COALESCE(SUM(units), 0) AS BIGINT) AS units FROM kpi
      WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}')
SELECT CAST(c.customers AS BIGINT) AS customers, u.units,
       {S.ratio_2dp('u.units * 100', 'c.customers')} AS items_per_customer
FROM c, u""")
def q_period_customers(spark, sf_dir):
    """Distinct customers in the period and units per customer (dashboard definition)."""
    o = star.fact_order(spark, sf_dir, dense=True)
    c = o.filter(F.to_date("created_at").between(F.lit(RANGE[0]).cast("date"), F.lit(RANGE[1]).cast("date"))) \
        .select("customer_hash").distinct().agg(F.count("customer_hash").alias("customers"))
    u = P.in_period(_dense(spark, sf_dir), *RANGE).agg(F.coalesce(F.sum("units"), F.lit(0)).cast("bigint").alias("units"))
    # Two one-row aggregates combined by a union + global max (no join needed).
    both = c.select("customers", F.lit(None).cast("bigint").alias("units")) \
        .unionByName(u.select(F.lit(None).cast("bigint").alias("customers"), "units")) \
        .agg(F.max("customers").alias("customers"), F.max("units").alias("units"))
    return both.select(F.col("customers").cast("bigint"), "units",
                       ratio_2dp("units", "customers", num_in_cents=False).alias("items_per_customer"))


@register("series_summary", _KPI + f"""
, d AS (SELECT date, SUM(sales) AS sales, SUM(units) AS units FROM kpi
        WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY date)
SELECT CAST(MAX(sales) AS DECIMAL(18,2)) AS peak_sales,
       {S.ratio_2dp('SUM(sales) * 100', 'COUNT(*)')} AS mean_sales,
       CAST(SUM(units) AS BIGINT) AS total_units, CAST(MAX(units) AS BIGINT) AS peak_units
FROM d""")
def q_series_summary(spark, sf_dir):
    """Peak and mean daily sales, total and peak daily units over a range."""
    d = P.in_period(_dense(spark, sf_dir), *RANGE).groupBy("date").agg(
        F.sum("sales").alias("sales"), F.sum("units").alias("units"))
    a = d.agg(F.max("sales").alias("mx"), F.sum("sales").alias("s"), F.count(F.lit(1)).alias("n"),
              F.sum("units").alias("u"), F.max("units").alias("mu"))
    return a.select(F.col("mx").cast(MONEY_SUM).alias("peak_sales"), ratio_2dp(cents("s"), "n").alias("mean_sales"),
                    F.col("u").cast("bigint").alias("total_units"), F.col("mu").cast("bigint").alias("peak_units"))


@register("kpi_response", _KPI + f"""
SELECT 'kpis' AS section, CAST(NULL AS DATE) AS date,
       CAST(COALESCE(SUM(sales), 0) AS DECIMAL(18,2)) AS sales, CAST(COALESCE(SUM(txns), 0) AS BIGINT) AS txns,
       CAST(COALESCE(SUM(units), 0) AS BIGINT) AS units,
       {S.ratio_2dp('COALESCE(SUM(aov) * 100, 0)', 'COUNT(aov)')} AS aov
FROM kpi WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND channel_id = '3'
UNION ALL
SELECT 'trend', date, CAST(SUM(sales) AS DECIMAL(18,2)), CAST(SUM(txns) AS BIGINT), CAST(SUM(units) AS BIGINT),
       CAST(NULL AS DECIMAL(14,2))
FROM kpi WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND channel_id = '3' GROUP BY date""")
def q_kpi_response(spark, sf_dir):
    """The KPI endpoint's dataset {kpis, trend} for start/end/channel as one frame."""
    k = P.in_period(_dense(spark, sf_dir), *RANGE, channel="3")
    a = P.period_aggregates(k).select(F.lit("kpis").alias("section"), F.lit(None).cast("date").alias("date"),
                                      "sales", "txns", "units", "aov")
    t = k.groupBy("date").agg(F.sum("sales").cast(MONEY_SUM).alias("sales"), F.sum("txns").cast("bigint").alias("txns"),
                              F.sum("units").cast("bigint").alias("units")) \
        .select(F.lit("trend").alias("section"), "date", "sales", "txns", "units",
                F.lit(None).cast("decimal(14,2)").alias("aov"))
    return a.unionByName(t)


@register("upcoming_attendance", S.with_(S.FACT_EVENT) + f"""
SELECT CAST(COALESCE(SUM(CASE WHEN CAST(starts_at AS DATE) = DATE '{star.EVENT_AS_OF}' + 1 THEN attendees END), 0) AS BIGINT) AS tomorrow,
       CAST(COALESCE(SUM(CASE WHEN CAST(starts_at AS DATE) BETWEEN DATE '{star.EVENT_AS_OF}' + 1 AND DATE '{star.EVENT_AS_OF}' + 7 THEN attendees END), 0) AS BIGINT) AS next_week,
       CAST(COALESCE(SUM(CASE WHEN CAST(starts_at AS DATE) BETWEEN DATE '{star.EVENT_AS_OF}' + 1 AND DATE '{star.EVENT_AS_OF}' + 30 THEN attendees END), 0) AS BIGINT) AS next_month,
       CAST(COALESCE(SUM(CASE WHEN CAST(starts_at AS DATE) > DATE '{star.EVENT_AS_OF}' THEN attendees END), 0) AS BIGINT) AS total_upcoming
FROM fact_event""")
def q_upcoming_attendance(spark, sf_dir):
    """Guests tomorrow / next 7 days / next 30 days / all upcoming."""
    e = star.fact_event(spark, sf_dir).withColumn("d", F.to_date("starts_at"))
    a = F.lit(star.EVENT_AS_OF).cast("date")

    def s(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("attendees"))), F.lit(0)).cast("bigint")
    return e.agg(s(F.col("d") == F.date_add(a, 1)).alias("tomorrow"),
                 s(F.col("d").between(F.date_add(a, 1), F.date_add(a, 7))).alias("next_week"),
                 s(F.col("d").between(F.date_add(a, 1), F.date_add(a, 30))).alias("next_month"),
                 s(F.col("d") > a).alias("total_upcoming"))
