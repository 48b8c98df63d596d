"""Period logic over the daily KPI table: ranges (D1-D3), aggregates (A7), growth (W5),
zero-filled trends (D4).

``as_of`` is always a parameter (a 'yyyy-MM-dd' string); nothing reads the wall clock.
Every period query filters the KPI table on ``date`` (and the matching ``month``), which prunes
partitions when the table is stored partitioned by month (see plans/jobs.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY_SUM, cents, growth_pct, ratio_2dp

# Dashboard periods, and report periods as days before the reference date
# (daily 1 day, weekly 7 days, monthly 30 trailing days).
PERIODS = ("today", "wtd", "mtd", "ytd", "custom")
REPORT_PERIODS = {"daily": 0, "weekly": 6, "monthly": 29}


def period_start(kind: str, as_of: Column) -> Column:
    """Start of a dashboard period; wtd weeks start on Monday; custom defaults to mtd."""
    if kind == "today":
        return as_of
    if kind == "wtd":
        return F.trunc(as_of, "week")
    if kind == "ytd":
        return F.trunc(as_of, "year")
    return F.trunc(as_of, "month")


def period_bounds(as_of_dates: DataFrame, col: str = "as_of") -> DataFrame:
    """D1 for every reference date: (as_of, period, start_date, end_date)."""
    rows = [F.struct(F.lit(k).alias("period"), period_start(k, F.col(col)).alias("start_date"))
            for k in PERIODS]
    return as_of_dates.select(F.col(col).alias("as_of"), F.explode(F.array(*rows)).alias("p")) \
        .select("as_of", "p.period", "p.start_date", F.col("as_of").alias("end_date"))


def report_bounds(as_of_dates: DataFrame, col: str = "as_of") -> DataFrame:
    """D2 + D3: report range ending on the date and the equally long range just before it."""
    rows = [F.struct(F.lit(k).alias("period"), F.lit(n).alias("n")) for k, n in REPORT_PERIODS.items()]
    x = as_of_dates.select(F.col(col).alias("as_of"), F.explode(F.array(*rows)).alias("p"))
    start = F.date_sub("as_of", F.col("p.n"))
    return x.select("as_of", "p.period", start.alias("start_date"), F.col("as_of").alias("end_date"),
                    F.date_sub(start, F.col("p.n") + 1).alias("comp_start_date"),
                    F.date_sub(start, 1).alias("comp_end_date"))


def in_period(kpi: DataFrame, start, end=None, channel: str | None = None,
              location: str | None = None) -> DataFrame:
    """Date >= start [and <= end]; channel/location optional ('all' = none).

    On the stored KPI table (partitioned by ``month``) the same bounds are also applied to
    the month column, so the scan reads only the months in range.
    """
    lo = F.lit(start).cast("date") if isinstance(start, str) else start
    hi = None if end is None else (F.lit(end).cast("date") if isinstance(end, str) else end)
    cond = F.col("date") >= lo
    if hi is not None:
        cond = cond & (F.col("date") <= hi)
    if "month" in kpi.columns:
        cond = cond & (F.col("month") >= F.trunc(lo, "month"))
        if hi is not None:
            cond = cond & (F.col("month") <= F.trunc(hi, "month"))
    if channel and channel != "all":
        cond = cond & (F.col("channel_id") == channel)
    if location and location != "all":
        cond = cond & (F.col("location_id") == location)
    return kpi.filter(cond)


def period_aggregates(kpi: DataFrame) -> DataFrame:
    """One row; sums, and the unweighted mean of the per-cell aov / items_per_customer
    (as the reference computes them), plus the weighted aov = sales / txns. 0 on empty."""
    a = kpi.agg(F.sum("sales").alias("s"), F.sum("txns").alias("t"), F.sum("units").alias("u"),
                F.sum("aov").alias("sa"), F.count("aov").alias("na"),
                F.sum("items_per_customer").alias("si"), F.count("items_per_customer").alias("ni"))
    return a.select(
        F.coalesce("s", F.lit(0)).cast(MONEY_SUM).alias("sales"),
        F.coalesce("t", F.lit(0)).cast("bigint").alias("txns"),
        F.coalesce("u", F.lit(0)).cast("bigint").alias("units"),
        ratio_2dp(F.coalesce(cents("sa"), F.lit(0)), "na").alias("aov"),
        ratio_2dp(F.coalesce(cents("si"), F.lit(0)), "ni").alias("items_per_customer"),
        ratio_2dp(F.coalesce(cents("s"), F.lit(0)), F.coalesce("t", F.lit(0))).alias("aov_weighted"))


def period_growth(kpi: DataFrame, cur_start: str, cur_end: str, prev_start: str, prev_end: str,
                  with_units: bool = False) -> DataFrame:
    """Current vs previous period in one scan with conditional aggregates
    (``with_units`` adds the current period's units for the report summary)."""
    cur = F.col("date").between(F.lit(cur_start).cast("date"), F.lit(cur_end).cast("date"))
    prev = F.col("date").between(F.lit(prev_start).cast("date"), F.lit(prev_end).cast("date"))
    k = in_period(kpi, prev_start, cur_end).filter(cur | prev)

    def s(c, cond):
        return F.sum(F.when(cond, F.col(c)))

    def n(c, cond):
        return F.count(F.when(cond, F.col(c)))
    a = k.agg(s("sales", cur).alias("sc"), s("sales", prev).alias("sp"),
              s("txns", cur).alias("tc"), s("txns", prev).alias("tp"),
              s("aov", cur).alias("ac"), n("aov", cur).alias("nc"),
              s("aov", prev).alias("ap"), n("aov", prev).alias("np"), s("units", cur).alias("uc"))
    sales_c = F.coalesce("sc", F.lit(0)).cast(MONEY_SUM)
    sales_p = F.coalesce("sp", F.lit(0)).cast(MONEY_SUM)
    tx_c = F.coalesce("tc", F.lit(0)).cast("bigint")
    tx_p = F.coalesce("tp", F.lit(0)).cast("bigint")
    aov_c = ratio_2dp(F.coalesce(cents("ac"), F.lit(0)), "nc")
    aov_p = ratio_2dp(F.coalesce(cents("ap"), F.lit(0)), "np")
    extra = [F.coalesce("uc", F.lit(0)).cast("bigint").alias("units_current")] if with_units else []
    return a.select(*extra, sales_c.alias("sales_current"), sales_p.alias("sales_previous"),
                    growth_pct(sales_c, sales_p).alias("sales_growth"),
                    tx_c.alias("txns_current"), tx_p.alias("txns_previous"),
                    growth_pct(tx_c, tx_p).alias("txns_growth"),
                    aov_c.alias("aov_current"), aov_p.alias("aov_previous"),
                    growth_pct(aov_c, aov_p).alias("aov_growth"))


def calendar_buckets(spark, start: str, count: int, unit: str, as_date: bool = False) -> DataFrame:
    """``count`` consecutive buckets from ``start``; ``unit`` is 'hour', 'day' or 'month'."""
    first = F.lit(start).cast("date") if as_date else F.to_timestamp_ntz(F.lit(start))
    last = first + F.expr(f"interval {count - 1} {unit}")
    seq = F.sequence(first, last, F.expr(f"interval 1 {unit}"))
    return spark.range(1).select(F.explode(seq).alias("bucket"))


# Chart label formats per period grain (hourly, weekday, month-day, month).
LABEL_FORMATS = {"today": "HH:mm", "wtd": "EEE", "mtd": "MMM d", "ytd": "MMM"}


def bucket_label(bucket: Column, period: str) -> Column:
    """The display label of a trend bucket for its period grain."""
    return F.date_format(bucket, LABEL_FORMATS[period])


def zero_filled(buckets: DataFrame, values: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Every bucket present; missing measures become 0."""
    j = buckets.join(values, buckets.bucket == values[key], "left")
    return j.select("bucket", *[F.coalesce(F.col(m), F.lit(0)).cast(values.schema[m].dataType).alias(m)
                                for m in measures])
