"""Rankings, shares and trends over the KPI table and the line facts (A8, A10-A12, W2,
W3, L1-L4).

Range rankings end in ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each partition keeps its own top k and only those rows reach the
final merge, so no task ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY_SUM, cents, pct, ratio_2dp
from omnitally.sources.star import CELL


def channel_performance(kpi: DataFrame, channels: DataFrame) -> DataFrame:
    """A8 + J4 + W2: per channel sums, mean cell aov, name (falls back to id), share."""
    g = kpi.groupBy("channel_id").agg(
        F.sum("sales").cast(MONEY_SUM).alias("sales"), F.sum("txns").cast("bigint").alias("txns"),
        F.sum("units").cast("bigint").alias("units"), F.sum("aov").alias("sa"), F.count("aov").alias("na"))
    names = channels.select(F.col("id").alias("cid"), F.col("name").alias("channel_name"))
    j = g.join(names, g.channel_id == names.cid, "left")
    # The share window runs over one row per channel (the aggregated result), never raw rows.
    total = F.sum(cents("sales")).over(Window.partitionBy())
    return j.select("channel_id", F.coalesce("channel_name", "channel_id").alias("channel_name"),
                    "sales", "txns", "units", ratio_2dp(cents("sa"), "na").alias("aov"),
                    pct(cents("sales"), total).alias("percent_of_total"))


def top_items_from_kpi(kpi: DataFrame, limit: int = 10) -> DataFrame:
    """A10 (faithful): re-sum the stored daily top-10 arrays; lossy by design."""
    x = kpi.select(F.explode("top_items").alias("i")).select("i.*")
    g = x.groupBy("sku", "product_title").agg(F.sum("qty").cast("bigint").alias("qty"),
                                              F.sum("revenue").cast(MONEY_SUM).alias("revenue"))
    return g.orderBy(F.col("revenue").desc(), "sku", "product_title").limit(limit)


def top_categories_from_kpi(kpi: DataFrame, limit: int = 5) -> DataFrame:
    """A11 (faithful): re-sum the stored daily top-5 category arrays."""
    x = kpi.select(F.explode("top_categories").alias("c")).select("c.*")
    g = x.groupBy("category").agg(F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
                                  F.sum("units").cast("bigint").alias("units"))
    return g.orderBy(F.col("revenue").desc(), "category").limit(limit)


def order_lines_in_range(orders: DataFrame, lines: DataFrame, start: str, end: str) -> DataFrame:
    d = F.to_date("created_at")
    o = orders.filter(d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("id", "channel_id")
    return lines.join(o, lines.order_id == o.id, "left_semi")


def top_items_exact(orders: DataFrame, lines: DataFrame, start: str, end: str, limit: int = 10) -> DataFrame:
    """A10 (exact): ranking straight from the lines of the range."""
    li = order_lines_in_range(orders, lines, start, end).filter(F.col("sku").isNotNull())
    g = li.groupBy("sku", "product_title").agg(F.sum("qty").cast("bigint").alias("qty"),
                                               F.sum("line_total").cast(MONEY_SUM).alias("revenue"))
    return g.orderBy(F.col("revenue").desc(), "sku", "product_title").limit(limit)


def top_categories_exact(orders: DataFrame, lines: DataFrame, start: str, end: str, limit: int = 5) -> DataFrame:
    li = order_lines_in_range(orders, lines, start, end)
    g = li.groupBy(F.coalesce("category", F.lit("Uncategorized")).alias("category")).agg(
        F.sum("line_total").cast(MONEY_SUM).alias("revenue"), F.sum("qty").cast("bigint").alias("units"))
    return g.orderBy(F.col("revenue").desc(), "category").limit(limit)


def daily_trend(kpi: DataFrame) -> DataFrame:
    """Per date sales, txns (and units, which the docs promise)."""
    return kpi.groupBy("date").agg(F.sum("sales").cast(MONEY_SUM).alias("sales"),
                                   F.sum("txns").cast("bigint").alias("txns"),
                                   F.sum("units").cast("bigint").alias("units"))


def with_rank(df: DataFrame, order_cols: list, name: str = "rank") -> DataFrame:
    """1-based rank of an already small, sorted list (a top-k result)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)).cast("bigint"))


__all__ = ["CELL", "channel_performance", "top_items_from_kpi", "top_categories_from_kpi",
           "top_items_exact", "top_categories_exact", "daily_trend", "with_rank"]
