"""Daily KPI build: grain (date, channel_id, location_id).

Shuffle plan (see README "Scale notes"):

1. orders JOIN lines once; one aggregate at (cell, sku, title, category) with quantity,
   revenue and number of lines feeds the item ranking and, in one aggregate, the category
   ranking and the cells' line totals. Both read all of its columns, so AQE reuses its exchange
   at runtime (ReusedExchange in the final plan): lines are scanned, joined and shuffled once.
2. Sales, transactions and customers per cell come from the orders alone. Distinct customers are
   pre-aggregated per (cell, customer) instead of a ``countDistinct`` next to other
   aggregates (which would Expand every row).
3. ``row_number() <= k`` compiles to a partial WindowGroupLimit before the shuffle, so a
   hot cell ships at most k rows per map task.
4. Cell aggregates and the ranked rows are combined with one union + groupBy on the cell
   key (null-safe by construction, hash-based collect_list), one shuffle of per-cell rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY, MONEY_SUM, cents, ratio_2dp
from omnitally.sources.star import CELL

# Fixed values (must equal the reference): daily top-k sizes and the label of a missing
# category.
TOP_ITEMS = 10
TOP_CATEGORIES = 5
UNCATEGORIZED = "Uncategorized"

ITEM_TYPE = "array<struct<sku:string,product_title:string,qty:bigint,revenue:decimal(18,2)>>"
CATEGORY_TYPE = "array<struct<category:string,revenue:decimal(18,2),units:bigint>>"


def slim_orders(orders: DataFrame) -> DataFrame:
    """Order columns the KPI build needs (column pruning narrows it further per join)."""
    return orders.select("id", F.to_date("created_at").alias("date"), "channel_id", "location_id",
                         "net_total", "customer_hash")


def per_order_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("line_item_count"),
                                         F.sum("qty").alias("units"))


def order_line_counts(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """A1: one row per order with its line count (0 without lines) and units (null)."""
    o = slim_orders(orders)
    pl = per_order_lines(lines)
    return o.join(pl, o.id == pl.order_id, "left").select(
        *CELL, F.col("id").alias("order_id"), "net_total", "customer_hash",
        F.coalesce("line_item_count", F.lit(0)).cast("bigint").alias("line_item_count"),
        F.col("units").cast("bigint").alias("units"))


def daily_aggregates(olc: DataFrame, approx_customers: bool = False) -> DataFrame:
    """A2 (+A3 units): per cell sums; distinct customers via a (cell, customer) pre-aggregate.

    ``approx_customers`` swaps the exact count for ``approx_count_distinct`` (HyperLogLog++,
    one shuffle fewer) as an option; the KPI table uses the exact count.
    """
    if approx_customers:
        return olc.groupBy(*CELL).agg(
            F.sum("net_total").cast(MONEY_SUM).alias("sales"), F.count(F.lit(1)).alias("txns"),
            F.approx_count_distinct("customer_hash").cast("bigint").alias("unique_customers"),
            F.sum("line_item_count").cast("bigint").alias("total_line_items"),
            F.sum("units").cast("bigint").alias("units"))
    per_cust = olc.groupBy(*CELL, "customer_hash").agg(
        F.sum("net_total").alias("s"), F.count(F.lit(1)).alias("n"),
        F.sum("line_item_count").alias("l"), F.sum("units").alias("u"))
    return per_cust.groupBy(*CELL).agg(
        F.sum("s").cast(MONEY_SUM).alias("sales"),
        F.sum("n").cast("bigint").alias("txns"),
        F.count("customer_hash").cast("bigint").alias("unique_customers"),
        F.sum("l").cast("bigint").alias("total_line_items"),
        F.sum("u").cast("bigint").alias("units"))


def item_category_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Shared aggregate at (cell, sku, title, category) over orders JOIN lines."""
    o = slim_orders(orders)
    j = lines.join(o, lines.order_id == o.id, "inner")
    return j.groupBy(*CELL, "sku", "product_title",
                     F.coalesce("category", F.lit(UNCATEGORIZED)).alias("category")).agg(
        F.sum("qty").alias("qty"), F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines"))


def order_totals(orders: DataFrame) -> DataFrame:
    """A2 without the lines: sales, transactions and distinct customers of every cell."""
    per_cust = slim_orders(orders).groupBy(*CELL, "customer_hash").agg(F.sum("net_total").alias("s"), F.count(F.lit(1)).alias("n"))
    return per_cust.groupBy(*CELL).agg(F.sum("s").cast(MONEY_SUM).alias("sales"), F.sum("n").cast("bigint").alias("txns"),
                                       F.count("customer_hash").cast("bigint").alias("unique_customers"))


def rank_items(ict: DataFrame, k: int = TOP_ITEMS) -> DataFrame:
    """Best k (sku, title) per cell by revenue; sku must be present.

    Rows without sku sort last inside the window and are removed after ranking, so the
    filter is not pushed below the shared aggregate and both rankings reuse one shuffle; for
    the same reason an item comes with its number of lines.
    """
    items = ict.groupBy(*CELL, "sku", "product_title").agg(
        F.sum("qty").cast("bigint").alias("qty"), F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        F.sum("lines").cast("bigint").alias("lines"))
    w = Window.partitionBy(*CELL).orderBy(F.col("sku").isNull(), F.col("revenue").desc(),
                                          F.col("sku"), F.col("product_title"))
    return items.withColumn("item_rank", F.row_number().over(w).cast("bigint")) \
        .filter((F.col("item_rank") <= k) & F.col("sku").isNotNull())


def rank_categories(ict: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """Best k categories per cell by revenue (null grouped as 'Uncategorized')."""
    cats = ict.groupBy(*CELL, "category").agg(
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"), F.sum("qty").cast("bigint").alias("units"))
    w = Window.partitionBy(*CELL).orderBy(F.col("revenue").desc(), F.col("category"))
    return cats.withColumn("category_rank", F.row_number().over(w).cast("bigint")) \
        .filter(F.col("category_rank") <= k)


def categories_and_totals(ict: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """``rank_categories`` and, marked ``whole``, the cell's line totals (A1 + A3), in one aggregate.

    The grouping sets are (cell, category) and (cell); a cell's only whole row ranks first.
    """
    sets = ict.groupingSets([[*CELL, "category"], CELL], *CELL, "category").agg(
        (F.grouping("category") == 1).alias("whole"), F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        F.sum("qty").cast("bigint").alias("units"), F.sum("lines").cast("bigint").alias("lines"))
    w = Window.partitionBy(*CELL, "whole").orderBy(F.col("revenue").desc(), F.col("category"))
    return sets.withColumn("category_rank", F.row_number().over(w).cast("bigint")) \
        .filter(F.col("category_rank") <= k)


def kpi_from_parts(cells: DataFrame, items: DataFrame, cats: DataFrame) -> DataFrame:
    """Assemble the KPI row per cell (left-join semantics from the cell aggregates).

    Cell aggregates, ranked items (<= 10 per cell), ranked categories (<= 5 per cell) and line totals
    are unioned and grouped once by the cell key: one shuffle of per-cell rows, null-safe
    on location, hash-based (collect_list), and the arrays are ordered by rank.
    """
    item = F.struct(F.col("item_rank").alias("r"), "sku", "product_title", "qty", "revenue", "lines")
    cat = F.struct(F.col("category_rank").alias("r"), "category", "revenue", "units")
    u = cells.withColumn("_base", F.lit(True)) \
        .unionByName(items.select(*CELL, item.alias("_item")), allowMissingColumns=True) \
        .unionByName(cats.select(*CELL, F.when(~F.col("whole"), cat).alias("_cat"),
                                 F.when(F.col("whole"), F.col("lines")).alias("total_line_items"),
                                 F.when(F.col("whole"), F.col("units")).alias("units")), allowMissingColumns=True)
    g = u.groupBy(*CELL).agg(
        F.max("_base").alias("_base"),
        F.max("sales").alias("sales"), F.max("txns").alias("txns"),
        F.max("unique_customers").alias("unique_customers"),
        F.coalesce(F.max("total_line_items"), F.lit(0)).alias("total_line_items"), F.max("units").alias("units"),
        F.collect_list("_item").alias("_items"), F.collect_list("_cat").alias("_cats"))
    top_items = F.transform(F.array_sort("_items"), lambda x: F.struct(
        x["sku"].alias("sku"), x["product_title"].alias("product_title"), x["qty"].alias("qty"),
        x["revenue"].alias("revenue")))
    top_cats = F.transform(F.array_sort("_cats"), lambda x: F.struct(
        x["category"].alias("category"), x["revenue"].alias("revenue"), x["units"].alias("units")))
    return g.filter(F.col("_base")).select(
        *CELL,
        F.col("sales").cast(MONEY).alias("sales"),
        F.col("txns"),
        F.coalesce("units", F.lit(0)).cast("bigint").alias("units"),
        ratio_2dp(cents("sales"), "txns").alias("aov"),
        ratio_2dp("total_line_items", "unique_customers", num_in_cents=False).alias("items_per_customer"),
        top_items.cast(ITEM_TYPE).alias("top_items"),
        top_cats.cast(CATEGORY_TYPE).alias("top_categories"),
    )


def build_kpi_daily(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The daily KPI table from fact_order and fact_order_line."""
    ict = item_category_totals(orders, lines)
    return kpi_from_parts(order_totals(orders), rank_items(ict), categories_and_totals(ict))


def kpi_text(kpi: DataFrame) -> DataFrame:
    """KPI rows with the ranked arrays rendered as canonical text (for comparisons)."""
    items = F.array_join(F.transform("top_items", lambda x: F.concat_ws(
        ":", x["sku"], x["product_title"], x["qty"].cast("string"), x["revenue"].cast("string"))), "|")
    cats = F.array_join(F.transform("top_categories", lambda x: F.concat_ws(
        ":", x["category"], x["revenue"].cast("string"), x["units"].cast("string"))), "|")
    return kpi.select(*CELL, "sales", "txns", "units", "aov", "items_per_customer",
                      items.alias("top_items"), cats.alias("top_categories"))
