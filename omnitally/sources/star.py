"""Binding of the driver's TPC-H-style tables to the retail star schema.

``orders``/``lineitem``/``customer``/``part`` become fact_order and fact_order_line;
``events`` becomes fact_event and ingest_audit. Two order bindings exist:

* ``real``: created_at = o_orderdate, location = customer nation.
* ``dense``: dates folded into 120 days before 2001-06-30 with an hour of day, location =
  customer region. Folding puts many orders in each (date, channel, location) cell, so
  top-k truncation, periods and hourly trends have real work to do.

Null rules (fixed binding values, they exercise null-safe keys and null guards): location
is null when o_orderkey % 7 = 0, customer_hash when o_custkey % 10 = 0, sku when
l_partkey % 13 = 0, category when l_partkey % 11 = 0. They null values; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY
from omnitally.sources.tables import read

# Fixed binding values.
DENSE_ANCHOR = "2001-06-30"
DENSE_DAYS = 120
ORDER_AS_OF = "2001-06-15"
EVENT_AS_OF = "2024-01-15"
REFUND_ON_PENDING = 100  # refunds_total of orders with status 'P'
# Audit rows derived from events: event_type -> audit type; source by user_id % 3.
AUDIT_SOURCES = ["shop", "pos", "booking"]
AUDIT_TYPES = {
    "click": "webhook_orders_create",
    "view": "webhook_orders_updated",
    "purchase": "backfill_checkpoint",
    "signup": "mv_refresh",
}
EXPERIENCES = {
    "click": ("Distillery Tour", "tour"),
    "view": ("Tasting Flight", "tasting"),
    "purchase": ("Cocktail Class", ""),
    "signup": ("Barrel Tour Deluxe", None),
    "error": ("Private Event", "private"),
}

# The channels and their names.
CHANNELS = {"1": "URGENT", "2": "HIGH", "3": "MEDIUM", "4": "NOT SPECIFIED", "5": "LOW"}

CELL = ["date", "channel_id", "location_id"]


def _created_at(dense: bool):
    if not dense:
        return F.col("o_orderdate")
    return F.expr(
        f"timestampadd(HOUR, cast(o_orderkey * 7 % 24 as int), "
        f"timestampadd(DAY, -cast(o_orderkey % {DENSE_DAYS} as int), to_timestamp_ntz('{DENSE_ANCHOR}')))")


def fact_order(spark: SparkSession, sf_dir: str, dense: bool = False, location: bool = True) -> DataFrame:
    """Order facts. With ``location`` False there is no location_id, and customers are not
    read: a left join that only adds a column is not dropped by the optimizer."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
             "o_totalprice", "o_orderdate", "o_orderpriority")
    gross = F.col("o_totalprice").cast(MONEY)
    refunds = F.when(F.col("o_orderstatus") == "P", F.lit(REFUND_ON_PENDING)).otherwise(0).cast(MONEY)
    created = _created_at(dense)
    facts = {
        "id": F.col("o_orderkey"),
        "channel_id": F.substring("o_orderpriority", 1, 1),
        "location_id": F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("loc_key").cast("string")) if location else None,
        "created_at": created,
        "updated_at": created,
        "customer_hash": F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
                          .otherwise(F.substring(F.sha2(F.col("o_custkey").cast("string"), 256), 1, 32)),
        "gross_total": gross,
        "net_total": (gross - refunds).cast(MONEY),
        "tax_total": F.lit(0).cast(MONEY),
        "discount_total": F.lit(0).cast(MONEY),
        "refunds_total": refunds,
        "status": F.col("o_orderstatus"),
        "customer_key": F.col("o_custkey"),
    }
    columns = [c.alias(n) for n, c in facts.items() if c is not None]
    if not location:
        return o.select(*columns)
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    if dense:
        n = read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
        c = c.join(n, c.c_nationkey == n.n_nationkey, "left") \
            .select("c_custkey", F.col("n_regionkey").alias("loc_key"))
    else:
        c = c.select("c_custkey", F.col("c_nationkey").alias("loc_key"))
    # customer is an order of magnitude smaller than orders; AQE turns this into a
    # broadcast join only when the runtime size is below the threshold.
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(*columns)


def fact_order_line(spark: SparkSession, sf_dir: str, product: bool = True) -> DataFrame:
    """Line facts. With ``product`` False there is no title or category, and parts are not read."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_quantity", "l_extendedprice")
    if product:
        p = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
        li = li.join(p, li.l_partkey == p.p_partkey, "left")
    described = [
        F.col("p_name").alias("product_title"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
    ] if product else []
    return li.select(
        # (order, line number) is not unique in the input; the price completes the key.
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    (F.col("l_extendedprice").cast(MONEY) * 100).cast("bigint")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("sku"),
        *described,
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast(MONEY).alias("line_total"),
    )


def dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderpriority")
    return o.select(F.substring("o_orderpriority", 1, 1).alias("id"),
                    F.expr("substring(o_orderpriority, 3)").alias("name")).distinct()


def static_channels(spark: SparkSession) -> DataFrame:
    """The channel list itself, for lookups and checks that must not depend on the facts."""
    return spark.createDataFrame(list(CHANNELS.items()), "id string, name string")


def dim_location(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    if dense:
        r = read(spark, sf_dir, "region", "r_regionkey", "r_name")
        return r.select(F.col("r_regionkey").cast("string").alias("id"),
                        F.col("r_name").alias("name"), F.lit("any").alias("channel"))
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").cast("string").alias("id"),
                    F.col("n_name").alias("name"), F.lit("any").alias("channel"))


def fact_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("event_type"),
        F.col("ts").alias("starts_at"),
        F.expr("timestampadd(HOUR, 2, ts)").alias("ends_at"),
        (F.col("user_id") % 6 + 1).cast("int").alias("attendees"),
        F.col("value").cast(MONEY).alias("revenue"),
        F.lit(0).cast(MONEY).alias("add_on_sales"),
        # booked (last updated) some days before it starts
        F.expr("timestampadd(DAY, -cast(user_id % 30 as int), ts)").alias("updated_at"),
        F.col("user_id"),
    )


def audit_type_col(event_type: str = "event_type", source: str = "source"):
    expr = F.concat(F.lit("resync_"), F.col(source))
    for k, v in AUDIT_TYPES.items():
        expr = F.when(F.col(event_type) == k, F.lit(v)).otherwise(expr)
    return expr


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    src = F.element_at(F.array(*[F.lit(s) for s in AUDIT_SOURCES]),
                       (F.col("user_id") % 3 + 1).cast("int"))
    failed = F.col("event_type") == "error"
    return e.withColumn("source", src).select(
        F.col("event_id").alias("id"),
        "source",
        audit_type_col().alias("type"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.col("ts"),
        F.col("props").alias("payload"),
        F.when(failed, F.concat(F.lit("upstream rejected: token="), F.col("user_id").cast("string"),
                                F.lit("abc&key=k"), F.col("event_id").cast("string"),
                                F.lit(" password=Secret"), F.col("user_id").cast("string"),
                                F.lit(" retry later")))
         .otherwise(F.lit(None).cast("string")).alias("error"),
    )
