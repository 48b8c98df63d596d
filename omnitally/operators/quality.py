"""Data quality and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY, MONEY_SUM, customer_hash

# Reconciliation matches when counts are equal and |revenue diff| < 1;
# a fee discrepancy is a difference above 0.01.
RECON_REVENUE_TOLERANCE = 1
FEE_TOLERANCE = 0.01


def days_of(rows: DataFrame) -> DataFrame:
    """Rows (source, date, rev) reduced to n and rev per source and day, combined map-side."""
    return rows.groupBy("source", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("rev").cast(MONEY_SUM).alias("rev"))


def compare_days(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """FULL OUTER JOIN of two sides' days; match = equal counts and |revenue diff| < 1."""
    s, w = source.alias("s"), warehouse.alias("w")
    j = s.join(w, (F.col("s.source") == F.col("w.source")) & F.col("s.date").eqNullSafe(F.col("w.date")), "full_outer")

    def of(c, kind):
        return F.coalesce(c, F.lit(0)).cast(kind)

    out = j.select(F.coalesce("s.source", "w.source").alias("source"), F.coalesce("s.date", "w.date").alias("date"),
                   of("s.n", "bigint").alias("source_count"), of("w.n", "bigint").alias("warehouse_count"),
                   of("s.rev", MONEY_SUM).alias("source_revenue"), of("w.rev", MONEY_SUM).alias("warehouse_revenue"))
    cd = F.col("warehouse_count") - F.col("source_count")
    rd = (F.col("warehouse_revenue") - F.col("source_revenue")).cast(MONEY_SUM)
    return out.select("*", cd.alias("count_diff"), rd.alias("revenue_diff"),
                      F.when((cd == 0) & (F.abs(rd) < RECON_REVENUE_TOLERANCE), F.lit("match")).otherwise(F.lit("mismatch")).alias("status"))


def reconcile(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """A13/J11 of two frames of rows (source, date, rev)."""
    return compare_days(days_of(source), days_of(warehouse))


def unread(spark, errors: dict[str, str]) -> DataFrame:
    """One 'error' row for every source that could not be read."""
    rows = spark.createDataFrame(list(errors), "string").toDF("source") if errors else spark.createDataFrame([], "source string")
    zero = F.lit(0).cast(MONEY_SUM)
    none = F.lit(0).cast("bigint")
    return rows.select("source", F.lit(None).cast("date").alias("date"), none.alias("source_count"), none.alias("warehouse_count"),
                       zero.alias("source_revenue"), zero.alias("warehouse_revenue"), none.alias("count_diff"),
                       zero.alias("revenue_diff"), F.lit("error").alias("status"))


def reconcile_summary(r: DataFrame) -> DataFrame:
    """Match / mismatch / error counts and exit level (2 error, 1 mismatch, 0 ok)."""
    a = r.agg(F.count_if(F.col("status") == "match").alias("matches"),
              F.count_if(F.col("status") == "mismatch").alias("mismatches"),
              F.count_if(F.col("status") == "error").alias("errors"))
    return a.select(F.col("matches").cast("bigint"), F.col("mismatches").cast("bigint"), F.col("errors").cast("bigint"),
                    F.when(F.col("errors") > 0, 2).when(F.col("mismatches") > 0, 1).otherwise(0).alias("exit_level"))


def mismatch_actions(r: DataFrame) -> DataFrame:
    """What the auto-fix would re-pull."""
    return r.filter((F.col("status") == "mismatch") & (F.col("count_diff") != 0)) \
        .select("source", "date", "count_diff", F.lit("resync").alias("action"))


def fee_discrepancy(pos_orders: DataFrame) -> DataFrame:
    """|(gross - net) - recorded fees| > 0.01."""
    implied = (F.col("gross_total") - F.col("net_total")).cast(MONEY)
    diff = (implied - F.col("fees_total")).cast(MONEY)
    return pos_orders.filter(F.abs(diff) > FEE_TOLERANCE).select(
        F.col("id").alias("order_id"), implied.alias("implied_fee"), F.col("fees_total").alias("recorded_fee"),
        diff.alias("difference"))


def customer_identity(shop_raw: DataFrame, bookings: DataFrame) -> DataFrame:
    """(hash, channel, id) triples from every source -> one row per hash.

    pos never contributes an id (the reference never sets it). The triples are distinct
    before the groupBy, and the groupBy is partially aggregated map-side.
    """
    head = shop_raw.filter(F.col("page") == 0) if "page" in shop_raw.columns else shop_raw
    shop = head.filter(F.col("customer").isNotNull()).select(
        customer_hash("customer.email", "customer.phone").alias("customer_hash"),
        F.lit("shop").alias("channel"), F.col("customer.id").alias("cid"))
    book = bookings.select(customer_hash("primary_guest.email", "primary_guest.phone").alias("customer_hash"),
                           F.lit("booking").alias("channel"), F.col("primary_guest.id").alias("cid"))
    u = shop.unionByName(book).filter(F.col("customer_hash").isNotNull()).distinct()
    return u.groupBy("customer_hash").agg(
        F.max(F.when(F.col("channel") == "shop", F.col("cid"))).alias("shop_customer_id"),
        F.lit(None).cast("string").alias("pos_customer_id"),
        F.max(F.when(F.col("channel") == "booking", F.col("cid"))).alias("booking_guest_id"))


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def orphan_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose order does not exist (left anti join, never ids through the driver)."""
    return lines.join(orders.select(F.col("id").alias("oid")), lines.order_id == F.col("oid"), "left_anti")


# The patterns of a request's dates and recipients.
DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
EMAIL_RE = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"


def validate_requests(r: DataFrame, channels: list[str]) -> DataFrame:
    """dates 'yyyy-MM-dd', channel in the enum, every recipient an e-mail address.

    Returns the rows with ``valid`` and the first failing rule as ``reason`` (null when
    valid), so a batch splits into accepted and quarantined rows without failing (I10).
    """
    def sure(check):  # a null input fails its rule
        return F.coalesce(check, F.lit(False))
    ok_start = sure(F.col("start_date").rlike(DATE_RE))
    ok_end = sure(F.col("end_date").rlike(DATE_RE))
    ok_channel = sure(F.col("channel").isin(channels))
    ok_emails = sure(F.forall("recipients", lambda x: x.rlike(EMAIL_RE)))
    reason = F.when(~ok_start, F.lit("start_date")).when(~ok_end, F.lit("end_date")) \
        .when(~ok_channel, F.lit("channel")).when(~ok_emails, F.lit("recipients"))
    return r.withColumn("reason", reason).withColumn("valid", ok_start & ok_end & ok_channel & ok_emails)


def validate_payloads(rows: DataFrame) -> DataFrame:
    """what a delivery's body must hold. shop: an id, and times that are text; pos: a type and
    data.object, an object; booking: an event type (also as ``type``) and data, an object.

    Adds ``reason`` (the first failing rule, null when valid) and ``valid``.
    """
    body = F.try_parse_json("body")

    def kind(path):  # the JSON type behind a path: STRING, BIGINT, OBJECT<...>, VOID or null
        return F.schema_of_variant(F.try_variant_get(body, path, "variant"))

    def is_a(path, *kinds):
        return F.coalesce(F.regexp_like(kind(path), F.lit("^(" + "|".join(kinds) + ")")), F.lit(False))

    def text_or_missing(path):
        return kind(path).isNull() | is_a(path, "STRING")

    shop = F.when(~is_a("$.id", "STRING", "BIGINT", "DECIMAL", "DOUBLE"), F.lit("id")) \
        .when(~text_or_missing("$.created_at"), F.lit("created_at")).when(~text_or_missing("$.updated_at"), F.lit("updated_at"))
    pos = F.when(~is_a("$.type", "STRING"), F.lit("type")).when(~is_a("$.data.object", "OBJECT"), F.lit("data"))
    booking = F.when(~(is_a("$.event_type", "STRING") | is_a("$.type", "STRING")), F.lit("event_type")) \
        .when(~is_a("$.data", "OBJECT"), F.lit("data"))
    reason = F.when(F.coalesce(body.isNull(), F.lit(True)), F.lit("body")).when(F.col("source") == "shop", shop) \
        .when(F.col("source") == "pos", pos).when(F.col("source") == "booking", booking).otherwise(F.lit("source"))
    return rows.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())
