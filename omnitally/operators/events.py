"""Event application in set form (T4-T7): the state is a deduplicated event table, so
replayed deliveries change nothing (the reference's running counters double count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY, merge_json, minor_to_money, pii_hash
from omnitally.operators import normalize as N
from omnitally.operators.upsert import latest_version


def apply_refunds(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Refunds += amount per order, net = gross - refunds; unknown orders skipped.
    ``refunds``: refund_id, order_id, amount_cents (possibly delivered more than once)."""
    per = refunds.dropDuplicates(["refund_id"]).groupBy("order_id").agg(F.sum("amount_cents").alias("c"))
    j = orders.join(per, orders.id == per.order_id, "inner")
    refunds_total = (F.col("refunds_total") + minor_to_money("c")).cast(MONEY)
    return j.select(F.col("id").alias("order_id"), refunds_total.alias("refunds_total"),
                    (F.col("gross_total") - refunds_total).cast(MONEY).alias("net_total"))


def unmatched(events: DataFrame, targets: DataFrame, event_key: str, target_key: str) -> DataFrame:
    """Events whose target is missing (logged as warnings by the reference)."""
    t = targets.select(F.col(target_key).alias("_t"))
    return events.join(t, events[event_key] == F.col("_t"), "left_anti")


def apply_payments(orders: DataFrame, payment_versions: DataFrame) -> DataFrame:
    """Newest version per payment id, then per-order totals (A9); an order that
    does not exist yet is created from its payments (full outer join)."""
    latest = latest_version(payment_versions, "id", ["updatedAt"])
    per = N.payments_per_order(latest)
    existing = F.col("customer_hash") if "customer_hash" in orders.columns else F.lit(None).cast("string")
    o = orders.select(F.col("id").alias("oid"), existing.alias("old_hash"))
    j = o.join(per, o.oid == per.order_id, "full_outer")
    return j.select(F.coalesce("oid", "order_id").alias("order_id"), F.col("oid").isNull().alias("created"),
                    F.coalesce("n_payments", F.lit(0)).cast("bigint").alias("n_payments"),
                    minor_to_money(F.coalesce("paid_cents", F.lit(0))).alias("total_paid"),
                    minor_to_money(F.coalesce("refunded_cents", F.lit(0))).alias("total_refunded"),
                    # the customer hash is only set when the order has none yet
                    F.coalesce("old_hash", pii_hash("buyer_email")).alias("customer_hash"))


def apply_cancellations(events: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Revenue and add-ons set to 0 for cancelled bookings; attendees kept. When both
    sides carry ``raw_json`` / (``cancelled_at``, ``reason``), the raw payload is flagged."""
    extra = [c for c in ("cancelled_at", "reason") if c in cancellations.columns]
    c = cancellations.select(F.col("id").alias("cid"), *extra).dropDuplicates(["cid"])
    j = events.join(c, events.id == c.cid, "left")
    cancelled = F.col("cid").isNotNull()
    out = [F.col("id"), F.when(cancelled, F.lit(0).cast(MONEY)).otherwise(F.col("revenue")).alias("revenue"),
           F.when(cancelled, F.lit(0).cast(MONEY)).otherwise(F.col("add_on_sales")).alias("add_on_sales"),
           "attendees", cancelled.alias("cancelled")]
    if "raw_json" in events.columns and extra:
        flagged = merge_json("raw_json", {"cancelled": F.lit(True), **{k: F.col(k) for k in extra}})
        out.append(F.when(cancelled, flagged).otherwise(F.col("raw_json")).alias("raw_json"))
    return j.select(*out)


def apply_completions(events: DataFrame, completions: DataFrame) -> DataFrame:
    """Actual attendance recorded, the guest count where it is missing or 0; missing events are created."""
    c = completions.select(F.col("id").alias("cid"), F.coalesce(F.nullif("actual_attendance", F.lit(0)), "guests_count").alias("att"))
    e = events.select(F.col("id").alias("eid"), "attendees")
    j = e.join(c, e.eid == c.cid, "full_outer")
    return j.select(F.coalesce("eid", "cid").alias("id"),
                    F.coalesce("att", "attendees").cast("int").alias("attendance"),
                    F.col("eid").isNull().alias("created"))
