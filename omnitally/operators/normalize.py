"""Record normalisation: raw vendor records -> fact_order / fact_order_line / fact_event /
identities (P1-P12, A9, J5, J6). Column expressions only; no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY, customer_hash, external_id, minor_to_money, pii_hash, utc_ts

# Channel ids, the shop's single location, and the event-type rule's words
# ('tour' in the name gives type 'tour', otherwise 'experience').
SHOP, POS, BOOKING = "shop", "pos", "booking"
SHOP_LOCATION = "online-shop"
TOUR, EXPERIENCE = "tour", "experience"


def _ts(c: str | Column) -> Column:
    """ISO-8601 text to timestamp (session zone UTC), stored without zone."""
    return utc_ts(c)


def _shop_money(c: str) -> Column:
    return F.col(f"{c}.shopMoney.amount").cast(MONEY)


# --- shop ---------------------------------------------------------------------------

def first_page(raw: DataFrame) -> DataFrame:
    """Order-level fields come from page 0 of a paged record (headers repeat on pages)."""
    return raw.filter(F.col("page") == 0) if "page" in raw.columns else raw


def with_all_pages(rows: DataFrame, key: str, number: str) -> DataFrame:
    """The page-0 rows of paged records, without ``page``, their ``number`` summed over all pages of the record.

    A page that came several times (its order row repeats) counts once. Records of one page, which
    have no further ones, pass as they are.
    """
    pages = rows.filter(F.col("page") != 0).groupBy(key, "page").agg(F.max(number).alias("_n"))
    more = pages.groupBy(F.col(key).alias("_key")).agg(F.sum("_n").alias("_more"))
    head = first_page(rows)
    whole = (F.col(number) + F.coalesce("_more", F.lit(0))).cast(rows.schema[number].dataType)
    return head.join(more, head[key] == more._key, "left").withColumn(number, whole).drop("page", "_key", "_more")


def shop_orders(raw: DataFrame) -> DataFrame:
    """P1 (+P9/P10): order header; net = gross - refunded; location fixed."""
    gross, refunded = _shop_money("totalPriceSet"), _shop_money("totalRefundedSet")
    return first_page(raw).select(
        external_id("id", SHOP).alias("id"), F.lit(SHOP).alias("channel_id"),
        F.lit(SHOP_LOCATION).alias("location_id"), _ts("createdAt").alias("created_at"),
        _ts("updatedAt").alias("updated_at"),
        customer_hash("customer.email", "customer.phone").alias("customer_hash"),
        gross.alias("gross_total"), (gross - refunded).cast(MONEY).alias("net_total"),
        _shop_money("totalTaxSet").alias("tax_total"), _shop_money("totalDiscountsSet").alias("discount_total"),
        refunded.alias("refunds_total"))


def shop_lines(raw: DataFrame) -> DataFrame:
    """One row per line edge; category = productType or null."""
    x = raw.select(external_id("id", SHOP).alias("order_id"), F.explode("lineItems.edges").alias("e"))
    return x.select(external_id("e.node.id", SHOP).alias("id"), "order_id", F.col("e.node.sku").alias("sku"),
                    F.col("e.node.name").alias("product_title"), F.col("e.node.product.productType").alias("category"),
                    F.col("e.node.quantity").alias("qty"),
                    F.col("e.node.originalTotalSet.shopMoney.amount").cast(MONEY).alias("line_total"))


def shop_tenders(raw: DataFrame) -> Column:
    """Successful sales only, as an array of (gateway, amount)."""
    keep = F.filter("transactions.edges", lambda t: (t["node"]["kind"] == "SALE") & (t["node"]["status"] == "SUCCESS"))
    return F.transform(keep, lambda t: F.struct(t["node"]["gateway"].alias("gateway"),
                                                t["node"]["amountSet"]["shopMoney"]["amount"].cast(MONEY).alias("amount")))


def total_refunded(refunds: str = "refunds") -> Column:
    """P5: sum of refund amounts, 0 when there are none."""
    return F.aggregate(refunds, F.lit(0).cast("decimal(18,2)"),
                       lambda acc, r: (acc + F.coalesce(r["total_refund_set"]["shop_money"]["amount"].cast(MONEY),
                                                        F.lit(0).cast(MONEY))).cast("decimal(18,2)")).cast(MONEY)


def newest_pages(raw: DataFrame, updated: str = "updated_at", order: tuple[str, ...] = ()) -> DataFrame:
    """One delivery of every page of a record: the record's newest version.

    The order's own update time decides, then the columns ``order`` (say, the time of receipt), then the whole
    row, so repeated and late deliveries change nothing. Pages that the newest version does
    not have any more go. Grouped maxima, combined map-side; no order is gathered.
    """
    keys = [c for c in ("id", "page") if c in raw.columns]
    rest = [c for c in raw.columns if c not in keys]
    first = list(dict.fromkeys([updated, *order]))  # the maximum is the row itself, carried once
    row = F.struct(*first, *[c for c in rest if c not in first])
    one = raw.groupBy(*keys).agg(F.max(row).alias("_v")).select(*keys, *[F.col("_v")[c].alias(c) for c in rest])
    if "page" not in raw.columns:
        return one
    last = one.groupBy(F.col("id").alias("_id")).agg(F.max(updated).alias("_last"))
    return one.join(last, F.col("id") == F.col("_id")).filter(F.col(updated).eqNullSafe(F.col("_last"))).drop("_id", "_last")


def event_to_order(raw: DataFrame) -> DataFrame:
    """Flat order events in the shape of the shop's order records, with their defaults,
    so that P1 to P3 and the identity bridge read them like any other order."""
    def money(c: Column) -> Column:
        return F.struct(F.struct(F.coalesce(c, F.lit("0")).alias("amount")).alias("shopMoney"))

    def gid(kind: str, c: Column) -> Column:
        return F.concat(F.lit(f"gid://shop/{kind}/"), c.cast("string"))

    line = F.transform("line_items", lambda li: F.struct(F.struct(
        gid("LineItem", li["id"]).alias("id"), li["name"].alias("name"), li["sku"].alias("sku"), li["quantity"].alias("quantity"),
        money((li["price"].cast(MONEY) * li["quantity"]).cast(MONEY).cast("string")).alias("originalTotalSet"),
        F.when(li["product_id"].isNotNull(), F.struct(gid("Product", li["product_id"]).alias("id"),
                                                      F.nullif(li["product_type"], F.lit("")).alias("productType"))).alias("product")).alias("node")))
    txn = F.transform("transactions", lambda t: F.struct(F.struct(
        F.upper(F.coalesce(F.nullif(t["kind"], F.lit("")), F.lit("SALE"))).alias("kind"),
        F.upper(F.coalesce(F.nullif(t["status"], F.lit("")), F.lit("SUCCESS"))).alias("status"),
        money(t["amount"]).alias("amountSet"), F.coalesce(F.nullif(t["gateway"], F.lit("")), F.lit("unknown")).alias("gateway")).alias("node")))
    customer = F.when(F.col("customer").isNotNull(), F.struct(
        gid("Customer", F.col("customer.id")).alias("id"), F.col("customer.email").alias("email"), F.col("customer.phone").alias("phone")))
    page = F.col("page") if "page" in raw.columns else F.lit(0).cast("bigint")
    return raw.select(
        gid("Order", F.col("id")).alias("id"), page.alias("page"),
        F.coalesce(F.nullif("name", F.lit("")), "order_number").alias("name"),
        F.col("created_at").alias("createdAt"), F.col("updated_at").alias("updatedAt"),
        money(F.col("total_price")).alias("totalPriceSet"), money(F.col("subtotal_price")).alias("currentSubtotalPriceSet"),
        money(F.col("total_discounts")).alias("totalDiscountsSet"), money(F.col("total_tax")).alias("totalTaxSet"),
        money(total_refunded().cast("string")).alias("totalRefundedSet"), customer.alias("customer"),
        F.struct(line.alias("edges")).alias("lineItems"), F.struct(txn.alias("edges")).alias("transactions"))


def shop_events(raw: DataFrame) -> DataFrame:
    """Flat event payload into one summary row per order, with its defaults.

    Repeated deliveries of an order count once (its newest version). Header fields come from
    page 0; line counts and totals are summed over every page (a per-order aggregate,
    combined map-side)."""
    raw = newest_pages(raw)
    lines = F.transform("line_items", lambda li: (li["price"].cast(MONEY) * li["quantity"]).cast(MONEY))
    per_page = raw.select(F.col("id").alias("lid"), F.size("line_items").alias("n"),
                          F.aggregate(lines, F.lit(0).cast("decimal(18,2)"),
                                      lambda a, x: (a + x).cast("decimal(18,2)")).alias("t"))
    per_order = per_page.groupBy("lid").agg(F.sum("n").cast("bigint").alias("n_lines"),
                                            F.sum("t").cast("decimal(18,2)").alias("lines_total"))
    head = _shop_event_header(first_page(raw))
    return head.join(per_order, head._key == per_order.lid, "left").select(
        "id", "name", "gross_total", "tax_total", "discount_total", "refunds_total",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("lines_total", F.lit(0)).cast("decimal(18,2)").alias("lines_total"),
        "sale_tenders", "tendered", "gateway")


def _shop_event_header(raw: DataFrame) -> DataFrame:
    zero = F.lit("0")
    txns = F.transform("transactions", lambda t: F.struct(
        F.upper(F.coalesce(t["kind"], F.lit("sale"))).alias("kind"),
        F.upper(F.coalesce(t["status"], F.lit("success"))).alias("status"),
        F.coalesce(t["amount"], zero).cast(MONEY).alias("amount"),
        F.coalesce(t["gateway"], F.lit("unknown")).alias("gateway")))
    sales = F.filter(txns, lambda t: (t["kind"] == "SALE") & (t["status"] == "SUCCESS"))
    gid = F.concat(F.lit("gid://shop/Order/"), F.col("id").cast("string"))
    return raw.select(
        F.col("id").alias("_key"), external_id(gid, SHOP).alias("id"),
        F.coalesce("name", F.concat(F.lit("#"), F.col("order_number"))).alias("name"),
        F.coalesce("total_price", zero).cast(MONEY).alias("gross_total"),
        F.coalesce("total_tax", zero).cast(MONEY).alias("tax_total"),
        F.coalesce("total_discounts", zero).cast(MONEY).alias("discount_total"),
        total_refunded().alias("refunds_total"),
        F.size(sales).cast("bigint").alias("sale_tenders"),
        F.aggregate(sales, F.lit(0).cast("decimal(18,2)"), lambda a, t: (a + t["amount"]).cast("decimal(18,2)")).cast("decimal(18,2)")
         .alias("tendered"),
        F.element_at(txns, 1)["gateway"].alias("gateway"))


# --- pos ------------------------------------------------------------------------------

def payments_per_order(payments: DataFrame) -> DataFrame:
    """Per order, totals over COMPLETED payments; payments without an order dropped.

    Map-side partial aggregation keeps a hot order key from landing whole in one task.
    """
    done = F.col("status") == "COMPLETED"
    fee = F.aggregate("processingFee", F.lit(0).cast("bigint"), lambda a, f: a + F.coalesce(f["amountMoney"]["amount"], F.lit(0)))
    first_email = F.min_by(F.col("buyerEmailAddress"),
                           F.when(F.col("buyerEmailAddress").isNotNull(), F.struct("createdAt", "id")))
    return payments.filter(F.col("orderId").isNotNull()).groupBy(F.col("orderId").alias("order_id")).agg(
        F.count(F.lit(1)).alias("n_payments"),
        F.sum(F.when(done, F.col("amountMoney.amount")).otherwise(0)).alias("paid_cents"),
        F.sum(F.when(done, fee).otherwise(0)).alias("fee_cents"),
        F.sum(F.when(done, F.coalesce("refundedMoney.amount", F.lit(0))).otherwise(0)).alias("refunded_cents"),
        first_email.alias("buyer_email"))


def pos_orders(raw: DataFrame, per_order: DataFrame) -> DataFrame:
    """P6 + J5: order totals from minor units; refunds from completed payments; fees are
    not subtracted; customer hash from the first payment carrying an email."""
    head = first_page(raw)
    j = head.join(per_order, head.id == per_order.order_id, "left")
    gross = minor_to_money("totalMoney.amount")
    refunds = minor_to_money(F.coalesce("refunded_cents", F.lit(0)))
    return j.select(
        F.concat(F.lit("pos_order_"), F.col("id")).alias("id"), F.lit(POS).alias("channel_id"),
        F.concat(F.lit("pos_location_"), F.col("locationId")).alias("location_id"),
        _ts("createdAt").alias("created_at"), _ts("updatedAt").alias("updated_at"),
        pii_hash("buyer_email").alias("customer_hash"),
        gross.alias("gross_total"), (gross - refunds).cast(MONEY).alias("net_total"),
        minor_to_money(F.coalesce("totalTaxMoney.amount", F.lit(0))).alias("tax_total"),
        minor_to_money(F.coalesce("totalDiscountMoney.amount", F.lit(0))).alias("discount_total"),
        refunds.alias("refunds_total"),
        minor_to_money(F.coalesce("fee_cents", F.lit(0))).alias("fees_total"))


def parse_int(c: Column) -> Column:
    """JavaScript parseInt of a decimal string: leading integer part ('3.7' -> 3)."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int")


def pos_lines(raw: DataFrame) -> DataFrame:
    """sku = catalog id; title = name [- variation]; category null; qty = parseInt."""
    x = raw.select(F.col("id").alias("oid"), F.explode("lineItems").alias("li"))
    title = F.when(F.col("li.variationName").isNotNull() & (F.col("li.variationName") != ""),
                   F.concat(F.col("li.name"), F.lit(" - "), F.col("li.variationName"))).otherwise(F.col("li.name"))
    return x.select(F.concat(F.lit("pos_lineitem_"), F.col("li.uid")).alias("id"),
                    F.concat(F.lit("pos_order_"), F.col("oid")).alias("order_id"),
                    F.col("li.catalogObjectId").alias("sku"), title.alias("product_title"),
                    F.lit(None).cast("string").alias("category"), parse_int(F.col("li.quantity")).alias("qty"),
                    minor_to_money("li.totalMoney.amount").alias("line_total"))


def pos_tenders(payments: DataFrame) -> DataFrame:
    """One tender per payment with its fee list and the list's total."""
    fees = F.transform("processingFee", lambda f: F.struct(
        f["type"].alias("type"), minor_to_money(F.coalesce(f["amountMoney"]["amount"], F.lit(0))).alias("amount")))
    fee = F.aggregate("processingFee", F.lit(0).cast("bigint"), lambda a, f: a + F.coalesce(f["amountMoney"]["amount"], F.lit(0)))
    return payments.select(
        F.concat(F.lit("pos_order_"), F.col("orderId")).alias("order_id"), F.col("id").alias("payment_id"),
        "status", F.col("sourceType").alias("source_type"), minor_to_money("amountMoney.amount").alias("amount"),
        F.col("cardDetails.card.cardBrand").alias("card_brand"), F.col("cardDetails.card.last4").alias("last4"),
        minor_to_money(fee).alias("fee_total"), fees.alias("fees"))


def last_payment(payments: DataFrame) -> DataFrame:
    """The last payment per order wins, any status (reconcile's payment map).

    A grouped ``max_by`` (combined map-side) rather than a window, so an order with a
    huge number of payments is reduced in every task before the shuffle.
    """
    cols = [c for c in payments.columns if c != "orderId"]
    return payments.filter(F.col("orderId").isNotNull()).groupBy("orderId") \
        .agg(F.max_by(F.struct(*cols), F.struct("createdAt", "id")).alias("_p")).select("orderId", "_p.*")


# --- booking -----------------------------------------------------------------------------

def event_type(name: str | Column, category: str | Column) -> Column:
    """Category, else 'tour' if the name mentions a tour, else 'experience'."""
    n = F.col(name) if isinstance(name, str) else name
    c = F.col(category) if isinstance(category, str) else category
    return F.coalesce(F.nullif(c, F.lit("")),
                      F.when(F.lower(n).contains(TOUR), F.lit(TOUR)).otherwise(F.lit(EXPERIENCE)))


def booking_events(raw: DataFrame, *more: str) -> DataFrame:
    """Booking -> fact_event; ends_at null without an end time; numbers default to 0. Columns ``more`` come after."""
    start = F.to_timestamp_ntz(F.concat("event_date", F.lit("T"), "start_time"))
    end = F.when(F.col("end_time").isNull(), F.lit(None).cast("timestamp_ntz")) \
        .otherwise(F.to_timestamp_ntz(F.concat("event_date", F.lit("T"), "end_time")))
    return raw.select(
        F.concat(F.lit("booking_"), F.col("id")).alias("id"),
        event_type("experience.name", "experience.category").alias("event_type"),
        start.alias("starts_at"), end.alias("ends_at"),
        F.coalesce("guests_count", F.lit(0)).alias("attendees"),
        F.coalesce("total_price", F.lit(0).cast(MONEY)).cast(MONEY).alias("revenue"),
        F.coalesce("add_ons_total", F.lit(0).cast(MONEY)).cast(MONEY).alias("add_on_sales"),
        customer_hash("primary_guest.email", "primary_guest.phone").alias("customer_hash"),
        F.col("primary_guest.id").alias("guest_id"), F.col("status"), *more)
