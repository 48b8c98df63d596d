"""Raw vendor records ("landed JSON") and their explicit schemas.

In production the three sources land as JSON files and are read with
``read_landed(spark, path, kind)`` -- an explicit schema, no inference. For the driver's
tables the same nested records are derived from ``orders``/``lineitem``/``customer``/
``part``/``nation`` (shop and pos orders, pos payments) and ``events`` (bookings), so every
normaliser runs over data that grows with the input.

Records are paged like the vendor APIs page them: at most ``PAGE_SIZE`` line items per
record, keyed by (order, page) with the order header repeated on every page. An order of up
to ``PAGE_SIZE`` lines is one page-0 record; a larger one has an empty page 0 and its lines,
dealt by a hash of their row, on further pages, so no list grows with an order, whatever its line numbers
are. Normalisers take the header from page 0 and the lines from every page. Queries that
need headers only ask for records without lines, which read no line table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnitally.functions.expr import MONEY
from omnitally.sources.star import EXPERIENCES
from omnitally.sources.tables import read

# --- explicit schemas (Spark DDL) ---------------------------------------------------------

_MONEY_SET = "struct<shopMoney:struct<amount:string>>"
_MINOR = "struct<amount:bigint,currency:string>"

SHOP_ORDER_DDL = (
    "id string, page bigint, name string, createdAt string, updatedAt string, "
    f"totalPriceSet {_MONEY_SET}, currentSubtotalPriceSet {_MONEY_SET}, totalDiscountsSet {_MONEY_SET}, "
    f"totalTaxSet {_MONEY_SET}, totalRefundedSet {_MONEY_SET}, "
    "customer struct<id:string,email:string,phone:string>, "
    "lineItems struct<edges:array<struct<node:struct<id:string,name:string,sku:string,quantity:int,"
    f"originalTotalSet:{_MONEY_SET},product:struct<id:string,productType:string>>>>>, "
    "transactions struct<edges:array<struct<node:struct<kind:string,status:string,"
    f"amountSet:{_MONEY_SET},gateway:string>>>>")

SHOP_EVENT_DDL = (
    "id bigint, page bigint, name string, order_number string, created_at string, updated_at string, total_price string, "
    "subtotal_price string, total_discounts string, total_tax string, "
    "customer struct<id:bigint,email:string,phone:string>, "
    "line_items array<struct<id:bigint,name:string,sku:string,quantity:int,price:string,product_id:bigint,"
    "product_type:string>>, "
    "transactions array<struct<kind:string,status:string,amount:string,gateway:string>>, "
    "refunds array<struct<total_refund_set:struct<shop_money:struct<amount:string>>>>")

POS_ORDER_DDL = (
    "id string, page bigint, locationId string, referenceId string, createdAt string, updatedAt string, state string, "
    f"totalMoney {_MINOR}, totalTaxMoney {_MINOR}, totalDiscountMoney {_MINOR}, totalServiceChargeMoney {_MINOR}, "
    "lineItems array<struct<uid:string,name:string,quantity:string,catalogObjectId:string,variationName:string,"
    f"basePriceMoney:{_MINOR},totalMoney:{_MINOR}>>")

POS_PAYMENT_DDL = (
    "id string, orderId string, locationId string, createdAt string, updatedAt string, "
    f"amountMoney {_MINOR}, status string, sourceType string, "
    "cardDetails struct<card:struct<cardBrand:string,last4:string>>, "
    f"processingFee array<struct<amountMoney:{_MINOR},type:string>>, "
    f"refundedMoney {_MINOR}, buyerEmailAddress string")

BOOKING_DDL = (
    "id string, experience_id string, experience struct<name:string,category:string>, event_date string, "
    "start_time string, end_time string, status string, guests_count int, total_price decimal(14,2), "
    "add_ons_total decimal(14,2), currency string, "
    "primary_guest struct<id:string,email:string,phone:string,first_name:string,last_name:string>, "
    "created_at string, updated_at string")

EXPERIENCE_DDL = "id string, name string, category string, status string"

# Fixed value: line items per vendor record page.
PAGE_SIZE = 100

SCHEMAS = {"shop_order": SHOP_ORDER_DDL, "shop_event": SHOP_EVENT_DDL, "pos_order": POS_ORDER_DDL,
           "pos_payment": POS_PAYMENT_DDL, "booking": BOOKING_DDL, "experience": EXPERIENCE_DDL}


def schema(kind: str) -> T.StructType:
    return T._parse_datatype_string(SCHEMAS[kind])


CORRUPT = "_corrupt_record"


def read_landed(spark: SparkSession, path: str, kind: str, keep_corrupt: bool = False) -> DataFrame:
    """Read landed JSON lines of one record kind with its explicit schema.

    With ``keep_corrupt`` a malformed line does not fail the load: it arrives with all
    fields null and its text in ``_corrupt_record`` (I10), ready for ``split_corrupt``.
    """
    ddl = SCHEMAS[kind] + (f", {CORRUPT} string" if keep_corrupt else "")
    r = spark.read.schema(ddl).option("mode", "PERMISSIVE")
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    return r.json(path)


def land(records: DataFrame, path: str, cut: Column | None = None) -> None:
    """Write records as JSON lines; where ``cut`` holds, a copy that ends in the middle lands too."""
    text = records.select(F.to_json(F.struct(*records.columns)).alias("value"), (F.lit(False) if cut is None else cut).alias("cut"))
    lines = F.when(F.col("cut"), F.array("value", F.expr("substring(value, 1, length(value) div 2)"))).otherwise(F.array("value"))
    # One compressed file per task, which is as large as the scans of the tables make it.
    text.select(F.explode(lines).alias("value")).write.option("compression", "gzip").text(path)


def scan(spark: SparkSession, path: str, kind: str, quarantine: str) -> DataFrame:
    """The well-formed records of landed JSON; malformed lines go to ``quarantine``.

    The lines are parsed once: both parts are written from one pass over the files.
    """
    parsed = read_landed(spark, path, kind, keep_corrupt=True).withColumn("bad", F.col(CORRUPT).isNotNull())
    out = f"{quarantine}-split-{kind}"
    parsed.write.partitionBy("bad").parquet(out)
    both = spark.read.schema(T.StructType([*parsed.schema.fields])).parquet(out)
    both.filter("bad").select(F.lit(kind).alias("kind"), F.col(CORRUPT).alias("line")).write.mode("append").parquet(quarantine)
    return both.filter("not bad").drop("bad", CORRUPT)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined raw lines); the rest of the batch continues.

    Spark refuses queries over raw JSON that reference only the corrupt-record column, so
    persist the parsed frame first (``cache()``, or ``checkpoint()`` for long lineage).
    """
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad).select(CORRUPT)


def parse(body: Column, kind: str) -> Column:
    """Parse a JSON body column with the record kind's explicit schema."""
    return F.from_json(body, SCHEMAS[kind])


# --- derivation from the driver's tables ----------------------------------------------------

def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _amount(dec: Column) -> Column:
    return F.struct(F.struct(dec.cast(MONEY).cast("string").alias("amount")).alias("shopMoney"))


def _minor(cents: Column) -> Column:
    return F.struct(cents.cast("bigint").alias("amount"), F.lit("USD").alias("currency"))


def _cents(x: Column) -> Column:
    return (x.cast(MONEY) * 100).cast("bigint")


def _lines(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate") \
        .withColumn("_row", F.monotonically_increasing_id())  # by file and place: the same on a retry
    p = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey, "left")


def _sku() -> Column:
    return F.when(F.col("l_partkey") % 13 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string")))


def _line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_pages(lines: DataFrame, item: Column, name: str) -> DataFrame:
    """(l_orderkey, page, list of at most ``PAGE_SIZE`` items) for ``lines`` with their ``_row``.

    First pass: lines per order, combined map-side; only orders of more than a page are kept.
    Second pass: their lines go to pages of half the size on average by a hash of the row
    number that the scan gave them, so equal lines part too. A page that chance filled beyond
    the size is cut.
    """
    large = lines.groupBy(F.col("l_orderkey").alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > PAGE_SIZE)
    dealt = lines.join(large, lines.l_orderkey == large._k, "left")
    pages = F.ceil(F.col("_n") / (PAGE_SIZE // 2))
    page = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("_row"), pages)).cast("bigint")
    listed = dealt.groupBy("l_orderkey", page.alias("_page")).agg(F.collect_list(item).alias("_items"))
    starts = F.sequence(F.lit(1), F.size("_items"), F.lit(PAGE_SIZE))
    cut = listed.select("l_orderkey", "_page", F.posexplode(F.transform(
        starts, lambda i: F.slice("_items", i, F.lit(PAGE_SIZE)))).alias("_part", name))
    # Cut pages stay apart: the first part keeps the page's number, the others follow all pages.
    number = F.when(F.col("_part") == 0, F.col("_page")).otherwise(F.col("_part") * F.lit(1 << 40) + F.col("_page"))
    return cut.select("l_orderkey", number.cast("bigint").alias("page"), name)


def _paged(orders: DataFrame, lines: DataFrame | None, item: Column, name: str, kind: str | T.DataType) -> DataFrame:
    """Orders with their line pages; without ``lines``, every order's page-0 record alone.

    The pages join on the splittable side of an inner join, so AQE can split a hot order's.
    Page-0 records without lines (orders of no line, or of more than a page) come from an anti join.
    """
    empty = F.array().cast(kind)
    if lines is None:
        return orders.withColumn("page", F.lit(0).cast("bigint")).withColumn(name, empty)
    pages = line_pages(lines, item, name)
    with_lines = pages.join(orders, pages.l_orderkey == orders.o_orderkey, "inner").drop("l_orderkey")
    first = pages.filter(F.col("page") == 0).select(F.col("l_orderkey").alias("_k"))
    without = orders.join(first, orders.o_orderkey == first._k, "left_anti") \
        .withColumn("page", F.lit(0).cast("bigint")).withColumn(name, empty)
    return with_lines.unionByName(without)


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def shop_orders(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    """Nested shop order records, paged; without ``lines`` the headers alone."""
    item = F.struct(F.struct(
        F.concat(F.lit("gid://shop/LineItem/"), _line_key()).alias("id"),
        F.col("p_name").alias("name"), _sku().alias("sku"), F.col("l_quantity").cast("int").alias("quantity"),
        _amount(F.col("l_extendedprice")).alias("originalTotalSet"),
        F.struct(F.concat(F.lit("gid://shop/Product/"), F.col("l_partkey").cast("string")).alias("id"),
                 F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type"))
                 .alias("productType")).alias("product")).alias("node"))
    j = _paged(_orders(spark, sf_dir), _lines(spark, sf_dir) if lines else None, item, "edges",
               schema("shop_order")["lineItems"].dataType["edges"].dataType)
    key = F.col("o_custkey")
    customer = F.when(key % 10 == 0, F.lit(None)).otherwise(F.struct(
        F.concat(F.lit("gid://shop/Customer/"), key.cast("string")).alias("id"),
        F.when(key % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("  Customer"), key.cast("string"), F.lit("@Example.COM\t"))).alias("email"),
        F.concat(F.lit("+1 555 "), key.cast("string")).alias("phone")))
    gateway = F.when(key % 2 == 0, F.lit("card")).otherwise(F.lit("cash"))
    sale = F.struct(F.struct(F.lit("SALE").alias("kind"),
                             F.when(F.col("o_orderstatus") == "O", F.lit("PENDING")).otherwise(F.lit("SUCCESS")).alias("status"),
                             _amount(F.col("o_totalprice")).alias("amountSet"), gateway.alias("gateway")).alias("node"))
    refund = F.struct(F.struct(F.lit("REFUND").alias("kind"), F.lit("SUCCESS").alias("status"),
                               _amount(F.lit(100)).alias("amountSet"), gateway.alias("gateway")).alias("node"))
    txns = F.when(F.col("o_orderstatus") == "P", F.array(sale, refund)).otherwise(F.array(sale))
    created = iso(F.col("o_orderdate"))
    return j.select(
        F.concat(F.lit("gid://shop/Order/"), F.col("o_orderkey").cast("string")).alias("id"), "page",
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        created.alias("createdAt"), created.alias("updatedAt"),
        _amount(F.col("o_totalprice")).alias("totalPriceSet"),
        _amount(F.col("o_totalprice")).alias("currentSubtotalPriceSet"),
        _amount(F.lit(0)).alias("totalDiscountsSet"), _amount(F.lit(0)).alias("totalTaxSet"),
        _amount(F.when(F.col("o_orderstatus") == "P", F.lit(100)).otherwise(F.lit(0))).alias("totalRefundedSet"),
        customer.alias("customer"),
        F.struct("edges").alias("lineItems"),
        F.struct(txns.alias("edges")).alias("transactions"))


def shop_events(spark: SparkSession, sf_dir: str, lines: bool = True) -> DataFrame:
    """Flat order events (REST form) with lower-case / missing fields to normalise."""
    return shop_events_from(_orders(spark, sf_dir), _lines(spark, sf_dir) if lines else None)


def shop_events_from(o: DataFrame, lines: DataFrame | None) -> DataFrame:
    """Order event records from order rows and (line x part) rows."""
    item = F.struct(
        F.col("l_linenumber").cast("bigint").alias("id"), F.col("p_name").alias("name"), _sku().alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast(MONEY).cast("string").alias("price"),
        F.col("l_partkey").alias("product_id"), F.col("p_type").alias("product_type"))
    j = _paged(o, lines, item, "line_items", schema("shop_event")["line_items"].dataType)
    key, st = F.col("o_custkey"), F.col("o_orderstatus")
    txn = F.struct(F.when(key % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("sale")).alias("kind"),
                   F.when(key % 4 == 1, F.lit(None).cast("string"))
                    .otherwise(F.when(st == "O", F.lit("pending")).otherwise(F.lit("success"))).alias("status"),
                   F.col("o_totalprice").cast(MONEY).cast("string").alias("amount"),
                   F.when(key % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("cash")).alias("gateway"))
    refund = F.struct(F.struct(F.struct(F.lit("100.00").alias("amount")).alias("shop_money")).alias("total_refund_set"))
    refunds = F.when(st == "P", F.array(refund, refund)).otherwise(F.array().cast(
        schema("shop_event")["refunds"].dataType))
    created = iso(F.col("o_orderdate"))
    return j.select(
        F.col("o_orderkey").alias("id"), "page",
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("#"), F.col("o_orderkey").cast("string"))).alias("name"),
        F.col("o_orderkey").cast("string").alias("order_number"), created.alias("created_at"),
        created.alias("updated_at"),
        F.when(st == "O", F.lit(None).cast("string")).otherwise(F.col("o_totalprice").cast(MONEY).cast("string"))
         .alias("total_price"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("subtotal_price"),
        F.lit(None).cast("string").alias("total_discounts"), F.lit("0.00").alias("total_tax"),
        F.struct(key.alias("id"), F.lit(None).cast("string").alias("email"),
                 F.concat(F.lit("+1 555 "), key.cast("string")).alias("phone")).alias("customer"),
        "line_items", F.array(txn).alias("transactions"), refunds.alias("refunds"))


def _order_location(spark, sf_dir):
    o = _orders(spark, sf_dir)
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left") \
        .withColumn("location", F.concat(F.lit("L"), F.col("c_nationkey").cast("string")))


def pos_orders(spark: SparkSession, sf_dir: str, lines: bool = True, location: bool = True,
               beside: DataFrame | None = None) -> DataFrame:
    """Nested pos order records (minor units), paged; without ``lines`` the headers alone.
    Without ``location`` the customers are not read and the location is null. The columns of
    ``beside`` (one row per ``order_id``) come after the record's own; they are joined to the
    headers, before the lines, so no line list is shuffled for them."""
    item = F.struct(
        _line_key().alias("uid"), F.col("p_name").alias("name"),
        F.concat(F.col("l_quantity").cast("int").cast("string"),
                 F.when(F.col("l_linenumber") % 3 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("quantity"),
        _sku().alias("catalogObjectId"),
        F.when(F.col("l_partkey") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("variationName"),
        _minor(_cents(F.col("p_retailprice"))).alias("basePriceMoney"),
        _minor(_cents(F.col("l_extendedprice"))).alias("totalMoney"))
    orders = _order_location(spark, sf_dir) if location else \
        _orders(spark, sf_dir).withColumn("location", F.lit(None).cast("string"))
    key = F.concat(F.lit("SQ"), F.col("o_orderkey").cast("string"))
    more = [] if beside is None else [c for c in beside.columns if c != "order_id"]
    if beside is not None:
        orders = orders.join(beside, key == beside.order_id, "left").drop(beside.order_id)
    j = _paged(orders, _lines(spark, sf_dir) if lines else None, item, "lineItems", schema("pos_order")["lineItems"].dataType)
    st, total = F.col("o_orderstatus"), _cents(F.col("o_totalprice"))
    created = iso(F.col("o_orderdate"))
    none = F.lit(None).cast(_MINOR)
    return j.select(
        key.alias("id"), "page",
        F.col("location").alias("locationId"), F.lit(None).cast("string").alias("referenceId"),
        created.alias("createdAt"), created.alias("updatedAt"),
        F.when(st == "O", F.lit("OPEN")).otherwise(F.lit("COMPLETED")).alias("state"),
        _minor(total).alias("totalMoney"),
        F.when(st == "O", none).otherwise(_minor(F.call_function("div", total, F.lit(12)))).alias("totalTaxMoney"),
        F.when(st == "F", _minor(F.call_function("div", total, F.lit(50)))).otherwise(none).alias("totalDiscountMoney"),
        none.alias("totalServiceChargeMoney"), "lineItems", *more)


def pos_payments(spark: SparkSession, sf_dir: str, location: bool = True, buyer: bool = True) -> DataFrame:
    """One pos payment per line item row. Without ``location`` the customers are not read, and
    without ``buyer`` neither are the orders; the columns are null then."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    if location:
        o = _order_location(spark, sf_dir).select("o_orderkey", "o_custkey", "location")
    else:
        o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").withColumn("location", F.lit(None).cast("string"))
    if buyer:
        j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    else:
        j = li.withColumn("o_custkey", F.lit(None).cast("bigint")).withColumn("location", F.lit(None).cast("string"))
    amt = _cents(F.col("l_extendedprice"))
    created = iso(F.col("l_shipdate"))
    return j.select(
        F.concat(F.lit("PAY"), _line_key(), F.lit("-"), amt.cast("string")).alias("id"),
        F.concat(F.lit("SQ"), F.col("l_orderkey").cast("string")).alias("orderId"),
        F.col("location").alias("locationId"), created.alias("createdAt"), created.alias("updatedAt"),
        _minor(amt).alias("amountMoney"),
        F.when(F.col("l_linestatus") == "F", F.lit("COMPLETED")).otherwise(F.lit("APPROVED")).alias("status"),
        F.lit("CARD").alias("sourceType"),
        F.struct(F.struct(F.when(F.col("l_suppkey") % 2 == 0, F.lit("VISA")).otherwise(F.lit("MASTERCARD")).alias("cardBrand"),
                          F.lpad((F.col("l_suppkey") % 10000).cast("string"), 4, "0").alias("last4")).alias("card"))
         .alias("cardDetails"),
        F.array(F.struct(_minor(F.call_function("div", amt * 29, F.lit(1000)) + 30).alias("amountMoney"),
                         F.lit("INITIAL").alias("type"))).alias("processingFee"),
        F.when(F.col("l_returnflag") == "R", _minor(F.call_function("div", amt, F.lit(10))))
         .otherwise(F.lit(None).cast(_MINOR)).alias("refundedMoney"),
        F.when(F.col("l_partkey") % 2 == 0,
               F.concat(F.lit(" Buyer"), F.col("o_custkey").cast("string"), F.lit("@Shop.Example ")))
         .otherwise(F.lit(None).cast("string")).alias("buyerEmailAddress"))


def pos_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("id"),
                    F.when(F.col("n_nationkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name"))
                    .alias("name"))


def _experience(col: str, idx: int) -> Column:
    out = F.lit(None).cast("string")
    for k, v in EXPERIENCES.items():
        out = F.when(F.col(col) == k, F.lit(v[idx]).cast("string")).otherwise(out)
    return out


def experiences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The experiences that bookings name, each once; those of cancelled bookings are inactive."""
    e = read(spark, sf_dir, "events", "event_type").distinct()
    return e.select(F.concat(F.lit("exp_"), F.col("event_type")).alias("id"), _experience("event_type", 0).alias("name"),
                    _experience("event_type", 1).alias("category"),
                    F.when(F.col("event_type") == "error", F.lit("inactive")).otherwise(F.lit("active")).alias("status"))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking per event row."""
    e = read(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    u, et = F.col("user_id"), F.col("event_type")
    created = iso(F.col("ts"))
    return e.select(
        F.concat(F.lit("bk_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("exp_"), et).alias("experience_id"),
        F.struct(_experience("event_type", 0).alias("name"), _experience("event_type", 1).alias("category"))
         .alias("experience"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"), F.date_format("ts", "HH:mm:ss").alias("start_time"),
        F.when(et == "error", F.lit(None).cast("string"))
         .otherwise(F.date_format(F.expr("timestampadd(HOUR, 2, ts)"), "HH:mm:ss")).alias("end_time"),
        F.when(et == "error", F.lit("cancelled")).when(et == "purchase", F.lit("completed"))
         .otherwise(F.lit("confirmed")).alias("status"),
        (u % 6 + 1).cast("int").alias("guests_count"), F.col("value").cast(MONEY).alias("total_price"),
        F.when(et == "click", F.lit(None).cast(MONEY)).otherwise((u % 20).cast(MONEY)).alias("add_ons_total"),
        F.lit("USD").alias("currency"),
        F.struct(F.concat(F.lit("G"), u.cast("string")).alias("id"),
                 F.when(u % 4 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("Customer"), u.cast("string"), F.lit("@Example.COM"))).alias("email"),
                 F.concat(F.lit("+1 555 "), u.cast("string")).alias("phone"),
                 F.lit("Guest").alias("first_name"), u.cast("string").alias("last_name")).alias("primary_guest"),
        created.alias("created_at"), created.alias("updated_at"))
