"""Hand-made fixtures with known answers (FIXTURES.md sections 3-4) and invariants."""

import datetime as dt
import hashlib
import hmac
import base64
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from omnitally.functions import expr as X
from omnitally.functions import security as SEC
from omnitally.operators import calendar as C
from omnitally.operators import events as EV
from omnitally.operators import kpi as K
from omnitally.operators import normalize as N
from omnitally.operators import period as P
from omnitally.operators import quality as Q
from omnitally.operators import upsert as U

ORDER = ("id bigint, channel_id string, location_id string, created_at timestamp_ntz, customer_hash string, "
         "net_total decimal(14,2)")
LINE = "id string, order_id bigint, sku string, product_title string, category string, qty int, line_total decimal(14,2)"
T0 = dt.datetime(2024, 11, 1, 10, 0)


def D(x):
    return Decimal(x)


def test_seed_order_kpi_cell(spark):
    o = spark.createDataFrame([(1, "shop", "online-shop", T0, "h1", D("135.00"))], ORDER)
    li = spark.createDataFrame([("l1", 1, "BOURBON-750ML", "Bourbon", "Spirits", 2, D("120.00")),
                                ("l2", 1, "GLASSWARE-SET", "Glasses", "Merchandise", 1, D("30.00"))], LINE)
    r = K.build_kpi_daily(o, li).collect()
    assert len(r) == 1
    row = r[0]
    assert (row.sales, row.txns, row.units, row.aov, row.items_per_customer) == (D("135.00"), 1, 3, D("135.00"), D("2.00"))
    assert row.top_items[0].sku == "BOURBON-750ML" and row.top_items[0].revenue == D("120.00")
    assert [c.category for c in row.top_categories] == ["Spirits", "Merchandise"]


def test_kpi_edge_cases(spark):
    orders = [(1, "a", None, T0, None, D("10.00")),          # null location, null customer, no lines
              (2, "a", None, T0, None, D("20.00")),
              (3, "a", "L1", T0, "h", D("5.00"))]
    lines = [("x", 3, None, "no sku", None, 1, D("5.00"))]    # sku null, category null
    # 11 skus with a tie at ranks 10/11 in cell (date, a, L1)
    for i in range(11):
        lines.append((f"t{i}", 3, f"S{i:02d}", "t", "Cat", 1, D("1.00")))
    o = spark.createDataFrame(orders, ORDER)
    li = spark.createDataFrame(lines, LINE)
    rows = {r.location_id: r for r in K.build_kpi_daily(o, li).collect()}
    n = rows[None]
    assert (n.sales, n.txns, n.units, n.aov, n.items_per_customer) == (D("30.00"), 2, 0, D("15.00"), D("0.00"))
    assert n.top_items == [] and n.top_categories == []
    c = rows["L1"]
    assert [i.sku for i in c.top_items] == [f"S{i:02d}" for i in range(10)]   # null sku excluded, tie by sku
    assert c.top_categories[0].category == "Cat"
    assert "Uncategorized" in [x.category for x in c.top_categories]


def test_pii_hash_rules(spark):
    def h(s):
        return hashlib.sha256(s.encode()).hexdigest()[:32]
    df = spark.createDataFrame([(" Foo@Example.COM\t", None), (None, " +1 555 "), (None, None), ("", "")],
                               "email string, phone string")
    got = [r[0] for r in df.select(X.customer_hash("email", "phone")).collect()]
    assert got == [h("foo@example.com"), h("+1 555"), None, None]


def test_parse_int_and_external_id(spark):
    df = spark.createDataFrame([("3.7", "gid://shop/Order/123"), (" 12", "123"), ("abc", "gid://x/LineItem/9")],
                               "q string, g string")
    rows = df.select(N.parse_int(F.col("q")).alias("q"), X.external_id("g", "shop").alias("e")).collect()
    assert [r.q for r in rows] == [3, 12, None]
    assert [r.e for r in rows] == ["shop_order_123", "shop_unknown_123", "shop_lineitem_9"]


@pytest.mark.parametrize("body", ['{"id": 1, "total": "10.00"}', '{"name": "Café – naïve ✓"}'])
def test_hmac_matches_python(spark, body):
    key = "s3cret-key"
    df = spark.createDataFrame([(body,)], "body string")
    r = df.select(SEC.hmac_sha256_hex(F.col("body"), key).alias("h"), SEC.hmac_sha256_b64(F.col("body"), key).alias("b"),
                  SEC.verify_signature(F.col("body"), F.lit("wrong"), key).alias("bad"),
                  SEC.verify_signature(F.col("body"), F.lit(None).cast("string"), key).alias("null")).first()
    mac = hmac.new(key.encode(), body.encode("utf-8"), hashlib.sha256)
    assert r.h == mac.hexdigest() and r.b == base64.b64encode(mac.digest()).decode()
    assert r.bad is False and r.null is False


def test_redact_and_mask(spark):
    df = spark.createDataFrame([("x KEY=abc&token=t1 PassWord=p secret=s y", "abcdef", "abc", 42)],
                               "error string, buyer_email string, card_last4 string, order_key bigint")
    r = df.select(SEC.redact(F.col("error")).alias("e")).first()
    assert r.e == "x key=***&token=*** password=*** secret=*** y"
    m = SEC.mask_columns(df.drop("error")).first()
    assert (m.buyer_email, m.card_last4, m.order_key) == ("***cdef", "***", "***")


def test_event_type_rule(spark):
    df = spark.createDataFrame([("Barrel Tour", ""), ("Tasting", None), ("Class", "workshop"), ("TOUR x", None)],
                               "name string, category string")
    assert [r[0] for r in df.select(N.event_type("name", "category")).collect()] == [
        "tour", "experience", "workshop", "tour"]


def test_payments_per_order(spark):
    from omnitally.sources.landed import POS_PAYMENT_DDL
    rows = [("p1", "o1", "L", "2024-01-01T10:00:00Z", None, (1000, "USD"), "COMPLETED", "CARD", None,
             [((30, "USD"), "INITIAL")], (200, "USD"), None),
            ("p2", "o1", "L", "2024-01-01T11:00:00Z", None, (500, "USD"), "FAILED", "CARD", None,
             [((15, "USD"), "INITIAL")], None, "A@b.c"),
            ("p3", None, "L", "2024-01-01T12:00:00Z", None, (700, "USD"), "COMPLETED", "CARD", None, [], None, None)]
    p = spark.createDataFrame(rows, POS_PAYMENT_DDL)
    r = N.payments_per_order(p).collect()
    assert len(r) == 1
    x = r[0]
    assert (x.order_id, x.n_payments, x.paid_cents, x.fee_cents, x.refunded_cents, x.buyer_email) == (
        "o1", 2, 1000, 30, 200, "A@b.c")


def test_refund_replay_is_idempotent(spark):
    o = spark.createDataFrame([(1, D("100.00"), D("0.00"))], "id bigint, gross_total decimal(14,2), refunds_total decimal(14,2)")
    r = spark.createDataFrame([("r1", 1, 500), ("r2", 1, 250), ("r3", 9, 100)], "refund_id string, order_id bigint, amount_cents bigint")
    once = EV.apply_refunds(o, r).collect()
    twice = EV.apply_refunds(o, r.unionByName(r)).collect()
    assert once == twice and once[0].refunds_total == D("7.50") and once[0].net_total == D("92.50")
    assert [x.refund_id for x in EV.unmatched(r, o, "order_id", "id").collect()] == ["r3"]


def test_upsert_is_idempotent_and_newest_wins(spark):
    cur = spark.createDataFrame([(1, "a", 1, 0), (2, "b", 1, 0)], "id int, v string, updated_at int, ingest_ts int")
    b = spark.createDataFrame([(1, "a2", 2, 1), (3, "c", 1, 1), (2, "old", 0, 1)], "id int, v string, updated_at int, ingest_ts int")
    once = U.upsert(cur, b, "id")
    twice = U.upsert(once, b, "id")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {1: "a2", 2: "b", 3: "c"}


def test_replace_children_and_cascade(spark):
    lines = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, order_id int")
    batch = spark.createDataFrame([("a2", 1)], "id string, order_id int")
    assert sorted(r.id for r in U.replace_children(lines, batch).collect()) == ["a2", "c"]
    headers = spark.createDataFrame([(1,), (2,)], "order_id int")  # order 2 comes without lines
    assert [r.id for r in U.replace_children(lines, batch, parents=headers).collect()] == ["a2"]
    deleted = spark.createDataFrame([(2,)], "id int")
    assert sorted(r.id for r in U.cascade_delete(lines, deleted).collect()) == ["a", "b"]


def test_sunday_week_matches_calendar_rule(spark):
    start, end = dt.date(2015, 1, 1), dt.date(2030, 12, 31)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))
    got = {r.d: r.w for r in days.select("d", C.sunday_week(F.col("d")).alias("w")).collect()}

    def rule(d):
        sow = d - dt.timedelta(days=(d.weekday() + 1) % 7)          # Sunday on or before d
        year = (sow + dt.timedelta(days=6)).year                     # the week's year: where it ends
        jan1 = dt.date(year, 1, 1)
        first = jan1 - dt.timedelta(days=(jan1.weekday() + 1) % 7)   # week 1 holds 1 January
        return (sow - first).days // 7 + 1
    assert all(got[d] == rule(d) for d in got)


def test_period_and_report_bounds(spark):
    d = spark.createDataFrame([(dt.date(2001, 6, 15),)], "as_of date")
    pb = {r.period: (r.start_date, r.end_date) for r in P.period_bounds(d).collect()}
    assert pb["wtd"][0] == dt.date(2001, 6, 11) and pb["mtd"][0] == dt.date(2001, 6, 1)
    assert pb["ytd"][0] == dt.date(2001, 1, 1) and pb["today"] == (dt.date(2001, 6, 15),) * 2
    rb = {r.period: r for r in P.report_bounds(d).collect()}
    m = rb["monthly"]
    assert (m.start_date, m.comp_start_date, m.comp_end_date) == (dt.date(2001, 5, 17), dt.date(2001, 4, 17), dt.date(2001, 5, 16))


def test_validation_split(spark):
    r = spark.createDataFrame([("2024-01-01", "2024-01-02", "all", ["a@b.co"]),
                               ("2024/01/01", "2024-01-02", "all", ["a@b.co"]),
                               ("2024-01-01", "2024-01-02", "dtc", ["a@b.co"]),
                               ("2024-01-01", "2024-01-02", "pos", ["a@b.co", "nope"])],
                              "start_date string, end_date string, channel string, recipients array<string>")
    got = [(x.valid, x.reason) for x in Q.validate_requests(r, ["shop", "pos", "booking", "all"]).collect()]
    assert got == [(True, None), (False, "start_date"), (False, "channel"), (False, "recipients")]


def test_invariants_on_tables(spark, sf_small):
    from omnitally.sources import star
    o, li = star.fact_order(spark, sf_small, True), star.fact_order_line(spark, sf_small)
    kpi = K.build_kpi_daily(o, li)
    assert kpi.agg(F.sum("sales")).first()[0] == o.agg(F.sum("net_total")).first()[0]
    # Rebuilding gives the same table (refresh twice = once).
    def rows(df):
        return sorted(tuple("" if v is None else str(v) for v in r) for r in K.kpi_text(df).collect())
    assert rows(kpi) == rows(K.build_kpi_daily(o, li))
    # Each cell's daily top-10 is the head of the exact per-cell ranking.
    exact = K.rank_items(K.item_category_totals(o, li), k=10_000).toPandas()
    exact = exact[exact.item_rank <= 10].sort_values(["date", "channel_id", "location_id", "item_rank"])
    stored = kpi.select(*star.CELL, F.posexplode("top_items").alias("pos", "i")).select(
        *star.CELL, (F.col("pos") + 1).alias("item_rank"), "i.sku").toPandas()
    m = exact.merge(stored, on=["date", "channel_id", "location_id", "item_rank"], how="outer", indicator=True)
    assert (m["_merge"] == "both").all() and (m.sku_x == m.sku_y).all()


def test_cancellation_flags_raw_payload(spark):
    import json
    ev = spark.createDataFrame([("b1", D("10.00"), D("2.00"), 3, '{"guests": "3", "cancelled": "false"}'),
                                ("b2", D("5.00"), D("0.00"), 1, None)],
                               "id string, revenue decimal(14,2), add_on_sales decimal(14,2), attendees int, raw_json string")
    c = spark.createDataFrame([("b1", "2024-01-02T00:00:00Z", "weather"), ("zz", "2024-01-02T00:00:00Z", "x")],
                              "id string, cancelled_at string, reason string")
    rows = {r.id: r for r in EV.apply_cancellations(ev, c).collect()}
    b1 = rows["b1"]
    assert (b1.revenue, b1.add_on_sales, b1.attendees, b1.cancelled) == (D("0.00"), D("0.00"), 3, True)
    assert json.loads(b1.raw_json) == {"guests": "3", "cancelled": True, "cancelled_at": "2024-01-02T00:00:00Z",
                                       "reason": "weather"}
    assert rows["b2"].cancelled is False and rows["b2"].raw_json is None and "zz" not in rows


def test_reconcile_threshold_and_missing_order(spark):
    src = spark.createDataFrame([("shop", dt.date(2024, 1, 1), D("10.00")), ("shop", dt.date(2024, 1, 2), D("10.00")),
                                 ("pos", dt.date(2024, 1, 1), D("5.00")), ("pos", dt.date(2024, 1, 1), D("1.00"))],
                                "source string, date date, rev decimal(14,2)")
    wh = spark.createDataFrame([("shop", dt.date(2024, 1, 1), D("10.99")), ("shop", dt.date(2024, 1, 2), D("11.00")),
                                ("pos", dt.date(2024, 1, 1), D("6.00"))],
                               "source string, date date, rev decimal(14,2)")
    r = {(x.source, x.date.day): x for x in Q.reconcile(src, wh).collect()}
    assert r[("shop", 1)].status == "match"          # |0.99| < 1
    assert r[("shop", 2)].status == "mismatch"       # |1.00| is not < 1
    assert r[("pos", 1)].count_diff == -1 and r[("pos", 1)].status == "mismatch"   # one order missing
    s = Q.reconcile_summary(Q.reconcile(src, wh)).first()
    assert (s.matches, s.mismatches, s.errors, s.exit_level) == (1, 2, 0, 1)
    assert {(x.source, x.date.day) for x in Q.mismatch_actions(Q.reconcile(src, wh)).collect()} == {("pos", 1)}


def test_half_open_window_keeps_last_fraction_of_a_second(spark, sf_small):
    from omnitally.plans import q_quality
    df = spark.createDataFrame([(1, dt.datetime(1998, 1, 31, 23, 59, 59, 500000)), (2, dt.datetime(1998, 2, 1, 0, 0))],
                               "id bigint, created_at timestamp_ntz")
    lo = F.lit(q_quality.TS_WINDOW[0]).cast("timestamp_ntz")
    hi = F.date_add(F.lit(q_quality.TS_WINDOW[1]).cast("date"), 1).cast("timestamp_ntz")
    assert [r.id for r in df.filter((F.col("created_at") >= lo) & (F.col("created_at") < hi)).collect()] == [1]


def test_completions_known_and_unknown(spark):
    ev = spark.createDataFrame([("e1", 4), ("e2", 2)], "id string, attendees int")
    comp = spark.createDataFrame([("e1", 4, 3), ("e9", 5, None)], "id string, guests_count int, actual_attendance int")
    r = {x.id: x for x in EV.apply_completions(ev, comp).collect()}
    assert (r["e1"].attendance, r["e1"].created) == (3, False)
    assert (r["e9"].attendance, r["e9"].created) == (5, True)      # created, guest count as fallback
    assert (r["e2"].attendance, r["e2"].created) == (2, False)


def test_range_ranking_is_lossy_but_exact_variant_is_not(spark):
    from omnitally.operators import rank as R
    orders, lines = [], []
    # Two days; item Z is 11th on each day (outside both daily top 10s) but first over the range.
    for day in (1, 2):
        oid = day
        orders.append((oid, "c", "L", dt.datetime(2024, 1, day, 9), "h", D("100.00")))
        for i in range(10):
            lines.append((f"{day}-{i}", oid, f"S{day}{i}", "t", "C", 1, D("10.00")))
        lines.append((f"{day}-z", oid, "Z", "z", "C", 1, D("9.00")))
    o = spark.createDataFrame(orders, ORDER)
    li = spark.createDataFrame(lines, LINE)
    kpi = K.build_kpi_daily(o, li)
    faithful = [r.sku for r in R.top_items_from_kpi(kpi, 1).collect()]
    exact = [r.sku for r in R.top_items_exact(o.withColumn("gross_total", F.col("net_total")), li,
                                                "2024-01-01", "2024-01-02", 1).collect()]
    assert faithful != ["Z"] and exact == ["Z"]


@pytest.mark.parametrize("tz", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_iso_parsing_is_session_zone_independent(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([("2024-01-01T23:30:00Z",), ("2024-01-02T01:00:00+02:00",)], "s string")
        got = [r[0] for r in df.select(X.utc_ts("s")).collect()]
        assert got == [dt.datetime(2024, 1, 1, 23, 30), dt.datetime(2024, 1, 1, 23, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_payment_sets_hash_only_when_empty(spark):
    from omnitally.sources.landed import POS_PAYMENT_DDL
    o = spark.createDataFrame([("o1", "keep"), ("o2", None)], "id string, customer_hash string")
    mk = lambda pid, oid, upd, st: (pid, oid, "L", "2024-01-01T10:00:00Z", upd, (100, "USD"), st, "CARD", None,
                                    [], None, "x@y.z")
    p = spark.createDataFrame([mk("p1", "o1", "1", "APPROVED"), mk("p1", "o1", "2", "COMPLETED"),
                               mk("p2", "o2", "1", "COMPLETED"), mk("p3", "o3", "1", "COMPLETED")], POS_PAYMENT_DDL)
    r = {x.order_id: x for x in EV.apply_payments(o, p).collect()}
    assert r["o1"].customer_hash == "keep" and r["o1"].total_paid == D("1.00") and r["o1"].n_payments == 1
    assert r["o2"].customer_hash == hashlib.sha256(b"x@y.z").hexdigest()[:32]
    assert r["o3"].created is True and r["o1"].created is False


KPI_ROW = ("date date, channel_id string, location_id string, sales decimal(14,2), txns bigint, units bigint, "
           "aov decimal(14,2), items_per_customer decimal(14,2)")


def test_channel_performance_names_and_shares(spark):
    from omnitally.operators import rank as R
    kpi = spark.createDataFrame([(dt.date(2024, 1, 1), "a", None, D("30.00"), 3, 5, D("10.00"), D("1.00")),
                                 (dt.date(2024, 1, 2), "a", "L", D("10.00"), 1, 1, D("10.01"), D("1.00")),
                                 (dt.date(2024, 1, 1), "zz", None, D("60.00"), 2, 2, D("30.00"), D("1.00"))], KPI_ROW)
    names = spark.createDataFrame([("a", "Alpha")], "id string, name string")
    r = {x.channel_id: x for x in R.channel_performance(kpi, names).collect()}
    assert r["a"].channel_name == "Alpha" and r["zz"].channel_name == "zz"          # falls back to the id
    assert (r["a"].sales, r["a"].txns, r["a"].aov) == (D("40.00"), 4, D("10.01"))   # mean of 10.00 and 10.01, half up
    assert abs(r["a"].percent_of_total + r["zz"].percent_of_total - 100.0) < 1e-9


def test_growth_is_zero_without_a_previous_period(spark):
    kpi = spark.createDataFrame([(dt.date(2024, 1, 9), "a", None, D("50.00"), 2, 3, D("25.00"), D("1.00"))], KPI_ROW)
    g = P.period_growth(kpi, "2024-01-08", "2024-01-14", "2024-01-01", "2024-01-07").first()
    assert (g.sales_current, g.sales_previous, g.sales_growth, g.txns_growth, g.aov_growth) == (
        D("50.00"), D("0.00"), 0.0, 0.0, 0.0)
    kpi2 = kpi.unionByName(spark.createDataFrame(
        [(dt.date(2024, 1, 2), "a", None, D("25.00"), 1, 1, D("25.00"), D("1.00"))], KPI_ROW))
    g2 = P.period_growth(kpi2, "2024-01-08", "2024-01-14", "2024-01-01", "2024-01-07").first()
    assert (g2.sales_growth, g2.txns_growth, g2.aov_growth) == (100.0, 100.0, 0.0)


def test_zero_filled_trend_has_every_bucket(spark):
    v = spark.createDataFrame([(dt.datetime(2001, 6, 15, 7), D("5.00"), 2)], "h timestamp_ntz, sales decimal(18,2), txns bigint")
    out = P.zero_filled(P.calendar_buckets(spark, "2001-06-15 00:00:00", 24, "hour"), v, "h", ["sales", "txns"]) \
        .withColumn("label", P.bucket_label(F.col("bucket"), "today")).orderBy("bucket").collect()
    assert len(out) == 24 and out[7].txns == 2 and out[8].txns == 0 and out[7].label == "07:00"
    assert sum(r.sales for r in out) == D("5.00")


def test_mask_short_and_null_values(spark):
    df = spark.createDataFrame([("ab", None)], "phone string, card_number string")
    r = SEC.mask_columns(df).first()
    assert (r.phone, r.card_number) == ("***", "***")
