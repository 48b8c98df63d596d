"""The dispatching stream on hand-made deliveries: replays, late and unordered versions, one commit per batch."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from omnitally.functions import security as SEC
from omnitally.plans import jobs, snapshots
from omnitally.streaming import dispatch as DI
from omnitally.streaming import ingest as ST


def order(updated, price, lines, refunds=(), customer=True):
    return {"id": 1, "page": 0, "name": "", "order_number": "1001", "created_at": "2024-01-05T10:00:00Z", "updated_at": updated,
            "total_price": price, "total_tax": "1.00", "customer": {"id": 5, "email": " A@x.IO ", "phone": None} if customer else None,
            "line_items": [{"id": n, "name": f"item {n}", "sku": f"S{n}", "quantity": 2, "price": "3.50", "product_id": n,
                            "product_type": "Spirits"} for n in lines],
            "transactions": [{"kind": "sale", "amount": price}, {"kind": "sale", "status": "pending", "amount": "9"}],
            "refunds": [{"total_refund_set": {"shop_money": {"amount": r}}} for r in refunds]}


def payment(key, updated, status, amount, refunded=0, fees=(30, 5), email=None):
    return {"id": key, "orderId": "Q1", "locationId": "L1", "createdAt": "2024-01-05T10:00:00Z", "updatedAt": updated, "status": status,
            "amountMoney": {"amount": amount}, "sourceType": "CARD", "cardDetails": {"card": {"cardBrand": "VISA", "last4": "4242"}},
            "processingFee": [{"amountMoney": {"amount": f}, "type": "INITIAL"} for f in fees],
            "refundedMoney": {"amount": refunded}, "buyerEmailAddress": email}


def booking(key, guests=4, **more):
    return {"id": key, "experience": {"name": "A Tour", "category": ""}, "event_date": "2024-03-01", "start_time": "10:00:00",
            "status": "confirmed", "guests_count": guests, "total_price": 50, "add_ons_total": 5,
            "primary_guest": {"id": "G1", "email": "g@x.io"}, "updated_at": "2024-02-01T00:00:00Z", "metadata": {"a": [1, {"b": True}]}, **more}


FEED = [
    ("shop", "orders/updated", "o2", order("2024-01-06T00:00:00Z", "70.00", [1, 2, 3], ["4.00"])),
    ("shop", "orders/create", "o1", order("2024-01-05T00:00:00Z", "10.00", [1, 9], customer=False)),
    ("shop", "refunds/create", "r1", {"id": "R1", "order_id": 1, "amount": "6.00"}),
    ("shop", "refunds/create", "r2", {"id": "R1", "order_id": 1, "amount": "6.00"}),  # the same refund under another delivery id
    ("shop", "refunds/create", "r3", {"id": "R2", "order_id": 99, "amount": "5.00"}),  # its order never comes
    ("pos", "payment.updated", "p2", payment("P1", "2024-01-07T00:00:00Z", "COMPLETED", 1500, 200, email="b@x.io")),
    ("pos", "payment.created", "p1", payment("P1", "2024-01-05T00:00:00Z", "APPROVED", 1500)),
    ("pos", "payment.created", "p3", payment("P2", "2024-01-05T00:00:00Z", "APPROVED", 800, 100)),
    ("booking", "booking.cancelled", "x1", booking("B1", cancellation_reason="rain")),
    ("booking", "booking.created", "b1", booking("B1")),
    ("booking", "booking.completed", "c2", booking("B2", guests=6, actual_attendance=0)),
    ("booking", "experience.updated", "e1", {"id": "E1"}),
    ("booking", "booking.created", "b3", {"no": "id"}),
]


def envelopes(spark, feed, secret=ST.SECRET, at="2024-02-02T00:00:00Z"):
    df = spark.createDataFrame([(s, t, e, json.dumps(b), at) for s, t, e, b in feed],
                               "source string, topic string, event_id string, body string, at string")
    body = F.when(F.col("source") == "pos", F.concat(F.lit(ST.POS_URL), F.col("body"))).otherwise(F.col("body"))
    sig = F.when(F.col("source") == "booking", SEC.hmac_sha256_hex(body, secret)).otherwise(SEC.hmac_sha256_b64(body, secret))
    return df.select("source", "topic", "event_id", "body", sig.alias("signature"), F.col("at").cast("timestamp").alias("received_at"))


def state(spark, base):
    out = {}
    for name in DI.SCHEMAS:
        if name not in ("deliveries", "records"):
            out[name] = sorted(map(str, DI.table(spark, base, name).collect()))
    return out


@pytest.fixture(scope="module")
def applied(spark):
    base = ST.run_dir(spark, "test-dispatch")
    DI.apply_batch(spark, base, envelopes(spark, FEED), 0, 4)
    return base


def test_all_tables_of_a_batch(spark, applied):
    orders = {r.id: r for r in DI.table(spark, applied, "orders").collect()}
    shop, pos = orders["shop_order_1"], orders["pos_order_Q1"]
    assert (shop.gross_total, shop.refunds_total, shop.net_total, shop.tax_total) == (D("70.00"), D("10.00"), D("60.00"), D("1.00"))
    assert json.loads(shop.raw_json)["lastRefund"] == {"id": "R1", "order_id": 1, "amount": "6.00"}
    assert json.loads(shop.raw_json)["line_items"][0]["quantity"] == 2
    # Created from its payments; only completed ones count.
    assert pos.from_payments and (pos.gross_total, pos.refunds_total, pos.net_total) == (D("15.00"), D("2.00"), D("13.00"))
    assert json.loads(pos.raw_json)["lastPaymentUpdate"]["amountMoney"] == {"amount": 1500}
    assert "shop_order_99" not in orders
    lines = DI.table(spark, applied, "lines").collect()
    assert sorted((r.order_id, r.sku, r.category, r.qty, r.line_total) for r in lines) == [
        ("shop_order_1", f"S{n}", "Spirits", 2, D("7.00")) for n in (1, 2, 3)]
    tenders = {r.tender_id: (r.status, r.amount, r.fee_total) for r in DI.table(spark, applied, "tenders").collect()}
    assert tenders == {"shop_order_1#0": ("SUCCESS", D("70.00"), None), "P1": ("COMPLETED", D("15.00"), D("0.35")),
                       "P2": ("APPROVED", D("8.00"), D("0.35"))}
    events = {r.id: r for r in DI.table(spark, applied, "events").collect()}
    gone, made = events["booking_B1"], events["booking_B2"]
    assert (gone.cancelled, gone.revenue, gone.add_on_sales, gone.attendees) == (True, D("0.00"), D("0.00"), 4)
    raw = json.loads(gone.raw_json)
    assert raw["cancelled"] is True and raw["cancellationReason"] == "rain" and raw["metadata"] == {"a": [1, {"b": True}]}
    assert (made.completed, made.attendance, made.revenue, made.event_type) == (True, 6, D("50.00"), "tour")
    assert json.loads(made.raw_json)["actualAttendees"] == 6
    people = {(r.shop_customer_id, r.booking_guest_id) for r in DI.table(spark, applied, "identities").collect()}
    assert people == {("gid://shop/Customer/5", None), (None, "G1"), (None, None)}
    log = {r.delivery: r.status for r in DI.table(spark, applied, "deliveries").collect()}
    assert {k for k, v in log.items() if v == "warning"} == {"booking|e1", "booking|b3"} and len(log) == len(FEED)


def test_replays_and_other_orders_change_nothing(spark, applied):
    want = state(spark, applied)
    DI.apply_batch(spark, applied, envelopes(spark, FEED[:3]), 0, 4)  # a batch that is committed
    DI.apply_batch(spark, applied, envelopes(spark, FEED, at="2024-02-03T00:00:00Z"), 1, 4)  # delivered again later
    assert state(spark, applied) == want
    base = ST.run_dir(spark, "test-dispatch")
    back = list(reversed(FEED))
    for n in range(3):
        DI.apply_batch(spark, base, envelopes(spark, back[n::3]), n, 4)
    assert state(spark, base) == want


def test_forged_deliveries_change_nothing(spark, applied):
    want = state(spark, applied)
    forged = [("shop", "orders/updated", "o9", order("2030-01-01T00:00:00Z", "999.00", []))]
    number = snapshots.load(spark, applied).batch
    DI.apply_batch(spark, applied, envelopes(spark, forged, "another secret"), number + 1, 4)
    assert state(spark, applied) == want
    # The same id with a right signature is a delivery of its own.
    DI.apply_batch(spark, applied, envelopes(spark, [(*forged[0][:3], order("2024-01-05T12:00:00Z", "1.00", []))]), number + 2, 4)
    assert state(spark, applied) == want
    log = [r.status for r in DI.table(spark, applied, "deliveries").filter("delivery = 'shop|o9'").collect()]
    assert log == ["success"]


def test_tables_appear_together(spark, applied, monkeypatch):
    """A batch that fails before its manifest leaves every table as it was, and can run again."""
    want, number = state(spark, applied), snapshots.load(spark, applied).batch
    more = [("shop", "orders/updated", "o5", order("2024-01-09T00:00:00Z", "80.00", [4]))]

    def fail(*_):
        raise RuntimeError("no commit")

    with monkeypatch.context() as m:
        m.setattr(jobs, "publish_version", fail)
        with pytest.raises(RuntimeError):
            DI.apply_batch(spark, applied, envelopes(spark, more), number + 1, 4)
    assert state(spark, applied) == want
    DI.apply_batch(spark, applied, envelopes(spark, more), number + 1, 4)
    after = {r.id: r.gross_total for r in DI.table(spark, applied, "orders").collect()}
    assert after["shop_order_1"] == D("80.00") and len(state(spark, applied)["lines"]) == 1


def test_a_batch_reads_its_own_buckets(spark, applied, sf_small):
    snap = snapshots.load(spark, applied)
    held = snap.tables["deliveries"]
    one = int(next(iter(held)))
    files = snapshots.read(spark, snap, "deliveries", DI.DELIVERY, [one]).inputFiles()
    assert files and all(f"bucket={one}/" in f for f in files) and len(held) > 1
    # The streaming dedupe prunes the partitions of other buckets.
    table = ST.run_dir(spark, "test-dedupe")
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    ST.new_deliveries(spark, events, table, 0).withColumn("batch_id", F.lit(0).cast("bigint")).write.partitionBy("bucket", "batch_id").parquet(table)
    few = events.filter("event_id in (3, 4)")
    again = ST.new_deliveries(spark, few, table, 1)
    assert again.count() == 0
    plan = again._jdf.queryExecution().executedPlan().toString()
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("bucket#" in f and " IN (" in f for f in filters)


def test_newest_rows_are_carried_once(spark):
    """A shuffle of newest versions holds each row once, and the stored bodies are verified and freed of repeats once."""
    from omnitally.operators import normalize as N
    from omnitally.operators.upsert import latest_version
    rows = spark.createDataFrame([("a", 1, "x", 0), ("a", 2, "w", 0), ("a", 2, "y", 0), ("b", None, "z", 0), (None, 3, "n", 0), (None, 4, "m", 0)],
                                 "id string, updated_at int, body string, page int")
    newest = latest_version(rows, "id", ["updated_at"])
    assert {(r.id, r.updated_at, r.body) for r in newest.collect()} == {("a", 2, "y"), ("b", None, "z"), (None, 4, "m")}
    for df in (newest, N.newest_pages(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "max_by" not in plan and "partial_max(" in plan


def test_pages_of_an_older_version_go(spark, monkeypatch):
    rows = [("shop_order", "s1", 0, "2"), ("shop_order", "s1", 1, "1"), ("shop_order", "s1", 2, "2"), ("pos_order", "p1", 0, "1"),
            ("payment", "s1", 0, "0"), ("shop_order", "s2", 1, "1")]
    df = spark.createDataFrame(rows, "kind string, key string, page bigint, updated_at string")
    for few in (0, DI.FEW):
        monkeypatch.setattr(DI, "FEW", few)
        assert sorted(tuple(r) for r in DI.newest_pages(df).select(*df.columns).collect()) == sorted(rows[:1] + rows[2:])
    single = df.filter("page = 0")
    assert DI.newest_pages(single) is single


def test_landed_text_is_compressed(spark):
    from omnitally.sources import landed as L
    path = ST.run_dir(spark, "test-land")
    L.land(spark.createDataFrame([("a", 1)], "id string, n int"), path)
    assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())
    assert [r.value for r in spark.read.text(path).collect()] == ['{"id":"a","n":1}']


RECORDS = [("shop_order", "shop_order_1", 0, "shop_order_1", "1", '{"id": 1, "page": 0}'), ("refund", "R1", 0, "shop_order_1", "2", '{"id": "R1"}'),
           ("payment", "P1", 0, "pos_order_Q", "2", '{"id": "P1", "orderId": "Q"}'), ("booking", "booking_B", 0, "booking_B", "1", '{"id": "B"}'),
           ("completion", "booking_C", 0, "booking_C", "1", '{"id": "C", "guests_count": 3}'),
           ("cancellation", "booking_D", 0, "booking_D", "1", '{"id": "D"}')]


def records(spark):
    df = spark.createDataFrame(RECORDS, "kind string, key string, page bigint, owner string, updated_at string, body string")
    return df.withColumn("received_at", F.lit("2024-02-02").cast("timestamp")).withColumn("delivery", F.col("key"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_rows_are_written_where_they_lie(spark):
    """No shuffle by bucket: every task writes its own rows, in the order that readers filter by."""
    base = ST.run_dir(spark, "test-stage")
    rows = spark.range(400).selectExpr("cast(id as string) AS id", "cast(400 - id as string) AS kind").repartition(3)
    staged = snapshots.stage(spark, base, "t", 0, rows, F.col("id"), [0, 1], 2, ("kind",))
    stored = spark.read.parquet(staged.folder)
    assert sorted((r.id, r.kind) for r in stored.collect()) == sorted((r.id, r.kind) for r in rows.collect())
    files = stored.inputFiles()
    assert len(files) == 6 and sum("bucket=0/" in f for f in files) == 3
    for f in files:
        kinds = [r.kind for r in spark.read.parquet(f).collect()]
        assert kinds == sorted(kinds)


def test_bodies_that_several_tables_read_are_parsed_once(spark):
    """The fields of orders and payments are stored beside the batch's records; the tables read them, not the bodies."""
    from omnitally.sources import landed as L
    from pyspark.sql import types as T
    feed = [(DI.TOPICS[source, topic], b) for source, topic, _, b in FEED if DI.TOPICS.get((source, topic)) in DI.PARSED]
    rows = spark.createDataFrame([(k, f"{k}-{n}", 0, f"{k}-{n}", "1", json.dumps(b), "2024-02-02", str(n)) for n, (k, b) in enumerate(feed)]
                                 + [("payment", "bad", 0, "bad", "1", '{"id":', "2024-02-02", "bad")],
                                 "kind string, key string, page bigint, owner string, updated_at string, body string, at string, delivery string")
    rows = rows.select("kind", "key", "page", "owner", "updated_at", F.col("at").cast("timestamp").alias("received_at"), "delivery", "body")
    base = ST.run_dir(spark, "test-parsed")
    staged = snapshots.stage(spark, base, "records", 0, rows, F.col("owner"), [0, 1], 2, ("kind", "owner"), DI.parsed_bodies())
    fields = [T.StructField(f"_{kind}", L.schema(landed)) for kind, landed in DI.PARSED.items()]
    stored = snapshots.read_staged(spark, staged, T.StructType([*T._parse_datatype_string(DI.RECORD).fields, *fields]))
    plain, parsed = DI.order_tables(rows), DI.order_tables(stored)
    for name in ("orders", "lines", "tenders"):
        assert "from_json(StructField(id" in plan_of(plain[name]) and "from_json(StructField(id" not in plan_of(parsed[name])
        assert sorted(map(str, parsed[name].collect())) == sorted(map(str, plain[name].collect()))


def test_shuffle_files_end_with_their_query(spark):
    import time
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {n.rsplit("/", 1)[-1] for n in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}

    before, setting = shuffles(), spark.conf.get(jobs._RELEASE, "false")
    with jobs.released_shuffles(spark):
        path = ST.run_dir(spark, "test-release")
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(path)
    for _ in range(100):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and spark.read.parquet(path).count() == 7
    with pytest.raises(RuntimeError), jobs.released_shuffles(spark):
        raise RuntimeError("stop")
    assert spark.conf.get(jobs._RELEASE) == setting


def test_payloads_are_shuffled_once(spark):
    """An order's payload goes to its order in one left join; an event's records are grouped once, without a join."""
    tables = DI.order_tables(records(spark))
    assert "FullOuter" not in plan_of(tables["orders"])
    raw = {r.id: json.loads(r.raw_json) for r in tables["orders"].collect()}
    assert raw == {"shop_order_1": {"id": 1, "page": 0, "lastRefund": {"id": "R1"}},
                   "pos_order_Q": {"lastPaymentUpdate": {"id": "P1", "orderId": "Q"}}}
    events = DI.event_table(records(spark))
    assert "Join" not in plan_of(events) and plan_of(events).count("Exchange hashpartitioning") == 1
    assert {(r.id, r.completed, r.cancelled, r.attendance) for r in events.collect()} == {
        ("booking_B", False, False, 0), ("booking_C", True, False, 3)}


def test_a_table_without_folders_costs_nothing(spark):
    none = snapshots.read(spark, snapshots.Snapshot(-1, {}, []), "records", DI.RECORD)
    assert none.count() == 0 and none.schema.names == spark.createDataFrame([], DI.RECORD).schema.names
    rows = records(spark)
    both = none.unionByName(rows.select(*none.columns)).join(none.select("delivery"), "delivery", "left_anti")
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan and both.count() == len(RECORDS)


def test_independent_jobs_run_at_once(spark):
    import threading
    meet = threading.Barrier(2, timeout=20)  # broken unless both run at the same time
    assert sorted(jobs.at_once(spark, [lambda: meet.wait(), lambda: meet.wait()])) == [0, 1]
    with pytest.raises(ValueError):
        jobs.at_once(spark, [lambda: 1, lambda: int("x")])
