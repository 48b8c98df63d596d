"""Reconciliation with failing sources, resync, gaps, payload rules, typed merges and repeated order events."""

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from omnitally.functions.expr import merge_json
from omnitally.operators import normalize as N
from omnitally.operators import quality as Q
from omnitally.operators import upsert as U
from omnitally.plans import jobs, recon
from omnitally.sources import landed as L

DAY = [dt.date(2024, 1, d) for d in range(1, 6)]


def rows(spark, data):
    return spark.createDataFrame(data, "id string, source string, date date, revenue decimal(14,2)")


@pytest.fixture
def store(spark):
    base = jobs.new_table_dir(spark, "test_recon")
    recon.store_facts(rows(spark, [("s1", "shop", DAY[0], D("10.00")), ("s2", "shop", DAY[1], D("5.00")),
                                   ("p1", "pos", DAY[0], D("7.00")), ("b1", "booking", DAY[0], D("1.00"))]), f"{base}/facts")
    return base


def broken():
    raise OSError("no such feed")


def test_one_failing_source_does_not_stop_the_others(spark, store):
    sources = {"shop": lambda: rows(spark, [("s1", "shop", DAY[0], D("10.99")), ("s2", "shop", DAY[1], D("6.00")), ("s3", "shop", DAY[2], D("1.00"))]),
               "pos": broken, "booking": lambda: rows(spark, [("b1", "booking", DAY[0], D("1.00"))]).withColumn("revenue", F.expr(
                   "cast(raise_error('half way') as decimal(14,2))"))}
    r = {(x.source, x.date): x for x in recon.reconcile(spark, sources, f"{store}/facts", f"{store}/first").collect()}
    assert {k: v.status for k, v in r.items()} == {("shop", DAY[0]): "match", ("shop", DAY[1]): "mismatch", ("shop", DAY[2]): "mismatch",
                                                   ("pos", None): "error", ("booking", None): "error"}
    s = Q.reconcile_summary(spark.read.parquet(f"{store}/first")).first()
    assert (s.matches, s.mismatches, s.errors, s.exit_level) == (1, 2, 2, 2)
    every = recon.reconcile(spark, {"pos": broken}, f"{store}/facts", f"{store}/none").collect()
    assert [x.status for x in every] == ["error"]


def test_resync_can_be_run_again(spark, store):
    sources = {"shop": lambda: rows(spark, [("s1", "shop", DAY[0], D("10.00")), ("s2", "shop", DAY[1], D("6.00")), ("s3", "shop", DAY[1], D("2.00"))]),
               "pos": broken}
    actions = spark.createDataFrame([("shop", DAY[1]), ("pos", DAY[0])], "source string, date date")
    for version in (1, 2):
        recon.resync(spark, sources, actions, f"{store}/facts", f"{store}/totals", f"{store}/audit{version}", "2024-02-01 00:00:00", version)
        facts = {r.id: r.revenue for r in recon.stored(spark, f"{store}/facts").collect()}
        assert facts == {"s1": D("10.00"), "s2": D("6.00"), "s3": D("2.00"), "p1": D("7.00"), "b1": D("1.00")}
        totals = {(r.source, r.date): (r.sales, r.txns) for r in spark.read.parquet(f"{store}/totals").collect()}
        assert totals[("shop", DAY[1])] == (D("8.00"), 2)
        audit = {(r.source, r.status): r.error for r in spark.read.parquet(f"{store}/audit{version}").collect()}
        assert set(audit) == {("shop", "processing"), ("shop", "success"), ("pos", "processing"), ("pos", "failed")}
        assert "no such feed" in audit["pos", "failed"]


def test_gaps_and_islands(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    done = spark.createDataFrame([("pos", "L1", t(2), t(4)), ("pos", "L1", t(3), t(6)), ("pos", "L1", t(3), t(6)), ("pos", "L1", t(8), t(9)),
                                  ("pos", "L1", t(9), t(10)), ("shop", None, t(0), t(12)), ("pos", "L9", t(1), t(2))],
                                 "source string, location string, window_start timestamp_ntz, window_end timestamp_ntz")
    bounds = spark.createDataFrame([("pos", "L1", t(0), t(12)), ("pos", "L2", t(0), t(12)), ("shop", None, t(0), t(12)), ("pos", "L9", t(3), t(5))],
                                   "source string, location string, begin timestamp_ntz, finish timestamp_ntz")
    got = {(r.source, r.location, r.gap_start.hour, r.gap_end.hour) for r in U.backfill_gaps(done, bounds).collect()}
    assert got == {("pos", "L1", 0, 2), ("pos", "L1", 6, 8), ("pos", "L1", 10, 12), ("pos", "L2", 0, 12), ("pos", "L9", 3, 5)}


@pytest.mark.parametrize("raw, want", [
    ('{"a":{"b":1},"n":2,"l":[1,"x",null],"t":true,"s":"q\\"","d":1.25}', {"a": {"b": 1}, "l": [1, "x", None], "t": True, "s": 'q"', "d": 1.25}),
    (None, {}), ("not json", {}), ("[1]", {}), ("{}", {})])
def test_merged_payloads_keep_types(spark, raw, want):
    df = spark.createDataFrame([(raw, 7, '{"x":[{"y":false}]}')], "raw string, n int, inner string")
    out = df.select(merge_json("raw", {"n": F.col("n"), "cancelled": F.lit(True), "none": F.lit(None).cast("string"),
                                       "last": F.try_parse_json("inner")}).alias("j")).first().j
    assert json.loads(out) == {**want, "n": 7, "cancelled": True, "none": None, "last": {"x": [{"y": False}]}}


def test_repeated_order_events_count_once(spark):
    """An order delivered twice, an older version late, and one that lost a page: 4 lines once, 1 header."""
    line = lambda n: (n, f"i{n}", f"S{n}", 2, "5.00", n, "T")
    data = [(1, 0, "new", "2024-01-02", [line(1), line(2)]), (1, 1, "new", "2024-01-02", [line(3), line(4)]),
            (1, 0, "new", "2024-01-02", [line(1), line(2)]), (1, 1, "new", "2024-01-02", [line(3), line(4)]),
            (1, 0, "old", "2024-01-01", [line(9)]), (1, 2, "old", "2024-01-01", [line(8)])]
    raw = spark.createDataFrame([(i, p, n, None, "2024-01-01T00:00:00Z", u, "40.00", None, None, None, None, x, None, None)
                                 for i, p, n, u, x in data], L.SHOP_EVENT_DDL)
    one = N.shop_events(raw).collect()
    assert [(r.name, r.n_lines, r.lines_total) for r in one] == [("new", 4, D("40.00"))]
    orders = N.event_to_order(N.newest_pages(raw))
    assert N.shop_orders(orders).count() == 1
    assert sorted((r.id, r.qty, r.line_total) for r in N.shop_lines(orders).collect()) == [
        (f"shop_lineitem_{n}", 2, D("10.00")) for n in (1, 2, 3, 4)]


def test_landed_scan_quarantines(spark):
    path = jobs.new_table_dir(spark, "landed_test")
    records = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), F.lit("c").alias("category"),
                                     F.lit("active").alias("status"))
    L.land(records, path, F.col("id") == "3")
    good = L.scan(spark, path, "experience", f"{path}-bad")
    assert sorted(int(r.id) for r in good.collect()) == list(range(10)) and good.columns == records.columns
    bad = spark.read.parquet(f"{path}-bad").collect()
    assert [r.kind for r in bad] == ["experience"] and bad[0].line.startswith('{"id":"3"')


def test_a_resync_pulls_every_source_once(spark):
    """The pulled rows are stored before the upsert, which reads them several times."""
    base = jobs.new_table_dir(spark, "test-resync-once")
    rows = spark.createDataFrame([(f"o{n}", "shop", "2024-01-05", "2.00") for n in range(10)], "id string, source string, date string, revenue string") \
        .withColumn("date", F.to_date("date"))
    recon.store_facts(rows.filter("id < 'o5'"), f"{base}/facts")
    pulled = spark.sparkContext.accumulator(0)

    def count(x):
        pulled.add(1)
        return x

    source = rows.withColumn("id", F.udf(count, "string").asNondeterministic()("id"))
    recon.resync(spark, {"shop": lambda: source}, rows.select("source", "date"), f"{base}/facts", f"{base}/totals", f"{base}/audit",
                 "2024-02-01 06:00:00", 1)
    assert pulled.value == 10
    assert [(r.txns, str(r.sales)) for r in spark.read.parquet(f"{base}/totals").collect()] == [(10, "20.00")]


def test_the_shop_scan_is_parsed_once(spark, sf_small):
    """A global sort samples its input first: the parsed rows are stored, so neither pass parses again."""
    from omnitally.plans.q_normalize import q_scan_shop_orders
    found = q_scan_shop_orders(spark, sf_small)
    assert "from_json" not in found._jdf.queryExecution().executedPlan().toString()
    times = [r.created_at for r in found.collect()]
    assert times and times == sorted(times)


def test_the_shop_scan_counts_the_lines_of_every_page(spark, tmp_path):
    """Orders of 3, 100 and 250 lines, the last one delivered as two equal rows, and one without lines or without a key."""
    import datetime as dt

    from omnitally.plans.q_normalize import q_scan_shop_orders
    day = dt.datetime(1998, 2, 1)
    orders = [(k, 7, "P", 10.0, day) for k in (1, 2, 3, 3, 4, None)]
    lines = [(k, n % 7 + 1, 1, 1, 1.0, 5.0, "N", "O", day) for k, many in ((1, 3), (2, 100), (3, 250), (None, 150)) for n in range(many)]
    for name, rows, ddl in [
        ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
        ("lineitem", lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                            "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("part", [(1, "p", "T", "b", 5.0)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_retailprice double")]:
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = sorted((str(r.id)[17:], r.n_lines, r.n_transactions) for r in q_scan_shop_orders(spark, str(tmp_path)).collect())
    assert found == [("", 0, 2), ("1", 3, 2), ("2", 100, 2), ("3", 250, 2), ("3", 250, 2), ("4", 0, 2)]
