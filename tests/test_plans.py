"""Physical-plan properties the scale design relies on (checked with explain())."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from omnitally.operators import kpi as K
from omnitally.plans import catalog
from omnitally.sources import star

QUERIES = E.queries()
SIDE_EFFECTS = {"kpi_refresh", "stream_ingest", "stream_upsert_orders", "stream_dedupe", "stream_daily_totals",
                "stream_daily_visitors", "stream_counts_by_topic", "quarantined_lines"}


def nodes(p, name):
    """Number of physical operators called ``name`` (detail lines "(n) name")."""
    import re
    return len(re.findall(rf"^\(\d+\) {name}\b", p, flags=re.M))


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_topk_is_limited_before_the_shuffle(spark, sf_small):
    p = plan(K.build_kpi_daily(star.fact_order(spark, sf_small), star.fact_order_line(spark, sf_small)))
    # partial + final group limit for both rankings
    assert p.count("WindowGroupLimit") >= 4


def test_no_broadcast_of_large_tables(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["kpi_daily", "norm_pos_orders", "reconcile", "apply_payments", "customer_identity"]:
            assert "BroadcastExchange" not in plan(QUERIES[name](spark, sf_small)), name
        # no broadcast is forced, not even of the fixed-size dimensions
        assert "BroadcastExchange" not in plan(QUERIES["orders_with_location"](spark, sf_small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_period_queries_prune_kpi_partitions(spark, sf_small):
    p = plan(QUERIES["kpi_mtd"](spark, sf_small))
    assert "PartitionFilters: [isnotnull(month" in p and "2001-06-01" in p
    assert "ReadSchema: struct<date:date,sales:decimal(14,2),txns:bigint,units:bigint,aov" in p
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2001-06-01)]" in p


def test_scans_are_pruned(spark, sf_small):
    p = plan(QUERIES["kpi_daily"](spark, sf_small))
    schemas = [l for l in p.splitlines() if l.startswith("ReadSchema: struct<l_")]
    assert schemas and all("l_shipdate" not in s and "l_returnflag" not in s and "l_tax" not in s for s in schemas)
    assert "SortAggregate" not in p


def test_header_queries_read_no_lines(spark, sf_small):
    for name in ["norm_shop_orders", "norm_shop_tenders", "shop_total_refunded", "customer_identity"]:
        schemas = [ln for ln in plan(QUERIES[name](spark, sf_small)).splitlines() if ln.startswith("ReadSchema")]
        assert schemas and not any("l_orderkey" in s for s in schemas), name
    # Payments are lines here: one scan of them, none of their orders' customers.
    for name in ["payments_to_orders", "apply_payments", "recon_pos_net"]:
        p = plan(QUERIES[name](spark, sf_small))
        schemas = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
        assert sum("l_orderkey" in s for s in schemas) == 1 and not any("c_custkey" in s for s in schemas), name
    assert not any("c_nationkey" in ln for ln in plan(QUERIES["norm_pos_tenders"](spark, sf_small)).splitlines())


def test_kpi_scans_lines_once_at_runtime(spark, sf_small):
    df = K.build_kpi_daily(star.fact_order(spark, sf_small), star.fact_order_line(spark, sf_small))
    df.collect()
    final = plan(df, "simple").split("== Initial Plan ==")[0]
    scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert len(scans) == 1 or final.count("ReusedExchange") >= 2


def test_kpi_totals_share_the_rankings_lines(spark, sf_small):
    """Without broadcasts too, lines are joined to their orders in one place: no branch prunes a column that another reads."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = K.build_kpi_daily(star.fact_order(spark, sf_small), star.fact_order_line(spark, sf_small))
        df.collect()
        final = plan(df, "simple").split("== Initial Plan ==")[0]
        scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]
        assert len(scans) == 1, scans
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_payload_joins_fees_to_headers(spark, sf_small):
    """No order's line list is shuffled for its fees, and the records stay as they are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES["raw_payload"](spark, sf_small), "simple")
        assert "hashpartitioning(id#" not in p and "hashpartitioning(concat(SQ" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_payload_stores_its_fees(spark, tmp_path):
    """The lines are read for the payments, the line counts and the lists (both twice in the plan, whose shuffles are reused
    when it runs), not for the fees, which stay right where an order row repeats (its payments come twice), has no
    payment or no key."""
    import datetime as dt
    import json
    day = dt.datetime(1998, 2, 1)
    for name, rows, ddl in [
        ("orders", [(k, 7, "P", 10.0, day) for k in (1, 2, 2, 3, None)],
         "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
        ("lineitem", [(k, n, 1, 1, 1.0, 100.0, "N", s, day) for k, n, s in ((1, 1, "F"), (1, 2, "F"), (1, 3, "O"), (2, 1, "F"), (9, 1, "F"), (None, 1, "F"))],
         "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
         "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("part", [(1, "p", "T", "b", 5.0)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_retailprice double"),
        ("customer", [(7, 3)], "c_custkey bigint, c_nationkey bigint")]:
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    df = QUERIES["raw_payload"](spark, str(tmp_path))
    scans = [x for x in plan(df, "simple").splitlines() if "FileScan" in x and "l_orderkey" in x]
    assert len(scans) == 5, scans
    got = df.collect()
    fees = sorted((str(r.id), json.loads(r.raw_json)["fees"]) for r in got if r.record_type == "order")
    assert fees == [("None", 0), ("SQ1", 6.4), ("SQ2", 6.4), ("SQ2", 6.4), ("SQ3", 0)]  # 2.9 % and 30 cents of 100.00, completed ones
    assert sum(r.record_type == "payment" for r in got) == 7


def test_latest_per_key_is_an_aggregate_not_a_window(spark, sf_small):
    for name in ["audit_latest", "latest_checkpoint", "recon_pos_net", "upsert_orders"]:
        p = plan(QUERIES[name](spark, sf_small))
        assert "Window " not in p and "max_by" in p, name


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SIDE_EFFECTS))
def test_no_python_udfs(spark, sf_small, name):
    p = plan(QUERIES[name](spark, sf_small), "extended")
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_bucketed_star_removes_order_key_shuffles(spark, sf_small):
    import uuid
    from omnitally.plans import jobs
    db = f"star_{uuid.uuid4().hex[:8]}"
    o, li = star.fact_order(spark, sf_small), star.fact_order_line(spark, sf_small)
    fo, fol = jobs.write_star_bucketed(spark, o, li, db, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = K.build_kpi_daily(spark.table(fo), spark.table(fol))
        p = plan(bucketed)
        assert "hashpartitioning(order_id" not in p and "hashpartitioning(id#" not in p
        assert "hashpartitioning(order_id" in plan(K.build_kpi_daily(o, li))
        a = sorted(map(str, K.kpi_text(bucketed).collect()))
        b = sorted(map(str, K.kpi_text(K.build_kpi_daily(o, li)).collect()))
        assert a == b
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rankings_share_one_exchange_at_runtime(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = K.build_kpi_daily(star.fact_order(spark, sf_small), star.fact_order_line(spark, sf_small))
        df.collect()  # the final AQE plan exists only after execution
        final = plan(df, "simple")
        assert "isFinalPlan=true" in final
        assert any("ReusedExchange" in ln and "sku" in ln and "product_title" in ln for ln in final.splitlines())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
