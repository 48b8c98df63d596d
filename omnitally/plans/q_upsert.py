"""Upserts, incremental loading, resync and refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY
from omnitally.operators import kpi as K
from omnitally.operators import quality as Q
from omnitally.operators import upsert as U
from omnitally.plans import jobs
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.q_normalize import IDENTITY_SQL
from omnitally.plans.q_period import AS_OF
from omnitally.sources import landed as L
from omnitally.sources import star
from omnitally.sources.tables import read

SNAPSHOT_INGEST = "2001-06-15 12:00:00"
BATCH_INGEST = "2001-07-01 00:00:00"
_FACTS = S.with_(S.fact_order(), S.FACT_ORDER_LINE)


def _snapshot_orders(spark, sf_dir):
    o = star.fact_order(spark, sf_dir, location=False)
    return o.filter(F.to_date("created_at") <= F.lit(star.ORDER_AS_OF).cast("date"))


@register("upsert_orders", _FACTS + f"""
SELECT id,
       CASE WHEN status = 'P' AND CAST(created_at AS DATE) <= DATE '{star.ORDER_AS_OF}'
            THEN created_at + INTERVAL 30 DAY ELSE updated_at END AS updated_at,
       CASE WHEN status = 'P' AND CAST(created_at AS DATE) <= DATE '{star.ORDER_AS_OF}'
            THEN CAST(150 AS DECIMAL(14,2)) ELSE refunds_total END AS refunds_total,
       CASE WHEN status = 'P' AND CAST(created_at AS DATE) <= DATE '{star.ORDER_AS_OF}'
            THEN CAST(gross_total - 150 AS DECIMAL(14,2)) ELSE net_total END AS net_total
FROM fact_order""")
def q_upsert_orders(spark, sf_dir):
    """Warehouse snapshot at as_of + a batch of changed (refund raised) and new orders."""
    cols = ["id", "created_at", "updated_at", "gross_total", "refunds_total", "net_total", "ingest_ts"]
    cur = _snapshot_orders(spark, sf_dir).withColumn("ingest_ts", F.lit(SNAPSHOT_INGEST).cast("timestamp_ntz"))
    o = star.fact_order(spark, sf_dir, location=False).withColumn("ingest_ts", F.lit(BATCH_INGEST).cast("timestamp_ntz"))
    known = F.to_date("created_at") <= F.lit(star.ORDER_AS_OF).cast("date")
    changed = o.filter(known & (F.col("status") == "P")).select(
        "id", "created_at", F.expr("timestampadd(DAY, 30, created_at)").alias("updated_at"), "gross_total",
        F.lit(150).cast(MONEY).alias("refunds_total"), (F.col("gross_total") - 150).cast(MONEY).alias("net_total"),
        "ingest_ts")
    new = o.filter(~known).select(*cols)
    out = U.upsert(cur.select(*cols), changed.unionByName(new), "id")
    return out.select("id", "updated_at", "refunds_total", "net_total")


@register("replace_lines", _FACTS + """
SELECT CASE WHEN fo.status = 'P' THEN fol.id || '-v2' ELSE fol.id END AS id, fol.order_id,
       CASE WHEN fo.status = 'P' THEN fol.qty + 1 ELSE fol.qty END AS qty
FROM fact_order_line fol JOIN fact_order fo ON fo.id = fol.order_id""")
def q_replace_lines(spark, sf_dir):
    """All lines of every order in the batch are replaced by the batch's lines."""
    lines = star.fact_order_line(spark, sf_dir, product=False).select("id", "order_id", "qty")
    p = star.fact_order(spark, sf_dir, location=False).filter(F.col("status") == "P").select(F.col("id").alias("order_id"))
    batch = lines.join(p, "order_id", "left_semi").select(
        F.concat("id", F.lit("-v2")).alias("id"), "order_id", (F.col("qty") + 1).alias("qty"))
    return U.replace_children(lines, batch, parents=p)


@register("upsert_events", S.with_(S.FACT_EVENT) + f"""
SELECT id, CASE WHEN event_type = 'purchase' AND starts_at < TIMESTAMP '{star.EVENT_AS_OF}' THEN CAST(revenue * 2 AS DECIMAL(14,2))
                ELSE revenue END AS revenue,
       CASE WHEN event_type = 'purchase' AND starts_at < TIMESTAMP '{star.EVENT_AS_OF}' THEN starts_at + INTERVAL 1 DAY
            ELSE updated_at END AS updated_at
FROM fact_event""")
def q_upsert_events(spark, sf_dir):
    """Event snapshot + re-sent purchases (revenue corrected) + new events; full replace by id."""
    e = star.fact_event(spark, sf_dir)
    known = F.col("starts_at") < F.lit(star.EVENT_AS_OF).cast("timestamp_ntz")
    cols = ["id", "revenue", "updated_at", "ingest_ts"]
    cur = e.filter(known).withColumn("ingest_ts", F.lit(0)).select(*cols)
    resent = e.filter(known & (F.col("event_type") == "purchase")).select(
        "id", (F.col("revenue") * 2).cast(MONEY).alias("revenue"),
        F.expr("timestampadd(DAY, 1, starts_at)").alias("updated_at"), F.lit(1).alias("ingest_ts"))
    new = e.filter(~known).withColumn("ingest_ts", F.lit(1)).select(*cols)
    return U.upsert(cur, resent.unionByName(new), "id").select("id", "revenue", "updated_at")


@register("upsert_locations", S.with_(S.dim_location()) + """
SELECT id, name, channel FROM dim_location
UNION ALL
SELECT 'L' || CAST(n_nationkey AS VARCHAR), COALESCE(CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END,
       'Unnamed Location'), 'pos' FROM nation""")
def q_upsert_locations(spark, sf_dir):
    """Pos locations appended/updated by id into the location dimension."""
    cur = star.dim_location(spark, sf_dir).withColumn("updated_at", F.lit(1))
    batch = L.pos_locations(spark, sf_dir).select(
        "id", F.coalesce("name", F.lit("Unnamed Location")).alias("name"), F.lit("pos").alias("channel"),
        F.lit(2).alias("updated_at"))
    return U.upsert(cur, batch, "id", ["updated_at"]).select("id", "name", "channel")


@register("backfill_windows", """
WITH b AS (SELECT 'shop' AS source, CAST(max(o_orderdate) AS DATE) AS e FROM orders
           UNION ALL SELECT 'booking', CAST(max(ts) AS DATE) FROM events)
SELECT source, CAST(ws AS DATE) AS window_start, LEAST(CAST(ws AS DATE) + 7, e) AS window_end
FROM b, unnest(generate_series(CAST(e - 90 AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 8 DAY)) t(ws)""")
def q_backfill_windows(spark, sf_dir):
    """90-day lookback cut into 7-day windows per source (bounds from the data)."""
    o = read(spark, sf_dir, "orders", "o_orderdate").agg(F.to_date(F.max("o_orderdate")).alias("end")) \
        .select(F.lit("shop").alias("source"), "end")
    e = read(spark, sf_dir, "events", "ts").agg(F.to_date(F.max("ts")).alias("end")) \
        .select(F.lit("booking").alias("source"), "end")
    return U.backfill_windows(o.unionByName(e))


@register("resync_day", S.with_(S.kpi_ctes(dense=True)) + f"SELECT * FROM kpi WHERE date = DATE '{AS_OF}'")
def q_resync_day(spark, sf_dir):
    """I8: one day recomputed from that day's orders only (the partition a resync rewrites)."""
    o = star.fact_order(spark, sf_dir, dense=True).filter(F.to_date("created_at") == F.lit(AS_OF).cast("date"))
    li = star.fact_order_line(spark, sf_dir).join(o.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return K.kpi_text(K.build_kpi_daily(o, li))


@register("kpi_refresh", S.with_(S.kpi_ctes()) + "SELECT * FROM kpi")
def q_kpi_refresh(spark, sf_dir):
    """Rebuild into a new version directory (month-partitioned) and read it back."""
    base = jobs.new_table_dir(spark, "kpi_daily")
    _, kpi = jobs.refresh_kpi(spark, star.fact_order(spark, sf_dir), star.fact_order_line(spark, sf_dir),
                              base, f"{star.ORDER_AS_OF} 00:00:00")
    return K.kpi_text(kpi)


@register("cascade_delete", _FACTS + """
SELECT fol.id, fol.order_id FROM fact_order_line fol
WHERE fol.order_id NOT IN (SELECT id FROM fact_order WHERE status = 'F' AND year(created_at) = 1996)""")
def q_cascade_delete(spark, sf_dir):
    """Deleting orders (fulfilled in 1996) deletes their lines."""
    o = star.fact_order(spark, sf_dir, location=False).filter((F.col("status") == "F") & (F.year("created_at") == 1996))
    return U.cascade_delete(star.fact_order_line(spark, sf_dir, product=False).select("id", "order_id"), o)


_WINDOWS = """
w AS (SELECT ['shop', 'pos', 'booking'][user_id % 3 + 1] AS source,
             CASE WHEN user_id % 3 = 1 THEN 'L' || CAST(user_id % 4 AS VARCHAR) END AS location,
             ts AS s, ts + to_minutes(CAST(user_id % 50 AS INTEGER)) AS e
      FROM events WHERE event_type = 'purchase')"""


@register("backfill_gaps", f"""
WITH {_WINDOWS},
b AS (SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) AS lo, CAST(max(CAST(ts AS DATE)) + 1 AS TIMESTAMP) AS hi FROM events),
k AS (SELECT DISTINCT source, location FROM w),
p AS (SELECT source, location, s, least(e, hi) AS e FROM w, b
      UNION ALL SELECT source, location, lo, lo FROM k, b UNION ALL SELECT source, location, hi, hi FROM k, b),
r AS (SELECT source, location, s, max(e) OVER (PARTITION BY source, location ORDER BY s, e
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p)
SELECT source, location, reach AS gap_start, s AS gap_end FROM r WHERE s > reach""")
def q_backfill_gaps(spark, sf_dir):
    """Gaps between the finished windows that the checkpoints record, per source and pos location."""
    e = read(spark, sf_dir, "events", "ts", "user_id", "event_type")
    n = F.col("user_id") % 3
    done = e.filter("event_type = 'purchase'").select(
        F.element_at(F.array(*[F.lit(x) for x in star.AUDIT_SOURCES]), (n + 1).cast("int")).alias("source"),
        F.when(n == 1, F.concat(F.lit("L"), (F.col("user_id") % 4).cast("string"))).alias("location"),
        F.col("ts").alias("window_start"), F.expr("timestampadd(MINUTE, cast(user_id % 50 as int), ts)").alias("window_end"))
    range_ = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        F.to_date("lo").cast("timestamp_ntz").alias("begin"), F.date_add(F.to_date("hi"), 1).cast("timestamp_ntz").alias("finish"))
    bounds = done.select("source", "location").distinct().join(range_)  # one row of bounds
    return U.backfill_gaps(done, bounds)


@register("backfill_resume", S.with_(S.fact_order()) + """
SELECT id, channel_id AS source, location_id AS location,
       CASE WHEN location_id IS NOT NULL AND quarter(created_at) IN (1, 3) THEN 1 ELSE 2 END AS run
FROM fact_order""")
def q_backfill_resume(spark, sf_dir):
    """A load by channel and location that ended after two quarters of each year and before the
    orders without a location; the second run loads the gaps alone, the third finds none."""
    base = jobs.new_table_dir(spark, "backfill_resume")
    orders = star.fact_order(spark, sf_dir).select("id", F.col("channel_id").alias("source"), F.col("location_id").alias("location"),
                                                   "created_at", F.trunc("created_at", "month").alias("created_month"))
    ends = orders.groupBy("source", "location").agg(F.min("created_at").alias("lo"), F.max("created_at").alias("hi"))
    bounds = ends.select("source", "location", F.trunc("lo", "quarter").cast("timestamp_ntz").alias("begin"),
                         F.date_add(F.to_date("hi"), 1).cast("timestamp_ntz").alias("finish"))
    quarters = F.sequence(F.col("begin").cast("date"), F.col("finish").cast("date"), F.expr("interval 3 months"))
    windows = bounds.filter("location IS NOT NULL").select("source", "location", F.explode(quarters).alias("q")) \
        .filter(F.quarter("q").isin(1, 3)).select("source", "location", F.col("q").cast("timestamp_ntz").alias("window_start"),
                                                  F.add_months("q", 3).cast("timestamp_ntz").alias("window_end"))
    first = orders.filter(F.col("location").isNotNull() & F.quarter("created_at").isin(1, 3))
    jobs.backfill(spark, first.withColumn("run", F.lit(1)), f"{base}/orders", windows, f"{base}/audit", "2024-01-01 00:00:00",
                  partition_col="created_month", order_cols=("run",))
    for run in (2, 3):
        jobs.resume_backfill(spark, orders.withColumn("run", F.lit(run)), f"{base}/orders", bounds, f"{base}/audit",
                             f"2024-01-0{run} 00:00:00", partition_col="created_month", order_cols=("run",))
    return spark.read.parquet(f"{base}/orders").select("id", "source", "location", "run")


@register("identity_merge", IDENTITY_SQL)
def q_identity_merge(spark, sf_dir):
    """I4: the shop's identities first, then the booking system's ids merged in by hash; no id is lost."""
    shop = Q.customer_identity(L.shop_orders(spark, sf_dir, lines=False), L.bookings(spark, sf_dir).limit(0))
    guests = Q.customer_identity(L.shop_orders(spark, sf_dir, lines=False).limit(0), L.bookings(spark, sf_dir))
    return U.merge_identity(shop, guests)
