"""Source against stored warehouse, and the resync of what differs.

The warehouse holds what was known at as_of; the sources know more. A fourth source (``dtc``) has no landed files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY
from omnitally.operators import normalize as N
from omnitally.operators import quality as Q
from omnitally.plans import jobs, recon
from omnitally.plans import sql as S
from omnitally.plans.catalog import register
from omnitally.plans.q_normalize import _pos, EVENTS_SQL, M, PAY_CTE, POS_ORDERS_SQL, SHOP_ORDERS_SQL
from omnitally.sources import landed as L
from omnitally.sources import star
from omnitally.sources.tables import table_path

RAN_AT = "2024-02-01 06:00:00"
_RUNS: dict[tuple, dict[str, str]] = {}

RECON_SQL = S.with_(PAY_CTE) + f"""
, src AS (
  SELECT 'shop' AS source, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n,
         SUM(CAST(o_totalprice AS DECIMAL(14,2)) - CASE WHEN o_orderstatus = 'P' THEN 100 ELSE 0 END) AS rev
  FROM orders GROUP BY 1, 2
  UNION ALL
  SELECT 'pos', CAST(p.o_orderdate AS DATE), COUNT(*), SUM({M('p.total_cents')} - {M('COALESCE(po.refunded_cents, 0)')})
  FROM pos_o p LEFT JOIN per_order po ON p.id = po.order_id GROUP BY 1, 2
  UNION ALL
  SELECT 'booking', CAST(ts AS DATE), COUNT(*),
         SUM(CAST(value AS DECIMAL(14,2)) + CASE WHEN event_type = 'click' THEN 0 ELSE user_id % 20 END)
  FROM events GROUP BY 1, 2),
wh AS (
  SELECT 'shop' AS source, CAST(created_at AS DATE) AS date, COUNT(*) AS n, SUM(net_total) AS rev
  FROM ({SHOP_ORDERS_SQL}) WHERE CAST(created_at AS DATE) <= DATE '{star.ORDER_AS_OF}' GROUP BY 1, 2
  UNION ALL
  SELECT 'pos', CAST(created_at AS DATE), COUNT(*), SUM(net_total) FROM ({POS_ORDERS_SQL})
  WHERE CAST(created_at AS DATE) <= DATE '{star.ORDER_AS_OF}' GROUP BY 1, 2
  UNION ALL
  SELECT 'booking', CAST(starts_at AS DATE), COUNT(*), SUM(revenue + add_on_sales) FROM ({EVENTS_SQL})
  WHERE CAST(starts_at AS DATE) <= DATE '{star.EVENT_AS_OF}' GROUP BY 1, 2),
r AS (
  SELECT COALESCE(s.source, w.source) AS source, COALESCE(s.date, w.date) AS date,
         CAST(COALESCE(s.n, 0) AS BIGINT) AS source_count, CAST(COALESCE(w.n, 0) AS BIGINT) AS warehouse_count,
         CAST(COALESCE(s.rev, 0) AS DECIMAL(18,2)) AS source_revenue, CAST(COALESCE(w.rev, 0) AS DECIMAL(18,2)) AS warehouse_revenue
  FROM src s FULL OUTER JOIN wh w ON s.source = w.source AND s.date = w.date)
"""
RECON_SELECT = """
SELECT source, date, source_count, warehouse_count, source_revenue, warehouse_revenue,
       warehouse_count - source_count AS count_diff, CAST(warehouse_revenue - source_revenue AS DECIMAL(18,2)) AS revenue_diff,
       CASE WHEN warehouse_count - source_count = 0 AND abs(warehouse_revenue - source_revenue) < 1 THEN 'match'
            ELSE 'mismatch' END AS status
FROM r
UNION ALL SELECT 'dtc', NULL, 0, 0, CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), 0, CAST(0 AS DECIMAL(18,2)), 'error'"""




def sources(spark, sf_dir):
    """Every source's rows as the vendors give them now."""
    def rows(df, source, date, revenue):
        return df.select("id", F.lit(source).alias("source"), date.alias("date"), revenue.cast(MONEY).alias("revenue"))

    def shop():
        o = N.shop_orders(L.shop_orders(spark, sf_dir, lines=False))
        return rows(o, "shop", F.to_date("created_at"), F.col("net_total"))

    def pos():
        o, _, per = _pos(spark, sf_dir, location=False)
        return rows(N.pos_orders(o, per), "pos", F.to_date("created_at"), F.col("net_total"))

    def booking():
        e = N.booking_events(L.bookings(spark, sf_dir))
        return rows(e, "booking", F.to_date("starts_at"), F.col("revenue") + F.col("add_on_sales"))

    def dtc():  # nothing has landed: reading it fails
        o = N.shop_orders(L.read_landed(spark, table_path(sf_dir, "dtc_orders") + "/missing", "shop_order"))
        return rows(o, "dtc", F.to_date("created_at"), F.col("net_total"))

    return {"shop": shop, "pos": pos, "booking": booking, "dtc": dtc}


def _known(df):
    limit = F.when(F.col("source") == "booking", F.lit(star.EVENT_AS_OF)).otherwise(F.lit(star.ORDER_AS_OF)).cast("date")
    return df.filter(F.col("date") <= limit)


def run(spark, sf_dir, resync=True):
    """Load the warehouse as of as_of and reconcile it; with ``resync`` also mend the days that differ and
    reconcile again. Once per session and input state; returns the folders."""
    state = tuple(jobs.table_state(spark, table_path(sf_dir, t)) for t in ("orders", "lineitem", "events"))
    key = (spark.sparkContext.applicationId, sf_dir, state)
    paths = _RUNS.get(key)
    every = sources(spark, sf_dir)
    if paths is None:
        base = jobs.new_table_dir(spark, "reconcile")
        paths = {n: f"{base}/{n}" for n in ("facts", "first", "second", "totals", "audit")}
        readable = [every[n]() for n in ("shop", "pos", "booking")]
        recon.store_facts(_known(readable[0].unionByName(readable[1]).unionByName(readable[2])), paths["facts"])
        recon.reconcile(spark, every, paths["facts"], paths["first"])
        _RUNS[key] = paths
    if resync and not jobs.path_exists(spark, paths["second"]):
        first = spark.read.parquet(paths["first"])
        lost = spark.createDataFrame([("dtc", star.EVENT_AS_OF)], "source string, date string").withColumn("date", F.to_date("date"))
        actions = Q.mismatch_actions(first).select("source", "date").unionByName(lost)
        recon.resync(spark, every, actions, paths["facts"], paths["totals"], paths["audit"], RAN_AT, 1)
        recon.reconcile(spark, every, paths["facts"], paths["second"])
    return paths


def first_run(spark, sf_dir):
    return spark.read.parquet(run(spark, sf_dir, resync=False)["first"])


@register("reconcile", RECON_SQL + RECON_SELECT)
def q_reconcile(spark, sf_dir):
    """A13 + J11 + U4: source vs stored warehouse, count and revenue per source and day; an unreadable source is an error."""
    return first_run(spark, sf_dir)


@register("reconcile_summary", RECON_SQL + f"""
, x AS ({RECON_SELECT})
SELECT CAST(COUNT(*) FILTER (WHERE status = 'match') AS BIGINT) AS matches,
       CAST(COUNT(*) FILTER (WHERE status = 'mismatch') AS BIGINT) AS mismatches,
       CAST(COUNT(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'error') > 0 THEN 2
            WHEN COUNT(*) FILTER (WHERE status = 'mismatch') > 0 THEN 1 ELSE 0 END AS exit_level
FROM x""")
def q_reconcile_summary(spark, sf_dir):
    """Counts of match / mismatch / error and the overall exit level 0/1/2."""
    return Q.reconcile_summary(first_run(spark, sf_dir))


@register("mismatch_actions", RECON_SQL + f"""
, x AS ({RECON_SELECT})
SELECT source, date, count_diff, 'resync' AS action FROM x WHERE status = 'mismatch' AND count_diff <> 0""")
def q_mismatch_actions(spark, sf_dir):
    """sources/days to re-pull: status mismatch with a count difference."""
    return Q.mismatch_actions(first_run(spark, sf_dir))


@register("reconcile_after_resync", RECON_SQL + f"""
, x AS ({RECON_SELECT})
SELECT source, date, source_count, source_count AS warehouse_count, source_revenue, source_revenue AS warehouse_revenue,
       CASE WHEN status = 'error' THEN 'error' ELSE 'match' END AS status FROM x""")
def q_reconcile_after_resync(spark, sf_dir):
    """I8 + I9: the days of the actions pulled again, upserted and compared: all sources that can be read match."""
    return spark.read.parquet(run(spark, sf_dir)["second"]).drop("count_diff", "revenue_diff")


@register("resync_audit", RECON_SQL + f"""
, x AS ({RECON_SELECT}),
a AS (SELECT source FROM x WHERE status = 'mismatch' AND count_diff <> 0 UNION ALL SELECT 'dtc')
SELECT source, status, COUNT(*) AS days, CAST(COUNT(*) FILTER (WHERE status = 'failed') AS BIGINT) AS with_error
FROM (SELECT source, 'processing' AS status FROM a
      UNION ALL SELECT source, CASE WHEN source = 'dtc' THEN 'failed' ELSE 'success' END FROM a) GROUP BY 1, 2""")
def q_resync_audit(spark, sf_dir):
    """I8: what the resync recorded: every day processing, then success, or failed with the source's error."""
    audit = spark.read.parquet(run(spark, sf_dir)["audit"])
    return audit.groupBy("source", "status").agg(F.count(F.lit(1)).alias("days"), F.count("error").alias("with_error"))


@register("resync_totals", S.with_(PAY_CTE) + f"""
, f AS (SELECT 'shop' AS source, CAST(created_at AS DATE) AS date, net_total AS v FROM ({SHOP_ORDERS_SQL})
        UNION ALL SELECT 'pos', CAST(created_at AS DATE), net_total FROM ({POS_ORDERS_SQL})
        UNION ALL SELECT 'booking', CAST(starts_at AS DATE), revenue + add_on_sales FROM ({EVENTS_SQL})),
m AS (SELECT date_trunc('month', date) AS m FROM f WHERE date > CASE WHEN source = 'booking' THEN DATE '{star.EVENT_AS_OF}'
                                                                    ELSE DATE '{star.ORDER_AS_OF}' END
      UNION SELECT date_trunc('month', DATE '{star.EVENT_AS_OF}'))
SELECT source, date, CAST(SUM(v) AS DECIMAL(18,2)) AS sales, COUNT(*) AS txns
FROM f WHERE date_trunc('month', date) IN (SELECT m FROM m) GROUP BY 1, 2""")
def q_resync_totals(spark, sf_dir):
    """I8: daily totals of the months that the resync touched, recomputed from the stored facts."""
    return spark.read.parquet(run(spark, sf_dir)["totals"]).select(
        "source", "date", F.col("sales").cast("decimal(18,2)").alias("sales"), "txns")
