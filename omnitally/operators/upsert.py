"""Set-based upserts and incremental loading.

Plain Parquet has no MERGE, so an upsert is: union the current rows of the touched
partitions with the batch, keep the newest version per key, and overwrite only those
partitions (dynamic partition overwrite, see plans/jobs.py). "Newest per key" is a
grouped maximum so hot keys are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_version(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Newest row per key, ordered by ``order_cols`` (e.g. updated_at, ingest_ts)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns if c not in keys]
    order = [c for c in dict.fromkeys(order_cols) if c not in keys]
    # The whole row is the last tie-breaker, so equal order values still pick one
    # deterministic version (the same on every retry). The maximum is the row itself, its order
    # columns first, so a shuffle carries each row once.
    row = F.struct(*order, *[c for c in cols if c not in order])
    return df.groupBy(*keys).agg(F.max(row).alias("_v")).select(*keys, *[F.col("_v")[c].alias(c) for c in cols])


def upsert(current: DataFrame, batch: DataFrame, key: str | list[str],
           order_cols: list[str] = ("updated_at", "ingest_ts")) -> DataFrame:
    """Insert or replace every column by key; the newest version wins.

    Both sides carry ``ingest_ts`` so a re-delivered identical version resolves
    deterministically (idempotent on retry).
    """
    both = current.unionByName(batch, allowMissingColumns=True)
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in both.columns if c not in keys]
    order = [c for c in dict.fromkeys(order_cols) if c not in keys]
    # The version of latest_version, the whole row being the last tie-breaker here too.
    version = F.struct(*order, *[c for c in cols if c not in order])
    return both.groupBy(*keys).agg(F.max_by(F.struct(*cols), version).alias("_v")).select(*keys, "_v.*")


def replace_children(current: DataFrame, batch: DataFrame, parent_key: str = "order_id",
                     parents: DataFrame | None = None) -> DataFrame:
    """Delete all children of every parent of the batch, insert the batch's.

    A left anti join against the parents' keys (never a driver-side id list). ``parents``, the headers
    of the batch, spare a pass over its children and cover a parent whose children are all gone;
    without them the parents are those that the batch's children name.
    """
    keys = (batch if parents is None else parents).select(parent_key)
    return current.join(keys.distinct() if parents is None else keys, parent_key, "left_anti").unionByName(batch)


def cascade_delete(children: DataFrame, deleted_parents: DataFrame, parent_key: str = "order_id",
                   deleted_key: str = "id") -> DataFrame:
    """Deleting an order deletes its lines."""
    d = deleted_parents.select(F.col(deleted_key).alias(parent_key))
    return children.join(d, parent_key, "left_anti")


def merge_identity(current: DataFrame, updates: DataFrame, key: str = "customer_hash",
                   columns: tuple[str, ...] = ("shop_customer_id", "pos_customer_id", "booking_guest_id")) -> DataFrame:
    """I4: set this channel's id, keep the others (full outer join + coalesce(new, old))."""
    c = current.alias("c")
    u = updates.alias("u")
    j = c.join(u, F.col(f"c.{key}") == F.col(f"u.{key}"), "full_outer")
    return j.select(F.coalesce(f"u.{key}", f"c.{key}").alias(key),
                    *[F.coalesce(f"u.{x}", f"c.{x}").alias(x) for x in columns])


# Backfill looks back 90 days in 7-day windows.
LOOKBACK_DAYS = 90
WINDOW_DAYS = 7


def backfill_windows(bounds: DataFrame, lookback_days: int = LOOKBACK_DAYS, window_days: int = WINDOW_DAYS) -> DataFrame:
    """[end - lookback, end] cut into windows of ``window_days`` inclusive days; the
    next window starts the day after the previous end. ``bounds`` has columns source, end."""
    step = window_days + 1
    w = bounds.select("source", F.explode(F.sequence(F.date_sub("end", lookback_days), F.col("end"),
                                                     F.expr(f"interval {step} days"))).alias("window_start"), "end")
    return w.select("source", "window_start",
                    F.least(F.date_add("window_start", window_days), F.col("end")).alias("window_end"))


def backfill_gaps(finished: DataFrame, bounds: DataFrame) -> DataFrame:
    """What a restart still has to load, per source and location.

    ``finished`` (source, location, window_start, window_end) are loaded half-open windows in any
    order, repeated or overlapping; ``bounds`` (source, location, begin, finish) is the whole
    range. Gaps and islands: behind every window's start lies a gap when no earlier window
    reaches it. The range's own ends take part as empty windows. A location may be null.
    """
    keys = ["source", "location"]
    ends = bounds.select(*keys, F.explode(F.array("begin", "finish")).alias("window_start")) \
        .withColumn("window_end", F.col("window_start"))
    w = Window.partitionBy(*keys).orderBy("window_start", "window_end")
    reach = F.max("window_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    both = finished.select(*keys, "window_start", "window_end").unionByName(ends)
    inside = both.join(bounds.select(*[F.col(k).alias(f"b_{k}") for k in keys], "begin", "finish"),
                       F.col("source").eqNullSafe(F.col("b_source")) & F.col("location").eqNullSafe(F.col("b_location")))
    inside = inside.select(*keys, F.greatest("window_start", "begin").alias("window_start"),
                           F.least("window_end", "finish").alias("window_end")).filter("window_start <= window_end")
    return inside.withColumn("reach", reach).filter(F.col("window_start") > F.col("reach")) \
        .select(*keys, F.col("reach").alias("gap_start"), F.col("window_start").alias("gap_end"))
