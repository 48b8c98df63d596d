"""Ingest audit: status history, checkpoints, health (S12, I7, W4, A17, A18, F8-F12,
F17, F18, T2).

"Latest row per key" uses ``max_by`` in a grouped aggregate rather than a window: the
aggregate is combined map-side, so a key holding a third of all rows is reduced in every
task before the shuffle instead of being sorted whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_history(audit: DataFrame) -> DataFrame:
    """Every audit row is written 'processing' first and updated to its result one
    second later; the history keeps both rows (append-only)."""
    proc = audit.select("id", "source", "type", F.lit("processing").alias("status"), "ts", "payload",
                        F.lit(None).cast("string").alias("error"))
    done = audit.select("id", "source", "type", "status", F.expr("timestampadd(SECOND, 1, ts)").alias("ts"),
                        "payload", "error")
    return proc.unionByName(done)


def latest_per_key(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """The newest row per key; equal times fall to the greater row."""
    packed = F.max_by(F.struct(*cols), F.struct(order, *cols))
    return df.groupBy(*keys).agg(packed.alias("_l")).select(*keys, "_l.*")


def source_health(audit: DataFrame, as_of: str) -> DataFrame:
    """Per source: last event, events and errors in the 24 h before as_of, status."""
    now = F.lit(as_of).cast("timestamp_ntz")
    past = audit.filter(F.col("ts") <= now)
    in24 = F.col("ts") >= F.expr(f"timestamp_ntz'{as_of}' - interval 24 hours")
    g = past.groupBy("source").agg(
        F.max("ts").alias("last_event_at"),
        F.count_if(in24).alias("events_24h"),
        F.count_if(in24 & (F.col("status") == "failed")).alias("errors_24h"))
    return g.withColumn("status", F.when(F.col("events_24h") == 0, F.lit("error"))
                        .when(F.col("errors_24h") > 0, F.lit("warning")).otherwise(F.lit("healthy")))
