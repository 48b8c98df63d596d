"""Event feed as Structured Streaming jobs.

Deliveries arrive as files (here: the ``events`` / ``orders`` Parquet files, read as a
file stream). Each job writes through ``foreachBatch`` or a file sink into a table
under the shared checkpoint folder, with its own streaming checkpoint next to it, so a
restarted job resumes from its last committed batch and a replayed batch rewrites the
same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.functions import security as SEC
from omnitally.functions.expr import utc_instant, utc_ts, utc_wallclock
from omnitally.operators import normalize as N
from omnitally.operators.upsert import latest_version
from omnitally.session import scratch_dir
from omnitally.sources import landed as L
from omnitally.sources import star
from omnitally.sources.tables import table_path

SECRET = "local-test-secret"
POS_URL = "https://example.invalid/hooks/pos"


def _stream_path(sf_dir: str, name: str) -> str:
    # A glob over the table file: a file stream source needs a directory or a pattern.
    p = table_path(sf_dir, name)
    return p[: -len(f"{name}.parquet")] + f"{name[:-1]}[{name[-1]}].parquet"


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(_stream_path(sf_dir, name))


def run_dir(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"streams/{name}-{uuid.uuid4().hex[:8]}")


def envelopes(events: DataFrame) -> DataFrame:
    """Raw deliveries: source, topic, event id, body, signature, received_at (timestamp).

    Every 97th delivery carries a signature made with a rotated secret (must be rejected).
    """
    src = F.element_at(F.array(*[F.lit(s) for s in star.AUDIT_SOURCES]), (F.col("user_id") % 3 + 1).cast("int"))
    e = events.select(src.alias("source"), "event_type", "event_id", "user_id", "value", "props",
                      utc_instant("ts").alias("received_at"))
    e = e.withColumn("topic", star.audit_type_col())
    body = F.to_json(F.struct("event_id", "event_type", "user_id", "value", "props"))
    e = e.withColumn("body", body)
    secret = F.col("event_id") % 97 == 0

    def sig(sec):
        return F.when(F.col("source") == "shop", SEC.hmac_sha256_b64(F.col("body"), sec)) \
            .when(F.col("source") == "pos", SEC.hmac_sha256_b64(F.concat(F.lit(POS_URL), F.col("body")), sec)) \
            .otherwise(SEC.hmac_sha256_hex(F.col("body"), sec))
    return e.withColumn("signature", F.when(secret, sig("rotated-secret")).otherwise(sig(SECRET))) \
        .select("source", "topic", F.col("event_id").cast("string").alias("event_id"), "body", "signature",
                "received_at")


def verified(env: DataFrame) -> DataFrame:
    """F1 inside the stream: a per-source signature check column."""
    ok = F.when(F.col("source") == "shop", SEC.verify_signature(F.col("body"), F.col("signature"), SECRET)) \
        .when(F.col("source") == "pos", SEC.verify_signature(F.col("body"), F.col("signature"), SECRET,
                                                            prefix=F.lit(POS_URL))) \
        .otherwise(SEC.verify_signature(F.col("body"), F.col("signature"), SECRET, encoding="hex"))
    return env.withColumn("verified", ok)


KNOWN_TOPICS = ["webhook_orders_create", "webhook_orders_updated", "backfill_checkpoint", "mv_refresh"]


def audit_rows(batch: DataFrame) -> DataFrame:
    """One 'processing' row per delivery and one result row: success for routed
    topics, 'failed' when the signature is wrong, 'warning' for topics nobody handles."""
    status = F.when(~F.col("verified"), F.lit("failed")) \
        .when(F.col("topic").isin(KNOWN_TOPICS), F.lit("success")).otherwise(F.lit("warning"))
    base = batch.select(F.col("event_id").alias("id"), "source", F.concat(F.lit("webhook_"), F.col("topic")).alias("type"),
                        "received_at", F.get_json_object("body", "$.props").alias("payload"), status.alias("result"))
    proc = base.select("id", "source", "type", F.lit("processing").alias("status"),
                       utc_wallclock("received_at").alias("ts"), "payload")
    done = base.select("id", "source", "type", F.col("result").alias("status"),
                       utc_wallclock(F.timestamp_add("SECOND", F.lit(1), F.col("received_at"))).alias("ts"),
                       "payload")
    return proc.unionByName(done)


def run_ingest(spark: SparkSession, sf_dir: str) -> str:
    """Verify -> parse -> audit 'processing' -> route -> audit result, per micro-batch."""
    out = run_dir(spark, "ingest")
    env = verified(envelopes(read_stream(spark, sf_dir, "events")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = audit_rows(batch).withColumn("batch_id", F.lit(batch_id))
        # Replays of the same batch overwrite the same partition (idempotent sink).
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(f"{out}/audit")

    q = env.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/_checkpoint") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return f"{out}/audit"


def run_upsert_orders(spark: SparkSession, sf_dir: str) -> str:
    """Order events -> normalise (P4) -> upsert by id into the order table.

    Each micro-batch is merged on write: only the created-date partitions the batch
    touches are read, merged (newest batch wins) and overwritten. A replayed batch merges
    the same rows again and leaves the table unchanged.
    """
    from omnitally.plans import jobs
    out = run_dir(spark, "orders")
    table = f"{out}/orders"
    orders = read_stream(spark, sf_dir, "orders")
    lines = L._lines(spark, sf_dir)  # static side of a stream-static join

    def handle(batch: DataFrame, batch_id: int) -> None:
        li = lines.join(batch.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        raw = L.shop_events_from(batch, li)
        dates = N.first_page(raw).select(F.concat(F.lit("shop_order_"), F.col("id").cast("string")).alias("id"),
                                         F.to_date(utc_ts("created_at")).alias("created_date"))
        rows = N.shop_events(raw).join(dates, "id").withColumn("updated_at", F.lit(batch_id).cast("bigint"))
        if jobs.has_data(spark, table):
            jobs.upsert_partitions(spark, table, rows, "id", "created_date", ["updated_at"])
        else:  # first batch creates the table (a replay of it rewrites the same content)
            jobs.write_partitioned(rows, table, "created_date", dynamic=False)

    q = orders.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/_checkpoint") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return table


def current_orders(spark: SparkSession, table: str) -> DataFrame:
    """The upserted order table (one row per id)."""
    return spark.read.parquet(table).drop("updated_at")


DEDUPE_BUCKETS = 16


def new_deliveries(spark: SparkSession, batch: DataFrame, table: str, batch_id: int, buckets: int = DEDUPE_BUCKETS) -> DataFrame:
    """One delivery per id of ``batch`` that no earlier batch stored, with its bucket.

    Stored ids lie in hash buckets: only the partitions of the batch's own buckets are read.
    """
    from omnitally.plans import jobs
    from omnitally.plans.snapshots import bucket_of
    fresh = batch.dropDuplicates(["event_id"]).withColumn("bucket", bucket_of("event_id", buckets))
    if not jobs.has_data(spark, table):
        return fresh
    mine = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    known = spark.read.parquet(table).filter(F.col("bucket").isin(mine) & (F.col("batch_id") < batch_id)) \
        .select(F.col("bucket").alias("b"), F.col("event_id").alias("known"))
    return fresh.join(known, (fresh.bucket == known.b) & fresh.event_id.eqNullSafe(known.known), "left_anti")


def run_dedupe(spark: SparkSession, sf_dir: str) -> str:
    """Duplicate deliveries dropped by event id, however late they come.

    Each micro-batch keeps one delivery per id and only ids that no earlier batch stored,
    whatever the time of the repeat. There is no state and no watermark. A replayed batch
    ignores and rewrites its own rows.
    """
    out = run_dir(spark, "dedupe")
    table = f"{out}/events"
    a = read_stream(spark, sf_dir, "events")
    doubled = a.unionByName(read_stream(spark, sf_dir, "events")).withColumn("ts", utc_instant("ts"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        new_deliveries(spark, batch, table, batch_id).withColumn("batch_id", F.lit(batch_id).cast("bigint")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(table)

    q = doubled.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/_checkpoint") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return table


def run_daily_totals(spark: SparkSession, sf_dir: str) -> str:
    """Live daily totals per channel: tumbling 1-day windows, in update mode. The state is
    one row per day and channel, so it needs no watermark and late rows always count."""
    out = run_dir(spark, "daily")
    env = envelopes(read_stream(spark, sf_dir, "events"))
    parsed = env.select("source", "received_at",
                        F.get_json_object("body", "$.value").cast("decimal(14,2)").alias("value"),
                        F.get_json_object("body", "$.user_id").alias("user_id"))
    agg = parsed.groupBy(F.window("received_at", "1 day"), "source").agg(
        F.count(F.lit(1)).alias("deliveries"), F.sum("value").cast("decimal(18,2)").alias("revenue"),
        F.approx_count_distinct("user_id").alias("approx_users"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.select(utc_wallclock("window.start").alias("day"), "source", "deliveries", "revenue",
                     "approx_users", F.lit(batch_id).alias("batch_id")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id") \
            .parquet(f"{out}/totals")

    q = agg.writeStream.outputMode("update").foreachBatch(handle) \
        .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return f"{out}/totals"


def daily_totals(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.parquet(path)
    return latest_version(t, ["day", "source"], ["batch_id"]).drop("batch_id")


def run_topic_counts(spark: SparkSession, sf_dir: str) -> str:
    """T2 as a stream: deliveries per (source, topic). The state holds one row per source
    and topic, so it stays small without a watermark; each micro-batch's updated counts are
    written under its batch id (update mode)."""
    out = run_dir(spark, "topics")
    env = envelopes(read_stream(spark, sf_dir, "events"))
    agg = env.groupBy("source", "topic").agg(F.count(F.lit(1)).alias("n"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/counts")

    q = agg.writeStream.outputMode("update").foreachBatch(handle) \
        .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return f"{out}/counts"


def topic_counts(spark: SparkSession, path: str) -> DataFrame:
    return latest_version(spark.read.parquet(path), ["source", "topic"], ["batch_id"]).drop("batch_id")
