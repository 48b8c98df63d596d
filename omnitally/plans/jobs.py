"""Batch jobs that write tables: KPI build/refresh (S10, S11), fact upserts (I1-I3),
day resync (I8), audit append (S12).

Writes never overwrite a path that the same plan reads: results are either written to a
new version directory, or cut from their lineage with ``checkpoint()`` (files under the
shared ``spark.checkpoint.dir``) before a dynamic partition overwrite.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.operators import kpi as K
from omnitally.operators import period as P
from omnitally.operators import rank as R
from omnitally.operators import upsert as U
from omnitally.session import ensure_checkpoint_dir, scratch_dir

AUDIT_COLUMNS = ["id", "source", "type", "status", "ts", "payload", "error"]


def clustered(df: DataFrame, partition_col: str) -> DataFrame:
    """Cluster rows by the output partition column before a partitioned write.

    The ``rebalance`` hint shuffles by the column and lets AQE split oversized (skewed)
    partitions and merge small ones, so each output partition gets few, reasonably sized
    files instead of one file per task per partition.
    """
    return df.hint("rebalance", partition_col)


def write_partitioned(df: DataFrame, path: str, partition_col: str, dynamic: bool) -> None:
    mode = "dynamic" if dynamic else "static"
    clustered(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", mode) \
        .partitionBy(partition_col).parquet(path)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver's next collection finds them unused."""
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def at_once(spark: SparkSession, steps: list[Callable[[], Any]], most: int = 6) -> list[Any]:
    """Run independent jobs, ``most`` at a time, and return their results; the first error is raised when all have ended."""
    with ThreadPoolExecutor(most) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]


def with_month(kpi: DataFrame) -> DataFrame:
    return kpi.withColumn("month", F.trunc("date", "month"))


def write_kpi(kpi: DataFrame, path: str) -> str:
    """Full build, partitioned by month.

    The KPI table is an aggregate bounded by date x channel x location (small even for a
    100 TB input), so one partition per day would mean thousands of tiny files; months
    keep files reasonably sized while period filters (``period.in_period``) still prune to
    the months in range, and a day resync rewrites only its month.
    """
    write_partitioned(with_month(kpi), path, "month", dynamic=False)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table holds data: any entry that is not a marker or temporary one.

    Committers that write no ``_SUCCESS`` marker are told apart from an empty target too.
    """
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def table_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and modification time of a table, in two calls to its store.

    Writers that add, remove or replace files change the folder's time, its bytes or its files.
    """
    fs, p = _fs(spark, path)
    summary = fs.getContentSummary(p)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(p).getModificationTime()


def publish_version(spark: SparkSession, base: str, version: str) -> None:
    """Point readers at a finished version: a temporary file is renamed over ``_CURRENT`` in
    one step, so readers always find the old pointer or the new one."""
    fs, ptr = _fs(spark, f"{base.rstrip('/')}/_CURRENT")
    _, tmp = _fs(spark, f"{base.rstrip('/')}/_CURRENT.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode("utf-8")))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(ptr.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(tmp, ptr, options)


def current_version(spark: SparkSession, base: str) -> str:
    fs, ptr = _fs(spark, f"{base.rstrip('/')}/_CURRENT")
    stream = fs.open(ptr)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def read_current_kpi(spark: SparkSession, base: str) -> DataFrame:
    """What dashboards read: the last published KPI version."""
    return spark.read.parquet(current_version(spark, base))


def refresh_kpi(spark: SparkSession, orders: DataFrame, lines: DataFrame, base: str, as_of: str) -> tuple[str, DataFrame]:
    """Recompute into a fresh version directory, then publish it; readers of the
    previous version are never blocked and never see a partial table. An audit row records
    success or failure."""
    version = f"{base.rstrip('/')}/v={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    try:
        write_kpi(K.build_kpi_daily(orders, lines), version)
        publish_version(spark, base, version)
        status, err = "success", None
    except Exception as e:  # noqa: BLE001 - recorded, then re-raised
        status, err = "failed", str(e)
        append_audit(spark, f"{base.rstrip('/')}/_audit", "warehouse", "mv_refresh", status, as_of, error=err)
        raise
    append_audit(spark, f"{base.rstrip('/')}/_audit", "warehouse", "mv_refresh", status, as_of,
                 payload=f'{{"path": "{version}"}}')
    return version, spark.read.parquet(version)


def append_audit(spark: SparkSession, path: str, source: str, type_: str, status: str, ts: str,
                 payload: str | None = None, error: str | None = None) -> None:
    """Audit rows are appended; the current status is the newest row per id."""
    row = [(uuid.uuid4().hex, source, type_, status, ts, payload, error)]
    df = spark.createDataFrame(row, "id string, source string, type string, status string, ts string, "
                                    "payload string, error string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.mode("append").parquet(path)


def upsert_partitions(spark: SparkSession, target: str, batch: DataFrame, key: str, partition_col: str,
                      order_cols: list[str]) -> None:
    """Upsert a batch into a Parquet table partitioned by ``partition_col``.

    Read and rewritten are the partitions of the batch and those that hold its keys now (a
    semi join over the key column alone), so a row whose partition value changes leaves its
    old place. The merged result is checkpointed first so the overwrite never reads the
    files it replaces. A partition that all its rows left is deleted last; a job that ends
    before that is put right by running it again. A null partition value is a partition
    like any other.
    """
    ensure_checkpoint_dir(spark)
    table = spark.read.parquet(target)
    held = table.join(batch.select(key).distinct(), key, "left_semi").select(F.col(partition_col).alias("_p"))
    touched = batch.select(F.col(partition_col).alias("_p")).union(held).distinct().checkpoint(eager=True)
    # Partition values are few, so the table is not dealt out by them, which would put a partition into one task.
    current = table.join(F.broadcast(touched), F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi")
    merged = U.upsert(current, batch, key, order_cols).checkpoint(eager=True)
    left = touched.join(merged.select(partition_col).distinct(), F.col(partition_col).eqNullSafe(F.col("_p")), "left_anti")
    folder = F.regexp_replace(F.input_file_name(), "/[^/]*$", "")
    # At most one row per emptied partition.
    emptied = table.withColumn("_folder", folder).join(F.broadcast(left), F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi") \
        .select("_folder").distinct().collect()
    write_partitioned(merged, target, partition_col, dynamic=True)
    for row in emptied:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(row._folder))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def resync_day(spark: SparkSession, orders: DataFrame, lines: DataFrame, kpi_path: str, day: str) -> DataFrame:
    """I8: recompute one day idempotently and rewrite only its month partition.

    The day filter on ``created_at`` reaches the order scan, and lines are restricted to
    that day's orders with a semi join, so the heavy work is proportional to one day. The
    day's new cells replace its old ones inside the (small) month partition; the merged
    month is checkpointed before the dynamic overwrite, so it never reads the files it
    replaces.
    """
    ensure_checkpoint_dir(spark)
    d = F.lit(day).cast("date")
    o = orders.filter(F.to_date("created_at") == d)
    li = lines.join(o.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    cells = with_month(K.build_kpi_daily(o, li))
    month_rows = spark.read.parquet(kpi_path).filter((F.col("month") == F.trunc(d, "month")) & (F.col("date") != d))
    merged = month_rows.unionByName(cells).checkpoint(eager=True)
    write_partitioned(merged, kpi_path, "month", dynamic=True)
    return cells.drop("month")


def new_table_dir(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"tables/{name}-{uuid.uuid4().hex[:8]}")


def report_sections(spark: SparkSession, kpi: DataFrame, orders: DataFrame, lines: DataFrame, channels: DataFrame,
                    period: str, as_of: str) -> dict[str, DataFrame]:
    """The report dataset (metadata + summary + trends + channels + products +
    categories) as lazy DataFrames over the KPI table; each section is a separate job."""
    n = P.REPORT_PERIODS[period]
    ref = dt.date.fromisoformat(as_of)
    start = ref - dt.timedelta(days=n)
    comp_start, comp_end = start - dt.timedelta(days=n + 1), start - dt.timedelta(days=1)
    # Four sections read the same date slice: keep it once (recomputed from lineage if an
    # executor is lost).
    cur = P.in_period(kpi, str(start), as_of).persist()
    summary = P.period_growth(kpi, str(start), as_of, str(comp_start), str(comp_end))
    meta = spark.range(1).select(F.lit(period).alias("period"), F.lit(str(start)).cast("date").alias("start_date"),
                                 F.lit(as_of).cast("date").alias("end_date"),
                                 F.lit(str(comp_start)).cast("date").alias("comp_start_date"),
                                 F.lit(str(comp_end)).cast("date").alias("comp_end_date"))
    return {
        "metadata": meta,
        "summary": summary,
        "trends": R.daily_trend(cur).orderBy("date"),
        "channels": R.channel_performance(cur, channels),
        "products": R.top_items_from_kpi(cur, 10),
        "categories": R.top_categories_from_kpi(cur, 5),
    }


def write_report(sections: dict[str, DataFrame], path: str, fmt: str = "json") -> dict[str, str]:
    """Write every report section (single small file each: sections are top-k or
    per-day rows, never raw facts)."""
    out = {}
    for name, df in sections.items():
        p = f"{path.rstrip('/')}/{name}"
        df.coalesce(1).write.mode("overwrite").format(fmt).save(p)
        out[name] = p
    return out


def _load(spark: SparkSession, batch: DataFrame, target: str, key: str, partition_col: str, order_cols: tuple[str, ...]) -> None:
    if has_data(spark, target):
        upsert_partitions(spark, target, batch, key, partition_col, list(order_cols))
    else:
        write_partitioned(batch, target, partition_col, dynamic=False)


def _checkpoint_rows(windows: DataFrame, ran_at: str) -> DataFrame:
    """One ``backfill_checkpoint`` audit row per window (source, location if any, window_start, window_end)."""
    location = F.col("location") if "location" in windows.columns else F.lit(None).cast("string")
    start, end = F.col("window_start").cast("string"), F.col("window_end").cast("string")
    return windows.select(
        F.sha2(F.concat_ws("|", "source", location, start, F.lit(ran_at)), 256).alias("id"),
        "source", F.lit("backfill_checkpoint").alias("type"), F.lit("success").alias("status"),
        F.lit(ran_at).cast("timestamp_ntz").alias("ts"),
        F.to_json(F.struct(location.alias("location"), start.alias("start"), end.alias("end"))).alias("payload"),
        F.lit(None).cast("string").alias("error"))


def finished_windows(audit: DataFrame) -> DataFrame:
    """The half-open windows (source, location, window_start, window_end) that the checkpoints record.

    An end given as a date is the last day loaded, so its window ends with the next day.
    """
    done = audit.filter((F.col("type") == "backfill_checkpoint") & (F.col("status") == "success")) \
        .select("source", F.from_json("payload", "location string, start string, end string").alias("w"))
    end = F.to_timestamp_ntz("w.end")
    return done.select("source", "w.location", F.to_timestamp_ntz("w.start").alias("window_start"),
                       F.when(F.length("w.end") == 10, F.timestamp_add("DAY", F.lit(1), end)).otherwise(end).alias("window_end")) \
        .filter("window_start < window_end")


def backfill(spark: SparkSession, batch: DataFrame, target: str, windows: DataFrame, audit_path: str,
             ran_at: str, key: str = "id", partition_col: str = "created_date",
             order_cols: tuple[str, ...] = ("updated_at",)) -> None:
    """I6 + I7: load a whole lookback range in one set-based job and record progress.

    ``batch`` holds the normalised rows of every window (one filter on the source, not a
    driver loop per window); they are upserted into the touched partitions, then one
    ``backfill_checkpoint`` audit row per window is appended (``windows``: source,
    window_start, window_end, and a location if the source is loaded by location). Re-running
    is idempotent for the data; ``resume_backfill`` loads what the checkpoints leave out.
    """
    _load(spark, batch, target, key, partition_col, order_cols)
    _checkpoint_rows(windows, ran_at).write.mode("append").parquet(audit_path)


def resume_backfill(spark: SparkSession, rows: DataFrame, target: str, bounds: DataFrame, audit_path: str, ran_at: str,
                    time_col: str = "created_at", key: str = "id", partition_col: str = "created_date",
                    order_cols: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """Load only the gaps that the checkpoints leave in ``bounds``, and record them.

    ``rows`` (with source, location and ``time_col``) are the sources; ``bounds`` (source, location, begin,
    finish) is the range wanted. The gaps, a few rows per location, are fixed before anything is
    written; rows inside them are found by a semi join. Data is written before the checkpoints, so
    a job that ends in between loads the same gaps again, to the same result. Returns the gaps; without any,
    nothing is read or written.
    """
    ensure_checkpoint_dir(spark)
    if has_data(spark, audit_path):
        done = finished_windows(spark.read.parquet(audit_path))
    else:
        done = bounds.select("source", "location", F.col("begin").alias("window_start"), F.col("begin").alias("window_end")).limit(0)
    gaps = U.backfill_gaps(done, bounds).checkpoint(eager=True)
    if gaps.isEmpty():
        return gaps
    g = gaps.select(F.col("source").alias("_source"), F.col("location").alias("_location"), "gap_start", "gap_end")
    batch = rows.join(g, F.col("source").eqNullSafe(F.col("_source")) & F.col("location").eqNullSafe(F.col("_location"))
                      & (F.col(time_col) >= F.col("gap_start")) & (F.col(time_col) < F.col("gap_end")), "left_semi")
    _load(spark, batch, target, key, partition_col, order_cols)
    _checkpoint_rows(gaps.withColumnsRenamed({"gap_start": "window_start", "gap_end": "window_end"}), ran_at) \
        .write.mode("append").parquet(audit_path)
    return gaps


def write_star_bucketed(spark: SparkSession, orders: DataFrame, lines: DataFrame, database: str,
                        buckets: int) -> tuple[str, str]:
    """Store fact_order and fact_order_line bucketed (and sorted) by the order key with the
    same bucket count, as catalog tables under the shared folder.

    Joins and per-order aggregates on the order key then read co-located buckets: the
    line shuffle, the largest exchange of the KPI build, disappears. Choose ``buckets`` so
    a bucket of lines is a few hundred MB (e.g. lines bytes / 256 MB).
    """
    location = scratch_dir(spark, f"warehouse/{database}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    fo, fol = f"{database}.fact_order", f"{database}.fact_order_line"
    orders.write.mode("overwrite").bucketBy(buckets, "id").sortBy("id").format("parquet").saveAsTable(fo)
    lines.write.mode("overwrite").bucketBy(buckets, "order_id").sortBy("order_id").format("parquet").saveAsTable(fol)
    return fo, fol
