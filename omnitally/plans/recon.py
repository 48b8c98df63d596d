"""Reconciliation of landed sources with the stored warehouse, and the resync that mends it.

A source is a function that gives its rows (id, source, date, revenue). Each source is read,
reduced to its days and written by itself, so one that fails becomes an ``error`` row and the others go
on. The warehouse is one stored table of the same columns, partitioned by month.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.functions.expr import MONEY
from omnitally.operators import quality as Q
from omnitally.plans import jobs

FACT = f"id string, source string, date date, revenue {MONEY}, version bigint, month date"
Read = Callable[[], DataFrame]


def fact_rows(rows: DataFrame, version: int) -> DataFrame:
    return rows.select("id", "source", "date", F.col("revenue").cast(MONEY).alias("revenue"),
                       F.lit(version).cast("bigint").alias("version"), F.trunc("date", "month").alias("month"))


def store_facts(rows: DataFrame, path: str, version: int = 0) -> None:
    """The first load of the warehouse."""
    jobs.write_partitioned(fact_rows(rows, version), path, "month", dynamic=False)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT).parquet(path)


def _days(rows: DataFrame) -> DataFrame:
    return Q.days_of(rows.select("source", "date", F.col("revenue").alias("rev")))


def reconcile(spark: SparkSession, sources: dict[str, Read], facts: str, out: str) -> DataFrame:
    """Every source's days against the stored ones, written to ``out``; one scan a side."""
    errors, days = {}, None
    for name, rows in sources.items():
        path = f"{out}-source-{name}"
        try:
            _days(rows()).write.parquet(path)
        except Exception as e:  # noqa: BLE001 - any failure of one source is its own result
            errors[name] = str(e)
            continue
        part = spark.read.parquet(path)
        days = part if days is None else days.unionByName(part)
    held = _days(stored(spark, facts).filter(~F.col("source").isin([*errors])))
    compared = Q.compare_days(days, held) if days is not None else Q.unread(spark, {})
    compared.unionByName(Q.unread(spark, errors)).write.parquet(out)
    return spark.read.parquet(out)


def resync(spark: SparkSession, sources: dict[str, Read], actions: DataFrame, facts: str, totals: str, audit: str,
           ran_at: str, version: int) -> None:
    """Pull the days of ``actions`` (source, date) again, upsert them, refresh their totals, record each day.

    Every source is a stage of its own: 'processing' rows first, then one result row per day, success
    or failed with the error, which does not stop the other sources. Upserts are by id and the
    totals are recomputed from the facts, so a run that broke off is simply run again.
    """
    wanted = actions.select("source", "date").distinct().checkpoint(eager=True)

    def note(name: str, status: str, error: str | None) -> None:
        wanted.filter(F.col("source") == name).select(
            F.sha2(F.concat_ws("|", "source", F.col("date").cast("string"), F.lit(ran_at)), 256).alias("id"), "source",
            F.concat(F.lit("resync_"), "source").alias("type"), F.lit(status).alias("status"),
            F.timestamp_add("SECOND", F.lit(int(status != "processing")), F.lit(ran_at).cast("timestamp_ntz")).alias("ts"),
            F.to_json(F.struct(F.col("date").cast("string").alias("date"))).alias("payload"),
            F.lit(error).cast("string").alias("error")).write.mode("append").parquet(audit)

    for name, rows in sources.items():
        note(name, "processing", None)
        try:
            # The source is pulled once; the wanted days are few, so its rows are not dealt out by day.
            batch = rows().join(F.broadcast(wanted), ["source", "date"], "left_semi")
            batch = fact_rows(batch, version).checkpoint(eager=True)
            jobs.upsert_partitions(spark, facts, batch, "id", "month", ["version"])
        except Exception as e:  # noqa: BLE001 - recorded; the other sources go on
            note(name, "failed", str(e))
            continue
        note(name, "success", None)
    months = wanted.select(F.trunc("date", "month").alias("month")).distinct()
    fresh = stored(spark, facts).join(F.broadcast(months), "month", "left_semi").groupBy("source", "date", "month").agg(
        F.sum("revenue").alias("sales"), F.count(F.lit(1)).alias("txns"))
    jobs.write_partitioned(fresh, totals, "month", dynamic=jobs.has_data(spark, totals))
