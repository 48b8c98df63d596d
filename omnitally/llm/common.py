"""Helpers shared by the operators: reading tables, shared scratch tables, block sizes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.session import scratch_dir
from omnitally.sources.tables import read

#: Rows of an Arrow batch, so that a batch of whole texts stays at a few megabytes on both sides. Long texts are bounded
#: by bytes: spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless the session says otherwise.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: The white space that separates words in every contract of this package.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table; texts travel to Python in batches of at most ``BATCH_ROWS``."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    return read(spark, sf_dir, "documents", *columns)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back.

    This cuts the lineage on storage that every executor sees, so a lost executor costs a
    re-read and not a recomputation; ids drawn while writing stay as they are.
    """
    path = f"{scratch_dir(df.sparkSession, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Number of partitions that keeps each at about ``per_part`` rows."""
    return max(least, -(-rows // per_part))


def spread(df: DataFrame, *columns: Column) -> DataFrame:
    """Shuffle by ``columns`` into the session's number of shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def running_sums(numbers: Column, block: int = 64, levels: int = 2) -> Column:
    """Inclusive running sums of an array of numbers.

    Sums inside blocks, and running sums of the blocks' totals by the same step, so the work
    for each number is bounded by ``block`` as long as ``levels`` of blocks hold the array.
    """
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def plain(part: Column) -> Column:
        return F.transform(F.when(F.size(part) > 0, F.sequence(F.lit(1), F.size(part))),
                           lambda i: total(F.slice(part, F.lit(1), i)))

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        # Bound as the only element of an array, so that it is evaluated once.
        return F.element_at(F.transform(F.array(value), use), 1)

    def sums(values: Column, level: int) -> Column:
        if not level:
            return plain(values)

        def by_blocks(v: Column) -> Column:
            starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(block)))
            inner = F.transform(starts, lambda s: plain(F.slice(v, s, F.lit(block))))

            def add(parts: Column) -> Column:
                totals = F.transform(parts, lambda p: F.element_at(p, -1))
                offsets = sums(totals, level - 1)
                return F.flatten(F.zip_with(F.zip_with(parts, offsets, lambda p, o: F.struct(p.alias("p"), o.alias("o"))), totals,
                                            lambda b, t: F.transform(b["p"], lambda x: x + b["o"] - t)))

            return once(inner, add)

        return once(values, by_blocks)

    # The copy by transform is an array of objects, whose slices cost their own length only.
    return F.coalesce(sums(F.transform(numbers, lambda x: x), levels), F.array().cast("array<long>"))
