"""SimHash near-duplicates, linked by BK-trees.

1. Every text gets a 64-bit SimHash over its word shingles (Arrow batches).
2. Equal fingerprints fall together, so copies of any number cost one entry.
3. Two fingerprints within ``radius`` bits agree on at least ``agree`` of ``radius + agree``
   blocks of bits. A shard is a choice of ``agree`` blocks with their values; each
   fingerprint goes to one shard of every choice, and any two linked ones meet in a shard.
   ``agree`` follows the number of fingerprints, so that shards stay small at any size.
4. Each shard's fingerprints form a BK-tree (children keyed by integer distance to the
   parent); the search follows only edges within the radius. A shard hands on at most one
   link per entry, a spanning set of its links.
5. Connected components over the shards' links, and the smallest doc_id of each.

A shard's tree travels to its queries in one shuffle and is not broadcast through the
driver: all trees together are as large as the corpus has fingerprints.

Defined cases: null and empty texts have the fingerprint zero, linked like any other; a
text of fewer words than a shingle is one shingle; repeated rows are each returned, with
the same component; a null doc_id is never the smallest unless the whole component has
none (then the component is null); an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from omnitally.llm.bktree import Forest
from omnitally.llm.common import documents, materialize, parts_for
from omnitally.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
SHARD_TARGET = 256
ROWS_PER_TASK = 200_000
CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    spans = list(zip(starts[:n], ends[min(shingle, len(words)) - 1:]))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        parts = [joined[a:b - 1] for a, b in spans[i:i + CHUNK]]
        hashes = np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return run(text)


def block_scheme(n: int, radius: int, target: int = SHARD_TARGET) -> tuple[int, int]:
    """(blocks, agree): the fewest agreeing blocks that keep random shards near ``target``."""
    agree = 1
    while agree < 4 and n / 2 ** (64 * agree // (radius + agree)) > target:
        agree += 1
    return radius + agree, agree


def shard_keys(fp: Column, radius: int, blocks: int, agree: int) -> Column:
    """Array of one shard key for every choice of ``agree`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), agree)):
        mask = sum(signed[b] for b in chosen)
        keys.append(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``radius`` bits.

    ``prints`` has distinct fingerprints in column fp.
    """
    n = prints.count()
    blocks, agree = block_scheme(n, radius)
    keyed = prints.select("fp", F.explode(shard_keys(F.col("fp"), radius, blocks, agree)).alias("shard"))
    tasks = parts_for(n * len(list(combinations(range(blocks), agree))), ROWS_PER_TASK,
                      int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def join_shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        fp = np.concatenate([b["fp"].to_numpy() for b in held]).view(np.uint64)
        shard = np.concatenate([b["shard"].to_numpy() for b in held])
        labels = Forest(shard, fp).connect(radius)
        linked = np.flatnonzero(labels != np.arange(len(fp)))
        yield pd.DataFrame({"a": fp[linked].view(np.int64), "b": fp[labels[linked]].view(np.int64)})

    return keyed.repartition(tasks, "shard").mapInPandas(join_shards, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, extra: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, fp, root (one value per component), component_id, and the ``extra`` columns.

    ``component_id`` is the smallest doc_id of the component.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp"),
                       *[c.alias(k) for k, c in (extra or {}).items()])
    rows = materialize(rows, "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    comps = components(links(prints.select("fp"), radius), "a", "b")
    rooted = prints.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, all columns kept: the smallest (doc_id, text hash).

    A null doc_id comes after all others. Rows equal in id and text are one document.
    """
    cols = docs.columns
    held = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("i"),
                       F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"))
    found = near_duplicates(docs, doc_id, text, extra={"t": F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))},
                            **options)
    order = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("i"), F.col("t").alias("t"))
    chosen = found.groupBy("root").agg(F.min(order).alias("o")).select("o.late", "o.i", "o.t")
    chosen = chosen.select(F.coalesce("i", F.lit(0)).alias("i0"), "late", "t")
    held = held.select("doc", F.coalesce("i", F.lit(0)).alias("i0"), F.col("i").isNull().alias("late"), "t")
    return (held.join(chosen, ["i0", "late", "t"], "left_semi").dropDuplicates(["i0", "late", "t"])
            .select([F.col("doc")[c].alias(c) for c in cols]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
