"""K-d tree partitioning into shards of near-equal bytes, with DataFrame functions only.

A narrow table of metadata (id, size, checksum, dimensions) is written once. The tree is
split level by level, all its nodes at a time: a node's widest dimension (its range over
the table's) is chosen, and the weighted median along it (for an odd number of leaves the
matching quantile) is found by distributed histograms of bytes that narrow in on the cut.
Rows are ordered by (dimension, hash, row number), so a value that holds a third of all
rows, or any group of copies, is cut as finely as any other. The driver sees one row per
node and pass, never the data.

The number of leaves is given, or follows from the target bytes of a leaf.

Defined cases: a null text has no bytes (size 8) and the checksum 0; null dimensions count
as the smallest value; equal rows are told apart by a row number drawn when the metadata
is written, and are interchangeable; a row larger than a leaf is a leaf of its own or more
(other shards may stay empty); an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from omnitally.llm.common import documents, materialize, text_of

SHARDS, OVERHEAD = 24, 8
BINS = 65_536
TOLERANCE = 0.0005  # of a leaf
ROWS_PER_BLOCK = 50_000
CODES = 65_536
TOP = 1 << 62  # hashes lie below


def code(column: str) -> Column:
    """A category as a number; equal values stay together."""
    return F.when(F.col(column).isNull(), F.lit(-1)).otherwise(F.crc32(F.col(column).cast("binary")) % CODES).cast("long")


def _by_node(values: list, kind: str) -> Column:
    """The entry of a list at the row's node. The list travels as one string, which the optimizer folds into an array."""
    return F.element_at(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), (F.col("node") + 1).cast("int"))


class _Cut:
    """Search for one node's cut: fixed leading components, and the open range of the next."""

    def __init__(self, dim: int, low: int, high: int, need: float, slack: float, last: int):
        self.dim, self.low, self.high, self.need, self.slack, self.last = dim, low, high, need, slack, last
        self.fixed: list[int] = []
        self.done = False

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BINS))

    def narrow(self, bin_: int, before: int, weight: int) -> None:
        """Keep the bin in which the running bytes pass the need; stop when it is small enough."""
        self.need -= before
        low = self.low + bin_ * self.step
        high = min(self.high, low + self.step - 1)
        if weight <= self.slack or (low == high and len(self.fixed) == 2):
            # The bin goes to the side that it fits better.
            self.fixed.append(high + 1 if 2 * self.need >= weight else low)
            self.done = True
        elif low == high:
            self.fixed.append(low)
            self.low, self.high = 0, (TOP if len(self.fixed) == 1 else self.last)
        else:
            self.low, self.high = low, high


def _position(cuts: list[_Cut], dims: list[str]) -> Column:
    """The component that each node's search is at."""
    stage = _by_node([len(c.fixed) for c in cuts], "int")
    value = F.element_at(F.array(*dims), _by_node([c.dim + 1 for c in cuts], "int"))
    return F.when(stage == 0, value).when(stage == 1, F.col("hash")).otherwise(F.col("row"))


def _open(cuts: list[_Cut], dims: list[str]) -> Column:
    """Rows that the searches still look at."""
    value = F.element_at(F.array(*dims), _by_node([c.dim + 1 for c in cuts], "int"))
    first = _by_node([c.fixed[0] if c.fixed else None for c in cuts], "long")
    second = _by_node([c.fixed[1] if len(c.fixed) > 1 else None for c in cuts], "long")
    at = _position(cuts, dims)
    return (~_by_node([c.done for c in cuts], "boolean") & (first.isNull() | (value == first))
            & (second.isNull() | (F.col("hash") == second))
            & at.between(_by_node([c.low for c in cuts], "long"), _by_node([c.high for c in cuts], "long")))


def _find(rows: DataFrame, cuts: list[_Cut], dims: list[str]) -> None:
    """Narrow all searches, a histogram of bytes per node and pass, until each has its cut."""
    while not all(c.done for c in cuts):
        bin_ = F.expr("(at - low) div step").alias("bin")
        held = rows.where(_open(cuts, dims)).select(
            "node", "size", _position(cuts, dims).alias("at"), _by_node([c.low for c in cuts], "long").alias("low"),
            _by_node([c.step for c in cuts], "long").alias("step"), _by_node([c.need for c in cuts], "double").alias("need"))
        bins = held.select("node", "size", "need", bin_).groupBy("node", "bin").agg(
            F.sum("size").alias("weight"), F.first("need").alias("need"))
        order = Window.partitionBy("node").orderBy("bin")
        bins = bins.withColumn("before", F.sum("weight").over(order) - F.col("weight"))
        passed = (F.col("before") < F.col("need")) & (F.col("before") + F.col("weight") >= F.col("need"))
        found = {r["node"]: r for r in bins.where(passed).collect()}
        for node, cut in enumerate(cuts):
            if cut.done:
                continue
            if node in found:
                cut.narrow(found[node]["bin"], found[node]["before"], found[node]["weight"])
            else:  # nothing to cut off
                cut.fixed.append(cut.low if cut.need <= 0 else cut.high + 1)
                cut.done = True


def _right(cuts: list[_Cut], dims: list[str]) -> Column:
    """Whether a row lies at or behind its node's cut."""
    value = F.element_at(F.array(*dims), _by_node([c.dim + 1 for c in cuts], "int"))
    first = _by_node([c.fixed[0] for c in cuts], "long")
    second = _by_node([c.fixed[1] if len(c.fixed) > 1 else None for c in cuts], "long")
    third = _by_node([c.fixed[2] if len(c.fixed) > 2 else None for c in cuts], "long")
    by_row = third.isNull() | (F.col("row") >= third)
    by_hash = second.isNull() | (F.col("hash") > second) | ((F.col("hash") == second) & by_row)
    return (value > first) | ((value == first) & by_hash)


def kd_shards(docs: DataFrame, dims: dict[str, Column], doc_id: str = "doc_id", text: str = "text",
              leaves: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard for every row of ``docs``.

    ``dims`` are the metadata dimensions, as whole numbers. With ``leaves`` None their
    number follows from ``target_bytes``.
    """
    names = [f"dim{i}" for i in range(len(dims))]
    body = text_of(text)
    meta = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        *[F.coalesce(c.cast("long"), F.lit(-1).cast("long")).alias(n) for n, c in zip(names, dims.values())])
    meta = meta.withColumn("hash", F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 2)).withColumn(
        "row", F.monotonically_increasing_id())
    rows = materialize(meta, "shard-meta").withColumn("node", F.lit(0))
    whole = rows.agg(F.sum("size").alias("bytes"), F.max("row").alias("row"), *_ends(names)).first()
    total = whole["bytes"] or 0
    if leaves is None:
        leaves = max(1, -(-total // target_bytes))
    slack = TOLERANCE * total / leaves
    shares = [leaves]  # leaves below each node
    while total and max(shares) > 1:
        seen = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *_ends(names)).collect()}
        cuts = []
        for node, share in enumerate(shares):
            r = seen.get(node)
            if share == 1 or r is None:
                cut = _Cut(0, 0, 0, 0.0, 0.0, 0)
                cut.fixed, cut.done = [(1 << 63) - 1], True
            else:
                widths = [(r[f"max_{n}"] - r[f"min_{n}"]) / max(1, whole[f"max_{n}"] - whole[f"min_{n}"]) for n in names]
                dim = widths.index(max(widths))
                cut = _Cut(dim, r[f"min_{names[dim]}"], r[f"max_{names[dim]}"], r["bytes"] * (share // 2) / share,
                           slack, whole["row"])
            cuts.append(cut)
        _find(rows, cuts, names)
        # Children take the numbers that their leaves begin with, so a node's number is its order.
        parts = [(s,) if s == 1 else (s // 2, s - s // 2) for s in shares]
        begins = list(accumulate(map(len, parts), initial=0))[:-1]
        rows = materialize(rows.withColumn("node", (_by_node(begins, "int") + F.when(
            _right(cuts, names), 1).otherwise(0)).cast("int")), "shard-nodes")
        shares = [s for p in parts for s in p]
    return rows.withColumnRenamed("node", "shard")


def _ends(names: list[str]) -> list[Column]:
    return [f(n).alias(f"{k}_{n}") for n in names for k, f in (("min", F.min), ("max", F.max))]


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: gapless numbers inside each shard, counted by blocks of hash ranges."""
    counts = rows.groupBy("shard").agg(F.ceil(F.count("*") / ROWS_PER_BLOCK).alias("blocks"))
    held = rows.join(counts, "shard").withColumn(
        "block", F.floor(F.col("hash").cast("double") / float(TOP) * F.col("blocks"))).drop("blocks")
    held = materialize(held, "shard-blocks")
    per = held.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "block").orderBy("hash", "row")
    return held.withColumn("place", F.row_number().over(inside)).join(per, ["shard", "block"]).withColumn(
        "slot", (F.col("offset") + F.col("place") - 1).cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by a k-d tree over source, language and length."""
    docs = documents(spark, sf_dir, "doc_id", "text", "source", "lang", "n_chars")
    dims = {"source": code("source"), "lang": code("lang"), "n_chars": F.col("n_chars")}
    out = with_slots(kd_shards(docs, dims))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                      "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
