"""Importance resampling towards a target distribution.

The hashed n-grams of the corpus and of the target are counted in fixed arrays of
``buckets``; an array of gains (log ratio of the smoothed shares) scores every document by
the mean gain of its n-grams. Each document's weight is shifted by a hash-random Gumbel value, so the highest
scores are a sample without replacement in proportion to exp(weight / 1000).

The cutoff is selected exactly without a global sort. In every round each partition gives
the median of its remaining keys and their number; the median of those medians, weighted by
the numbers, is the pivot: at least a quarter of the remaining keys lies on either side, so
the counts below and at the pivot discard that share at once. One row for each partition
comes to the driver. Ties of the cutoff score are
cut by a second selection over the ids. Only the winners are sorted, by range.

Defined cases: a null or empty text has no n-grams, weight 0, and fewer words than
``least_words``; a null id hashes as an empty text and comes after all other ids; rows
with the same id, score and number of n-grams are interchangeable; without eligible rows no rank is
given; an empty corpus gives an empty result, an empty target the counts 0; other columns
are carried by ``resample`` in a struct and cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from omnitally.llm.common import documents, materialize
from omnitally.sources.tables import read

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Distinct n-grams whose bucket a worker remembers; beyond, the memory starts anew.
REMEMBERED = 300_000
#: Winners of one sorted range.
ROWS_PER_RANGE = 50_000
#: Rows whose keys one selection step holds in memory at a time.
SELECT_ROWS = 2_000_000

MEASURES = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])

#: Bytes that part words (ASCII without digits and letters) become spaces, A-Z become small.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class _Buckets(dict):
    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def __missing__(self, gram: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[gram] = b = zlib.crc32(gram) % self.buckets
        return b


def gram_buckets(text: bytes, known: _Buckets, longest: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every n-gram of ``text``."""
    words = text.translate(_WORDS).split()
    found = list(map(known.__getitem__, words))
    for k in range(2, longest + 1):
        found += [known[b" ".join(words[i:i + k])] for i in range(len(words) - k + 1)]
    return len(words), np.array(found, dtype=np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) over the column ``text``; each task sends at most one row a bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                if text.is_valid:
                    total += np.bincount(gram_buckets(text.as_py(), known, longest)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], schema=schema)

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """The gain of every bucket; ``buckets`` numbers of either side come to the driver."""
    def counts(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        for row in bucket_counts(texts, buckets, longest).collect():
            out[row.bucket] = row.n
        return out

    s, t = counts(corpus), counts(target)
    every_s, every_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * every_s / ((float(a) + 1) * every_t)))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weights(gain: np.ndarray, longest: int = LONGEST) -> Callable[[Column], Column]:
    """A function of a text column that gives a struct of n_words, n_features and weight."""
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Buckets(len(gain))
        for part in texts:
            rows = []
            for text in part:
                words, found = gram_buckets((text or "").encode("utf-8", "surrogatepass"), known, longest)
                rows.append((words, len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
            yield pd.DataFrame(rows, columns=MEASURES.names, dtype="int64")

    score.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    # Evaluated once, where it stands, and not again in a filter on one of its fields.
    return F.pandas_udf(score, MEASURES).asNondeterministic()


def shifted(weight: Column, doc_id: Column, seed: str = SEED) -> Column:
    """The weight plus a Gumbel value that depends on the id alone, in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _sides(keys: DataFrame, pivot: int | None) -> np.ndarray:
    """Keys below, at and above the pivot, and the medians of both sides: a row per partition.

    Every partition sends one row (one for each ``SELECT_ROWS`` keys), whatever its size.
    Without a pivot all keys are above it.
    """
    def middle(side: np.ndarray) -> int:
        at = (len(side) - 1) // 2
        return int(np.partition(side, at)[at]) if len(side) else 0

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> pa.RecordBatch:
            part = np.concatenate(held)
            below, above = (part[:0], part) if pivot is None else (part[part < pivot], part[part > pivot])
            row = len(below), len(part) - len(below) - len(above), len(above), middle(below), middle(above)
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=names)

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            rows += len(held[-1])
            if rows >= SELECT_ROWS:
                yield out()
                held, rows = [], 0
        if rows:
            yield out()

    names = ["below", "equal", "above", "below_median", "above_median"]
    found = keys.mapInArrow(split, ", ".join(f"{c} long" for c in names)).collect()
    return np.array(found, dtype=np.int64).reshape(-1, len(names))


def _weighted_median(values: np.ndarray, n: np.ndarray) -> int:
    by = np.argsort(values)
    upto = np.cumsum(n[by])
    return int(values[by][np.searchsorted(upto, (upto[-1] + 1) // 2)])


def select(keys: DataFrame, k: int) -> int:
    """The ``k``-th smallest (from 1) of the one long column of ``keys``.

    ``keys`` is read once a round, restricted to the interval that remains, which loses at
    least a quarter of its keys in every round.
    """
    key = F.col(keys.columns[0])
    sides = _sides(keys, None)
    pivot = _weighted_median(sides[:, 4], sides[:, 2])
    while True:
        sides = _sides(keys, pivot)
        below, equal, _ = sides[:, :3].sum(axis=0).tolist()
        if k <= below:
            keys = keys.where(key < pivot)
            pivot = _weighted_median(sides[:, 3], sides[:, 0])
        elif k <= below + equal:
            return pivot
        else:
            k -= below + equal
            keys = keys.where(key > pivot)
            pivot = _weighted_median(sides[:, 4], sides[:, 2])


def draw(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Add ``rank`` to ``rows`` (id, score, n_words, n_features, ...): 1, 2, 3 ... by score, then id.

    ``rows`` is read several times and should be a written table.
    """
    eligible = rows.where(F.col("n_words") >= least_words)
    take = eligible.count() * percent // 100
    if not take:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    last_score = -select(eligible.select((-F.col("score")).alias("key")), take)
    ties = eligible.where(F.col("score") == last_score)
    wanted = take - eligible.where(F.col("score") > last_score).count()
    if wanted <= ties.where("id is not null").count():
        last_id = select(ties.where("id is not null").select("id"), wanted)
        among = F.coalesce(F.col("id") <= last_id, F.lit(False))
    else:
        among = F.lit(True)
    # Rows that share the cutoff's score and id may be too many; the ranks beyond ``take`` are taken back.
    won = F.coalesce((F.col("n_words") >= least_words) & (
        (F.col("score") > last_score) | ((F.col("score") == last_score) & among)), F.lit(False))
    # The place in the table spreads equal rows over several ranges.
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    by = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]
    ranges = max(1, -(-take // ROWS_PER_RANGE))
    dealt = rows.where(won).repartitionByRange(ranges, *by).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "resample-winners")
    starts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*by))
    ranked = dealt.join(starts, F.col("part") == F.col("p")).withColumn("rank", rank)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    lost = rows.where(~won).withColumn("rank", F.lit(None).cast("long"))
    return ranked.drop("p", "part", "before", "place").unionByName(lost.drop("place"))


def scored(docs: DataFrame, target: DataFrame, seed: str = SEED, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``docs`` (id, text, ...) with n_words, n_features, weight and score instead of the text."""
    gain = gains(docs.select("text"), target.select("text"), buckets, longest)
    rows = docs.withColumn("m", weights(gain, longest)("text"))
    return rows.select(*[c for c in docs.columns if c != "text"], "m.*", shifted(F.col("m.weight"), F.col("id"), seed).alias("score"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             least_words: int = LEAST_WORDS, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns kept, in a table of their own."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.struct("*").alias("doc"))
    out = materialize(scored(rows, target.select(F.col(target_text).alias("text")), **options), "resample-scores")
    return draw(out, least_words, percent).where("rank is not null").select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document for the benchmark's distribution."""
    docs = documents(spark, sf_dir, F.col("doc_id").alias("id"), "text")
    rows = materialize(scored(docs, read(spark, sf_dir, "benchmark", "text")), "resample-scores")
    return draw(rows).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
texts AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
target AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
used AS (SELECT n, unnest(words) AS word FROM texts),
crc AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM used UNION SELECT word FROM target)), tab),
s AS (SELECT bucket, count(*) AS n FROM used JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN crc USING (word) GROUP BY bucket),
gain AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) AS r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weighed AS (
  SELECT n, count(*)::BIGINT AS n_features, sum(gain)::BIGINT AS total FROM used JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY n),
scored AS (
  SELECT texts.n, doc_id, coalesce(n_features, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
         ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM texts LEFT JOIN weighed USING (n)),
shifted AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         (SELECT count(*) FROM shifted WHERE n_features >= 20) * 10 // 100 AS take
  FROM shifted)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= take THEN place END::BIGINT AS rank FROM ranked
"""
