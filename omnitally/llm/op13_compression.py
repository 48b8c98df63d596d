"""Quality classifier by compression.

One zstandard dictionary is trained on text labelled good and one on text labelled bad. A
text that resembles the good text compresses better with its dictionary: the difference of
the two compressed sizes, over the larger one, is the evidence. A logistic model turns it,
with the text's compressibility and the logarithm of its length, into a probability. The
model is fitted on texts that the dictionaries of the other half of the sample compress, so
that no text meets a dictionary that holds it, and is weighted to the classes' shares of all labels.

The fit reads a bounded sample: at most ``FIT_ROWS`` labelled ids of each class, the first by
a hash of the id, and for the dictionaries one window of at most ``WINDOW`` bytes of each, at
a hash-random place. Every document is scored over its whole text.

Defined cases: ids with labels of both classes, null ids, null labels and labels other than
0 and 1 are not learned from; where an id has several texts, the smallest is taken; a null
or empty text has the difference 0, the ratio 1 and the length 0; without labels of both
classes every score is the share of good labels, counting one more of each; repeated rows
are each scored; other columns are kept by ``with_scores``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnitally.llm.common import documents, materialize, text_of
from omnitally.sources.tables import read

FIT_ROWS = 3000
WINDOW = 2000
DICTIONARY_BYTES = 256 << 10
LEVEL = 3
THRESHOLD = 0.7
RIDGE = 1e-3


class Model(NamedTuple):
    """Dictionaries of bad and good text and the logistic model; without dictionaries, a constant."""
    dictionaries: tuple[bytes, bytes] | None
    weights: tuple[float, ...]


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def window(text: bytes, size: int = WINDOW) -> bytes:
    """At most ``size`` bytes of ``text``, from a place that depends on the text alone."""
    spare = max(0, len(text) - size)
    start = zlib.crc32(text) % (spare + 1)
    return text[start:start + size]


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of few samples, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
    if len(content) < 8:
        return zstandard.ZstdCompressor(**options)
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=held, **options)


def measure(text: bytes, bad: zstandard.ZstdCompressor, good: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """Normalised difference of the compressed sizes, the smaller one over the text's, log length."""
    if not text:
        return 0.0, 1.0, 0.0
    as_bad, as_good = len(bad.compress(text)), len(good.compress(text))
    return (as_bad - as_good) / max(as_bad, as_good), min(as_bad, as_good) / len(text), math.log1p(len(text))


def fit_logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights (constant first) of a ridge logistic model by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        curve = (x.T * (share * p * (1 - p))) @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (share * (y - p)) - RIDGE * w)
        w = w + step * min(1.0, 10 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return w


MEASURES = T.StructType([T.StructField(c, T.DoubleType()) for c in ("difference", "ratio", "log_length")])


def _measures(dictionaries: tuple[bytes, bytes]) -> Callable[[Column], Column]:
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bad, good = map(compressor, dictionaries)
        for part in texts:
            yield pd.DataFrame([measure((t or "").encode("utf-8", "surrogatepass"), bad, good) for t in part],
                               columns=MEASURES.names, dtype="float64")

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, MEASURES)


@F.pandas_udf(T.BinaryType())
def _windows(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: window((t or "").encode("utf-8", "surrogatepass")))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = FIT_ROWS) -> Model:
    """The model of ``labels`` (doc_id, 0/1) over the texts of ``docs``.

    The driver receives the windows and measures of at most ``2 * rows`` texts.
    """
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where("id is not null and y in (0, 1)")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other"))
             .where("y = other").select("id", "y"))
    known = materialize(known, "quality-labels")
    total = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return Model(None, (math.log((total.get(1, 0) + 1) / (total.get(0, 0) + 1)),))
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows) for y in (0, 1)]
    # Two rows of numbers for each sampled id at most: small enough to broadcast whatever the input.
    sample = F.broadcast(materialize(some[0].union(some[1]), "quality-sample"))
    texts = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).join(sample, "id")
    texts = texts.groupBy("id", "y").agg(F.min("text").alias("text"))
    texts = materialize(texts.withColumn("half", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))), "quality-texts")
    found = texts.select("id", "y", "half", _windows("text").alias("w")).orderBy("id").collect()
    if len({r.y for r in found}) < 2:
        return Model(None, (math.log((total[1] + 1) / (total[0] + 1)),))

    def dictionaries(half: int | None) -> tuple[bytes, bytes]:
        return tuple(dictionary([bytes(r.w) for r in found if r.y == y and r.half != half]) for y in (0, 1))

    x, y = [], []
    for half in (0, 1):
        part = texts.where(F.col("half") == half).select("y", _measures(dictionaries(half))("text").alias("m"), "id")
        for r in part.orderBy("id").collect():
            x.append(tuple(r.m))
            y.append(r.y)
    y = np.array(y, dtype=np.float64)
    share = np.where(y == 1, total[1] / max(1, y.sum()), total[0] / max(1, (1 - y).sum()))
    weights = fit_logistic(np.array(x), y, share * len(y) / (total[0] + total[1]))
    return Model(dictionaries(None), tuple(weights.tolist()))


def score(model: Model, text: Column) -> Column:
    """The probability that the text is good."""
    if model.dictionaries is None:
        return F.lit(1 / (1 + math.exp(-model.weights[0])))
    constant, *slopes = model.weights

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bad, good = map(compressor, model.dictionaries)
        for part in texts:
            x = np.array([measure((t or "").encode("utf-8", "surrogatepass"), bad, good) for t in part]).reshape(-1, len(slopes))
            yield pd.Series(1 / (1 + np.exp(-np.clip(constant + x @ np.array(slopes), -35, 35))))

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # Evaluated once, where it stands, for the score and the verdict.
    return F.pandas_udf(run, T.DoubleType()).asNondeterministic()(text)


def with_scores(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the columns score and predicted instead of any of these names."""
    kept = docs.drop("score", "predicted").withColumn("score", score(model, F.col(text)))
    return kept.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    out = with_scores(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return out.select("doc_id", "held_out", "score", "predicted")
