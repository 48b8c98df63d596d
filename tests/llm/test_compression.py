"""The compression classifier: held-out accuracy, no leaks, defined cases."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from omnitally.llm import op13_compression as Z

SF = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return Z.fit(*tables)


def test_held_out_accuracy(spark, tables):
    rows = {r.doc_id: r for r in Z.query(spark, SF).collect()}
    assert len(rows) == tables[0].count()
    labels = {r.doc_id: r.quality for r in tables[1].collect()}
    for d, r in rows.items():
        assert r.held_out == is_held_out(d) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    test = [(rows[d], y) for d, y in labels.items() if is_held_out(d)]
    assert np.mean([r.predicted == y for r, y in test]) > 0.95
    # Calibrated: the mean score is near the share of good labels, the squared error is small.
    assert abs(np.mean([r.score for r, _ in test]) - np.mean([y for _, y in test])) < 0.05
    assert np.mean([(r.score - y) ** 2 for r, y in test]) < 0.04


def test_scores_equal_plain_ones(tables, model):
    bad, good = map(Z.compressor, model.dictionaries)
    for r in Z.with_scores(tables[0].limit(200), model).collect():
        m = Z.measure(r.text.encode(), bad, good)
        z = model.weights[0] + sum(w * x for w, x in zip(model.weights[1:], m))
        assert math.isclose(r.score, 1 / (1 + math.exp(-max(-35, min(35, z)))), rel_tol=1e-9)


def test_nothing_is_learned_from_held_out_rows(tables, model):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(Z.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert Z.fit(moved, flipped) == model
    other = labels.withColumn("quality", 1 - F.col("quality"))
    assert Z.fit(docs, other) != model


def test_logistic_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert np.abs(Z.fit_logistic(x, y, np.ones(4000)) - [0.5, 2, -1]).max() < 0.2
    # Separable classes stay finite.
    assert np.isfinite(Z.fit_logistic(np.sign(x[:, :1]), (x[:, 0] > 0).astype(float), np.ones(4000))).all()


def test_windows():
    text = bytes(range(256)) * 40
    assert Z.window(text) in text and len(Z.window(text)) == Z.WINDOW and Z.window(b"ab") == b"ab" and Z.window(b"") == b""


def test_odd_rows(spark, tables, model, odd_docs, no_docs):
    out = Z.with_scores(odd_docs.withColumn("score", F.lit("clash")), model)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1  # null and empty texts alike
    assert Z.with_scores(no_docs, model).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (4, 1), (7, 0), (7, 0), (None, 1), (5, None), (6, 3)], "doc_id long, quality int")
    got = Z.with_scores(odd_docs, Z.fit(odd_docs, labels)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    one = [d for d in range(1, 8) if not is_held_out(d)][:2]
    for rows, share in (([], 0.5), ([(d, 1) for d in one], 3 / 4), ([(d, 0) for d in one], 1 / 4)):
        fitted = Z.fit(odd_docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {round(r.score, 9) for r in Z.with_scores(odd_docs, fitted).collect()} == {share}
    assert Z.fit(no_docs, labels).dictionaries is None
