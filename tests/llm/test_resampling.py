"""Importance resampling against a plain scoring and sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from omnitally.llm import op12_resampling as R
from tools.oracle_check import digest, duck


def grams(text, longest=1):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(words), [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, least=20, percent=10, buckets=10_000, longest=1):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, text in docs for g in grams(text, longest)[1])
    t = Counter(bucket(g) for text in target for g in grams(text, longest)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        words, found = grams(text, longest)
        weight = sum(gain[bucket(g)] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    ok = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = ok[:len(ok) * percent // 100]
    rest = ok[len(drawn):] + [r for r in rows if r[1] < least]
    return Counter([(d, n, w, s, i) for i, (d, _, n, w, s) in enumerate(drawn, 1)] + [(d, n, w, s, None) for d, _, n, w, s in rest])


def got(df, target, least=20, percent=10, **options):
    rows = R.materialize(R.scored(df.select(F.col("doc_id").alias("id"), "text"), target.select("text"), **options), "t")
    out = R.draw(rows, least, percent).collect()
    return Counter((r.id, r.n_features, r.weight, r.score, r["rank"]) for r in out)


def test_resampling_on_documents(spark, sf_small, docs):
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    rows, target = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()]
    assert got(docs, bench) == plain(rows, target)
    assert got(docs, bench, 5, 60, buckets=50, longest=2) == plain(rows, target, 5, 60, 50, 2)
    drawn = R.resample(docs, bench)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {k[0] for k in plain(rows, target) if k[4]}


def test_resampling_oracle(spark, sf_small):
    df = R.query(spark, sf_small)
    rel = duck(sf_small).sql(R.ORACLE)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


@pytest.mark.parametrize("kind", ["different", "few", "one"])
def test_select(spark, kind, monkeypatch):
    monkeypatch.setattr(R, "SELECT_ROWS", 50)
    rng = random.Random(4)
    values = [{"different": rng.randrange(-10**15, 10**15), "few": rng.randrange(3), "one": -7}[kind] for _ in range(700)]
    keys = spark.createDataFrame([(v,) for v in values], "key long").repartition(5).cache()
    for k in (1, 2, 350, 699, 700):
        assert R.select(keys, k) == sorted(values)[k - 1]
    assert R._weighted_median(np.array([5, 1, 3]), np.array([1, 1, 5])) == 3


def test_ties_at_the_cutoff(spark, monkeypatch):
    """Many rows share score and id, null ids included: ranks stay gapless and exact."""
    monkeypatch.setattr(R, "ROWS_PER_RANGE", 7)
    text = "w " * 25
    rows = [(1, text)] * 30 + [(None, text)] * 40 + [(i, text) for i in range(2, 12)] + [(None, "w " * 30)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("w x",)], "text string")
    for percent in (1, 30, 50, 90, 100):
        assert got(df, target, 20, percent) == plain(rows, ["w x"], 20, percent)


def test_resampling_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    target = spark.createDataFrame([("Lorem ipsum",), (None,), ("",)], "text string")
    for least, percent in ((20, 10), (1, 50), (0, 100)):
        assert got(odd_docs, target, least, percent) == plain(rows, ["Lorem ipsum"], least, percent)
    assert got(odd_docs, target.limit(0), 1, 50) == plain(rows, [], 1, 50)
    assert R.resample(odd_docs, target, least_words=1, percent=50).columns == odd_docs.columns
    assert got(no_docs, target) == Counter()
