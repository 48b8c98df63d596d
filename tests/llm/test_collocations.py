"""Counting automata and collocations against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from omnitally.llm import automata as A
from omnitally.llm import op11_collocations as C
from tools.oracle_check import digest, duck


def plain(docs, width=3, least=10, top=2000):
    """Brute force over (text, lang)."""
    n, f = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, width + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cands = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    out = {}
    for (lang, p), a in cands.items():
        inside = any(l2 == lang and len(q) > len(p) and 100 * b >= 50 * a
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in cands.items())
        if not inside:
            score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)}


def got(df, top=2000, **options):
    rows = C.top(C.collocations(df, **options), top)
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows.collect()}


def random_rows(rng, words, width, count):
    rows = {tuple(rng.randrange(words) for _ in range(rng.randint(1, width))) for _ in range(count)}
    rows = np.array(sorted((*r, *[-1] * (width - len(r))) for r in rows), dtype=np.int32).reshape(-1, width)
    return rows, np.array([rng.choice([1, 1, 1, 2, 9]) for _ in rows], dtype=np.int64)


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_automata(width):
    rng = random.Random(width)
    words = sorted({f"w{i}é".encode() for i in range(12)})
    held, total = [], Counter()
    for count in (0, 1, 5, 200, 3000):
        rows, n = random_rows(rng, len(words), width, count)
        t = A.read(A.build(words, rows, n))
        back, counts = A.rows_of(t)
        seen = {tuple(t.words[w] for w in r if w >= 0): c for r, c in zip(back.tolist(), counts.tolist())}
        want = {tuple(words[w] for w in r if w >= 0): c for r, c in zip(rows.tolist(), n.tolist())}
        assert seen == want
        # Minimal: no two states are alike, and shared ends are stored once.
        first = t.first_arc()
        states = [(t.weight[s], *t.label[first[s]:first[s] + t.degree[s]], "to", *t.target[first[s]:first[s] + t.degree[s]])
                  for s in range(len(t.weight))]
        assert len(set(states)) == len(states)
        held.append(t)
        total.update(want)
    names, rows, n = A.union(held, 3)
    both = {tuple(names[w] for w in r if w >= 0): c for r, c in zip(rows.tolist(), n.tolist())}
    assert both == {k: v for k, v in total.items() if v >= 3}
    assert rows.tolist() == sorted(rows.tolist())
    counts = A.read(A.build(names, rows, n))
    asked = sorted(rng.sample(sorted(total), min(100, len(total)))) + [(b"zz",)]
    more = sorted({w for k in asked for w in k})
    q = np.array([[*[more.index(w) for w in k], *[-1] * (width - len(k))] for k in asked], dtype=np.int32)
    found, f = A.compose(counts, A.read(A.build(more, q, np.ones(len(q), dtype=np.int64))))
    assert {tuple(counts.words[w] for w in r if w >= 0): c for r, c in zip(found.tolist(), f.tolist())} == {
        k: both[k] for k in asked if k in both}


def test_order_of_many_words():
    rows = np.array([[5, 1 << 21, 3], [5, 2, -1], [0, 1 << 21, 0], [5, 1 << 21, -1]], dtype=np.int32)
    by, _ = A.order(rows, (1 << 21) + 1)
    assert rows[by].tolist() == sorted(rows.tolist())


def test_collocations_on_documents(spark, sf_small, docs):
    want = plain([(r.text, r.lang) for r in docs.collect()])
    assert got(docs) == want and len(want) > 100
    # Small blocks, many ranges, and ranges split by hash give the same result.
    assert got(docs, block_words=500, range_grams=40_000, max_ranges=3) == want
    assert got(docs, top=5) == {r for r in want if r[1] <= 5}


def test_collocations_by_hand(spark):
    rows = [("New York city. NEW york\tCity, new york", "en")] * 6 + [("a b\na b?a b", None)] * 4 + [("a b", "und")] * 4
    rows += [("x y z w " * 10, "fr"), ("ä\x01 ö ä\x01 ö", "de")] * 7 + [("", "en"), (None, "en"), (" \t", "es"), ("..!", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert got(df) == plain(rows)
    assert got(df, width=2, least=3) == plain(rows, 2, 3)
    assert got(df, width=4, least=3) == plain(rows, 4, 3)
    assert {r[2] for r in got(df) if r[0] == "en"} == {"new york city"}


def test_collocations_odd_rows(odd_docs, no_docs):
    assert got(odd_docs) == plain([(r.text, r.lang) for r in odd_docs.collect()])
    assert got(no_docs) == set()


def test_exact_scores(spark):
    """Products beyond 64 bits."""
    a, l, r = 4 * 10**12, 5 * 10**12, 9 * 10**12
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(C.score_of("a", "l", "r").alias("s")).first()
    assert row.s == 1000000 * a * a // (l * r)


def test_collocations_oracle(spark, sf_small):
    df = C.query(spark, sf_small)
    rel = duck(sf_small).sql(C.ORACLE)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]
