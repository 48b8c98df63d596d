"""SimHash and BK-trees, decontamination and line dedup against brute force."""

import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from omnitally.llm import op3_decontamination as D
from omnitally.llm import op4_line_dedup as L
from omnitally.llm import op9_simhash as H
from omnitally.llm.bktree import Forest
from omnitally.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=4):
    keys = sorted(set(prints))
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {k: find(k) for k in keys}


def check_simhash(df):
    rows = df.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, f in zip(rows, prints):
        if r.doc_id is not None:
            least[root[f]] = min(least.get(root[f], r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f, least.get(root[f])) for r, f in zip(rows, prints)), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in H.near_duplicates(df).collect()), key=str)
    assert got == want


def test_simhash_on_documents(docs):
    check_simhash(docs)


def test_simhash_odd_rows(odd_docs, no_docs):
    check_simhash(odd_docs)
    assert H.near_duplicates(no_docs).count() == 0
    kept = H.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and H.keep_one(no_docs).count() == 0
    assert kept.count() == len(set(plain_components([plain_fingerprint(r.text) for r in odd_docs.collect()]).values()))


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_links_at_every_block_scheme(spark, monkeypatch, agree):
    r = random.Random(agree)
    prints = {r.getrandbits(64) for _ in range(60)}
    for p in list(prints):  # chains and dense balls around some
        for _ in range(r.choice([0, 0, 3, 30])):
            q = p
            for b in r.sample(range(64), r.randint(1, 5)):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    monkeypatch.setattr(H, "block_scheme", lambda n, radius: (radius + agree, agree))
    found = {x.node: x.root for x in components(H.links(df), "a", "b").collect()}
    want = plain_components(prints)
    groups = Counter(frozenset(k for k in want if want[k] == w) for w in set(want.values()))
    got = {}
    for p, s in zip(prints, signed):
        got.setdefault(found.get(s, s), set()).add(p)
    assert Counter(map(frozenset, got.values())) == groups


def test_bktree_edges_and_dense_group():
    r = np.random.default_rng(1)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, 2, replace=False)) for _ in range(3000)], dtype=np.uint64)
    fp = np.unique(np.concatenate([flips ^ np.uint64(0x0123456789ABCDEF), r.integers(0, 1 << 63, 500).astype(np.uint64)]))
    forest = Forest(np.zeros(len(fp), dtype=np.int64), fp)
    kids = np.flatnonzero(forest.parent >= 0)
    assert len(kids) == len(fp) - 1
    assert (np.bitwise_count(fp[kids] ^ fp[forest.parent[kids]]) == forest.edge[kids]).all()
    assert len(set(zip(forest.parent[kids].tolist(), forest.edge[kids].tolist()))) == len(kids)
    labels = forest.connect(4)
    assert len(set(labels.tolist())) == len(set(plain_components(fp.tolist()).values()))


def test_components_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def plain_similarity(a, b):
    k = max(1, min(5, len(a), len(b)))
    x = Counter(tuple(a[i:i + k]) for i in range(len(a) - k + 1))
    y = Counter(tuple(b[i:i + k]) for i in range(len(b) - k + 1))
    return sum((x & y).values()) / sum((x | y).values())


def plain_matches(texts, items):
    out = set()
    for d, t in texts:
        words = D.words_of(t)
        for i, item in items:
            w = D.words_of(item)
            if not w or not words:
                continue
            n = min(len(w), len(words))
            ours = set(zip(*(w[j:] for j in range(min(5, len(w))))))
            if not ours & set(zip(*(words[j:] for j in range(min(5, len(w)))))):
                continue
            fp = D.Items([(0, w)]).prints[0][2]
            k = min(5, len(w))
            if n < k:
                continue
            for s in range(len(words) - n + 1):
                part = words[s:s + n]
                if plain_similarity(part, w) < 0.8:
                    continue
                h = D.shingle_hashes(part, k)
                f = int(D.simhashes(h, np.zeros(1, dtype=np.int64), len(h))[0].astype(np.int64))
                if ((f ^ fp) % (1 << 64)).bit_count() <= D.RADIUS:
                    out.add((d, i))
                    break
    return out


def test_decontamination_on_documents(spark, docs, sf_small):
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = D.contaminated(docs, bench).collect()
    want = plain_matches([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert {(r.key, r.item_id) for r in got} == want and want
    assert all(r.similarity >= 0.8 and r.hamming <= D.RADIUS for r in got)


def test_item_blocks_are_built_in_tasks(spark, docs, sf_small, monkeypatch):
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    rows = [(r.item_id, D.words_of(r.text)) for r in bench.collect()]
    size = {i: len(w) + 400 for i, w in rows if w}
    whole = {(r.key, r.item_id): tuple(r) for r in D.contaminated(docs, bench).collect()}
    most = sum(size.values()) // 3

    def on_driver(*_):
        raise AssertionError("an index was built on the driver")
    monkeypatch.setattr(D, "index_rows", on_driver)
    blocks = [pickle.loads(r.block) for r in D.item_blocks(bench, "item_id", "text", block_words=most).collect()]
    held = [[p[0] for p in b.prints] for b in blocks]
    assert len(blocks) > 1 and sorted(i for h in held for i in h) == sorted(size)
    assert all(sum(size[i] for i in h[:-1]) <= most for h in held)
    monkeypatch.setattr(D, "BLOCK_WORDS", most)
    assert {(r.key, r.item_id): tuple(r) for r in D.contaminated(docs, bench).collect()} == whole and whole


def test_decontamination_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    items = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, ""), (4, "just three words"), (1, " ".join(words)),
                                   (5, "alpha beta GAMMA delta epsilon zeta")], "item_id long, text string")
    made = spark.createDataFrame([
        (100, "x " * 30 + " ".join(words) + " y" * 30), (101, " ".join(words[:11])), (102, " ".join(words[:5])),
        (103, "here are JUST three\nwords indeed"), (104, None), (105, "")], "doc_id long, text string")
    every = made.unionByName(odd_docs.select("doc_id", "text"))
    want = plain_matches([(r.doc_id, r.text) for r in every.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert {(100, 1), (101, 1), (103, 4), (1, 5), (None, 5)} == want
    assert {(r.key, r.item_id) for r in D.contaminated(every, items).collect()} == want
    monkeypatch.setattr(D, "BLOCK_WORDS", 10)  # an item at a time
    assert {(r.key, r.item_id) for r in D.contaminated(every, items).collect()} == want
    clean = D.decontaminate(odd_docs, items)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count() - 3
    assert D.contaminated(no_docs, items).count() == 0 and D.contaminated(odd_docs, items.limit(0)).count() == 0
    assert D.decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_blocks_cover_the_radius():
    """Pigeonhole: any value within the radius agrees with a listed block value."""
    r = random.Random(3)
    words = [b"w%d" % r.randrange(50) for _ in range(30)]
    items = D.Items([(7, words)])
    rows = {(j, v) for _, j, v, *_ in D.index_rows(items, D.RADIUS)}
    fp = items.prints[0][2] % (1 << 64)
    for _ in range(300):
        x = fp
        for b in r.sample(range(64), D.RADIUS):
            x ^= 1 << b
        assert any((j, x >> a & ((1 << (b - a)) - 1)) in rows for j, (a, b) in enumerate(zip(D._CUTS, D._CUTS[1:])))


def plain_dedup(rows, least=L.MIN_WORDS):
    """All earlier documents of each one, aligned without any candidate search."""
    order = sorted(rows, key=lambda r: r[0])
    lines = [(k, *L.lines_of(t)[:2]) for k, t in order]
    out = {}
    for n, (k, h, w) in enumerate(lines):
        out[k] = sorted({j for _, a, _ in lines[:n] for j in L.common_blocks(a, h, w, least)})
    return out


def test_line_dedup_on_documents(docs):
    want = plain_dedup([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.deleted for r in L.deduplicate(docs).collect()}
    assert got == want and sum(map(len, want.values())) > 10


def test_line_dedup_planted(spark):
    r = random.Random(5)
    line = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    block = [line(20), "", line(20), line(20)]
    common = line(12)
    rows = [(i, "\n".join([common, line(15), *(block if i % 2 else []), line(9), common, line(8)])) for i in range(30)]
    rows += [(40 + i, "\n".join(block)) for i in range(12)] + [(60, line(60)), (61, common)]
    got = {x.doc_id: (x.deleted, x.text) for x in L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_dedup(rows)
    assert {k: v[0] for k, v in got.items()} == want
    assert got[1][0] == [] and got[3][0] == [2, 3, 4, 5] and got[45] == ([0, 1, 2, 3], "") and got[61][0] == []
    text = dict(rows)[3].split("\n")
    assert got[3][1] == "\n".join(text[:2] + text[6:])


def test_line_dedup_reordered_passages(spark):
    """Passages that their first holder has in another order, with more holders than a rare line has."""
    r = random.Random(7)
    line = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    a, b = line(55), line(60)
    rows = [(0, "\n".join([b, line(5), a]))] + [(i, "\n".join([a, line(5), b])) for i in range(1, 7)]
    passages = ["\n".join([line(30), "", line(25)]) for _ in range(5)]
    for i in range(10, 50):
        order = r.sample(passages, r.randint(1, 5))
        rows.append((i, "\n".join(x for p in order for x in (p, line(3), ""))))
    got = {x.doc_id: x.deleted for x in L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_dedup(rows)
    assert len(got[1]) == 1 and all(got[i] == [0, 2] for i in range(2, 7))


def test_line_dedup_with_many_holders(spark, monkeypatch):
    """A passage that many documents hold once and a late one twice: few rounds, the marks of all pairs."""
    r = random.Random(11)
    line = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    passage, rounds = line(55), []
    rows = [(i, "\n".join([line(4), passage, line(3)])) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # copies: one of them stands for all
    rows += [(2000, "\n".join([passage, line(9), passage])), (2001, "\n".join([passage, line(9), passage]))]
    whole = L.materialize

    def noted(df, name):
        rounds.extend([name] if name == "next-holders" else [])
        return whole(df, name)

    monkeypatch.setattr(L, "materialize", noted)
    got = {x.doc_id: x.deleted for x in L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(rounds) <= 6
    some = [rows[0], rows[7], rows[8], *rows[-4:]]
    want = plain_dedup(some)
    assert {k: got[k] for k in want} == want and got[399] == [1]


def test_line_dedup_odd_rows(odd_docs, no_docs):
    got = L.deduplicate(odd_docs).collect()
    assert len(got) == odd_docs.count() and L.deduplicate(no_docs).count() == 0
    by = {(r.doc_id, r.n_lines): r for r in got}
    assert by[(5, 1)].deleted == [] and by[(6, 1)].text == "" and by[(2, 1)].text is None


def test_patience_prefers_unique_lines():
    a, b = [1, 9, 2, 9, 3], [9, 1, 2, 9, 9, 3]
    got = L.patience(a, b)
    assert [a[i] for i, _ in got] == [b[j] for _, j in got]
    assert got == sorted(got) and len(got) >= 4
    assert L.patience([], [1]) == [] and L.patience([5, 5], [5, 5, 5]) in ([(0, 0), (1, 1)], [(0, 0), (1, 2)])


def test_alignment_without_unique_lines():
    """An earlier document with a passage twice and blank lines between; then the heaviest block against all blocks."""
    h, blank, passage, y, z, q, w = range(7)
    earlier, later = [h, blank, passage, y, blank, passage, z], [q, passage, blank, w]
    assert L.common_blocks(earlier, later, [5, 60, 0, 5]) == [1]
    r = random.Random(4)
    for _ in range(2000):
        a, b = ([r.randrange(4) for _ in range(r.randint(1, 12))] for _ in range(2))
        words = [(0, 1, 3, 3)[x] for x in b]
        blocks = [(sum(words[j:j + n]), n) for i in range(len(a)) for j in range(len(b))
                  for n in range(1, min(len(a) - i, len(b) - j) + 1) if a[i:i + n] == b[j:j + n]]
        sums = [sum(words[:j]) for j in range(len(b) + 1)]
        got = L._heaviest_block(a, 0, len(a), b, 0, len(b), sums, 1)
        assert [a[i] for i, _ in got] == [b[j] for _, j in got]
        assert all((k - i, m - j) == (1, 1) for (i, j), (k, m) in zip(got, got[1:]))
        heaviest = max(blocks, default=(0, 0))
        assert (sum(words[j] for _, j in got), len(got)) == (heaviest if heaviest[0] else (0, 0))
