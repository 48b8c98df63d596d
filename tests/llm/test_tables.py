"""Chats, tokens, shards, mixing, quality rules and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from omnitally.llm import op2_chat as C
from omnitally.llm import op5_tokens as K
from omnitally.llm import op7_sharding as S
from omnitally.llm import op8_mixing as M
from omnitally.llm import op10_quality as Q
from omnitally.llm.wavelet import WaveletMatrix, encode
from tools.oracle_check import digest, duck


def test_oracles(spark, sf_small):
    from omnitally.llm.catalog import ORACLES, QUERIES
    con = duck(sf_small)
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf_small)
        rows = [tuple(r) for r in df.collect()]
        rel = con.sql(sql)
        assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0], name


def plain_tree(nodes):
    """Best path of each tree by mean score, length, smaller leaf."""
    known = {(t, n) for t, n, *_ in nodes}
    parent = {(t, n): (t, p) if (t, p) in known else None for t, n, p, *_ in nodes}
    score = {(t, n): s for t, n, _, s, *_ in nodes}
    inner = {p for p in parent.values() if p}
    best = {}
    for key in parent:
        if key in inner:
            continue
        path, at = [], key
        while at is not None and len(path) <= len(nodes):
            path.append(at)
            at = parent[at]
        if at is not None:
            continue
        rank = (-sum(score[x] for x in path) / len(path), -len(path), key[1])
        if key[0] not in best or rank < best[key[0]][0]:
            best[key[0]] = rank, [x[1] for x in reversed(path)]
    return {t: p for t, (_, p) in best.items()}


def test_paths_of_random_trees(spark):
    r = random.Random(2)
    nodes = []
    for t in range(12):
        for n in range(r.choice([1, 5, 40])):
            parent = r.randrange(n) if n and r.random() > 0.1 else None
            nodes.append((f"t{t}", n, parent, float(r.randint(0, 9))))
    nodes += [("chain", n, n - 1 if n else None, 1.0) for n in range(70)]
    nodes += [("orphan", 5, 99, 1.0), ("cycle", 1, 2, 1.0), ("cycle", 2, 1, 1.0), ("cycle", 3, None, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = {}
    for x in sorted(C.paths(df).collect(), key=lambda x: x.place):
        got.setdefault(x.tree, []).append(x.node)
    assert got == plain_tree(nodes)
    ranks = C.paths(df, top=3).groupBy("tree").agg({"rank": "max"}).collect()
    assert max(x[1] for x in ranks) == 3


def test_odd_nodes(spark):
    """Null trees, repeated nodes, null scores and null node ids, by the docstring."""
    nodes = [(None, 1, None, 1.0, "user", "a"), (None, 2, 1, None, "assistant", "b"), ("null", 1, None, 5.0, "user", "n"),
             ("r", 1, None, 1.0, "user", "x"), ("r", 1, None, 2.0, "user", "y"), ("r", 2, 1, 3.0, "assistant", "z"), ("r", 2, 1, 3.0, "assistant", "z"),
             ("r", None, 1, 9.0, "user", "gone"), ("s", 1, None, None, "user", "s1"), ("s", 2, 1, None, None, None), ("s", 3, 1, 1.0, "user", "s3")]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double, role string, text string")
    got = {r.tree: ([(t.role, t.text) for t in r.turns], r.score) for r in C.format_paths(df).select(
        "tree", "score", C.read_turns(C.F.col("formatted")).alias("turns")).collect()}
    assert got == {None: ([("user", "a"), ("assistant", "b")], 0.5), "null": ([("user", "n")], 5.0),
                   "r": ([("user", "y"), ("assistant", "z")], 2.5), "s": ([("user", "s1"), ("user", "s3")], 0.5)}


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "a\\b\\.\\n\\\\", "<|im_end|>\n<|im_start|>user\nhi", "<<SYS>><</SYS>><s>",
                                  "", None, "line\nline\\", "<", "|<|<||>", "\\.<|im_end|"])
def test_template_is_reversible(spark, text):
    df = spark.createDataFrame([("t", 1, None, 1.0, text, text), ("t", 2, 1, 1.0, "assistant", text)],
                               "tree string, node long, parent long, score double, role string, text string")
    out = C.format_paths(df).first()
    assert "".join(s.text for s in out.segments) == out.formatted and out.formatted.count("<|im_start|>") == 2
    back = C.format_paths(df).select(C.read_turns(C.F.col("formatted")).alias("t")).first().t
    assert [(x.role, x.text) for x in back] == [(text or "", text or ""), ("assistant", text or "")]
    for control in ("[INST]", "</s>", "<<SYS>>"):
        assert control not in out.formatted


def test_chat_odd_rows(spark):
    rows = spark.createDataFrame([(1, 0, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "b"),
                                  (2, None, "assistant", "")], "conv_id long, turn long, role string, text string")
    out = {r.tree: r for r in C.format_paths(C.reply_nodes(rows)).collect()}
    assert set(out) == {"1", "2", "null"} and out["1"].formatted.count("<|im_start|>") == 3
    assert C.format_paths(C.reply_nodes(rows.limit(0))).count() == 0


def test_wavelet_matrix():
    r = np.random.default_rng(0)
    x = np.concatenate([r.integers(0, 50, 3000), r.integers(0, 50257, 2000), [2]]).astype(np.uint32)
    w = WaveletMatrix(encode(x, np.array([len(x) - 1, 1])))
    assert (w.tokens() == x).all() and w.doc_lengths.tolist() == [len(x) - 1, 1]
    assert [w.access(i) for i in range(0, len(x), 97)] == x[::97].tolist()
    for token in (0, 2, 49, 50256, 50257, 65535, 70000):
        at = np.flatnonzero(x == token)
        assert w.count(token) == len(at) and w.count(token, 2500) == (at < 2500).sum()
        assert [w.locate(token, k) for k in range(min(len(at), 5))] == at[:5].tolist()
    assert (WaveletMatrix(encode(np.array([7]), np.array([1]))).tokens() == [7]).all()
    wide = np.array([1 << 20, 3, 0], dtype=np.uint32)
    assert (WaveletMatrix(encode(wide, np.array([3]))).tokens() == wide).all()
    with pytest.raises(ValueError):
        WaveletMatrix(b"nope")


def plain_tokens(rows):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_tokens_on_documents(docs):
    want = plain_tokens([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, K.write_and_read(docs, shard_tokens=5000).collect())) == want


def test_encoder_equals_the_library():
    e = K.Encoder()
    for t in ["a b  c", " a", "a ", "a\n b\n\nc d", "it's we'll, x.y! z?", "ünï çé 12 34.5", "a <|endoftext|> b", "　x \xa0y", "",
              "word, word. (word) 3, é! ́. x́, a.", "\t a", "x  y"]:
        assert e.ids(t).tolist() == [*e.whole(t), 2], t


def test_encoder_keeps_no_pairs_of_lines():
    """Pairs of words over a line's end are put together from their parts and take no room from words."""
    e = K.Encoder()
    for text in ("a word.\nNext, é.\nZ", "one Line\nTwo! (x) don't.\nI've ééé", "x end,\nfoo) bar.\n\nY"):
        assert list(e.ids(text)[:-1]) == e.whole(text)
    assert "word.\nNext," not in e and "Line\nTwo!" not in e and "word" in e


def test_encoder_keeps_no_words_with_runs_of_signs_once_full(monkeypatch):
    """Letters with signs after them, and words over line ends, are put together from their parts in any Latin script."""
    monkeypatch.setattr(K, "CACHE", 12)
    e, asked = K.Encoder(), []
    for text in ("a THREHA!! È.!! hesh,### os.\nÓími", "ñ fue.\"\nÑes.\nIs, x", "a d'or.'s l'\n's ***\n*a", "Zé!!\nB\n\nC y\t\nz \nw",
                 "ªº ǅa. don't!! 'll've a\u0345. x\u0301!"):
        assert list(e.ids(text)[:-1]) == e.whole(text), text
    monkeypatch.setattr(K, "CACHE", 500_000)
    e = K.Encoder()
    e.CUT = type("Cut", (), {"findall": lambda self, t: asked.append(t) or K.Encoder.CUT.findall(t)})()
    e.ids("a THREHA!! È.!! hesh,### os.\nÓími Ñes.\nIs, oferhaouti.***")
    assert not asked  # the pattern was asked for each of these words before
    assert "os.\nÓími" not in e and "THREHA" in e and "Ñes" in e


def test_encoder_cuts_as_the_library_does():
    e, rng = K.Encoder(), random.Random(5)
    texts = [t for c in map(chr, range(0x260))
             for t in (f"a b{c}c", f"x 1{c}2", f"x {c}{c}a'{c}", f"x .{c}.", f"{c}a {c}", f"q a{c} b", f"'s{c} 't {c}ll")]
    parts = [*"ab1.,'s \n\t\r\x1c\x85\xa0éßµªº²½×|<>\u2003\u3000中ǅ😀", "e\u0308", "<|endoftext|>", " the", "'ll"]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(20_000)]
    assert [t for t in texts if e.ids(t).tolist() != [*e.whole(t), K.END_ID]] == []


def test_tokens_odd_rows(odd_docs, no_docs):
    got = K.write_and_read(odd_docs).collect()
    want = plain_tokens([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, n, c) for d, _, n, c in want)
    ends = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:])) and ends[0][0] == 0
    assert K.write_and_read(no_docs).count() == 0


def check_shards(rows, leaves, slack):
    size = Counter()
    slots = {}
    for r in rows:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(size) <= set(range(leaves))
    return max(size.values()) - min([size[i] for i in range(leaves)]) <= slack


def test_shards_are_balanced(spark, docs):
    many = docs.crossJoin(spark.range(10)).drop("id")
    dims = {"source": S.code("source"), "lang": S.code("lang"), "n_chars": S.F.col("n_chars")}
    rows = S.with_slots(S.kd_shards(many, dims)).collect()
    assert len(rows) == many.count()
    largest = max(r.size for r in rows)
    assert check_shards(rows, 24, 2 * largest + 0.02 * sum(r.size for r in rows) / 24)
    by_bytes = S.kd_shards(docs, dims, leaves=None, target_bytes=100_000)
    total = sum(r.size for r in by_bytes.collect())
    assert by_bytes.select("shard").distinct().count() == -(-total // 100_000)


def plain_kd_tree(rows, leaves, dims):
    """Leaf of every row (by its row number), from a k-d tree with exact weighted medians."""
    def ends(part, d):
        return min(r[d] for r in part), max(r[d] for r in part)

    whole = {d: ends(rows, d) for d in dims}
    leaf = {}

    def split(part, share, begin):
        if share == 1 or not part:
            leaf.update({r.row: begin for r in part})
            return
        widths = [(ends(part, d)[1] - ends(part, d)[0]) / max(1, whole[d][1] - whole[d][0]) for d in dims]
        dim = dims[widths.index(max(widths))]
        part = sorted(part, key=lambda r: (r[dim], r.hash, r.row))
        need = sum(r.size for r in part) * (share // 2) / share
        before = at = 0
        while before + part[at].size < need:
            before += part[at].size
            at += 1
        at += 2 * (need - before) >= part[at].size  # the row on the cut goes to the side it fits better
        split(part[:at], share // 2, begin)
        split(part[at:], share - share // 2, begin + share // 2)

    split(rows, leaves, 0)
    return leaf


@pytest.mark.parametrize("leaves", [2, 5, 7])
def test_shards_equal_a_plain_tree(spark, docs, monkeypatch, leaves):
    monkeypatch.setattr(S, "TOLERANCE", 0.0)  # cuts are exact, to the row
    copies = docs.where("doc_id < 40").drop("id").crossJoin(spark.range(8)).drop("id")  # equal rows lie on cuts
    every = docs.select(copies.columns).union(copies)
    dims = {"source": S.code("source"), "lang": S.code("lang"), "n_chars": S.F.col("n_chars")}
    rows = S.kd_shards(every, dims, leaves=leaves).collect()
    got = {r.row: r.shard for r in rows}
    want = plain_kd_tree(rows, leaves, ["dim0", "dim1", "dim2"])
    assert len(got) == len(rows) == every.count() and got == want and set(got.values()) == set(range(leaves))


def test_node_lists_are_folded(spark):
    n = 5_000
    longs, flags = [None if i % 7 == 0 else i * (1 << 49) for i in range(n)], [i % 3 == 0 for i in range(n)]
    parts = [i / 3 for i in range(n)]
    nodes = spark.range(n).withColumnRenamed("id", "node")
    out = nodes.select("node", S._by_node(longs, "long").alias("a"), S._by_node(flags, "boolean").alias("b"), S._by_node(parts, "double").alias("c"))
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.orderBy("node").collect()] == list(zip(range(n), longs, flags, parts))


def test_shards_cut_equal_rows(spark):
    same = spark.range(480).selectExpr("cast(null as long) as doc_id", "'same text' as text", "'s' as source", "9L as n_chars")
    rows = S.with_slots(S.kd_shards(same, {"source": S.code("source"), "n": S.F.col("n_chars")})).collect()
    assert check_shards(rows, 24, 2 * 17)


def test_shards_odd_rows(odd_docs, no_docs):
    dims = {"source": S.code("source"), "n": S.F.col("n_chars")}
    rows = S.with_slots(S.kd_shards(odd_docs, dims, leaves=5)).collect()
    assert len(rows) == odd_docs.count()
    check_shards(rows, 5, 1e9)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert S.with_slots(S.kd_shards(no_docs, dims)).count() == 0


def test_mix_meets_targets(spark, docs):
    rows = docs.select("doc_id", "source", M.word_count("text").alias("size"), M.random_key("doc_id", "text", "source").alias("key"))
    got = M.plan_mix(rows).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(taken[s] == round(t) for s, t in target.items())
    mixed = M.mixed_rows(docs).collect()
    words = Counter()
    for r in mixed:
        words[r.source] += len(r.text.encode().split())
    assert words == Counter({s: n for s, n in taken.items() if n})


def test_mix_keeps_all_columns_of_repeated_rows(spark):
    """Rows alike in id, text and source but not in other columns stay apart; runs agree."""
    rows = [(1, "a b c d", "s", "en", 1), (1, "a b c d", "s", "de", 1), (1, "a b c d", "s", "de", 1), (2, "x y", "s", None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n long")
    first, again = (sorted(map(str, M.mixed_rows(df.repartition(n)).collect())) for n in (1, 5))
    assert first == again and len({r.lang for r in M.mixed_rows(df).collect()}) == 3
    counts = spark.createDataFrame([("a  b\tc\n",), ("",), (None,), ("\u00a0 \u2003x",), (" \v\f\r ",)], "t string")
    assert [r.n for r in counts.select(M.word_count("t").alias("n")).collect()] == [3, 0, 0, 2, 0]


def test_mix_odd_rows(odd_docs, no_docs):
    mixed = M.mixed_rows(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.where("text is null").count() == 0
    total = sum(len((r.text or "").encode().split()) for r in odd_docs.collect())
    assert abs(sum(len(r.text.encode().split()) for r in mixed.collect()) - 1.5 * total) <= 3
    assert M.mixed_rows(no_docs).count() == 0


def plain_measures(text):
    import re
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text or "")
    lines = [x for x in (text or "").split("\n") if word.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures(spark, sf_small, docs):
    from omnitally.llm.catalog import QUERIES
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op10_quality_fences"](spark, sf_small).collect()
    assert len(rows) == len(text)
    for r in rows:
        m = plain_measures(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.base_failed and r.kept)
    for t in ["a b c a b c a b", "x\n x\nx\n\n \nx", "a a a a a", "é ü z # *"]:
        assert Q.measure_text(t)[:5] == plain_measures(t)


def test_fences_adapt_to_the_group(spark):
    """A rate that is usual in one source and odd in another is judged by its own source."""
    r = random.Random(1)
    words = lambda n: ["".join(r.choices("abcdefghij", k=r.randint(3, 8))) for _ in range(n)]
    plain = [(i, " ".join(words(80)), "en", "prose") for i in range(300)]
    table = [(1000 + i, " ".join(f"{w} |" for w in words(80)), "en", "tables") for i in range(300)]
    odd = [(5000, " ".join(f"{w} ||||" for w in words(80)), "en", "prose")]
    df = spark.createDataFrame(plain + table + odd, "doc_id long, text string, lang string, source string")
    kept = {x.doc_id for x in Q.quality_filter(df).collect()}
    assert kept == {x[0] for x in plain + table}


def test_fences_hold_in_a_source_full_of_junk(spark):
    """Junk of a fifth to a third of a source goes, as it does from a clean source; the rest stays."""
    r = random.Random(3)
    words = lambda n: ["".join(r.choices("abcdefghij", k=r.randint(3, 8))) for _ in range(n)]
    line = lambda: " ".join(words(8))

    def junk(i):
        if i % 3 == 0:
            return " ".join(f"{w} |||" for w in words(80))  # symbols
        same = line() if i % 3 == 1 else " ".join(words(4))
        # Half the lines are one line, or a third of the words one phrase.
        return "\n".join(x for _ in range(8) for x in (line(), same))

    rows, bad = [], set()
    for source, share in (("clean", 0.01), ("hot", 0.15), ("hotter", 0.3)):
        for i in range(400):
            n = len(rows)
            if i < 400 * share:
                bad.add(n)
                rows.append((n, junk(0) if source == "hotter" else junk(i), "en", source))
            else:
                rows.append((n, "\n".join(line() for _ in range(12)), "en", source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {x.doc_id for x in Q.quality_filter(df).collect()} == {n for n, *_ in rows} - bad


def plain_fences(rows, least):
    """Fences by plain quantiles: the smallest value whose rank reaches the share."""
    def rates(t):
        n, chars, _, dup, repeat, lines, marks, upper, distinct = Q.measure_text(t)
        return {"mark_rate": marks / chars, "upper_rate": upper / chars, "word_length": chars / n,
                "distinct_rate": math.log(distinct) / math.log(n), "dup_line_rate": dup / lines, "repeat_rate": repeat / n}

    passed = [(lang, source, rates(t)) for t, lang, source in rows
              if plain_measures(t)[0] >= 50 and 100 * plain_measures(t)[4] <= 50 * plain_measures(t)[0]]
    out = {}
    for lang, source in {x[1:] for x in rows}:
        for k, (sides, spread) in Q.RATES.items():
            for near in (lambda a, b: (a, b) == (lang, source), lambda a, b: a == lang, lambda a, b: True):
                v = sorted(r[k] for a, b, r in passed if near(a, b) and (sides != "rare" or r[k] > 0))
                if len(v) >= least:
                    break
            if v:
                q = {p: v[max(0, math.ceil(p * len(v) / 100) - 1)] for p in (20, 25, 40, 50, 60, 75, 80)}
                high = q[75] + 3 * max(q[75] - q[25], q[25]) if sides == "rare" else q[50] + Q.REACH * max(q[60] - q[20], spread)
                low = q[50] - Q.REACH * max(q[80] - q[40], spread)
                out[lang, source, k] = (low if sides in ("low", "both") else None, high if sides != "low" else None)
    return passed, out, rates


@pytest.mark.parametrize("least", [1, 12, 40, 1000])
def test_verdicts_equal_plain_quantiles(spark, docs, least):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()] + [("a b", None, "s"), (docs.first().text, "en", None)]
    _, want, rates = plain_fences(rows, least)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    measured = df.select("doc_id", "lang", "source", Q.measures("text").alias("q"))
    table = Q.fences(measured, least)
    got = {(r.lang, r.source, k): tuple(r.fence[k]) for r in table.collect() for k in Q.RATES if r.fence[k] is not None}
    near = lambda a, b: a is b is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    assert got.keys() == want.keys() and all(near(x, y) for k in got for x, y in zip(got[k], want[k]))
    for r in Q.judge(measured, table).collect():
        text, lang, source = rows[r.doc_id]
        base = plain_measures(text)[0] < 50 or 100 * plain_measures(text)[4] > 50 * plain_measures(text)[0]
        inside = base or all((low is None or rates(text)[k] >= low) and (high is None or rates(text)[k] <= high)
                             for k in Q.RATES for low, high in [got.get((lang, source, k), (None, None))])
        assert (r.base_failed, r.kept) == (base, not base and inside)


def test_fences_follow_the_data(spark):
    """At sf0.1 the fences differ between groups, and the least spread counts in few of them."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    measured = Q.materialize(docs.select("doc_id", "lang", "source", Q.measures("text").alias("q")), "test-quality")
    table = Q.fences(measured).collect()
    for k, (sides, least) in Q.RATES.items():
        assert len({(r.lang, *r.fence[k]) for r in table}) >= 4 or sides == "rare"
        if sides != "rare":
            wide = Q.fences(measured, reach=0.0).collect()
            middle = {(r.lang, r.source): r.fence[k] for r in wide}
            floors = sum(abs((r.fence[k].high or r.fence[k].low) - (middle[r.lang, r.source].high or middle[r.lang, r.source].low))
                         <= Q.REACH * least * 1.0001 for r in table)
            assert floors < len(table) / 10
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(r.kept, r.base_failed, labels[r.doc_id]) for r in Q.judge(measured, Q.fences(measured)).collect() if r.doc_id in labels]
    assert not any(kept for kept, _, quality in judged if quality == 0)
    clean = [kept for kept, failed, quality in judged if quality == 1 and not failed]
    assert sum(clean) > 0.98 * len(clean)


def test_quality_of_texts_without_words(spark, tmp_path):
    """Texts without words or lines have no rates: they fail the base rule and stop nothing, also where a group has no other text."""
    from omnitally.llm.catalog import QUERIES
    words = " ".join(f"word{n}" for n in range(60))
    rows = [(n, words + f" more{n}", "en", f"s{n % 3}") for n in range(30)] + [(100, "", "en", "s0"), (101, None, "fr", None), (102, " \n\t ", None, "s1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    judged = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in QUERIES["op10_quality_fences"](spark, str(tmp_path)).collect()}
    assert {n: judged[n] for n in (100, 101, 102)} == dict.fromkeys((100, 101, 102), (0, True, False))
    assert all(judged[n] == (61, False, True) for n in range(30)) and len(judged) == 33


def test_quality_odd_rows(odd_docs, no_docs):
    kept = Q.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() <= odd_docs.count() and Q.quality_filter(no_docs).count() == 0


def test_pipeline_steps(spark, docs, sf_small):
    """Every stage against its operator's brute force on what the one before kept."""
    import corpus_pipeline as P
    from .test_near_copies import plain_components, plain_fingerprint, plain_matches
    state, seen = docs, {}
    for name, stage in P.STAGES:
        state = P.materialize(stage(spark, state, sf_small), "test-stage")
        seen[name] = state.collect()
        if name != "tokens":
            assert state.columns == docs.columns
    start = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in seen["quality"]} < start
    prints = {r.doc_id: plain_fingerprint(r.text) for r in seen["quality"]}
    root = plain_components(list(prints.values()))
    least = {}
    for d, f in prints.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert {r.doc_id for r in seen["near_duplicates"]} == set(least.values())
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    bad = {d for d, _ in plain_matches([(r.doc_id, r.text) for r in seen["near_duplicates"]], bench)}
    assert {r.doc_id for r in seen["decontamination"]} == set(least.values()) - bad
    total = sum(len(r.text.encode().split()) for r in seen["decontamination"])
    assert abs(sum(len(r.text.encode().split()) for r in seen["mixing"]) - 1.5 * total) <= 20
    want = plain_tokens([(r.doc_id, r.text) for r in seen["mixing"]])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in seen["tokens"]) == Counter((d, n, c) for d, _, n, c in want)
    ends = sorted((r.start, r.n_tokens) for r in seen["tokens"])
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_text_digests_of_chats(spark, sf_small):
    """Turn and loss digests straight from the table, in Python."""
    from omnitally.llm.catalog import QUERIES
    convs = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(spark.read.parquet(f"{sf_small}/conversations.parquet").collect(), key=lambda r: r.turn):
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    for r in QUERIES["op2_chat_trees"](spark, sf_small).collect():
        turns = convs[r.conv_id]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
