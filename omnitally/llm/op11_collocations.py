"""Phrase collocations from weighted acyclic automata.

Every task counts the n-grams (up to ``width`` words) of bounded blocks of its documents,
sorts them and builds count transducers from them incrementally (``automata``): one for
each prefix range. Transducers of one range are brought together by one shuffle, united,
and their counts summed. The counts of a candidate's parts are looked up by composition: the parts
that a range's candidates ask for form an acceptor for each range that holds them, and the
range's count transducer is composed with the union of those acceptors. A join brings
the counts back to the candidates, which are scored in whole numbers.

A range is an interval of the order (language, first word, second word, ...). Its borders
come from the n-grams of about ``SAMPLE_DOCS`` sampled documents and only balance the
tasks; they never change a result. At most ``MAX_RANGES`` borders are made; larger inputs
split every range further by a hash of the n-gram, so a range's size stays bounded.

Unions keep the counts of at least ``least``: no candidate and no part of one is rarer.

Defined cases: a null or empty text has no words; a null language counts as ``und``; words
are compared as UTF-8 bytes; repeated rows count as often as they occur; an empty table
gives an empty result; other columns are not read. Counts from 10^15 on would leave the
range of the exact arithmetic.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from omnitally.llm import automata as A
from omnitally.llm.common import documents, materialize, spread, text_of

WIDTH = 3
LEAST = 10
INSIDE_PERCENT = 50
TOP = 2000
BLOCK_WORDS = 2_000_000
PIECE_ROWS = 1 << 17
RANGE_GRAMS = 4_000_000
MAX_RANGES = 4096
SAMPLE_DOCS = 2000
SAMPLE_STEP = 7

_GAP = b"."
_ENDS = bytes.maketrans(b".,;:!?\n\v\f\r", _GAP * 10)
_PIECE = pa.schema([("cell", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("blob", pa.binary())])
_PIECE_DDL = "cell long, lang string, words long, blob binary"

Border = tuple  # (language, word, word, ...)


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words, with ``.`` where a piece ends."""
    return text.lower().translate(_ENDS).replace(_GAP, b" . ").split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Block:
    """Words of documents of one language, numbered; the gap is number 0."""

    def __init__(self) -> None:
        self.numbers, self.parts = _Numbers({_GAP: 0}), []

    def add(self, text: bytes) -> int:
        found = tokens(text)
        found.append(_GAP)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        return len(found)

    def grams(self, width: int) -> tuple[list[bytes], np.ndarray, np.ndarray, int]:
        """Sorted words, sorted n-gram rows, their counts, and the number of words."""
        del self.numbers[_GAP]
        words = sorted(self.numbers)
        rank = np.empty(len(words) + 1, dtype=np.int64)
        rank[0] = -1
        rank[np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        x = rank[np.concatenate(self.parts)]
        gram, rows, counts = x, [], []
        if len(words):
            rows.append(np.arange(len(words), dtype=np.int32)[:, None])
            counts.append(np.bincount(x[x >= 0], minlength=len(words)))
        for size in range(2, width + 1):
            tail = x[size - 1:]
            ok = np.flatnonzero((gram[:-1] >= 0) & (tail >= 0))
            key, at, n = np.unique(gram[ok] * max(1, len(words)) + tail[ok], return_inverse=True, return_counts=True)
            gram = np.full(len(tail), -1)
            gram[ok] = at
            if len(key):
                before, last = np.divmod(key, len(words))
                rows.append(np.column_stack([rows[-1][before], last.astype(np.int32)]))
                counts.append(n)
        wide = [np.pad(r, ((0, 0), (0, width - r.shape[1])), constant_values=-1) for r in rows]
        all_rows = np.concatenate(wide) if wide else np.empty((0, width), dtype=np.int32)
        by, _ = A.order(all_rows, len(words))
        n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
        return words, all_rows[by], n[by], int((x >= 0).sum())


def pieces(lang: str, words: list[bytes], rows: np.ndarray, n: np.ndarray, borders: list[Border],
           split: int) -> Iterator[tuple[int, bytes]]:
    """(cell, automaton) of sorted rows: cut at the borders, then by hash into ``split`` cells."""
    cuts = [bisect_left(range(len(rows)), b, key=lambda i: (lang, *[words[w] for w in rows[i].tolist() if w >= 0]))
            for b in borders]
    hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) if split > 1 else None
    for r, (start, end) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        if start == end:
            continue
        part, counts = rows[start:end], n[start:end]
        cell = np.zeros(end - start, dtype=np.int64)
        if split > 1:
            mixed = np.zeros(end - start, dtype=np.uint64)
            for column in part.T:
                mixed = mixed * np.uint64(1_000_003) + np.where(column >= 0, hashes[column] + np.uint64(1), np.uint64(0))
            cell = (mixed % np.uint64(split)).astype(np.int64)
        for c in np.unique(cell).tolist():
            own = np.flatnonzero(cell == c) if split > 1 else np.arange(end - start)
            for at in range(0, len(own), PIECE_ROWS):
                i = own[at:at + PIECE_ROWS]
                yield r * split + c, A.build(words, part[i], counts[i])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    langs = batch.column("lang").to_pylist()
    for lang, text in zip(langs, batch.column("text").cast(pa.binary())):
        yield lang, text.as_py()


def shard_transducers(docs: DataFrame, borders: list[Border], split: int, width: int, block_words: int) -> DataFrame:
    """Count transducers (cell, lang, words, blob) of blocks of ``docs`` (lang, text).

    ``words`` is the number of words of a block and language, on its first piece.
    """
    def flush(blocks: dict[str, Block]) -> Iterator[pa.RecordBatch]:
        for lang, block in blocks.items():
            words, rows, n, total = block.grams(width)
            for cell, blob in pieces(lang, words, rows, n, borders, split):
                yield _table([(cell, lang, total, blob)])
                total = 0

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held = {}, 0
        for batch in batches:
            for lang, text in _texts(batch):
                held += blocks.setdefault(lang, Block()).add(text)
                if held >= block_words:
                    full, blocks, held = blocks, {}, 0
                    yield from flush(full)
        yield from flush(blocks)

    return docs.mapInArrow(count, _PIECE_DDL)


def range_borders(docs: DataFrame, width: int, range_grams: int, max_ranges: int) -> tuple[list[Border], int]:
    """Borders of the prefix ranges and the number of hash cells that each is split into."""
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    # A word and its gap take six bytes or so; each word starts up to ``width`` n-grams.
    cells = max(1, -(-(size["bytes"] or 0) * width // (6 * range_grams)))
    ranges = min(cells, max_ranges)
    if ranges == 1:
        return [], cells
    names = [f"w{i}" for i in range(width)]
    schema = pa.schema([("lang", pa.string()), *[(c, pa.binary()) for c in names]])

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in _texts(batch):
                words = tokens(text)
                grams = [(lang, *words[i:i + k], *[None] * (width - k)) for k in range(1, width + 1)
                         for i in range(0, len(words) - k + 1, SAMPLE_STEP) if _GAP not in words[i:i + k]]
                if grams:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*grams), schema)], schema=schema)

    some = docs.sample(min(1.0, SAMPLE_DOCS / size["rows"]), seed=11)
    keys = some.mapInArrow(sample, "lang string, " + ", ".join(f"{c} binary" for c in names))
    dealt = keys.repartitionByRange(ranges, "lang", *names).withColumn("part", F.spark_partition_id())
    least = dealt.groupBy("part").agg(F.min(F.struct("lang", *names)).alias("b")).select("b.*").collect()
    found = sorted((r.lang, *[bytes(r[c]) for c in names if r[c] is not None]) for r in least)
    return found[1:], -(-cells // ranges)


def unite(shards: DataFrame, least: int) -> DataFrame:
    """One union transducer (or a few pieces of it) for each cell and language."""
    def one(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, own in part.groupby("lang", sort=True):
            words, rows, n = A.union([A.read(b) for b in own["blob"]], least)
            cell, total = int(own["cell"].iloc[0]), int(own["words"].sum())
            for _, blob in pieces(lang, words, rows, n, [], 1):
                out.append((cell, lang, total, blob))
                total = 0
            if total:
                out.append((cell, lang, total, None))
        # Plain Python strings: columns of pandas' own string type may reach Arrow in chunks.
        return pd.DataFrame(out, columns=_PIECE.names, dtype=object)

    return spread(shards, F.col("cell")).groupBy("cell").applyInPandas(one, _PIECE_DDL)


def phrases(united: DataFrame) -> DataFrame:
    """(lang, phrase, size, a) of every n-gram of at least two words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("size", pa.int32()), ("a", pa.int64())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
                t = A.read(blob)
                rows, n = A.rows_of(t)
                size = (rows >= 0).sum(axis=1)
                keep = size > 1
                text = [b" ".join([t.words[w] for w in r if w >= 0]) for r in rows[keep].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(text), pa.string()), pa.array(text, pa.binary()),
                     pa.array(size[keep].astype(np.int32)), pa.array(n[keep])], schema=schema)

    found = united.where("blob is not null").mapInArrow(read, "lang string, phrase binary, size int, a long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def _parts(rows: np.ndarray, words: int) -> np.ndarray:
    """All first and last parts of the rows, sorted, each once."""
    width, size, out = rows.shape[1], (rows >= 0).sum(axis=1), []
    for k in range(1, width):
        own = rows[size > k]
        first, last = own.copy(), np.full_like(own, -1)
        first[:, k:] = -1
        last[:, :width - k] = own[:, k:]
        out += [first, last]
    both = np.concatenate(out)
    by, key = A.order(both, words)
    return both[by[np.append(True, np.diff(key[by]) != 0)[:len(by)]]]


def part_counts(united: DataFrame, borders: list[Border], split: int) -> DataFrame:
    """(lang, part, f) of every part of a phrase, by composing the transducers of its cell."""
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
                t = A.read(blob)
                rows = _parts(A.rows_of(t)[0], len(t.words))
                for cell, wanted in pieces(lang, t.words, rows, np.ones(len(rows), dtype=np.int64), borders, split):
                    yield _table([(cell, lang, 0, wanted)])

    def look(wanted: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        langs, texts, counts_of = [], [], []
        for lang, asked in wanted.groupby("lang", sort=True):
            words, rows, n = A.union([A.read(b) for b in asked["blob"]])
            acceptors = [A.read(b) for _, b in pieces(lang, words, rows, n, [], 1)]
            for blob in held.loc[held["lang"] == lang, "blob"]:
                counts = A.read(blob)
                for acceptor in acceptors:
                    found, f = A.compose(counts, acceptor)
                    langs += [lang] * len(found)
                    texts += [b" ".join([counts.words[w] for w in r if w >= 0]) for r in found.tolist()]
                    counts_of += f.tolist()
        return pd.DataFrame({"lang": pd.Series(langs, dtype=object), "part": pd.Series(texts, dtype=object), "f": counts_of})

    full = united.where("blob is not null")
    found = full.mapInArrow(ask, _PIECE_DDL).groupBy("cell").cogroup(full.groupBy("cell")).applyInPandas(
        look, "lang string, part binary, f long")
    return found.withColumn("part", F.col("part").cast("string"))



def score_of(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), in decimals of 38 digits."""
    a, left, right = (f"cast({c} as decimal(15,0))" for c in (a, left, right))
    return F.expr(f"cast(1000000 as decimal(7,0)) * {a} * {a} div ({left} * {right})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", width: int = WIDTH, least: int = LEAST,
                 inside_percent: int = INSIDE_PERCENT, block_words: int = BLOCK_WORDS,
                 range_grams: int = RANGE_GRAMS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of every candidate that no longer one covers."""
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    borders, split = range_borders(docs, width, range_grams, max_ranges)
    united = materialize(unite(shard_transducers(docs, borders, split, width, block_words), least), "ngram-unions")
    counts = materialize(part_counts(united, borders, split), "ngram-parts")
    found = materialize(phrases(united), "ngram-phrases")
    totals = united.groupBy("lang").agg(F.sum("words").alias("n"))

    words = F.split("phrase", " ")

    def some(first, size):
        return F.array_join(F.slice(words, first, size), " ")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: some(i, k))))
    longer = (found.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        f"longer is null or cast(100 as decimal(20,0)) * longer < cast({inside_percent} as decimal(20,0)) * a").drop("longer")

    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), some(F.lit(1), k).alias("first"), some(k + 1, F.col("size") - k).alias("last"))))
    cuts = kept.withColumn("cut", cut).select("lang", "phrase", "size", "a", "cut.*")
    cuts = cuts.join(counts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("part").alias("last"), F.col("f").alias("r")), ["lang", "last"])
    lowest = cuts.groupBy("lang", "phrase", "size", "a").agg(
        F.min(F.struct(score_of("a", "l", "r").alias("score"), "k", "l", "r")).alias("s"))
    return lowest.join(totals, "lang").select("lang", "phrase", "size", "a", "s.l", "s.r", "n", "s.score")


def top(scored: DataFrame, most: int = TOP) -> DataFrame:
    """Each language's first ``most`` by score, count and phrase, with their rank."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    out = top(collocations(documents(spark, sf_dir, "text", "lang")))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH w AS (
  SELECT doc, lang, piece, unnest(words) AS word, generate_subscripts(words, 1) AS i
  FROM (SELECT doc, lang, generate_subscripts(pieces, 1) AS piece,
               list_filter(string_split_regex(unnest(pieces), '[ \t]+'), lambda x: x <> '') AS words
        FROM (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                     string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]') AS pieces
              FROM documents))),
g AS (SELECT lang, word AS w1, lead(word) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM w
      WINDOW p AS (PARTITION BY doc, piece ORDER BY i)),
f AS (SELECT lang, w1 AS phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL
      UNION ALL SELECT lang, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE f >= 10 AND contains(phrase, ' ')),
kept AS (SELECT * FROM c WHERE NOT EXISTS (
  SELECT 1 FROM c AS t WHERE len(t.ws) = 3 AND len(c.ws) = 2 AND t.lang = c.lang AND 100 * t.a >= 50 * c.a
    AND c.phrase = t.ws[1] || ' ' || t.ws[2])
  AND NOT EXISTS (
  SELECT 1 FROM c AS t WHERE len(t.ws) = 3 AND len(c.ws) = 2 AND t.lang = c.lang AND 100 * t.a >= 50 * c.a
    AND c.phrase = t.ws[2] || ' ' || t.ws[3])),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, ws[1] AS first, array_to_string(ws[2:], ' ') AS last FROM kept
  UNION ALL SELECT lang, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM kept WHERE len(ws) = 3),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = first JOIN f AS y ON y.lang = cuts.lang AND y.phrase = last),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
           FROM best WHERE cut = 1),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
