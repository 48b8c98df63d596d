"""Benchmark decontamination by SimHash of item-sized windows.

1. Every benchmark item gets a 64-bit SimHash over its five-word shingles, weighted by how
   often each occurs, and an entry in a multi-index: the bits are cut into blocks, and the
   entry lists every block value within ``radius // BLOCKS`` bits of the item's. If two
   fingerprints differ in at most ``radius`` bits, one block differs in at most that many
   (pigeonhole), so looking up each block of a window finds every item within the radius.
2. Documents are read in windows as long as an item, one at every word. A window that has
   no shingle of any item of its length cannot reach a similarity above zero, so only
   windows over such a shingle are hashed and handed on.
3. Each window's blocks are looked up in the index, the Hamming distance of the whole
   fingerprints is checked, and the weighted Jaccard similarity of the shingles themselves
   (sum of minima over sum of maxima of their counts) must be at least 0.8.

The items are worked off in blocks of about ``BLOCK_WORDS`` words (a longer item is a block of
its own), so that what a block sends to the executors has a fixed bound however large the
benchmark is. Tasks build the blocks' indexes and write them to the shared folder; the driver
builds none and hands on one block's bytes at a time. A task looks the windows of a document
up where it reads it: neither windows nor candidates leave it, only the best window of each
item found.

Defined cases: null or empty texts have no windows; an item without words matches nothing;
an item of fewer than five words is one shingle; a document shorter than an item is one
window; words are lower-cased and split at ASCII white space; repeated documents are found
alike, repeated items each match; empty tables give an empty result; other columns are not
read, and ``decontaminate`` keeps them in a struct.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from omnitally.llm.common import WORD, documents, materialize, parts_for
from omnitally.sources.tables import read

SHINGLE, SIMILARITY = 5, 0.8
#: At a similarity of 0.8 the expected distance is 10 bits with a deviation of 3.
RADIUS, BLOCKS = 20, 7
BLOCK_WORDS = 2_000_000
STRETCH = 20_000  # windows hashed at a time
PAIRS = 1 << 20  # candidates of a block of bits held at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CUTS = [64 * i // BLOCKS for i in range(BLOCKS + 1)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Hash of the k-word shingle at every position."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    n = len(w) - k + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = (h ^ w[i:i + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def simhashes(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the ``width`` shingles from each start; repeats of a shingle add weight."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(shingles) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    ones = total[starts + width] - total[starts]
    return np.packbits(2 * ones > width, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: list[bytes], b: list[bytes], k: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of the word shingles of two word lists."""
    k = max(1, min(k, len(a), len(b)))
    x = Counter(zip(*(a[i:] for i in range(k))))
    y = Counter(zip(*(b[i:] for i in range(k))))
    most = sum((x | y).values())
    return sum((x & y).values()) / most if most else 0.0


class Items:
    """A block of items: their shingles by window length, their fingerprints and their index."""

    def __init__(self, items: list[tuple[int, list[bytes]]], radius: int = RADIUS):
        self.radius = radius
        self.lengths: dict[int, np.ndarray] = {}
        self.prints = []
        for item, words in items:
            k = min(SHINGLE, len(words))
            h = shingle_hashes(words, k)
            n = len(words)
            self.lengths[n] = np.union1d(self.lengths.get(n, h[:0]), h)
            fp = simhashes(h, np.zeros(1, dtype=np.int64), len(h))[0]
            self.prints.append((item, n, int(fp.astype(np.int64)), words))
        self.by_shingle = {}
        for k in {min(SHINGLE, n) for n in self.lengths}:
            every = np.unique(np.concatenate([h for n, h in self.lengths.items() if min(SHINGLE, n) == k]))
            bloom = np.zeros(1 << 20, dtype=bool)
            bloom[every >> np.uint64(44)] = True
            self.by_shingle[k] = bloom, every, {n: np.isin(every, h) for n, h in self.lengths.items()
                                                if min(SHINGLE, n) == k}
        self.fps = np.array([fp for _, _, fp, _ in self.prints], dtype=np.int64).view(np.uint64)
        self.index = self._index()

    def _index(self) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
        """By item length, for every block: where each value's items start, and the items."""
        rows = np.array(index_rows(self, self.radius), dtype=np.int64)
        out = {}
        for n in self.lengths:
            out[n] = []
            for j, (a, b) in enumerate(zip(_CUTS, _CUTS[1:])):
                own = rows[(rows[:, 0] == n) & (rows[:, 1] == j)]
                own = own[np.argsort(own[:, 2], kind="stable")]
                out[n].append((np.searchsorted(own[:, 2], np.arange((1 << (b - a)) + 1)), own[:, 3].astype(np.int32)))
        return out

    def near(self, n: int, fps: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in ``fps``, place of the item, distance) within the radius, for items of ``n`` words."""
        blocks = self.index[n]
        step = max(1, PAIRS // max(int(np.diff(starts).max()) for starts, _ in blocks))
        for low in range(0, len(fps), step):
            part, found = fps[low:low + step], []
            for (starts, items), a, b in zip(blocks, _CUTS, _CUTS[1:]):
                value = (part >> np.uint64(a) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)
                count = starts[value + 1] - starts[value]
                window = np.repeat(np.arange(len(part)), count)
                inside = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
                item = items[np.repeat(starts[value], count) + inside]
                close = np.bitwise_count(part[window] ^ self.fps[item]) <= self.radius
                found.append(window[close] * len(self.fps) + item[close])
            for pair in np.unique(np.concatenate(found)):
                w, i = divmod(int(pair), len(self.fps))
                yield low + w, i, int(np.bitwise_count(part[w] ^ self.fps[i]))

    def best(self, text: str | None, least: float) -> dict[int, tuple[float, int, int]]:
        """item_id -> (similarity, -distance, -start) of the best window of each item in a text."""
        words, out = words_of(text), {}
        for n, starts, width, fps in self.windows(words):
            for w, i, distance in self.near(n, fps):
                item, _, _, own = self.prints[i]
                s = int(starts[w])
                alike = similarity(words[s:s + width], own)
                if alike >= least:
                    out[item] = max(out.get(item, (0.0, 0, 0)), (alike, -distance, -s))
        return out

    def windows(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray, int, np.ndarray]]:
        """Stretches of windows that share a shingle: item length, starts, words, fingerprints."""
        for k, (bloom, every, of_length) in self.by_shingle.items():
            h = shingle_hashes(words, k)
            near = np.flatnonzero(bloom[h >> np.uint64(44)])
            place = np.searchsorted(every, h[near])
            place[place == len(every)] = 0
            real = every[place] == h[near]
            near, place = near[real], place[real]
            if not len(near):
                continue
            for n, member in of_length.items():
                hit = near[member[place]]
                if not len(hit):
                    continue
                width = min(n, len(words)) - k + 1
                last = len(h) - width
                reach = np.zeros(len(h) + 1, dtype=np.int32)
                np.add.at(reach, np.maximum(hit - width + 1, 0), 1)
                np.add.at(reach, hit + 1, -1)
                starts = np.flatnonzero(np.cumsum(reach)[:last + 1] > 0)
                # Hash the stretches around the hits, not the whole document.
                gaps = np.flatnonzero(np.diff(starts) > width) + 1
                for stretch in np.split(starts, gaps):
                    for part in (stretch[i:i + STRETCH] for i in range(0, len(stretch), STRETCH)):
                        low = part[0]
                        yield n, part, width + k - 1, simhashes(h[low:part[-1] + width], part - low, width)


def _within(bits: int, most: int) -> list[int]:
    """All values of ``bits`` bits with at most ``most`` of them set."""
    return [v for v in range(1 << bits) if v.bit_count() <= most]


def index_rows(items: Items, radius: int) -> list[tuple[int, int, int, int]]:
    """(item length, block, value, place of the item) of the multi-index."""
    rows = []
    near = [_within(b - a, radius // BLOCKS) for a, b in zip(_CUTS, _CUTS[1:])]
    for place, (_, n, fp, _) in enumerate(items.prints):
        for j, (a, b) in enumerate(zip(_CUTS, _CUTS[1:])):
            own = (fp >> a) & ((1 << (b - a)) - 1)
            rows += [(n, j, own ^ v, place) for v in near[j]]
    return rows


@lru_cache(maxsize=1)
def _loaded(block: bytes) -> Items:
    """The block that a worker searches, loaded once for all its tasks."""
    return pickle.loads(block)


def _search(docs: DataFrame, block: bytes, least: float) -> DataFrame:
    """The best window of each item found in each row of ``docs`` (columns key and text)."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    schema = T.StructType([docs.schema["key"], T.StructField("item_id", T.LongType()),
                           T.StructField("similarity", T.DoubleType()), T.StructField("near", T.IntegerType()),
                           T.StructField("first", T.IntegerType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _loaded(sent.value)
        types = [None, pa.int64(), pa.float64(), pa.int32(), pa.int32()]
        for batch in batches:
            types[0] = batch.schema.field(0).type
            rows = [(key.as_py(), item, *best) for key, text in zip(batch.column(0), batch.column(1))
                    for item, best in items.best(text.as_py(), least).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)

    return docs.select("key", "text").mapInArrow(search, schema)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, radius: int = RADIUS,
                block_words: int | None = None) -> DataFrame:
    """The items' indexes (column block, pickled ``Items``), built in tasks and written to the shared folder.

    Items are dealt over as many tasks as they fill blocks; a task closes a block as soon as
    it holds ``block_words`` words, an item counting 400 more for its place in the index.
    """
    most = block_words or BLOCK_WORDS
    rows = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) + 400)).first()[0] or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Items(held, radius))], pa.binary())], ["block"])

        held, size = [], 0
        for batch in batches:
            for item, t in zip(batch.column(0), batch.column(1)):
                words = words_of(t.as_py())
                if words:
                    held.append((item.as_py(), words))
                    size += len(words) + 400
                if size > most:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    dealt = rows.repartition(parts_for(size, most, 1))
    return materialize(dealt.mapInArrow(build, "block binary"), "item-blocks")


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", key: str = "doc_id", radius: int = RADIUS,
                 least: float = SIMILARITY) -> DataFrame:
    """key, item_id, similarity, hamming, start_word: the best window of each pair found."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    blocks = item_blocks(benchmark, item_id, item_text, radius).toLocalIterator()
    parts = [_search(docs, bytes(row.block), least) for row in blocks]
    if not parts:
        return docs.select("key", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"),
                           F.lit(0).alias("hamming"), F.lit(0).alias("start_word")).where(F.lit(False))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return (every.groupBy("key", "item_id").agg(F.max(F.struct("similarity", "near", "first")).alias("b"))
            .select("key", "item_id", "b.similarity", (-F.col("b.near")).alias("hamming"),
                    (-F.col("b.first")).alias("start_word")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, all columns kept.

    A text is its own key here (by hash), so equal texts share the verdict and rows
    without an id are treated like any other.
    """
    cols = docs.columns
    keyed = docs.select(F.struct("*").alias("doc"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"))
    found = contaminated(keyed.select("key", F.col("doc")[text].alias("text")), benchmark, key="key", **options)
    bad = materialize(found.select("key").distinct(), "contaminated")
    return keyed.join(bad, "key", "left_anti").select([F.col("doc")[c].alias(c) for c in cols])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    found = contaminated(documents(spark, sf_dir, "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")
