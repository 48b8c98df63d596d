"""Token ids in one wavelet matrix per shard.

Documents are range-partitioned by id and sorted, tokenised in Arrow batches, and packed
into shards of about ``SHARD_TOKENS`` ids, each one compressed byte string (see
``wavelet``). Spark writes the shards, so any file system that it reaches will do and a
lost task's files are written anew; a shard is a row with its place, its documents' ids
and its bytes. Start positions come from the shards' counts by a prefix sum over the
partitions and one inside each, without touching the bytes.

The tokenizer's pre-tokenisation never crosses a space that stands before a word, so a
text is cut there, and an unknown word by the tokenizer's own pattern; a worker asks the
library's model once for each distinct piece (up to a bounded cache). Words with characters
beyond U+024F go to the library as they are, texts with any other use of spaces whole.

Defined cases: a null text counts as empty and yields the end id alone; rows are ordered
by id, null ids last, equal ids by a hash of the text; repeated rows are each encoded; a
document is never split over shards, so a very long one makes a larger shard; an empty
table writes no shard and gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from omnitally.llm.common import documents, materialize, text_of
from omnitally.llm.wavelet import WaveletMatrix, encode

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 2_000_000
CACHE = 500_000
SHARD_SCHEMA = "part int, seq int, n_tokens long, docs array<long>, data binary"
ROWS = "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long"


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if visible, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Pieces(dict):
    """Ids of single pieces of the pre-tokenisation, as little-endian 32-bit bytes."""

    ALPHABET = _byte_alphabet()

    def __init__(self, model):
        super().__init__()
        self.model = model

    def encode(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            shown = piece.replace(" ", self.ALPHABET[32])
        else:
            shown = "".join(map(self.ALPHABET.__getitem__, piece.encode()))
        return self.shown(shown)

    def shown(self, shown: str) -> bytes:
        """Ids of a piece written in the byte alphabet."""
        return _bytes([t.id for t in self.model.tokenize(shown)])

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(self) < CACHE // 4:
            self[piece] = ids
        return ids


class Uncut(Exception):
    """The text has a space that stands before no word."""


class Encoder(dict):
    """Ids of whole texts, as the library gives them.

    The dictionary holds the ids of `` word`` as little-endian 32-bit bytes, which are compact
    and join fast.
    """

    SPECIAL = "<|endoftext|>"
    #: Characters whose classes are the same in every Unicode version in use.
    PLAIN = regex.compile(r"[\n\t\r\x21-\x7E\xA1-\u024F]+")
    CUT = regex.compile(public_tokenizers.PATTERN)
    SPACE = Pieces.ALPHABET[32]
    #: Signs that the pattern parts from the letters before them, as it does not an apostrophe's.
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    #: Space other than a line's end between two visible characters.
    BLANK = regex.compile(r"[\t\r]|\n(?:\n|\Z)")
    LAST = "\u024F"

    def __init__(self, vocabulary: str = VOCABULARY):
        super().__init__()
        self.lib = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.pieces = Pieces(self.lib.model)

    def whole(self, text: str) -> list[int]:
        return self.lib.encode(text, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        # Letters up to U+024F alone are one piece; the signs after them are the next one.
        if word.isalpha() and (word.isascii() or max(word) <= self.LAST):
            ids = self.pieces.shown(self.SPACE + word) if word.isascii() else self.pieces.encode(" " + word)
        elif (letters := word.rstrip(self.MARKS)).isalpha() and (word.isascii() or max(letters) <= self.LAST):
            # While there is much room such words are stored, then put together.
            known = letters in self
            ids = self[letters] + self.pieces[word[len(letters):]]
            if not known or len(self) >= CACHE // 4:
                return ids
        elif not word or word[0].isspace():
            raise Uncut
        elif not self.PLAIN.fullmatch(word):
            ids = _bytes(self.whole(" " + word))
        elif "\n" in word and not self.BLANK.search(word):
            # No piece crosses a line's end between two visible characters. Such pairs hardly come again and are not stored.
            first, *lines = word.split("\n")
            return self[first] + b"".join(map(self.line, lines))
        else:
            first, *rest = self.CUT.findall(" " + word)
            if not rest:
                ids = self.pieces.encode(first)
            else:
                known = first[1:] in self
                ids = b"".join([self[first[1:]], *map(self.pieces.__getitem__, rest)])
                if not known or len(self) >= CACHE // 2:  # a word seen for the first time is not worth a second entry
                    return ids
        if len(self) < CACHE:
            self[word] = ids
        return ids

    def line(self, start: str) -> bytes:
        """Ids of a line's end and what starts the next line, up to its first space."""
        pieces = self.pieces
        if start.isalpha():
            return pieces["\n"] + pieces[start]
        if (letters := start.rstrip(self.MARKS)).isalpha():
            return pieces["\n"] + pieces[letters] + pieces[start[len(letters):]]
        return pieces["\n"] + b"".join(map(pieces.__getitem__, self.CUT.findall(start)))

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text, the end id last."""
        first, *words = text.split(" ")
        try:
            if self.SPECIAL in text:
                raise Uncut
            start = self.pieces[first] if first.isascii() and first.isalpha() else _bytes(self.whole(first))
            data = b"".join([start, *map(self.__getitem__, words), _bytes([END_ID])])
        except Uncut:
            data = _bytes([*self.whole(text), END_ID])
        return np.frombuffer(data, dtype="<u4")


#: Packers of the short lists that words and pieces give.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _bytes(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACK[n](*ids) if n < len(_PACK) else struct.pack(f"<{n}I", *ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
           shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per shard: place, ids of its documents, and its bytes."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("late", F.col("doc_id").isNull()).withColumn("tie", F.xxhash64("text"))
    order = ["late", "doc_id", "tie"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, part = encoder(vocabulary), TaskContext.get().partitionId()
        seq, size, ids, held = 0, 0, [], []

        def row():
            data = encode(np.concatenate(held), np.array([len(h) for h in held]))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["part", "seq", "n_tokens", "docs", "data"])

        for batch in batches:
            # One text at a time: a batch of long texts is never held a second time as strings.
            for d, t in zip(batch.column(0), batch.column(1)):
                tokens = run.ids(t.as_py())
                if held and size + len(tokens) > shard_tokens:
                    yield row()
                    seq, size, ids, held = seq + 1, 0, [], []
                ids.append(d.as_py())
                held.append(tokens)
                size += len(tokens)
        if held:
            yield row()

    return rows.mapInArrow(pack, SHARD_SCHEMA)


def read_documents(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from stored shards."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, docs, data in zip(*batch.columns):
                matrix = WaveletMatrix(data.as_py())
                ids, sizes = matrix.tokens(), matrix.doc_lengths.astype(np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[a:b].data) for a, b in zip(ends - sizes, ends)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), docs.values,
                     pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    # Positions: totals per partition are few; inside a partition the shards are few.
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = stored.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("offset"))
    places = places.join(base, "part").select("part", "seq", (F.col("base") + F.col("offset")).alias("base"))
    rows = stored.select("part", "seq", "docs", "data").mapInArrow(unpack, ROWS)
    return rows.join(places, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Encode ``docs`` into shard files in the shared folder and read every document back."""
    return read_documents(materialize(shards(docs, **options), "tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token positions and checksums of every document, read back from the shards."""
    return write_and_read(documents(spark, sf_dir, "doc_id", "text"))
