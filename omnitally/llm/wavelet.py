"""Wavelet matrix of a token sequence: succinct bit-planes with rank and select.

Layout of a shard's bytes (little-endian; fixed values of this format):

- magic ``WVM1``, then unsigned 32-bit: planes, documents; unsigned 64-bit: tokens.
- the number of tokens of each document, unsigned 32-bit, zstandard-compressed;
- for every plane, highest bit first: the number of zeros, unsigned 64-bit; the plane's
  bits, zstandard-compressed; the rank directory (ones before every 512th bit, unsigned
  32-bit), zstandard-compressed. Each compressed part follows its length, unsigned 32-bit.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
STEP = 512


def _packed(data: bytes, level: int = 1) -> bytes:
    z = zstandard.ZstdCompressor(level=level).compress(data)
    return struct.pack("<I", len(z)) + z


def encode(tokens: np.ndarray, doc_lengths: np.ndarray) -> bytes:
    """The bytes of a shard."""
    planes = max(1, int(tokens.max()).bit_length() if len(tokens) else 1)
    x = tokens.astype(np.uint16 if planes <= 16 else np.uint32)
    out = [MAGIC, struct.pack("<IIQ", planes, len(doc_lengths), len(x)),
           _packed(np.asarray(doc_lengths, dtype="<u4").tobytes())]
    for p in range(planes - 1, -1, -1):
        # Places are gathered by index: masks of random bits are slow.
        bits = (x & x.dtype.type(1 << p)) != 0
        zeros = x.take(np.flatnonzero(~bits))
        packed = np.packbits(bits, bitorder="little")
        out += [struct.pack("<Q", len(zeros)), _packed(packed.tobytes()), _packed(_directory(packed).tobytes())]
        x = np.concatenate([zeros, x.take(np.flatnonzero(bits))])
    return b"".join(out)


def _directory(packed: np.ndarray) -> np.ndarray:
    step = STEP // 8
    padded = np.zeros(-(-len(packed) // step) * step, dtype=np.uint8)
    padded[:len(packed)] = packed
    ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, step // 8).sum(axis=1)
    return np.r_[0, np.cumsum(ones)].astype("<u4")


class WaveletMatrix:
    """Token access, counting and occurrence lookup over one shard's bytes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard of this format")
        planes, docs, self.n = struct.unpack_from("<IIQ", data, 4)
        self._data, self._at = data, 20
        self.doc_lengths = np.frombuffer(self._part(), dtype="<u4")
        if len(self.doc_lengths) != docs:
            raise ValueError("the shard's document table is cut short")
        self.zeros, self.planes, self.ranks = [], [], []
        for _ in range(planes):
            self.zeros.append(struct.unpack_from("<Q", data, self._at)[0])
            self._at += 8
            self.planes.append(np.frombuffer(self._part(), dtype=np.uint8))
            self.ranks.append(np.frombuffer(self._part(), dtype="<u4"))

    def _part(self) -> bytes:
        size, = struct.unpack_from("<I", self._data, self._at)
        start, self._at = self._at + 4, self._at + 4 + size
        return zstandard.ZstdDecompressor().decompress(self._data[start:self._at])

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i >> 3]) >> (i & 7) & 1

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // STEP
        part = int.from_bytes(self.planes[plane][block * STEP // 8:(i + 7) // 8].tobytes(), "little")
        return int(self.ranks[plane][block]) + (part & ((1 << (i - block * STEP)) - 1)).bit_count()

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of the given value in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, z in enumerate(self.zeros):
            bit, ones = self._bit(p, i), self._rank1(p, i)
            value = value << 1 | bit
            i = z + ones if bit else i - ones
        return value

    def _path(self, token: int, i: int) -> tuple[int, int]:
        """Where the first ``i`` tokens' occurrences of ``token`` start and end at the bottom."""
        start, end = 0, i
        for p, z in enumerate(self.zeros):
            a, b = self._rank1(p, start), self._rank1(p, end)
            if token >> (len(self.zeros) - 1 - p) & 1:
                start, end = z + a, z + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``end`` positions (all by default)."""
        if token < 0 or token >> len(self.zeros):
            return 0
        a, b = self._path(token, self.n if end is None else end)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._path(token, 0)[0] + k
        for p in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - p) & 1
            i = self._select(p, bit, i - self.zeros[p] if bit else i)
        return i

    def tokens(self) -> np.ndarray:
        """The whole sequence: the access walk of all positions, run from the lowest plane up."""
        x = np.zeros(self.n, dtype=np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for p in range(len(self.zeros) - 1, -1, -1):
            bits = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(x)
            up[np.flatnonzero(~bits)] = x[:self.zeros[p]]
            up[np.flatnonzero(bits)] = x[self.zeros[p]:] | x.dtype.type(1 << (len(self.zeros) - 1 - p))
            x = up
        return x.astype("<u4")
