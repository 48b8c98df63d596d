"""Weighted acyclic automata over word sequences: build, read, enumerate, union, compose.

An automaton maps word sequences of at most ``width`` words to counts. It is built
incrementally from sorted sequences: as soon as a prefix is left, its state is frozen and
replaced by an equal state seen before (same count, same arcs), so the result is minimal.
Labels are positions in a sorted word table that the automaton carries. States are numbered
in the order in which they were frozen, so arcs lead to smaller numbers and the start state
is the last one.

Sequences travel as ``rows``: an array of shape (sequences, width) of word numbers, -1 after
the last word.
"""

from __future__ import annotations

import struct
from array import array
from itertools import chain
from typing import NamedTuple

import numpy as np
import zstandard

_HEADER = struct.Struct("<4I")


class Automaton(NamedTuple):
    words: list[bytes]
    width: int
    weight: np.ndarray  # count of the sequence that ends in the state, 0 where none ends
    degree: np.ndarray  # arcs of the state
    label: np.ndarray   # of the arcs, state by state, ascending inside a state
    target: np.ndarray

    def start(self) -> np.ndarray:
        return np.arange(len(self.weight) - 1, len(self.weight))

    def first_arc(self) -> np.ndarray:
        return np.cumsum(self.degree) - self.degree


def order(rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorting permutation of ``rows`` and their sort keys."""
    key, most = np.zeros(len(rows), dtype=np.int64), 1
    for column in rows.T:
        if most * (words + 1) >= 1 << 62:
            key, most = np.unique(key, return_inverse=True)[1].astype(np.int64), len(rows)
        key, most = key * (words + 1) + column + 1, most * (words + 1)
    return np.argsort(key, kind="stable"), key


def build(words: list[bytes], rows: np.ndarray, n: np.ndarray) -> bytes:
    """Serialized automaton of sorted, different, non-empty ``rows`` with the counts ``n``.

    The rows of one prefix of ``width - 1`` words follow each other; the arcs of their state,
    all to states without arcs, are added in one step.
    """
    width = rows.shape[1]
    used = np.zeros(len(words) + 1, dtype=bool)
    used[rows.ravel()] = True  # -1 marks the last, extra place
    number = np.cumsum(used, dtype=np.int32) - 1
    number[-1] = -1
    used = np.flatnonzero(used[:-1]).tolist()
    rows, words = number[rows], [words[i] for i in used]

    leaf = rows[:, -1] >= 0
    counts, end = np.unique(n[leaf], return_inverse=True)
    # A state is (count, labels, targets); equal states are stored once, in the order of their freezing.
    register = {(c, b"", b""): i for i, c in enumerate(counts.tolist())}
    labels, targets = rows[leaf, -1].astype("<i4").tobytes(), end.astype("<i4").tobytes()

    prefix = rows[:, :-1]
    same = np.cumprod(prefix[1:] == prefix[:-1], axis=1)
    shared = np.append(0, same.sum(axis=1))[:len(rows)]
    first = np.flatnonzero(np.append(True, shared[1:] < width - 1)[:len(rows)])
    arcs_before = 4 * np.append(0, np.cumsum(leaf))
    own = np.where(leaf[first], 0, n[first])  # the count of the prefix itself
    open_states = [[0, [], []]]  # from the start state along the prefix: count, labels, targets

    freeze = register.setdefault

    def close() -> None:
        count, out, to = open_states.pop()
        open_states[-1][2].append(freeze((count, array("i", out).tobytes(), array("i", to).tobytes()), len(register)))

    start = (0, b"", b"")
    for row, keep, count, at, upto in zip(prefix[first].tolist(), shared[first].tolist(), own.tolist(),
                                          arcs_before[first].tolist(), arcs_before[np.append(first[1:], len(rows))[:len(first)]].tolist()):
        while len(open_states) > keep + 1:
            close()
        for label in row[keep:]:
            top = open_states[-1]
            if label < 0:
                top[0] = count
                break
            top[1].append(label)
            if len(open_states) == width - 1:  # the state of the whole prefix, complete at once
                top[2].append(freeze((count, labels[at:upto], targets[at:upto]), len(register)))
                break
            open_states.append([0, [], []])
        else:  # no prefix: the arcs are the start state's
            start = (0, labels, targets)
    while len(open_states) > 1:
        close()
    if width > 1:
        start = (open_states[0][0], array("i", open_states[0][1]).tobytes(), array("i", open_states[0][2]).tobytes())
    register[start] = len(register)  # unlike all others, as the longest sequences start here
    body = b"".join([
        np.fromiter((s[0] for s in register), "<i8", len(register)).tobytes(),
        np.fromiter((len(s[1]) // 4 for s in register), "<i4", len(register)).tobytes(),
        *(s[1] for s in register), *(s[2] for s in register), b"\n".join(words)])
    arcs = sum(len(s[1]) for s in register) // 4
    return _HEADER.pack(len(register), arcs, len(words), width) + zstandard.ZstdCompressor(level=1).compress(body)


def read(blob: bytes) -> Automaton:
    states, arcs, words, width = _HEADER.unpack_from(blob)
    body = zstandard.ZstdDecompressor().decompress(blob[_HEADER.size:])
    at, parts = 0, []
    for kind, size in (("<i8", states), ("<i4", states), ("<i4", arcs), ("<i4", arcs)):
        parts.append(np.frombuffer(body, kind, size, at).astype(np.int64))
        at += parts[-1].size * np.dtype(kind).itemsize
    return Automaton(body[at:].split(b"\n") if words else [], width, *parts)


def _arcs_of(automaton: Automaton, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all arcs of ``states``: the place of their state in it, and the arc."""
    degree = automaton.degree[states]
    place = np.repeat(np.arange(len(states)), degree)
    inside = np.arange(len(place)) - np.repeat(np.cumsum(degree) - degree, degree)
    return place, np.repeat(automaton.first_arc()[states], degree) + inside


def rows_of(automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """All sequences and their counts, shorter ones first, not sorted."""
    state, path, rows, n = automaton.start(), np.full((1, automaton.width), -1, dtype=np.int32), [], []
    for depth in range(automaton.width + 1):
        ends = automaton.weight[state] > 0
        rows.append(path[ends])
        n.append(automaton.weight[state[ends]])
        if depth < automaton.width:
            place, arc = _arcs_of(automaton, state)
            path, state = path[place], automaton.target[arc]
            path[:, depth] = automaton.label[arc]
    return np.concatenate(rows), np.concatenate(n)


def union(parts: list[Automaton], least: int = 1) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, sorted rows and summed counts of all ``parts``, without sums below ``least``."""
    words = sorted(set().union(*(p.words for p in parts)))
    index = {w: i for i, w in enumerate(words)}
    rows, n = [], []
    for p in parts:
        to = np.fromiter(chain(map(index.__getitem__, p.words), (-1,)), np.int32, len(p.words) + 1)
        own, counts = rows_of(p)
        rows.append(to[own])
        n.append(counts)
    rows, n = np.concatenate(rows), np.concatenate(n)
    by, key = order(rows, len(words))
    key = key[by]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    sums = np.add.reduceat(n[by], first) if len(first) else n
    kept = sums >= least
    return words, rows[by[first[kept]]], sums[kept]


def compose(counts: Automaton, wanted: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """The sequences of ``wanted`` that ``counts`` holds, and their counts there.

    Both automata are walked in step over equal labels, all pairs of states of one depth at
    a time. Rows hold word numbers of ``counts``.
    """
    index = {w: i for i, w in enumerate(counts.words)}
    to = np.fromiter((index.get(w, -1) for w in wanted.words), np.int64, len(wanted.words))
    size = max(1, len(counts.words))
    arcs = np.repeat(np.arange(len(counts.degree)), counts.degree) * size + counts.label  # ascending
    state, asked, path = counts.start(), wanted.start(), np.full((1, counts.width), -1, dtype=np.int32)
    rows, n = [], []
    for depth in range(counts.width + 1):
        ends = (counts.weight[state] > 0) & (wanted.weight[asked] > 0)
        rows.append(path[ends])
        n.append(counts.weight[state[ends]])
        if depth < counts.width and len(arcs):
            place, arc = _arcs_of(wanted, asked)
            label = to[wanted.label[arc]] if len(to) else wanted.label[arc]
            key = state[place] * size + label
            found = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
            both = np.flatnonzero((label >= 0) & (arcs[found] == key))
            path, state, asked = path[place[both]], counts.target[found[both]], wanted.target[arc[both]]
            path[:, depth] = label[both]
        else:
            state, asked, path = state[:0], asked[:0], path[:0]
    return np.concatenate(rows), np.concatenate(n)
