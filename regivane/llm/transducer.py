"""Minimal acyclic transducer over byte strings, stored flat so that it can be memory-mapped.

The automaton is built from sorted words by incremental minimisation: once a word is added,
the states that no later word can extend are merged with an equal state where there is one.
Every arc carries the number of words that sort before those behind it, so the sum along a
word's path is the word's rank: a minimal perfect hash into the table of outputs.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import struct
import tempfile
from collections.abc import Sequence

import numpy as np

#: Bytes at the beginning of a word whose walk is remembered.
PREFIX = 4
_HEADER = struct.Struct("<6I")


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.number, self.words = False, -1, 0


def compile_lexicon(entries: dict[bytes, Sequence[int]]) -> bytes:
    """Compile words and their id sequences into one block of bytes."""
    register: dict[tuple, _State] = {}
    root = _State()
    path: list[tuple[_State, int, _State]] = []
    order: list[_State] = []

    def freeze(down_to: int) -> None:
        while len(path) > down_to:
            parent, label, child = path.pop()
            key = (child.final, tuple((b, s.number) for b, s in child.arcs.items()))
            same = register.get(key)
            if same is None:
                child.number = len(order)
                child.words = child.final + sum(s.words for s in child.arcs.values())
                order.append(child)
                register[key] = child
            else:
                parent.arcs[label] = same

    before = b""
    words = sorted(entries)
    for word in words:
        shared = 0
        for a, b in zip(word, before, strict=False):
            if a != b:
                break
            shared += 1
        freeze(shared)
        state = path[-1][2] if path else root
        for label in word[shared:]:
            child = _State()
            state.arcs[label] = child
            path.append((state, label, child))
            state = child
        state.final = True
        before = word
    freeze(0)
    root.number = len(order)
    order.append(root)

    first, labels, targets, skipped, finals = [0], bytearray(), [], [], bytearray()
    for state in order:
        ahead = int(state.final)
        for label, child in state.arcs.items():
            labels.append(label)
            targets.append(child.number)
            skipped.append(ahead)
            ahead += child.words
        first.append(len(labels))
        finals.append(state.final)
    id_first = np.zeros(len(words) + 1, dtype="<u4")
    np.cumsum([len(entries[w]) for w in words], out=id_first[1:] if words else None)
    ids = [i for w in words for i in entries[w]]
    labels += bytes(-len(labels) % 4)
    finals += bytes(-len(finals) % 4)
    head = _HEADER.pack(len(order), first[-1], len(words), len(ids), root.number, 0)
    parts = [np.asarray(x, dtype="<u4").tobytes() for x in (first, targets, skipped, id_first, ids)]
    return head + b"".join(parts) + bytes(labels) + bytes(finals)


class Lexicon:
    """Read-only view of a compiled lexicon, mapped from a file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        states, arcs, words, ids, self._root, _ = _HEADER.unpack_from(self._map)
        view, at = memoryview(self._map), _HEADER.size
        sections = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            sections.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self._first, self._target, self._skip, self._id_first, self._ids = sections
        self._labels, self._finals = at, at + arcs + (-arcs % 4)
        self.size = words
        # (state, byte) of each arc, ascending as the arcs are
        labels, first = np.frombuffer(self._map, np.uint8, arcs, self._labels), np.asarray(self._first, dtype=np.int64)
        self._arcs = np.repeat(np.arange(states), np.diff(first)) << 8 | labels
        self._final = np.frombuffer(self._map, np.uint8, states, self._finals) > 0
        self._heads: dict[bytes, tuple[int, int]] = {}  # where the walk over a word's beginning ends

    def _walk(self, word: bytes, state: int, rank: int, at: int, end: int) -> tuple[int, int]:
        """State and rank after the bytes from ``at`` to ``end``; state -1 where an arc lacks."""
        first, base, find, skip, target = self._first, self._labels, self._map.find, self._skip, self._target
        for k in range(at, end):
            arc = find(word[k : k + 1], base + first[state], base + first[state + 1])
            if arc < 0:
                return -1, 0
            arc -= base
            rank += skip[arc]
            state = target[arc]
        return state, rank

    def lookup(self, word: bytes) -> list[int] | None:
        """The ids of a word, or None where the lexicon lacks it."""
        n = len(word)
        head = word[:PREFIX]
        got = self._heads.get(head)
        if got is None:
            if len(self._heads) >= 1 << 17:
                self._heads.clear()
            got = self._heads[head] = self._walk(word, self._root, 0, 0, min(n, PREFIX))
        state, rank = got
        if state >= 0 and n > PREFIX:
            state, rank = self._walk(word, state, rank, PREFIX, n)
        if state < 0 or not self._map[self._finals + state]:
            return None
        return self._ids[self._id_first[rank] : self._id_first[rank + 1]].tolist()

    def lookup_all(self, words: Sequence[bytes]) -> list[list[int] | None]:
        """:meth:`lookup` of many words, which walk side by side."""
        out: list[list[int] | None] = [None] * len(words)
        if not self.size:
            return out
        data, lengths = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(lengths) - lengths
        state, rank = np.full(len(words), self._root, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        skip, target = np.asarray(self._skip), np.asarray(self._target)
        on, k = np.flatnonzero(lengths > 0), 0
        while len(on):
            wanted = state[on] << 8 | data[begin[on] + k]
            arc = np.minimum(np.searchsorted(self._arcs, wanted), len(self._arcs) - 1)
            there = self._arcs[arc] == wanted
            state[on[~there]] = -1
            on, arc = on[there], arc[there]
            rank[on] += skip[arc]
            state[on] = target[arc]
            k += 1
            on = on[lengths[on] > k]
        hits = np.flatnonzero(self._final[state] & (state >= 0))
        for at, r in zip(hits.tolist(), rank[hits].tolist(), strict=True):
            out[at] = self._ids[self._id_first[r] : self._id_first[r + 1]].tolist()
        return out


def _holds(path: str, block: bytes) -> bool:
    with open(path, "rb") as f:
        return f.read() == block


def mapped(block: bytes) -> Lexicon:
    """Put a compiled lexicon into this machine's temporary folder once and map it.

    The file is a cache of a broadcast block, named and verified by its content: any process of
    this machine may make it anew, and none needs one of another machine.
    """
    path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(block).hexdigest()[:24]}")
    if not os.path.exists(path) or not _holds(path, block):
        part = f"{path}.{os.getpid()}"
        with open(part, "wb") as f:
            f.write(block)
        os.replace(part, path)
    return Lexicon(path)
