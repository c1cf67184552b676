"""Vectorised words, word hashes and shingle sets shared by the corpus operators.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text after
``A-Z`` became ``a-z``.  Words are hashed with one polynomial prefix sum over the bytes of
a slice (each byte first goes through a random 64-bit table), followed by a non-linear
mix, so a slice costs a handful of numpy passes and no Python loop over words.  Null text
counts as empty.  A text of any length is handled in slices of ``SLICE`` bytes cut between
words, so the working arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SLICE = 1 << 20
SHINGLE = 5
#: Words that a table holds before it starts afresh, and those that are described at a time.
HELD_WORDS = 1 << 18
DESCRIBED_WORDS = 1 << 13

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_PINV = _U(pow(int(_P), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
#: Odd multipliers of the words of a shingle; the last one takes the length of a short sequence.
_MULT = np.random.Generator(np.random.PCG64(99)).integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) * _U(2) + _U(1)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            size = 1 << (n - 1).bit_length()
            _POW, _INV = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)])) for p in (_P, _PINV))
    return _POW[:n], _INV[:n]


def _hash_slice(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of lower-cased bytes that end with a separator."""
    a = np.frombuffer(data, np.uint8)
    sep = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if len(a) and not sep[0]:
        edge = np.concatenate([np.zeros(1, edge.dtype), edge])
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = _powers(len(a) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_TABLE[a] * power[: len(a)], out=total[1:])
        return starts, ends, mix((total[ends] - total[starts]) * inverse[starts])


def _cut(data: bytes) -> Iterator[bytes]:
    """Slices of about SLICE bytes, cut between words; every slice ends with a separator."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end] + b" "
        at = end


def lowered(text: str | None) -> bytes:
    """UTF-8 with ASCII letters lower-cased and nothing else changed."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_slices(texts: Sequence[str | None]) -> Iterator[tuple[int, int, list[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]], np.ndarray]]:
    """Groups of consecutive texts as ``(first, count, slices, bounds)``.

    A slice is its bytes with starts, ends and hashes of its words; ``bounds`` cuts the
    words of all slices in a row into the texts of the group.
    """
    at = 0
    while at < len(texts):
        pack, size, first = [], 0, at
        while at < len(texts) and (not pack or size < SLICE):
            pack.append(lowered(texts[at]))
            size += len(pack[-1]) + 1
            at += 1
        if len(pack) == 1:
            slices = [(x, *_hash_slice(x)) for x in _cut(pack[0])]
            yield first, 1, slices, np.array([0, sum(len(x[1]) for x in slices)])
        else:
            data = b" ".join(pack) + b" "
            starts, ends, hashes = _hash_slice(data)
            offsets = np.cumsum([0] + [len(x) + 1 for x in pack])
            yield first, len(pack), [(data, starts, ends, hashes)], np.searchsorted(starts, offsets)


def word_hashes(texts: Sequence[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``word_slices``, with the word hashes of a group in one array."""
    for first, count, slices, bounds in word_slices(texts):
        yield first, count, np.concatenate([x[3] for x in slices]) if slices else np.zeros(0, np.uint64), bounds


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle."""
    with np.errstate(over="ignore"):
        if len(words) == 0:
            return np.zeros(0, np.uint64)
        if len(words) < n:
            return mix(np.array([np.sum(words * _MULT[: len(words)], dtype=np.uint64) + _U(len(words)) * _MULT[-1]]))
        m = len(words) - n + 1
        total = words[:m] * _MULT[0]
        for k in range(1, n):
            total = total + words[k : k + m] * _MULT[k]
        return np.unique(mix(total))


def shingle_sets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for _, count, hashes, bounds in word_hashes(texts):
        for i in range(count):
            yield shingles(hashes[bounds[i] : bounds[i + 1]])


class HashIndex:
    """Open-addressing table from 64-bit hashes to slots, probed with whole arrays; 0 is no key."""

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        mask = _U(len(self.keys) - 1)
        at = keys & mask
        found = self.keys[at]
        out = np.where(found == keys, self.slots[at], -1)
        todo = np.flatnonzero((found != keys) & (found != 0))
        while len(todo):
            at[todo] = (at[todo] + _U(1)) & mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.slots[at[todo[hit]]]
            todo = todo[~hit & (found != 0)]
        return out

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Distinct new keys."""
        if (self.n + len(keys)) * 3 > len(self.keys):
            old = self.keys != 0
            keys, slots = np.concatenate([self.keys[old], keys]), np.concatenate([self.slots[old], slots])
            size = 1 << (len(keys) * 4).bit_length()
            self.keys, self.slots, self.n = np.zeros(size, np.uint64), np.zeros(size, np.int64), 0
        mask = _U(len(self.keys) - 1)
        at, todo = keys & mask, np.arange(len(keys))
        self.n += len(keys)
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = keys[free]
            won = free[self.keys[at[free]] == keys[free]]
            self.slots[at[won]] = slots[won]
            done = np.zeros(len(keys), bool)
            done[won] = True
            todo = todo[~done[todo]]
            at[todo] = (at[todo] + _U(1)) & mask


class WordTable:
    """Numbers distinct words and keeps one described row for each, so a word is described once per worker.

    ``describe`` gets the new words (lower-cased text) and returns one row each.  From
    ``held`` words on the table starts afresh, which bounds its memory.
    """

    def __init__(self, describe, held: int = HELD_WORDS) -> None:
        self.describe, self.held = describe, held
        self._reset()

    def _reset(self) -> None:
        self.index, self.n, self.rows = HashIndex(), 0, None

    def _append(self, new: np.ndarray) -> None:
        if self.rows is None:
            self.rows = np.zeros((1 << 14, *new.shape[1:]), new.dtype)
        if self.n + len(new) > len(self.rows):
            grown = np.zeros((max(2 * len(self.rows), self.n + len(new)), *new.shape[1:]), new.dtype)
            grown[: self.n] = self.rows[: self.n]
            self.rows = grown
        self.rows[self.n : self.n + len(new)] = new
        self.n += len(new)

    def described(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Groups of consecutive texts as ``(first, count, rows, bounds)``, a row for each word."""
        for first, count, slices, bounds in word_slices(texts):
            parts = []
            for data, starts, ends, hashes in slices:
                if self.n > self.held:
                    self._reset()
                keys = hashes | _U(1)
                got = self.index.find(keys)
                missing = np.flatnonzero(got < 0)
                if len(missing):
                    new, where = np.unique(keys[missing], return_index=True)
                    self.index.add(new, self.n + np.arange(len(new)))
                    for low in range(0, len(new), DESCRIBED_WORDS):
                        self._append(self.describe([data[starts[i] : ends[i]].decode("utf-8", "replace") for i in missing[where[low : low + DESCRIBED_WORDS]]]))
                    got = self.index.find(keys)
                if len(got):
                    parts.append(self.rows[got])
            yield first, count, np.concatenate(parts) if parts else self.describe([]), bounds
