"""A byte-level BPE tokenizer compiled to finite-state transducers.

The first machine reads one symbol class per character and has eight states; its
transitions say whether a piece (pre-token) begins.  Texts are cut into chunks of equal
length.  Every chunk is run from all states at once, which gives its state map; the maps
are composed by a parallel prefix scan, so the state in which each chunk begins is known,
and a second pass reads off the transitions.  Nothing depends on where chunks are cut.

The second machine is compiled from the merges.  It reads a piece byte by byte; its state
stands for the bytes read, with the last token of their encoding, and a transition is
annotated with the number of tokens that it adds.  Two neighbouring tokens stay apart if no
merge across their border comes before the merges that made them (``Merges.apart``), and
every prefix has exactly one last token that stays apart from what is before it, so the
machine is deterministic.  States are made when they are reached; a whole piece seen before
is found by its hash.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

from ._words import HashIndex, mix

CHUNK = 64
BATCH_CHARS = 1 << 20
#: Pieces, and decided neighbours of tokens, that one worker holds before it starts afresh.
HELD_PIECES = 1 << 20

#: Symbol classes: letter, number, other, apostrophe before a one- or two-letter suffix, a space or other blank before a non-blank, a blank in a longer run, end of text.
LETTER, NUMBER, OTHER, SUFFIX1, SUFFIX2, SPACE_THEN, BLANK_THEN, BLANK_RUN, END = range(9)
#: States: between pieces, in letters, in numbers, in other characters, in blanks, after a leading space, one or two suffix letters to come.
FRESH, LETTERS, NUMBERS, OTHERS, BLANKS, LED, LAST1, LAST2 = range(8)
SYMBOLS, STATES = 9, 8
#: Characters from here on are private or unassigned in every Unicode version.
_PLAIN = [(0, 0xD800), (0xE000, 0x32400), (0xE0000, 0xE0200)]


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and begin-of-piece flag, by symbol * STATES + state."""
    to, begins = np.zeros((SYMBOLS, STATES), np.int64), np.ones((SYMBOLS, STATES), bool)
    for symbol, state in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS)):
        to[symbol] = state
        begins[symbol, [state, LED]] = False
    to[LETTER, LAST2], to[LETTER, LAST1] = LAST1, FRESH
    begins[LETTER, [LAST1, LAST2]] = False
    for symbol, state in ((SUFFIX1, LAST1), (SUFFIX2, LAST2)):
        to[symbol] = state
        to[symbol, [OTHERS, LED]] = OTHERS
        begins[symbol, [OTHERS, LED]] = False
    to[SPACE_THEN], to[BLANK_THEN], to[BLANK_RUN], to[END] = LED, FRESH, BLANKS, FRESH
    begins[BLANK_RUN, BLANKS] = False
    return to.ravel(), begins.ravel()


NEXT, BEGINS = _machine()


def _probe(pre, before: str, chars: list[int]) -> np.ndarray:
    """For each character whether the tokenizer's own splitter leaves it in one piece with ``before``."""
    text = "".join(f"{before}{chr(c)}\n" for c in chars)
    starts = np.zeros(len(text) + 1, bool)
    starts[[s for _, (s, _) in pre.pre_tokenize_str(text)]] = True
    return ~starts[1 : 3 * len(chars) : 3]


@lru_cache(4)
def compile_tokenizer(path: str) -> bytes:
    """Character classes of the tokenizer at ``path``, found by asking its splitter; compressed."""
    from tokenizers import Tokenizer

    spec = json.loads(open(path, encoding="utf-8").read())
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        raise ValueError("only byte-level BPE without normalizer or prefix space can be compiled")
    splitter = Tokenizer.from_file(path).pre_tokenizer
    table = np.full(0x110000, 2, np.uint8)
    for low, high in _PLAIN:
        chars = np.arange(low, high)
        for before, kind in (("x", 0), ("7", 1), ("!", 2)):
            same = _probe(splitter, before, chars.tolist())
            table[chars[same]] = kind
            chars = chars[~same]
        table[chars] = 3
    table[0x20], table[0x27] = 4, 5
    return zlib.compress(table.tobytes())


def _byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: itself where printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Merges:
    """The merge rules as a machine over bytes.  Tokens are numbered by age here: bytes first, then by rank of their merge."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        symbols = _byte_symbols()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        age = {c: b for c, b in symbols.items()}
        self.rule: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.ids = np.zeros(256 + len(pairs), np.int64)
        for c, b in symbols.items():
            self.ids[b] = vocab[c]
        self.bytes = [bytes([b]) for b in range(256)]
        self.number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        for rank, (x, y) in enumerate(pairs, 256):
            a, b = age[x], age[y]
            if x + y in age:
                raise ValueError("two merges make one token")
            age[x + y] = rank
            self.ids[rank] = vocab[x + y]
            self.rule[a, b] = rank
            self.parts.append((a, b))
            self.bytes.append(self.bytes[a] + self.bytes[b])
            if self.bytes[a] in self.number and self.bytes[b] in self.number and self._apart(a, b, rank):
                self.number[self.bytes[rank]] = rank  # the encoding of its bytes is the token itself
        lengths = sorted({len(x) for x in self.number})
        #: Lengths that tokens have, of those that fit in so many bytes (the last entry: in any more).
        self.lengths = [[n for n in lengths if n <= i] for i in range(lengths[-1] + 1)]
        self.sizes = [len(x) for x in self.bytes]
        self.known: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of a token at one edge, each with the merge that ends it (the token itself lasts)."""
        out = [(token, len(self.parts) + 1)]
        while (pair := self.parts[out[-1][0]]) is not None:
            out.append((pair[side], out[-1][0]))
        return out

    def _apart(self, a: int, b: int, before: int) -> bool:
        """No merge across the border of a and b comes before the merges of the parts that it needs; of equal merges the left one comes first."""
        for x, end_x in self._edge(a, 1):
            for y, end_y in self._edge(b, 0):
                rank = self.rule.get((x, y))
                if rank is not None and rank < before and rank < end_x and rank <= end_y:
                    return False
        return True

    def apart(self, a: int, b: int) -> bool:
        if len(self.known) > HELD_PIECES:
            self.known.clear()
        got = self.known[a << 20 | b] = self._apart(a, b, len(self.parts) + 1)
        return got

    def run(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each piece, and the token ids of all in a row.

        The pieces are read in sorted order, so the states of a common beginning are entered
        once: ``last`` and ``count`` hold the state after each byte of the current piece, and a
        transition's annotation is the difference of two counts.
        """
        number, known, sizes, lengths, longest = self.number.get, self.known.get, self.sizes, self.lengths, len(self.lengths) - 1
        found: list[list[int]] = [[]] * len(pieces)
        last, count, before = [-1], [0], b""
        for at in sorted(range(len(pieces)), key=pieces.__getitem__):
            piece, same = pieces[at], 0
            for x, y in zip(piece, before, strict=False):
                if x != y:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for i in range(same + 1, len(piece) + 1):
                for n in lengths[i] if i < longest else lengths[longest]:
                    token = number(piece[i - n : i])
                    if token is not None:
                        if n == i:
                            break
                        left = last[i - n]
                        ok = known(left << 20 | token)
                        if ok or (ok is None and self.apart(left, token)):
                            break
                last.append(token)
                count.append(count[i - n] + 1)
            i, tokens = len(piece), []
            while i:
                tokens.append(last[i])
                i -= sizes[last[i]]
            found[at] = tokens[::-1]
            before = piece
        return np.array([len(x) for x in found], np.int64), self.ids[np.array([t for x in found for t in x], np.int64)]


class Transducer:
    def __init__(self, path: str, classes: bytes) -> None:
        spec = json.loads(open(path, encoding="utf-8").read())
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])
        special = [(x["id"], x["content"]) for x in spec.get("added_tokens", []) if x["special"]]
        if len(special) > 1:
            raise ValueError("one special token at most")
        self.special_id, self.special = special[0] if special else (-1, None)
        self.classes = np.frombuffer(zlib.decompress(classes), np.uint8)
        self.values = mix(np.arange(1, len(self.classes) + 1, dtype=np.uint64))
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self._reset()

    def _reset(self) -> None:
        """Transition 0 ends a text and emits nothing; transition 1 is the special token."""
        self.pieces = HashIndex()
        self.counts, self.starts = np.array([0, 1], np.int64), np.array([0, 0], np.int64)
        self.ids = np.array([self.special_id], np.int64)

    def _symbols(self, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
        kind = self.classes[chars]
        kind[ends] = 6
        symbol = np.array([LETTER, NUMBER, OTHER, BLANK_RUN, BLANK_RUN, OTHER, END], np.int64)[kind]
        blank = (kind == 3) | (kind == 4)
        joins = np.zeros(len(chars), bool)
        joins[:-1] = blank[:-1] & ~blank[1:] & (kind[1:] != 6)
        symbol[joins & (kind == 4)] = SPACE_THEN
        symbol[joins & (kind == 3)] = BLANK_THEN
        quotes = np.flatnonzero(kind == 5)
        if len(quotes):
            padded = np.concatenate([chars, np.zeros(2, chars.dtype)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            symbol[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SUFFIX1
            pair = one.astype(np.int64) << 32 | two
            symbol[quotes[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = SUFFIX2
        return symbol

    @staticmethod
    def _begins(symbol: np.ndarray) -> np.ndarray:
        """Positions at which pieces begin, by chunk maps and their prefix scan."""
        n = -(-len(symbol) // CHUNK)
        columns = np.full(n * CHUNK, END, np.int64)
        columns[: len(symbol)] = symbol
        columns = np.ascontiguousarray(columns.reshape(n, CHUNK).T) * STATES
        maps = np.tile(np.arange(STATES), (n, 1))
        for row in columns:
            maps = NEXT[maps + row[:, None]]
        step = 1
        while step < n:
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
            step *= 2
        state = np.full(n, FRESH)
        state[1:] = maps[:-1, FRESH]
        flags = np.empty((CHUNK, n), bool)
        for j, row in enumerate(columns):
            at = row + state
            flags[j] = BEGINS[at]
            state = NEXT[at]
        return np.flatnonzero(flags.T.ravel()[: len(symbol)])

    def _hashes(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            if len(self.power) <= len(chars):
                size = 1 << len(chars).bit_length()
                base = np.uint64(0xD6E8FEB86659FD93)
                self.power, self.inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, p, np.uint64)])) for p in (base, np.uint64(pow(int(base), -1, 1 << 64))))
            total = np.zeros(len(chars) + 1, np.uint64)
            np.cumsum(self.values[chars] * self.power[: len(chars)], out=total[1:])
            return mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64)) | np.uint64(1)

    def _batch(self, segments: list[str], last: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Transitions of the segments in order, and the index of the one that ends each segment."""
        joined = "\0".join(segments) + "\0"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        starts = self._begins(self._symbols(chars, ends))
        stops = np.append(starts[1:], len(chars))
        closing = np.searchsorted(starts, ends)
        keys = self._hashes(chars, starts, stops)
        real = np.ones(len(starts), bool)
        real[closing] = False
        out = np.empty(len(starts), np.int64)
        out[closing] = np.where(last, 0, 1)
        places = np.flatnonzero(real)
        if self.pieces.n > HELD_PIECES:
            self._reset()
        got = self.pieces.find(keys[places])
        missing = places[got < 0]
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            sizes, ids = self.merges.run([joined[starts[i] : stops[i]].encode("utf-8", "replace") for i in missing[first]])
            slots = len(self.counts) + np.arange(len(new))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.counts = np.concatenate([self.counts, sizes])
            self.ids = np.concatenate([self.ids, ids])
            self.pieces.add(new, slots)
            got = self.pieces.find(keys[places])
        out[places] = got
        return out, closing

    def run(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Groups of consecutive texts as ``(first, count, transitions, bounds)``."""
        at = 0
        while at < len(texts):
            first, segments, last, size = at, [], [], 0
            while at < len(texts) and (not segments or size < BATCH_CHARS):
                text = texts[at] or ""
                parts = text.split(self.special) if self.special and self.special in text else [text]
                segments += parts
                last += [False] * (len(parts) - 1) + [True]
                size += len(text) + 1
                at += 1
            out, closing = self._batch(segments, last)
            yield first, at - first, out, np.append(0, closing[np.array(last)] + 1)

    def token_counts(self, texts: Sequence[str | None]) -> np.ndarray:
        parts = [np.diff(np.append(0, np.cumsum(self.counts[moves]))[bounds]) for _, _, moves, bounds in self.run(texts)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def token_ids(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The token ids of each text, in order."""
        for _, count, moves, bounds in self.run(texts):
            sizes = self.counts[moves]
            ends = np.append(0, np.cumsum(sizes))
            flat = self.ids[np.repeat(self.starts[moves] - ends[:-1], sizes) + np.arange(ends[-1])]
            for i in range(count):
                yield flat[ends[bounds[i]] : ends[bounds[i + 1]]]


@lru_cache(2)
def transducer(path: str, classes: bytes) -> Transducer:
    """One per worker process."""
    return Transducer(path, classes)
