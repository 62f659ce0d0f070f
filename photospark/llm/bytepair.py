"""Byte-level BPE: the vocabulary, the pre-tokens of whole batches in numpy, and a bounded cache from pre-token to result.

A text is cut at the strings of special tokens, each part into pre-tokens by the usual byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``, and each pre-token is encoded alone."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np

LETTER, NUMBER, SPACE, OTHER = range(4)
#: The code points of White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[WHITE] = SPACE
    return table


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads every bit (splitmix)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for many spans that aren't empty, equal for equal spans wherever they stand.

    Each value and its place in the span give a mixed number, and a span has their sum: no pattern of values cancels out, as
    patterns do in polynomials modulo 2^64."""
    size = ends - starts
    if not size.size:
        return np.zeros(0, np.uint64)
    first = np.cumsum(size) - size
    n = int(size.sum())
    held = values[starts[0] : ends[-1]] if ends[-1] - starts[0] == n else values[_spread(starts, size)]
    place = np.arange(n, dtype=np.int32)
    place -= np.repeat(first.astype(np.int32), size)
    often = (held < 256) & (place < 64)
    index = (place << 8) + held.astype(np.int32)
    if often.all():
        mixed = _OFTEN.take(index)
    else:
        mixed = _OFTEN.take(np.where(often, index, 0))
        rest = np.flatnonzero(~often)
        mixed[rest] = _mixed_places(held[rest], place[rest])
    return mix64(np.add.reduceat(mixed, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def _mixed_places(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    return mix64(values.astype(np.uint64) + np.uint64(1) + (places.astype(np.uint64) << np.uint64(21)))


#: Of the values below 256 at the first 64 places, by place and value.
_OFTEN = _mixed_places(np.tile(np.arange(256), 64), np.repeat(np.arange(64), 256))


class PreTokens:
    """The pre-tokens of some parts of texts: code points, starts and ends of all pre-tokens, and the first pre-token of each part."""

    def __init__(self, parts: list[str]):
        self.joined = "".join(parts)
        self.cp = cp = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        begin = np.cumsum(size) - size
        self.starts = self._starts(cp, begin[size > 0])
        self.ends = np.append(self.starts[1:], cp.size) if self.starts.size else self.starts
        self.first = np.append(np.searchsorted(self.starts, begin), self.starts.size)
        self.hashes = span_hashes(cp, self.starts, self.ends)

    @staticmethod
    def _starts(cp: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not cp.size:
            return np.zeros(0, np.int64)
        kind = _classes()[cp]
        edge = np.zeros(cp.size + 3, bool)  # beyond the end, every place is an edge
        edge[begin] = True
        edge[cp.size :] = True
        starts = edge[:-2].copy()
        starts[1 : cp.size] |= kind[1:] != kind[:-1]
        white = kind == SPACE
        # The last of some white space before something else stands alone, and a plain space goes with what follows.
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~edge[1 : cp.size])
        starts[last] = True
        starts[last[cp[last] == 32] + 1] = False
        # An apostrophe that begins a pre-token takes one or two letters along.
        q = np.flatnonzero((cp[:-1] == 39) & starts[: cp.size - 1] & (kind[1:] == LETTER) & ~edge[1 : cp.size])
        if q.size:
            far = np.append(cp, [0, 0]).astype(np.int64)
            one, two = far[q + 1], np.where(edge[q + 2], 0, far[q + 2])
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            starts[q[short | long] + 1] = False
            starts[q[short] + 2] = True
            starts[q[long] + 3] = True
        return np.flatnonzero(starts[: cp.size])

    def piece(self, i: int) -> str:
        return self.joined[self.starts[i] : self.ends[i]]


class Cache:
    """From pre-token to a number, bounded: a direct-mapped table before a dict, both by hash. The code points of every entry are kept and compared with
    those of each pre-token that finds it; one that differs (a collision) gets its number by itself. All starts anew beyond ``keep`` entries or
    ``most`` code points."""

    def __init__(self, make: Callable[[list[str]], list[int]], reset: Callable[[], None] = lambda: None, bits: int = 21, keep: int = 700_000, most: int = 30_000_000):
        self.make, self.reset, self.keep, self.most, self.shift = make, reset, keep, most, np.uint64(64 - bits)
        self.keys, self.entry, self.more = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), {}
        self.clear()

    def clear(self) -> None:
        self.keys[:] = 0
        self.more.clear()
        self.held, self.at = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)
        self.values = np.zeros(0, np.int64)
        self.reset()

    def _add(self, pre: PreTokens, at: np.ndarray) -> None:
        """New entries for the pre-tokens at these places."""
        made = self.make([pre.piece(i) for i in at.tolist()])
        size = pre.ends[at] - pre.starts[at]
        ends = self.at[-1] + np.cumsum(size)
        if ends[-1] > self.held.size:
            self.held = np.append(self.held, np.zeros(max(self.held.size, int(ends[-1])), np.uint32))
        self.held[self.at[-1] : ends[-1]] = pre.cp[_spread(pre.starts[at], size)]
        self.more.update(zip(pre.hashes[at].tolist(), range(self.at.size - 1, self.at.size - 1 + at.size), strict=True))
        self.at = np.append(self.at, ends)
        self.values = np.append(self.values, np.array(made, np.int64))

    def _differs(self, pre: PreTokens, entry: np.ndarray) -> np.ndarray:
        """Places of pre-tokens that aren't what their entry holds."""
        size, own = pre.ends - pre.starts, self.at[entry + 1] - self.at[entry]
        wrong = size != own
        same = np.flatnonzero(~wrong)
        if same.size:
            n = size[same]
            own = pre.cp if same.size == size.size else pre.cp[_spread(pre.starts[same], n)]
            unequal = own != self.held.take(_spread(self.at[entry[same]], n))
            if not unequal.any():
                return np.flatnonzero(wrong)
            wrong[same] = np.logical_or.reduceat(unequal, np.cumsum(n) - n)
        return np.flatnonzero(wrong)

    def __call__(self, pre: PreTokens) -> np.ndarray:
        if len(self.more) > self.keep or self.at[-1] > self.most:
            self.clear()
        h = pre.hashes
        slot = (h >> self.shift).astype(np.int64)
        entry = self.entry[slot]
        miss = np.flatnonzero(self.keys[slot] != h)
        if miss.size:
            u, at, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            keys = u.tolist()
            if (new := np.array([i for i, k in enumerate(keys) if k not in self.more], np.int64)).size:
                self._add(pre, miss[at[new]])
            found = np.fromiter(map(self.more.__getitem__, keys), np.int32, len(keys))
            entry[miss] = found[inverse]
            place = slot[miss[at]]
            self.keys[place], self.entry[place] = u, found
        out = self.values[entry]
        if (wrong := self._differs(pre, entry)).size:
            out[wrong] = self.make([pre.piece(i) for i in wrong.tolist()])
        return out


def _spread(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of spans, one after another."""
    first = starts - (np.cumsum(size) - size)
    kind = np.int32 if starts.size and starts.max() + size.sum() < 1 << 31 else np.int64
    out = np.repeat(first.astype(kind), size)
    out += np.arange(out.size, dtype=kind)
    return out


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, the others counted up from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}


class Vocabulary:
    """Of a ``tokenizers`` JSON file with a byte-level BPE model.

    merges: id * 2^32 + id of a pair -> id of the merged token; ids of merged tokens rise with the rank of the merge (checked), so an id
    serves as rank. halves: token -> the pair it was merged from (a byte: itself twice). token_bytes: id -> bytes. specials: string -> id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token_bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.specials}
        self.id_of = {b: i for i, b in self.token_bytes.items()}
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.merges, self.halves = {}, {i: (i, i) for i in self.byte_id}
        last = max(self.byte_id)
        for pair in spec["model"]["merges"]:
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.id_of[self.token_bytes[a] + self.token_bytes[b]]
            if made <= last:
                raise ValueError("merged ids don't rise with their ranks")
            last = made
            self.merges[a << 32 | b], self.halves[made] = made, (a, b)
        self.longest = max(map(len, self.id_of))
        for text, i in self.specials.items():
            self.token_bytes[i] = text.encode()

    def parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The texts cut at special strings: parts, the text of each, and the special id that follows each part (-1: none)."""
        import re

        if not self.specials or not any(s in t for t in texts for s in self.specials):
            return texts, np.arange(len(texts)), np.full(len(texts), -1)
        cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        parts, of, after = [], [], []
        for i, t in enumerate(texts):
            bits = cut.split(t)
            parts += bits[::2]
            of += [i] * len(bits[::2])
            after += [*(self.specials[x] for x in bits[1::2]), -1]
        return parts, np.array(of), np.array(after)


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
