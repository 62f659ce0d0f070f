"""Repeated passages, exact or fuzzy, by collinear chaining of shared word k-mers (operator 6).

A passage is a pair of spans of two documents, of ``least_words`` words or more each, whose alignment has at least ``identity`` equal words among its
columns (equal, changed, inserted and left-out words) and nowhere over ``most_gap`` columns between two runs of ``anchor`` equal words. With 51 words
and 0.9 this is wider than five-word shingles of similarity 0.8, which allow one changed word in about 47.

1. Seeds with places: minimizers of 5-word k-mers in windows of 4, so that any 8 equal words share one (46 equal words with 5 changes always hold 8),
and of 24-word k-mers, which tell texts apart whose shorter k-mers all stand in common lines. Blocks of seeds meet by hash, without texts.
2. Places that share a seed are tied: all pairs where a seed has few places, else each with the first one and the one before it.
3. The ties of each pair of documents become chains, on places alone. 4. Only the blocks of 64 words about chains are fetched. 5. Spans are
chained anew over exact runs, the words between and about them aligned, and the longest parts that reach the identity are told."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from photospark.llm.bytepair import mix64
from photospark.llm.common import portions, quoted, stage, whole_row
from photospark.llm.shingles import windows, word_hashes, word_places


@dataclass(frozen=True)
class Settings:
    """seeds: (words, window) of the k-mers of the search; few: places of a seed up to which all their pairs are tied; anchor: words of a k-mer of
    the chains; gap: cost of each word between two links of a chain, on either side; block: words of the blocks in which texts are fetched;
    margin: words fetched beyond a chain's ends; reach: words by which the ends of a chain are extended at most; drift: how far the shift of a run may lie
    outside those of the seeds. The others as said above."""

    seeds: tuple[tuple[int, int], ...] = ((5, 4), (24, 24))
    few: int = 4
    anchor: int = 5
    gap: float = 0.25
    most_gap: int = 25
    reach: int = 12
    drift: int = 6
    least_words: int = 51
    identity: float = 0.9
    block: int = 64
    margin: int = 45


def minimizers(h: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Places, among k-mer hashes in order, of the smallest of every ``window`` consecutive ones of a text (of all, if there are fewer)."""
    if not h.size:
        return np.zeros(0, np.int64)
    least, width = h.copy(), 1
    while width < window:  # minimum over [i, i + width), doubling; it never looks into the next text
        step = min(width, window - width)
        if least.size > step:
            same = text[step:] == text[:-step]
            least[:-step] = np.where(same, np.minimum(least[:-step], least[step:]), least[:-step])
        width += step
    # A k-mer is a seed if it is the minimum of a window that holds it: the largest such window minimum up to it says so.
    most, width = least.copy(), 1
    begin = np.append(True, text[1:] != text[:-1])
    ends = np.append(np.flatnonzero(begin)[1:], h.size)
    size = np.repeat(np.diff(np.append(np.flatnonzero(begin), h.size)), np.diff(np.append(np.flatnonzero(begin), h.size)))
    place = np.arange(h.size) - np.repeat(np.flatnonzero(begin), ends - np.flatnonzero(begin))
    most = np.where(place <= np.maximum(size - window, 0), least, 0)  # only whole windows, or the one of a short text
    whole = most.copy()
    while width < window:
        step = min(width, window - width)
        if whole.size > step:
            same = text[step:] == text[:-step]
            whole[step:] = np.where(same, np.maximum(whole[step:], whole[:-step]), whole[step:])
        width += step
    return np.flatnonzero(whole == h)


def seeds(words: np.ndarray, first: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place, words) of every seed of some texts."""
    out = []
    for k, window in s.seeds:
        h, text = windows(words, first, k, short=False)
        n = np.maximum(np.diff(first) - k + 1, 0)
        at = minimizers(h, text, window)
        text = text[at]
        out.append((mix64(h[at] + np.uint64(k)), text, at - (np.cumsum(n) - n)[text], np.full(at.size, k)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pack(keys: np.ndarray, marks: np.ndarray, arrays: list[np.ndarray]) -> bytes:
    """Seeds, sorted by document, as bytes: the documents (key, mark) that have some, then hash, document's number, place and words in columns. The
    hash keeps 40 bits beside those that chose the block; a chance tie costs time, not truth."""
    h, doc, place, words = arrays
    held, number = np.unique(doc, return_inverse=True)
    step = np.diff(number, prepend=0)
    parts = [np.array([h.size, held.size], "<u8"), keys[held].astype("<i8"), marks[held].astype("<i4"), step.astype("<u4"), (h >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5], place.astype("<u4"), words.astype(np.uint8)]
    raw = b"".join(np.ascontiguousarray(x).tobytes() for x in parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    """(hash, key, mark, place, words) of a block of seeds."""
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n, d = np.frombuffer(raw, "<u8", 2).tolist()
    at = 16
    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    keys, marks, number = take("<i8", d), take("<i4", d), np.cumsum(take("<u4", n).astype(np.int64))
    h = np.zeros((n, 8), np.uint8)
    h[:, :5] = take("u1", 5 * n).reshape(-1, 5)
    return h.reshape(-1).view("<u8"), keys[number], marks[number], take("<u4", n).astype(np.int64), take("u1", n).astype(np.int64)


TIES = "a long, a_mark int, b long, b_mark int, x int, y int, n int"
_TIE_NAMES = [x.split()[0] for x in TIES.split(", ")]
_TIE_TYPES = [{"long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in TIES.split(", ")]


def _groups(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of each run; same[i] says that i + 1 belongs to the run of i."""
    begin = np.flatnonzero(np.append(True, ~same))
    return begin, np.diff(np.append(begin, same.size + 1))


def _spread(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of runs, and the number of the run of each."""
    of = np.repeat(np.arange(size.size), size)
    return np.arange(of.size) + np.repeat(begin - (np.cumsum(size) - size), size), of


def _tie_to_heads(group: np.ndarray, doc: np.ndarray, previous: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (later, earlier) of places, from group and document ids sorted together: the n-th place in a document with the n-th (counted
    around) in the group's first document, and in the document before."""
    begin, size = _groups((group[1:] == group[:-1]) & (doc[1:] == doc[:-1]))  # the places of a document in a group
    place, of = _spread(begin, size)
    n = place - begin[of]
    new = np.append(True, group[begin][1:] != group[begin][:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(begin.size), 0))
    later, earlier = [], []
    for ref in (head, np.maximum(np.arange(begin.size) - 1, head))[: 1 + previous]:
        some = of != ref[of]
        if later:
            some &= ref[of] != head[of]
        later.append(place[some])
        earlier.append((begin[ref[of]] + n % size[ref[of]])[some])
    return np.concatenate(later), np.concatenate(earlier)


def _tie(group: np.ndarray, doc: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (later, earlier) of places, from group and document ids sorted together: all of a group of at most ``few``, else as _tie_to_heads."""
    begin, size = _groups(group[1:] == group[:-1])
    later, earlier = [], []
    for m in range(2, few + 1):
        own = begin[size == m]
        for i in range(1, m):
            for j in range(i):
                later.append(own + i), earlier.append(own + j)
    large = size > few
    place, _ = _spread(begin[large], size[large])
    a, b = _tie_to_heads(group[place], doc[place], True) if place.size else (place, place)
    a, b = np.concatenate([*later, place[a]]), np.concatenate([*earlier, place[b]])
    other = doc[a] != doc[b]
    return a[other], b[other]


def _seed_blocks(batches: Iterator[pa.RecordBatch], s: Settings, buckets: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows (key, mark, text) to rows (bucket, seeds, ties).

    Combined before the shuffle: of equal texts of a task the one of the smallest key has seeds, and the others are tied to it as a whole; of a seed
    with over ``few`` places here, one goes on and the others are tied to it and to the place before. So a common text or line sends a few rows
    per task."""
    held: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        keys, marks = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        h, doc, place, words = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4, 5))
        later, earlier, n = (np.concatenate([x[i] for x in held]) for i in (6, 7, 8))
        same_doc = np.unique(np.stack([keys, marks], axis=1), axis=0, return_inverse=True)[1].reshape(-1)  # equal for rows that repeat
        # Copies come in any order: the seeds of a text belong to its smallest key, or what that shares with smaller ones would be lost.
        smallest = np.arange(keys.size)
        for x, y in zip(later.tolist(), earlier.tolist(), strict=True):
            if same_doc[x] < same_doc[smallest[y]]:
                smallest[y] = x
        doc, later, earlier = smallest[doc], np.where(smallest[earlier] == later, earlier, later), smallest[earlier]
        order = np.argsort(h, kind="stable")
        begin, size = _groups(h[order][1:] == h[order][:-1]) if h.size else (np.zeros(0, np.int64),) * 2
        often = size > s.few
        inside, of = _spread(begin[often], size[often])
        at = order[inside]
        by = np.lexsort((place[at], same_doc[doc[at]], of))
        at, of = at[by], of[by]
        go = np.ones(h.size, bool)
        x_of, y_of = _tie_to_heads(of, same_doc[doc[at]], True) if at.size else (at, at)
        x_of, y_of = at[x_of], at[y_of]
        go[x_of] = False
        a, b = np.append(doc[x_of], later), np.append(doc[y_of], earlier)
        zeros = np.zeros(later.size, np.int64)
        other = same_doc[a] != same_doc[b]
        ties = [v[other] for v in (keys[a], marks[a], keys[b], marks[b], np.append(place[x_of], zeros), np.append(place[y_of], zeros), np.append(words[x_of], n))]
        spread = ((ties[0] * 31 + ties[4]) % buckets).astype(np.int64)
        h, doc, place, words = (v[go] for v in (h, doc, place, words))
        bucket = (h & np.uint64(buckets - 1)).astype(np.int64)
        order = np.lexsort((place, doc, bucket))
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        tie_order = np.argsort(spread, kind="stable")
        tie_ends = np.searchsorted(spread[tie_order], np.arange(buckets + 1))
        out: list[tuple] = []
        for c in range(buckets):
            own, tied = order[ends[c] : ends[c + 1]], tie_order[tie_ends[c] : tie_ends[c + 1]]
            if own.size or tied.size:
                out.append((c, _pack(keys, marks, [v[own] for v in (h, doc, place, words)]) if own.size else None, b"".join(v[tied].astype("<i8").tobytes() for v in ties) if tied.size else None))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["bucket", "seeds", "ties"])
        held.clear()

    total = docs = 0
    texts_seen: dict[str, int] = {}
    for batch in batches:
        keys, marks = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        order = np.lexsort((marks, keys))
        keys, marks = keys[order], marks[order]
        for first, texts in portions(batch.column(2).take(pa.array(order)).to_pylist()):
            words, at = word_hashes(texts)
            n, own, later, earlier, size = np.diff(at), np.zeros(len(texts), bool), [], [], []
            for i in np.flatnonzero(n >= s.least_words).tolist():
                j = texts_seen.setdefault(texts[i], docs + i)
                own[i] = j == docs + i
                if not own[i]:
                    later.append(docs + i), earlier.append(j), size.append(int(n[i]))
            h, text, place, count = seeds(words, at, s)
            go = own[text]
            part = slice(first, first + len(texts))
            held.append((keys[part], marks[part], h[go], text[go] + docs, place[go], count[go], *(np.array(v, np.int64) for v in (later, earlier, size))))
            docs += len(texts)
            total += int(go.sum())
            if total > most:
                yield from flush()
                total = docs = 0
                texts_seen.clear()
    if held:
        yield from flush()


def _bucket_ties(table: pa.Table, s: Settings) -> pa.Table:
    """The ties of a bucket: between its seeds, and those that tasks have made already."""
    found = [_unpack(x.as_py()) for x in table["seeds"] if x.is_valid]
    parts = []
    if found:
        h, keys, marks, place, words = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        some = order[np.append(False, same) | np.append(same, False)]
        h, keys, marks, place, words = (v[some] for v in (h, keys, marks, place, words))
        order = np.lexsort((place, marks, keys, words, h))
        h, keys, marks, place, words = (v[order] for v in (h, keys, marks, place, words))
        group = np.cumsum(np.append(0, (h[1:] != h[:-1]) | (words[1:] != words[:-1]))) if h.size else h.astype(np.int64)
        doc = np.unique(np.stack([keys, marks], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
        a, b = _tie(group, doc, s.few) if h.size else (np.zeros(0, np.int64),) * 2
        parts.append([keys[a], marks[a], keys[b], marks[b], place[a], place[b], words[a]])
    for x in table["ties"]:
        if x.is_valid:
            parts.append([*np.frombuffer(x.as_py(), "<i8").reshape(7, -1)])
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 7
    later = (columns[0] > columns[2]) | ((columns[0] == columns[2]) & (columns[1] > columns[3]))
    swapped = [np.where(later, columns[i], columns[j]) for i, j in ((0, 2), (1, 3), (2, 0), (3, 1), (4, 5), (5, 4))] + columns[6:]
    return pa.table([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(swapped, _TIE_TYPES, strict=True)], _TIE_NAMES)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted batches as tables that end where a group (equal values of the first ``keys`` columns) ends."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and all(rest[-1].column(i)[-1] == batch.column(i)[-1] for i in range(keys)):
            rest.append(batch)
            continue
        last = [np.asarray(batch.column(i)) for i in range(keys)]
        differs = np.logical_or.reduce([v != v[-1] for v in last])
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        yield pa.Table.from_batches([*rest, batch.slice(0, cut)], batch.schema).combine_chunks()
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


CHAINS = "a long, a_mark int, b long, b_mark int, x0 int, x1 int, y0 int, y1 int, low int, high int"


def _pair_chains(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Ties sorted by their pair to its chains: spans, and the smallest and largest shift (x less y) of their links."""
    names = [x.split()[0] for x in CHAINS.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in CHAINS.split(", ")]
    least = 2 * s.anchor - 1  # covered words of a chain
    for table in _whole_groups(batches, 4):
        if not table.num_rows:
            continue
        a, am, b, bm, x, y, n = (np.asarray(c).astype(np.int64) for c in table.columns)
        pair = np.cumsum(np.append(0, (a[1:] != a[:-1]) | (am[1:] != am[:-1]) | (b[1:] != b[:-1]) | (bm[1:] != bm[:-1])))
        order = np.lexsort((x, x - y, pair))
        pair, x, y, n, a, am, b, bm = (v[order] for v in (pair, x, y, n, a, am, b, bm))
        diagonal = np.cumsum(np.append(0, (pair[1:] != pair[:-1]) | ((x - y)[1:] != (x - y)[:-1])))
        end = x + n  # as far as any tie of the diagonal reaches
        far = np.maximum.accumulate(end + diagonal * (1 << 40)) - diagonal * (1 << 40)
        begin, _ = _groups((diagonal[1:] == diagonal[:-1]) & (x[1:] <= far[:-1]))
        size = np.maximum.reduceat(far, begin) - x[begin]
        pair, x, y, a, am, b, bm = (v[begin] for v in (pair, x, y, a, am, b, bm))
        first, count = _groups(pair[1:] == pair[:-1])
        enough = np.add.reduceat(size, first) >= least
        out: list[tuple] = []
        for i, m in zip(first[enough].tolist(), count[enough].tolist(), strict=True):
            about = int(a[i]), int(am[i]), int(b[i]), int(bm[i])
            runs = np.stack([x[i : i + m], y[i : i + m], size[i : i + m]], axis=1)
            for chain in chains(runs, s.gap) if m > 1 else [[0]]:
                links = runs[chain]
                if links[:, 2].sum() >= least:
                    shift = links[:, 0] - links[:, 1]
                    out.append((*about, int(links[0, 0]), int(links[-1, 0] + links[-1, 2]), int(links[0, 1]), int(links[-1, 1] + links[-1, 2]), int(shift.min()), int(shift.max())))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)


def _text_blocks(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Rows (key, mark, text) to (key, mark, block, part): the text in parts of ``block`` words."""
    for batch in batches:
        for first, texts in portions(batch.column(2).to_pylist()):
            coded = [t.encode() for t in texts]
            data = b"\n".join([*coded, b""])
            starts, at = word_places(data, np.fromiter(map(len, coded), np.int64, len(coded)))[::2]
            n = np.diff(at)
            count = np.where(n >= s.least_words, -(-n // s.block), 0)
            text = np.repeat(np.arange(len(texts)), count)
            block = np.arange(text.size) - np.repeat(np.cumsum(count) - count, count)
            begin = starts[at[text] + block * s.block]
            last = np.append(text[1:] != text[:-1], True) if text.size else np.zeros(0, bool)
            closes = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
            end = np.where(last, closes[text], np.append(begin[1:], 0))
            parts = [data[x:y].decode() for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
            own = pa.array(text + first)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(block, pa.int32()), pa.array(parts, pa.string())], ["key", "mark", "block", "part"])


def anchors(a: np.ndarray, b: np.ndarray, k: int, low: int, high: int) -> np.ndarray:
    """Maximal runs of at least k equal words between two texts (rows: start in a, start in b, length) whose shift (start in a less start in b) is
    from low to high."""
    ka, kb = (windows(v, np.array([0, v.size]), k, short=False)[0] for v in (a, b))
    kinds, rank = np.unique(np.append(ka, kb), return_inverse=True)
    width = np.int64(a.size + b.size + abs(low) + abs(high) + 2)
    of_b = np.sort(rank[ka.size :] * width + np.arange(kb.size) + abs(high) + 1)
    place = rank[: ka.size] * width + np.arange(ka.size) + abs(high) + 1
    least, most = np.searchsorted(of_b, np.maximum(place - high, rank[: ka.size] * width), "left"), np.searchsorted(of_b, np.minimum(place - low, (rank[: ka.size] + 1) * width - 1), "right")
    n = np.maximum(most - least, 0)
    x = np.repeat(np.arange(ka.size), n)
    if not x.size:
        return np.zeros((0, 3), np.int64)
    y = of_b[np.repeat(least, n) + np.arange(x.size) - np.repeat(np.cumsum(n) - n, n)] % width - abs(high) - 1
    by = np.lexsort((x, x - y))
    x, y = x[by], y[by]
    cut = np.flatnonzero(np.append(True, (np.diff(x) != 1) | (np.diff(y) != 1)))
    return np.stack([x[cut], y[cut], np.diff(np.append(cut, x.size)) + k - 1], axis=1)


class Fenwick:
    """Largest value, with its owner, over a prefix of places."""

    def __init__(self, n: int):
        self.tree = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.tree):
            if value > self.tree[i]:
                self.tree[i] = value
            i += i & -i

    def best(self, n: int) -> tuple[float, int]:
        """Over places below n."""
        found = (-1e18, -1)
        while n:
            found = max(found, self.tree[n])
            n -= n & -n
        return found


def chains(runs: np.ndarray, gap: float) -> list[list[int]]:
    """Collinear chains, best first, each run in one at most. A run's score is its length plus the best score of a run that ends before it on both
    sides, less ``gap`` for each word between, if that is positive. With each run's score kept as score + gap * (its ends), that is a prefix
    maximum over ends in b, while runs are passed by their starts in a."""
    runs = runs.tolist()
    ends = sorted({y + n for _, y, n in runs})
    tree = Fenwick(len(ends))
    score, back = [0.0] * len(runs), [-1] * len(runs)
    waiting = sorted(range(len(runs)), key=lambda i: runs[i][0] + runs[i][2])
    w = 0
    for i in sorted(range(len(runs)), key=lambda i: runs[i][0]):
        x, y, n = runs[i]
        while w < len(waiting) and runs[waiting[w]][0] + runs[waiting[w]][2] <= x:
            j = waiting[w]
            tree.put(bisect_left(ends, runs[j][1] + runs[j][2]), (score[j] + gap * (runs[j][0] + runs[j][1] + 2 * runs[j][2]), j))
            w += 1
        value, j = tree.best(bisect_left(ends, y + 1))
        score[i] = n + max(0.0, value - gap * (x + y))
        back[i] = j if score[i] > n else -1
    used, out = [False] * len(runs), []
    for i in sorted(range(len(runs)), key=lambda i: -score[i]):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = back[i]
        if own:
            out.append(own[::-1])
    return out


#: Columns of an alignment: equal words, changed words, a word of a alone, a word of b alone.
SAME, CHANGED, LEFT, RIGHT = range(4)


def runs_between(a: np.ndarray, b: np.ndarray, k: int, low: int, high: int, most: int = 2_000_000) -> np.ndarray:
    """As anchors(), by comparing words along each diagonal where those are few."""
    if (high - low + 1) * (a.size + 1) > most or high - low > 64:
        return anchors(a, b, k, low, high)
    shifts = np.arange(low, high + 1)[:, None]
    at = np.arange(a.size + 1) - shifts
    inside = (at >= 0) & (at < b.size)
    inside[:, -1] = False  # parts the diagonals
    equal = np.append(a, 0)[None, :] == b[np.where(inside, at, 0)]
    flat = np.append(False, (equal & inside).reshape(-1))
    edges = np.flatnonzero(flat[1:] != flat[:-1])
    begin, end = edges[::2], edges[1::2]
    long_enough = end - begin >= k
    begin, n = begin[long_enough], (end - begin)[long_enough]
    x = begin % (a.size + 1)
    return np.stack([x, x - low - begin // (a.size + 1), n], axis=1)


def align(a: list[int], b: list[int]) -> list[int]:
    """The columns of an alignment of fewest changes of two short lists of words."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    a, b = a[head:], b[head:]
    both = min(len(a), len(b))
    if not both or {*a}.isdisjoint(b):
        return [SAME] * head + [CHANGED] * both + [LEFT] * (len(a) - both) + [RIGHT] * (len(b) - both)
    rows = [[*range(len(b) + 1)]]
    for i, w in enumerate(a):
        before, row = rows[-1], [i + 1]
        for j, v in enumerate(b):
            row.append(before[j] if w == v else 1 + min(before[j], before[j + 1], row[j]))
        rows.append(row)
    i, j, out = len(a), len(b), []
    while i or j:
        cost = rows[i][j]
        if i and j and rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]) == cost:
            i, j = i - 1, j - 1
            out.append(SAME if a[i] == b[j] else CHANGED)
        elif i and rows[i - 1][j] + 1 == cost:
            i -= 1
            out.append(LEFT)
        else:
            j -= 1
            out.append(RIGHT)
    return [SAME] * head + out[::-1]


def _beyond(a: list[int], b: list[int]) -> list[int]:
    """Columns that a run may be extended by: the longest beginning of the alignment of which at least half is equal, up to its last equal word."""
    columns, best, equal = align(a, b), 0, 0
    for i, c in enumerate(columns, 1):
        equal += c == SAME
        if c == SAME and 2 * equal >= i:
            best = i
    return columns[:best]


def dense(equal: np.ndarray, s: Settings) -> Iterator[tuple[int, int]]:
    """The longest range of columns with at least ``identity`` equal ones (from an equal one to an equal one), then the same left and right of it."""
    score = np.append(0, np.cumsum(np.where(equal, round(1000 * (1 - s.identity)), -round(1000 * s.identity))))
    open_ranges = [(0, equal.size)]
    while open_ranges:
        i, j = open_ranges.pop()
        if j - i < s.least_words:
            continue
        begins, ends = np.flatnonzero(equal[i:j]) + i, np.flatnonzero(equal[i:j]) + i + 1
        if begins.size < s.identity * s.least_words:
            continue
        later = np.maximum.accumulate(score[ends][::-1])  # from the last end on, ascending
        far = ends.size - 1 - np.searchsorted(later, score[begins], "left")
        length = np.where(far >= 0, ends[far] - begins, 0)
        at = int(length.argmax())
        x, y = int(begins[at]), int(begins[at] + length[at])
        if y - x >= s.least_words:
            yield x, y
            open_ranges += [(i, x), (y, j)]


def passages(a: np.ndarray, b: np.ndarray, s: Settings, low: int | None = None, high: int | None = None) -> list[tuple[int, int, int, int, float]]:
    """(start in a, words, start in b, words, identity) of the passages that two spans share, from hashes of their words. A chain is cut where it has
    more than ``most_gap`` words between two links, extended at both ends, and its longest dense parts are told: first those that add ``least_words``
    words in a to those of better chains, then those that add ``anchor`` (a repeated line matches another at every shift)."""
    low, high = -b.size if low is None else low, a.size if high is None else high
    low, high = max(low, 1 - b.size), min(high, a.size - 1)
    if low > high:
        return []
    runs = runs_between(a, b, s.anchor, low, high)
    told, out = np.zeros(a.size, bool), []
    words_a, words_b = a.tolist(), b.tolist()
    parts = []
    for chain in chains(runs, s.gap):
        links = runs[chain]
        gaps = (links[1:, :2] - links[:-1, :2] - links[:-1, 2:]).max(axis=1) > s.most_gap if len(chain) > 1 else ()
        cuts = [0, *(np.flatnonzero(gaps) + 1).tolist(), len(chain)]
        parts += [links[i:j].tolist() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    for adds in (s.least_words, s.anchor):
        rest = []
        for part in parts:
            (x, y, _), (far, deep, n) = part[0], part[-1]
            if min(far - x, deep - y) + n + 2 * s.reach < s.least_words:
                continue
            about = told[max(0, x - s.reach) : far + n + s.reach]
            if about.size - np.count_nonzero(about) < adds:
                rest.append(part)
                continue
            m = min(s.reach, x, y)
            before = _beyond(words_a[x - m : x][::-1], words_b[y - m : y][::-1])[::-1]
            x0, y0, columns = x - sum(c != RIGHT for c in before), y - sum(c != LEFT for c in before), before
            for i, j, n in part:
                columns = columns + align(words_a[x:i], words_b[y:j]) + [SAME] * n
                x, y = i + n, j + n
            m = s.reach
            column = np.array(columns + _beyond(words_a[x : x + m], words_b[y : y + m]), np.int8)
            if column.size < s.least_words:
                continue
            equal, late = column == SAME, False
            for i, j in dense(equal, s):
                to_a, to_b = column != RIGHT, column != LEFT
                xa, na, yb, nb = x0 + int(to_a[:i].sum()), int(to_a[i:j].sum()), y0 + int(to_b[:i].sum()), int(to_b[i:j].sum())
                new = int((~told[xa : xa + na]).sum())
                if min(na, nb) >= s.least_words and new >= adds:
                    told[xa : xa + na] = True
                    out.append((xa, na, yb, nb, float(equal[i:j].mean())))
                elif new:
                    late = True
            if late:
                rest.append(part)
        parts = rest
    return out


FOUND = "key long, mark int, source long, start_word int, n_words int, source_start int, source_words int, identity double"


def _align_spans(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Rows (chain, side, block, part, about), sorted, to passages. A block that stands there twice (repeated rows) counts once."""
    types = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[x.split()[1]] for x in FOUND.split(", ")]
    for table in _whole_groups(batches, 1):
        if not table.num_rows:
            continue
        chain, side, block = (np.asarray(table[c]) for c in ("chain", "side", "block"))
        new = np.append(True, (chain[1:] != chain[:-1]) | (side[1:] != side[:-1]) | (block[1:] != block[:-1]))
        table = table.filter(pa.array(new))
        chain, side, block = chain[new], side[new], block[new]
        about = table["about"].to_pylist()
        out: list[tuple] = []
        parts = table["part"].to_pylist()
        begin, count = _groups(chain[1:] == chain[:-1])
        limit = 2_000_000  # characters hashed at once
        i = 0
        while i < begin.size:
            j, size = i, 0
            while j < begin.size and (j == i or size < limit):
                size += sum(map(len, parts[begin[j] : begin[j] + count[j]]))
                j += 1
            base = begin[i]
            words, at = word_hashes(parts[base : begin[j - 1] + count[j - 1]])
            for g in range(i, j):
                one, n = int(begin[g]), int(count[g])
                two = one + int(np.searchsorted(side[one : one + n], 1))
                if two == one or two == one + n or (c := about[one]) is None:
                    continue
                a, b = words[at[one - base] : at[two - base]], words[at[two - base] : at[one + n - base]]
                from_a, from_b = int(block[one]) * s.block, int(block[two]) * s.block
                shift = from_b - from_a
                for x, nx, y, ny, identity in passages(a, b, s, c["low"] + shift - s.drift, c["high"] + shift + s.drift):
                    out.append((c["a"], c["a_mark"], c["b"], x + from_a, nx, y + from_b, ny, identity))
            i = j
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], [x.split()[0] for x in FOUND.split(", ")])


def _mark(text: Column) -> Column:
    """32 bits that tell different texts of one key apart."""
    return F.hash(text)


def _found(docs: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """FOUND: passages by key and mark of the text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"), F.col(text).alias("text")).where("key is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << math.ceil(math.log2(max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 26)))
    blocks = rows.mapInArrow(partial(_seed_blocks, s=s, buckets=buckets), "bucket int, seeds binary, ties binary")

    def tie(table: pa.Table) -> pa.Table:
        return _bucket_ties(table, s)

    ties = blocks.groupBy("bucket").applyInArrow(tie, TIES)
    pair = ["a", "a_mark", "b", "b_mark"]
    found = ties.repartition(*pair).sortWithinPartitions(*pair).mapInArrow(partial(_pair_chains, s=s), CHAINS)
    found = stage(found.withColumn("chain", F.monotonically_increasing_id()), "chains")
    asked = None
    for side, (k, m, begin, end) in enumerate((("a", "a_mark", "x0", "x1"), ("b", "b_mark", "y0", "y1"))):
        first = F.expr(f"greatest({begin} - {s.margin}, 0) div {s.block}").cast("int")
        last = F.expr(f"({end} + {s.margin - 1}) div {s.block}").cast("int")
        part = found.withColumn("block", F.explode(F.sequence(first, last)))
        about = F.when(F.lit(side == 0) & (F.col("block") == first), F.struct("a", "a_mark", "b", "low", "high"))
        part = part.select(F.col(k).alias("key"), F.col(m).alias("mark"), "block", "chain", F.lit(side).alias("side"), about.alias("about"))
        asked = asked.union(part) if asked else part
    parts = rows.mapInArrow(partial(_text_blocks, s=s), "key long, mark int, block int, part string")
    spans = asked.join(parts, ["key", "mark", "block"]).select("chain", "side", "block", "part", "about")
    return spans.repartition("chain").sortWithinPartitions("chain", "side", "block").mapInArrow(partial(_align_spans, s=s), FOUND)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Passages that a document shares with one of a smaller key: key, source_<key>, start_word, n_words, source_start, source_words, identity. Words count
    from 0 and are runs of characters other than space and 09 to 0D.

    A seed with few places ties all of them; one with more ties each to the first and to the one before: linear in the occurrences, however common.
    So each document that holds a passage is told with some holder of it, not with all.

    A text that is null, empty or shorter than a passage shares none. Documents without a key take no part. Different texts of one key are
    documents of their own (told by 32 bits of hash beside the key), in an order of their own; repeated rows are one document. Other columns
    are not read; no rows give none."""
    found = _found(docs, key, text, settings).drop("mark").distinct()
    return found.withColumnsRenamed({"key": key, "source": f"source_{key}"})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (column 0) without the words of spans (column 1: lists of start and number), each with the white space after it."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if spans and text is not None:
                data = text.encode()
                raw = np.frombuffer(data, np.uint8)
                white = np.append(True, (raw == 32) | ((raw >= 9) & (raw <= 13)))
                starts = np.append(np.flatnonzero(white[:-1] & ~white[1:]), raw.size)
                keep = np.ones(raw.size, bool)
                for x in spans:
                    if x["start_word"] + x["n_words"] < starts.size:
                        keep[starts[x["start_word"]] : starts[x["start_word"] + x["n_words"]]] = False
                text = raw[keep].tobytes().decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[2:]], ["text", *batch.schema.names[2:]])


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with all its rows and columns, but each repeated passage cut from every text except that of the smallest key; the column ``length``, if
    there, is the new text's characters. Spans belong to key and text, so that rows of one key with other texts stay as they are. A text may
    become empty. Edge cases as repeated_passages."""
    spans = _found(docs, key, text, settings).groupBy("key", "mark").agg(F.collect_set(F.struct("start_word", "n_words")).alias("spans"))
    rows = docs.select(whole_row(docs).alias("row"), F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).alias("text"))
    joined = rows.withColumn("mark", _mark(F.col("text"))).join(spans, ["key", "mark"], "left").select("text", "spans", "row")
    cut = joined.mapInArrow(_cut, T.StructType([T.StructField("text", T.StringType()), rows.schema["row"]]))
    new = {text: F.col("text")} | ({length: F.length("text").cast(docs.schema[length].dataType)} if length in docs.columns else {})
    return cut.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])
