"""Exact BPE encoding by dynamic programming over prefixes, and decoding (operator 4)."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from photospark.llm.bytepair import Cache, PreTokens, Vocabulary, vocabulary
from photospark.llm.common import portions


class SuffixAutomaton:
    """Tokens that end at each place of some bytes, longest first, in one pass forwards.

    A state is a beginning of tokens; its suffix link is its longest proper end that is a state too, its output link the longest proper end that is a
    token. ``found`` is the state itself if it is a token, else its output link; 0, the empty beginning, ends every list."""

    def __init__(self, vocab: Vocabulary):
        self.step: dict[int, int] = {}  # state * 256 + byte -> state
        self.token, self.length = [-1], [0]
        grown = [(0, 0)]  # of each state: the state before it, and the byte between
        for data, i in vocab.id_of.items():
            state = 0
            for b in data:
                at = self.step.setdefault(state << 8 | b, len(grown))
                if at == len(grown):
                    grown.append((state, b))
                    self.token.append(-1)
                    self.length.append(self.length[state] + 1)
                state = at
            self.token[state] = i
        self.link, self.shorter, self.found = [0] * len(grown), [0] * len(grown), [0] * len(grown)
        for state in sorted(range(1, len(grown)), key=self.length.__getitem__):  # links lead to shorter states
            before, b = grown[state]
            self.link[state] = link = self.follow(self.link[before], b) if before else 0
            self.shorter[state] = self.found[link]
            self.found[state] = state if self.token[state] >= 0 else self.found[link]

    def follow(self, state: int, b: int) -> int:
        """The longest end of the state's bytes and ``b`` that is a state."""
        while (at := self.step.get(state << 8 | b)) is None:
            if not state:
                return 0
            state = self.link[state]
        return at

    def endings(self, data: bytes) -> Iterator[list[tuple[int, int]]]:
        """At each place, (length, token) of every token that the bytes so far end with, longest first."""
        state = 0
        for b in data:
            state = self.follow(state, b)
            at, own = self.found[state], []
            while at:
                own.append((self.length[at], self.token[at]))
                at = self.shorter[at]
            yield own


class Encoder:
    """Each prefix has just one possible last token: that of its exact encoding. A token that ends the prefix is the one if the prefix before it
    is encoded with a last token that BPE would leave standing beside it."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.automaton = vocab, SuffixAutomaton(vocab)
        self.known: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE over both tokens' bytes ends with the same two tokens: undo merges on both sides of the border, latest first, and look
        for one across the border that would have come earlier."""
        key = left << 32 | right
        if (known := self.known.get(key)) is not None:
            return known
        merges, halves, bound, ok = self.vocab.merges, self.vocab.halves, 1 << 60, None
        a, b = left, right
        while ok is None:
            if merges.get(a << 32 | b, 1 << 60) < bound:
                ok = False
                break
            a_whole, b_whole = halves[a][0] == a, halves[b][0] == b
            if a_whole and b_whole:
                ok = True
            elif b_whole or not a_whole and a > b:
                bound, a = a, halves[a][1]  # a merge on the left side comes before an equal one across the border
            else:
                bound, b = b + 1, halves[b][0]  # across the border stands further left, and so comes first
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[key] = ok
        return ok

    def encode(self, data: bytes) -> list[int]:
        last: list[tuple[int, int]] = [(-1, -1)]  # of each prefix: start and id of its last token
        for end, own in enumerate(self.automaton.endings(data), 1):
            for length, token in own:
                start = end - length
                if not start or self.compatible(last[start][1], token):
                    last.append((start, token))
                    break
            else:
                raise ValueError("no token ends this prefix")
        ids, end = [], len(data)
        while end:
            end, token = last[end]
            ids.append(token)
        return ids[::-1]


class Pieces:
    """Encoded pre-tokens by number: ids in one flat array."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        self.encode = encode
        self.cache = Cache(self.make, self.reset)
        self.reset()

    def reset(self) -> None:
        self.flat, self.begin = array("I"), array("q", [0])

    def make(self, words: list[str]) -> list[int]:
        first = len(self.begin) - 1
        for ids in self.encode(words):
            self.flat.extend(ids)
            self.begin.append(len(self.flat))
        return [*range(first, len(self.begin) - 1)]

    def encode_texts(self, texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another (uint32), and where those of each text begin, with the end."""
        parts, of, after = vocab.parts(texts)
        pre = PreTokens(parts)
        number = self.cache(pre)
        flat, begin = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32), np.frombuffer(self.begin, np.int64)
        size = begin[number + 1] - begin[number]
        sums = np.append(0, np.cumsum(size))
        ids = flat[np.repeat(begin[number] - sums[:-1], size) + np.arange(sums[-1])]
        at = sums[pre.first]
        special = np.flatnonzero(after >= 0)
        ids = np.insert(ids, at[1:][special], after[special]) if special.size else ids
        ends = at[1:] + np.cumsum(after >= 0)
        return ids.astype(np.uint32, copy=False), np.append(0, ends[np.searchsorted(of, np.arange(len(texts)), side="right") - 1])


@lru_cache(2)
def pieces(path: str) -> Pieces:
    encoder = Encoder(vocabulary(path))
    return Pieces(lambda words: [encoder.encode(w.encode()) for w in words])


@lru_cache(2)
def _decimal(path: str) -> tuple[list[str], list[bytes]]:
    """By id: the id in decimal after a comma, and the token's bytes."""
    n = max(vocabulary(path).token_bytes) + 1
    return [f",{i}" for i in range(n)], [vocabulary(path).token_bytes.get(i, b"") for i in range(n)]


def decode(ids: list[int], path: str) -> str:
    """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(_decimal(path)[1].__getitem__, ids)).decode("utf-8", "replace")


def _arrow(first: pa.Array, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([first, *columns.values()], ["key", *columns])


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab, store, (text_of, _) = vocabulary(path), pieces(path), _decimal(path)
    for batch in batches:
        n, ids_sha, text_sha = [], [], []
        for _, texts in portions(batch.column(1).to_pylist()):
            ids, begin = store.encode_texts(texts, vocab)
            for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                own = ids[a:b].tolist()
                n.append(b - a)
                ids_sha.append(hashlib.sha256("".join(map(text_of.__getitem__, own))[1:].encode()).hexdigest())
                text_sha.append(hashlib.sha256(decode(own, path).encode()).hexdigest())
        yield _arrow(batch.column(0), {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())})


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in portions(batch.column(1).to_pylist()):
            ids, begin = pieces(path).encode_texts(texts, vocabulary(path))
            yield _arrow(batch.column(0).slice(first, len(texts)), {"ids": pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids.astype(np.int32)))})


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _arrow(batch.column(0), {"text": pa.array([None if x is None else decode(x, path) for x in batch.column(1).to_pylist()], pa.string())})


def bpe_encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key and ids (array of int), exactly those of the tokenizers library without added special tokens.

    A null text is empty and has no ids; strings of special tokens inside a text become those tokens; a null key stays null; repeated rows
    each give their row; other columns are not read. Narrow: no shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(partial(_encode, path=tokenizer), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def bpe_decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The texts of arrays of ids: key and text (null for a null array, empty for an empty one)."""
    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(partial(_decode, path=tokenizer), f"key {kind}, text string").withColumnRenamed("key", key)


def codec_digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass: key, n_tokens, and SHA-256 of the decimal ids joined by commas and of the decoded text. Edge cases as
    bpe_encode; an empty text has the digests of nothing."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(partial(_digests, path=tokenizer), f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
