"""Words and word shingles of whole batches of texts as hashes in numpy. A word is a run of bytes other than space and 09 to 0D."""

from __future__ import annotations

import numpy as np

from photospark.llm.bytepair import mix64, span_hashes

#: Fixed odd factors, one for each word of a shingle.
_FACTORS = np.cumprod(np.full(64, 0xD1342543DE82EF95, np.uint64), dtype=np.uint64)


def word_places(data: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of texts of these sizes, each followed by one byte of white space, and the first word of each text, with the end."""
    raw = np.frombuffer(data, np.uint8)
    white = np.ones(raw.size + 2, bool)
    white[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts, ends = np.flatnonzero(white[:-1] & ~white[1:])[: raw.size + 1], np.flatnonzero(~white[:-1] & white[1:])
    return starts, ends, np.append(np.searchsorted(starts, np.cumsum(size + 1) - size - 1), starts.size)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the first word of each text, with the end."""
    coded = [t.encode() for t in texts]
    data = b"\n".join([*coded, b""])
    starts, ends, first = word_places(data, np.fromiter(map(len, coded), np.int64, len(coded)))
    return span_hashes(np.frombuffer(data, np.uint8), starts, ends), first


def windows(words: np.ndarray, first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of k words inside one text, and its text. With ``short``, a text of fewer words, but some, has one window: all of them."""
    n = np.diff(first)
    text = np.repeat(np.arange(n.size), np.maximum(n - (k - 1), 0))
    at = np.arange(text.size) + np.repeat(first[:-1] - np.append(0, np.cumsum(np.maximum(n - (k - 1), 0)))[:-1], np.maximum(n - (k - 1), 0))
    h = np.zeros(text.size, np.uint64)
    for j in range(k):
        h += words[at + j] * _FACTORS[j]
    h = mix64(h)
    if short and (few := np.flatnonzero((n > 0) & (n < k))).size:
        own = [mix64((words[first[i] : first[i + 1]] * _FACTORS[: n[i]]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n[i]))[0] for i in few.tolist()]
        h, text = np.append(h, np.array(own, np.uint64)), np.append(text, few)
    return h, text


def weighted(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, with their text and count."""
    if not h.size:
        return h, text, np.zeros(0, np.int64)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
    return h[first], text[first], np.diff(np.append(first, h.size))
