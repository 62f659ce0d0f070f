"""Token counts by heap-and-linked-list byte-pair merging (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from photospark.llm.bytepair import Cache, PreTokens, Vocabulary, vocabulary
from photospark.llm.common import portions


def merged_length(data: bytes, vocab: Vocabulary) -> int:
    """Tokens of one pre-token: its bytes less the merges made. The heap gives the lowest-rank (then leftmost) adjacent pair; neighbours
    are linked by place; an entry whose pair is gone is passed over."""
    n = len(data)
    if n < 2:
        return n
    merges, symbol = vocab.merges, [vocab.byte_id[b] for b in data]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [r << 32 | i for i in range(n - 1) if (r := merges.get(symbol[i] << 32 | symbol[i + 1])) is not None]
    heapify(heap)
    made = 0
    while heap:
        entry = heappop(heap)
        rank, i = entry >> 32, entry & 0xFFFFFFFF
        j = after[i]
        if j < 0 or symbol[i] < 0 or merges.get(symbol[i] << 32 | symbol[j]) != rank:
            continue
        symbol[i], symbol[j], k = rank, -1, after[j]
        after[i] = k
        made += 1
        if k >= 0:
            before[k] = i
            if (r := merges.get(rank << 32 | symbol[k])) is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0 and (r := merges.get(symbol[h] << 32 | rank)) is not None:
            heappush(heap, r << 32 | h)
    return n - made


@lru_cache(2)
def _cache(path: str) -> Cache:
    vocab = vocabulary(path)
    return Cache(lambda words: [merged_length(w.encode(), vocab) for w in words])


def counts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text."""
    vocab, cache = vocabulary(path), _cache(path)
    parts, of, after = vocab.parts(texts)
    pre = PreTokens(parts)
    sums = np.append(0, np.cumsum(cache(pre), dtype=np.int64))
    out = np.zeros(len(texts), np.int64)
    np.add.at(out, of, sums[pre.first[1:]] - sums[pre.first[:-1]] + (after >= 0))
    return out


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [counts(texts, path) for _, texts in portions(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate([np.zeros(0, np.int64), *found]))], ["key", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit (n_tokens > limit); no identifiers are made.

    tokenizer: path of a byte-level BPE file of the tokenizers library, on every machine. A null text counts as empty (0 tokens); strings
    of special tokens inside a text count as one token each; a null key stays null; repeated rows and keys each give their row; other
    columns are not read. Narrow: no shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    text_column = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(F.col(key).alias("key"), text_column.alias("text"), F.octet_length(text_column).cast("long").alias("n_bytes"))
        .mapInArrow(partial(_count, path=tokenizer), f"key {kind}, n_bytes long, n_tokens long")
        .select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
