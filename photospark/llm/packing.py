"""Best-fit packing by minimum bin slack (operator 3)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.llm.bpe_codec import Pieces
from photospark.llm.bytepair import vocabulary
from photospark.llm.common import portions, stage


@lru_cache(2)
def _library(path: str) -> Pieces:
    """Pre-tokens encoded by the tokenizers library, each once."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return Pieces(lambda words: [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)])


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    vocab, library, last = vocabulary(path), _library(path), np.array([end_id], np.uint32)
    for batch in batches:
        source, piece, start, length, crc = [], [], [], [], []
        for first, texts in portions(batch.column(1).to_pylist()):
            ids, begin = library.encode_texts(texts, vocab)
            for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                own, n = np.append(ids[a:b], last), b - a + 1
                at = 0
                for j in range(math.ceil(n / size)):
                    to = at + (n - 1) % size + 1 if j == 0 else at + size
                    source.append(first + i), piece.append(j), start.append(at), length.append(to - at)
                    crc.append(zlib.crc32(own[at:to].astype("<u4").tobytes()))
                    at = to
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["key", "piece", "start", "length", "ids_crc32"]
        )


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each document: key, piece, start, length, ids_crc32. A document is its ids and end_id; one longer than ``size`` is cut into
    pieces of ``size``, of which the first may be shorter. A null text is empty: one piece with the end alone."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        partial(_cut, path=tokenizer, size=size, end_id=end_id), f"key {kind}, piece int, start long, length long, ids_crc32 long"
    )


def fullest(counts: np.ndarray, size: int, room: int) -> list[int]:
    """Lengths, from those available in ``counts``, that together fill ``room`` best: subset sums as the bits of one integer per length (counts
    split in powers of two), then back along the integers. Stops at the first length with which the room can be filled."""
    full, sums, steps = (1 << room + 1) - 1, 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, take = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((sums, length, take))
            sums |= sums << length * take & full
            left -= take
            take *= 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            chosen += [length] * take
            at -= length * take
    return chosen


def bin_plan(counts: np.ndarray, size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Minimum bin slack over a histogram of lengths 1 to size: each bin takes the longest length left and the fullest combination beside it,
    and the same bin is made as often as the counts allow; then its lengths are removed.

    Rows (length, first, last, bin, each, offset): the pieces of a length numbered first to last (exclusive) go to bins from ``bin`` on, ``each`` to
    a bin, at ``offset`` and after. At most a few rows for each length, however many pieces there are."""
    counts, used, rows, n_bins = counts.copy(), np.zeros_like(counts), [], 0
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        inside = [longest, *fullest(counts, size, size - longest)]
        counts[longest] += 1
        lengths, each = np.unique(inside, return_counts=True)
        times, offset = int((counts[lengths] // each).min()), 0
        for length, n in zip(lengths.tolist(), each.tolist(), strict=True):
            rows.append((length, int(used[length]), int(used[length]) + n * times, n_bins, n, offset))
            counts[length] -= n * times
            used[length] += n * times
            offset += n * length
        n_bins += times
    return rows


def pack(pieces: DataFrame, size: int = 2048, per_salt: int = 100_000) -> DataFrame:
    """``pieces`` (column length, 1 to size) with sequence_id and offset: sequences of at most ``size``, gapless from 0.

    Only the histogram of lengths (at most ``size`` rows, whatever the input) comes to the driver. Pieces of one length are alike and get numbers
    in parts: ``salt`` deals them out, a part is numbered alone, and the parts' counts give where each begins; so a length that holds a third
    of all pieces is spread over many tasks. ``pieces`` must be a fixed table. An empty one gives no rows."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().collect()
    counts = np.zeros(size + 1, np.int64)
    for r in histogram:
        counts[r["length"]] = r["count"]
    plan = spark.createDataFrame(bin_plan(counts, size), "length long, first long, last long, bin long, each long, at long")
    salts = max(16, math.ceil(int(counts.sum()) / per_salt))
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(salts)))
    parts = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("key", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("number", number).join(parts, ["length", "salt"]).withColumn("number", F.col("number") + F.col("base"))
    # A row's place in the plan; the plan's size is bounded by the number of lengths.
    placed = ranked.join(F.broadcast(plan), "length").where("number >= first and number < last")
    slot = F.col("number") - F.col("first")
    return placed.select(
        *[c for c in pieces.columns], (F.col("bin") + F.expr("(number - first) div each")).alias("sequence_id"), (F.col("at") + slot % F.col("each") * F.col("length")).alias("offset")
    )


def best_fit_packing(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are tokenized once, in a narrow pass whose small result (no texts or ids) is written to the shared folder; counting and numbering read
    that. Null and empty texts give a piece of one id, null and repeated keys keep their pieces, other columns are not read, and no rows give none."""
    pieces = stage(token_pieces(docs, tokenizer, size, end_id, key, text), "pieces")
    return pack(pieces, size).withColumnRenamed("key", key)
