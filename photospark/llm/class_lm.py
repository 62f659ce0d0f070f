"""Language-model scoring with Brown class-based bigrams (operator 9)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from photospark.llm.common import stage

#: Stands for the end of a text in streams of words; no word holds a space.
END = b" "


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and 09 to 0D, with A-Z lower-cased. In UTF-8 no other byte is touched."""
    return (text or "").encode().lower().split()


class _Ids(dict):
    """Word -> id; words that aren't in it have ``other``."""

    def __init__(self, ids: dict[bytes, int], other: int):
        super().__init__(ids)
        self.other = other

    def __missing__(self, key: bytes) -> int:
        return self.other


def _count(batches: Iterator[pa.RecordBatch], most: int = 300_000) -> Iterator[pa.RecordBatch]:
    """(word, n), summed over this task as far as ``most`` different words go."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*held], pa.binary()), pa.array([*held.values()], pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(words(text))
            if len(held) > most:
                yield out()
                held.clear()
    yield out()


def _stream(texts: list[str | None]) -> list[bytes]:
    out = []
    for t in texts:
        out += words(t)
        out.append(END)
    return out


def _id_streams(batches: Iterator[pa.RecordBatch], ids, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The words of some texts at a time as ids (words that have none: the number of ids), an end before and after each text; packed."""
    table = _Ids(ids.value, len(ids.value))
    for batch in batches:
        out = []
        for i in range(0, batch.num_rows, rows):
            stream = _stream(batch.column(0).slice(i, rows).to_pylist())
            raw = np.append(table[END], np.fromiter(map(table.__getitem__, stream), np.int64, len(stream))).astype("<i4").tobytes()
            out.append(len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["data"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The streams that _id_streams has packed."""
    for batch in batches:
        for x in batch.column(0):
            data = x.as_py()
            yield np.frombuffer(pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), "<i4").astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch], group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(a, b, n) over the groups of consecutive ids of this task's texts, each begun and ended by the end."""
    size = int(group.max()) + 1
    counts = np.zeros(size * size, np.int64)
    for got in _numbered(batches):
        got = group[got].astype(np.int64)
        counts += np.bincount(got[:-1] * size + got[1:], minlength=size * size)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(counts[at])], ["a", "b", "n"])


def _pair_counts(streams: DataFrame, group: np.ndarray) -> np.ndarray:
    """Matrix of counts of neighbouring groups; to the driver comes a row per pair of groups."""
    found = streams.mapInArrow(partial(_pairs, group=group.astype(np.int32)), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((int(group.max()) + 1,) * 2)
    out[found["a"], found["b"]] = found["n"]
    return out


def _contexts(batches: Iterator[pa.RecordBatch], group: np.ndarray, first: int, known: int, buckets: int, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, data): how often which class follows, and precedes, each word with an id from ``first`` to ``known``; packed as sorted keys
    (id * 2 + side) * classes + class, and counts. Combined before the shuffle."""
    n = int(group.max()) + 1
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        bucket = keys // (2 * n) % buckets
        out = []
        for b in range(buckets):
            own = np.flatnonzero(bucket == b)
            if own.size:
                raw = np.diff(keys[own], prepend=0).astype("<i8").tobytes() + counts[own].astype("<i8").tobytes()
                out.append((b, len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)))
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], ["bucket", "data"])

    size = 0
    for got in _numbered(batches):
        mine = np.flatnonzero((got >= first) & (got < known))
        word, to, fro = got[mine] * 2 * n, group[got[np.minimum(mine + 1, got.size - 1)]], group[got[mine - 1]]
        held += [word + to, word + n + fro]
        size += 2 * mine.size
        if size > most:
            yield flush()
            size = 0
    if held:
        yield flush()


def _best_classes(table: pa.Table, counts: np.ndarray, n_classes: int) -> pa.Table:
    """(id, class): for each word of a bucket the class that makes its class bigrams likeliest, from its counts with the classes on both sides."""
    n = counts.shape[0]
    keys, times = [], []
    for x in table["data"]:
        data = x.as_py()
        raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), "<i8").reshape(2, -1)
        keys.append(np.cumsum(raw[0]))
        times.append(raw[1])
    keys, times = np.concatenate(keys), np.concatenate(times)
    words, at = np.unique(keys // (2 * n), return_inverse=True)
    order = np.argsort(at, kind="stable")
    likely = np.log(counts + 0.5)
    gain = np.concatenate([(likely - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * n))[:n_classes].T, (likely - np.log(counts.sum(axis=0, keepdims=True) + 0.5 * n))[:, :n_classes]])
    best = np.zeros(words.size, np.int32)
    ends = np.searchsorted(at[order], np.arange(words.size + 1))
    for i in range(0, words.size, 4096):
        j = min(words.size, i + 4096)
        own = order[ends[i] : ends[j]]
        seen = np.zeros((j - i, 2 * n))
        np.add.at(seen, (at[own] - i, keys[own] % (2 * n)), times[own])
        best[i:j] = (seen @ gain).argmax(axis=1)
    return pa.table({"id": pa.array(words.astype(np.int32)), "class": pa.array(best)})


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_classes(pairs: np.ndarray, n_words: int, n_classes: int, sweeps: int = 10) -> np.ndarray:
    """Classes of the first ``n_words`` ids of a matrix of pair counts by exchange: each word in turn leaves its class for the one that makes the
    likelihood of the class bigrams largest, until a sweep moves none. Ids after them keep a class each, after the others."""
    size = pairs.shape[0]
    of = np.append(np.arange(n_words) % n_classes, n_classes + np.arange(size - n_words))
    total = n_classes + size - n_words
    member = np.zeros((size, total))
    member[np.arange(size), of] = 1
    counts = member.T @ pairs @ member
    weight = pairs.sum(axis=1), pairs.sum(axis=0)
    out_of, into = np.bincount(of, weight[0], total), np.bincount(of, weight[1], total)
    before, after = pairs @ member, pairs.T @ member  # of each word: counts with the class that follows, and that precedes
    for _ in range(sweeps):
        moved = 0
        for w in range(n_words):
            a, own = of[w], pairs[w, w]
            to, fro = before[w].copy(), after[w].copy()
            to[a] -= own
            fro[a] -= own
            counts[a] -= to
            counts[:, a] -= fro
            counts[a, a] -= own
            out_of[a] -= weight[0][w]
            into[a] -= weight[1][w]
            gain = (_xlogx(counts + to) - _xlogx(counts)).sum(axis=1) + (_xlogx(counts + fro[:, None]) - _xlogx(counts)).sum(axis=0)
            d = np.diag(counts)
            gain += _xlogx(d + to + fro + own) + _xlogx(d) - _xlogx(d + to) - _xlogx(d + fro)
            gain -= _xlogx(out_of + weight[0][w]) - _xlogx(out_of) + _xlogx(into + weight[1][w]) - _xlogx(into)
            b = int(gain[:n_classes].argmax())
            b = a if gain[b] <= gain[a] + 1e-9 else b
            counts[b] += to
            counts[:, b] += fro
            counts[b, b] += own
            out_of[b] += weight[0][w]
            into[b] += weight[1][w]
            if b != a:
                moved += 1
                of[w] = b
                for side, by in ((before, pairs[:, w]), (after, pairs[w])):
                    side[:, a] -= by
                    side[:, b] += by
        if not moved:
            break
    return of


@dataclass
class Model:
    """counts: word -> (number, count) of the ``n_known`` most frequent words and the end; class_of and emission by number; the last number stands for
    every other word. step: log10 of class transitions. Other words' emission is (c + 1) / rest."""

    counts: dict[bytes, int]
    count_of: np.ndarray
    class_of: np.ndarray
    emission: np.ndarray
    step: np.ndarray
    rest: int
    tokens: int
    types: int


def _most_frequent(table: DataFrame, most: int, steps: int = 500) -> list[tuple[bytes, int]]:
    """At most ``most`` (word, count), most frequent first: all words above a count that a histogram of log counts gives (a bounded number of rows), so that no
    task sends a whole list to be merged. Only where the highest step alone holds more does a plain top list serve."""
    step = F.floor(F.log("c") * steps).cast("int")
    held, lowest = 0, None
    for s, n in sorted(((r["s"], r["n"]) for r in table.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True):
        held += n
        if held > most:
            break
        lowest = s
    rows = table.orderBy(F.desc("c"), "word").limit(most) if lowest is None else table.where(step >= lowest)
    found = rows.select("word", "c").toPandas()
    return sorted(zip(map(bytes, found["word"]), found["c"].tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def train(texts: DataFrame, n_exact: int = 1000, classes: tuple[int, int] = (48, 128), n_known: int = 200_000, smooth: float = 0.1, sweeps: int = 4, settled: float = 0.02) -> tuple[DataFrame, Model]:
    """(table of every word with its count, model) from the one column of ``texts``.

    Classes number a tenth of the square root of the types, within ``classes``. The ``n_exact`` most frequent words are exchanged one by one, on
    their pair counts. All other words of the ``n_known`` most frequent are exchanged in sweeps of Spark jobs: a word's counts with the classes
    on both sides are gathered by buckets of words, and tasks give it the class that makes them likeliest; a sweep moves all words at once, until
    less than ``settled`` of them move. Words beyond share one class, in which a word has the share of its count plus one. To the driver come
    ``n_known`` words with their classes, and matrices over n_exact words and over the classes: bounds that are parameters, not data."""
    spark = texts.sparkSession
    table = stage(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")
    n_words, types = table.agg(F.sum("c"), F.count("*")).first()
    n_texts = texts.count()
    n_words, types = n_words or 0, types + (n_texts > 0)
    top = _most_frequent(table, n_known)
    n, k = len(top), min(n_exact, len(top))
    n_classes = max(1, min(k, max(classes[0], min(classes[1], math.isqrt(types) // 10))))
    total = n_classes + 2  # the end, and the class of all other words
    ids = {w: i for i, (w, _) in enumerate(top)} | {END: n}
    shared = spark.sparkContext.broadcast(ids)
    streams = stage(texts.mapInArrow(partial(_id_streams, ids=shared), "data binary"), "ids")  # so that no later pass parts texts into words
    count_of = np.array([c for _, c in top] + [n_texts, 0], np.int64)

    group = np.full(n + 2, k + 1)
    group[:k], group[n] = np.arange(k), k
    pairs = _pair_counts(streams, group)
    class_of = np.full(n + 2, n_classes + 1)
    class_of[:k], class_of[n] = exchange_classes(np.pad(pairs, (0, k + 2 - pairs.shape[0])), k, n_classes)[:k], n_classes
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = np.pad(c := _pair_counts(streams, class_of), (0, total - c.shape[0]))
    for _ in range(sweeps if n > k else 0):

        def best(table: pa.Table) -> pa.Table:
            return _best_classes(table, counts, n_classes)  # noqa: B023

        found = streams.mapInArrow(partial(_contexts, group=class_of.astype(np.int32), first=k, known=n, buckets=buckets), "bucket int, data binary").groupBy("bucket").applyInArrow(best, "id int, class int").toPandas()
        moved = int((class_of[found["id"]] != found["class"]).sum())
        class_of[found["id"]] = found["class"]
        counts = np.pad(c := _pair_counts(streams, class_of), (0, total - c.shape[0]))
        if moved <= settled * (n - k):
            break
    step = np.log10((counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * total))
    mass = np.bincount(class_of[:n], count_of[:n], total)
    rest = n_words - int(count_of[:n].sum()) + (types - (n_texts > 0) - n) + 1
    emission = np.zeros(n + 2)
    emission[:n] = np.log10(count_of[:n] / mass[class_of[:n]])
    return table, Model(ids, count_of, class_of, emission, step, rest, n_words + n_texts, types)


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """A row per text with what its known words give, and a row per text and other word with its count in the text."""
    m: Model = model.value
    number = _Ids(m.counts, m.count_of.size - 1)
    other, end = number.other, number[END]
    base_of = np.log10((m.count_of + 1) / (m.tokens + m.types + 1))
    base_of[other] = 0
    known_of = (m.count_of > 0).astype(np.int64)
    types = (pa.int64(), None, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = ["row", "key", "word", "times", "n_tokens", "n_known", "base_score", "score"]
    for batch in batches:
        for i in range(0, batch.num_rows, 300):
            part = batch.slice(i, 300)
            row, stream = part.column(0).to_pylist(), _stream(part.column(2).to_pylist())
            got = np.fromiter(map(number.__getitem__, stream), np.int64, len(stream))
            ends = np.flatnonzero(got == end)
            begin = np.append(0, ends[:-1] + 1)
            before = np.append(end, got[:-1])
            gain = m.step[m.class_of[before], m.class_of[got]] + m.emission[got]
            n_tokens, known = ends + 1 - begin, np.add.reduceat(known_of[got], begin)
            base, score = np.add.reduceat(base_of[got], begin), np.add.reduceat(gain, begin)
            unknown = np.flatnonzero(got == other)
            text = np.searchsorted(ends, unknown)
            rare = Counter(zip(text.tolist(), map(stream.__getitem__, unknown.tolist()), strict=True))
            zeros = np.zeros(len(rare))
            at = np.array([t for t, _ in rare], np.int64)
            # The key of a text's own row is no word, and its own, so that the join spreads these rows and finds nothing for them.
            columns = [
                row + [row[t] for t in at.tolist()], pa.concat_arrays([part.column(1), part.column(1).take(pa.array(at))]), [b" %d" % x for x in row] + [w for _, w in rare], [0] * len(row) + [*rare.values()],
                np.append(n_tokens, zeros.astype(np.int64)), np.append(known, zeros.astype(np.int64)), np.append(base, zeros), np.append(score, zeros),
            ]
            yield pa.RecordBatch.from_arrays([c if t is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def class_scores(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per row of ``docs``: key, held_out (not in training), n_tokens, n_known, train_tokens, base_score (add-one unigrams), score (log10 probability
    by class bigrams, each text begun by an end) and perplexity. The model learns from the rows where ``training`` holds; settings as train().

    A null text is empty: its end is its one token. Null and repeated keys keep their rows; other columns are not read; without training rows every word is
    unknown. Words beyond the broadcast ones are counted per text, joined to the table of all words, and summed with the rest of their text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    table, model = train(rows.where("training").select("text"), **settings)
    kind = docs.schema[key].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.struct("key", "training").alias("key"), "text")
    parts = numbered.mapInArrow(partial(_score, model=spark.sparkContext.broadcast(model)), f"row long, key struct<key: {kind}, training: boolean>, word binary, times long, n_tokens long, n_known long, base_score double, score double")
    joined = parts.join(table, "word", "left")
    c, times = F.coalesce("c", F.lit(0)), F.col("times")
    per_word = lambda over: times * F.log10((c + 1) / F.lit(float(over)))
    found = joined.groupBy("row").agg(
        F.max("key").alias("key"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(c > 0, times).otherwise(0)).alias("n_known"),
        F.sum(F.col("base_score") + per_word(model.tokens + model.types + 1)).alias("base_score"), F.sum(F.col("score") + per_word(model.rest)).alias("score"),
    )
    return found.select(
        F.col("key.key").alias(key), (~F.col("key.training")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
