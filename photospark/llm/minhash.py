"""Near-duplicates by ProbMinHash over weighted word shingles (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from photospark.llm.bytepair import mix64
from photospark.llm.common import connected_components, portions, stage, whole_row
from photospark.llm.shingles import weighted, windows, word_hashes

REGISTERS, BANDS = 128, 32


def signatures(elements: np.ndarray, text: np.ndarray, weight: np.ndarray, n_texts: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (n_texts, m): each element of weight w sends arrivals of a Poisson process of rate w to random registers; a register
    keeps the element of its earliest arrival. An element is done once its next arrival is later than every register of its text has."""
    times, kept, limit = np.full((n_texts, m), np.inf), np.zeros(n_texts * m, np.uint32), np.full(n_texts, np.inf)
    flat, shown = times.reshape(-1), mix64(elements).astype(np.uint32)
    t, w, i = np.zeros(elements.size), weight.astype(float), 0
    while elements.size:
        i += 1
        r = mix64(elements + np.uint64(i * 0xA0761D6478BD642F & (1 << 64) - 1))
        t = t - np.log(((r >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / w
        going = t < limit[text]
        if not going.all():
            elements, text, t, w, shown, r = (x[going] for x in (elements, text, t, w, shown, r))
        at = text * m + (r % np.uint64(m)).astype(np.int64)
        np.minimum.at(flat, at, t)
        first = flat[at] == t
        kept[at[first]] = shown[first]
        own = np.unique(text) if i > 2 else np.arange(n_texts)
        limit[own] = times[own].max(axis=1)
    return kept.reshape(n_texts, m)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two weighted sets (sorted distinct elements, weights): the sum over common elements d of 1 / sum over all d' of
    max(a(d') / a(d), b(d') / b(d)). For equal weights it is the plain Jaccard similarity."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    upto = np.searchsorted(ratio, ratio, side="right")  # elements of at most this ratio count by a, the others by b
    low, high = np.append(0, np.cumsum(x))[upto], y.sum() - np.append(0, np.cumsum(y))[upto]
    return float((1 / ((a[1].sum() - x.sum() + low) / x + (b[1].sum() - y.sum() + high) / y)).sum())


def _sign(batches: Iterator[pa.RecordBatch], k: int, m: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, rows = [], []
        for _, texts in portions(batch.column(3).to_pylist()):
            words, first = word_hashes(texts)
            elements, text, weight = weighted(*windows(words, first, k))
            n.append(np.bincount(text, minlength=len(texts)))
            rows.append(signatures(elements, text, weight, len(texts), m))
        sig = np.concatenate([np.zeros((0, m), np.uint32), *rows]).astype(np.int32)
        values = pa.ListArray.from_arrays(pa.array(np.arange(sig.shape[0] + 1) * m, pa.int32()), pa.array(sig.reshape(-1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate([np.zeros(0, np.int64), *n]), pa.int64()), values], ["key", "h1", "h2", "n", "sig"])


def _verify(batches: Iterator[pa.RecordBatch], k: int, least: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) of at least the similarity; rows that follow each other mostly share b."""
    seen: dict[int, tuple] = {}

    def shingled(i: int, text: str) -> tuple:
        if i not in seen:
            if len(seen) > 64:
                seen.clear()
            elements, _, weight = weighted(*windows(*word_hashes([text]), k))
            seen[i] = elements, weight
        return seen[i]

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found = [probability_jaccard(shingled(x, batch.column(2)[i].as_py()), shingled(y, batch.column(3)[i].as_py())) for i, (x, y) in enumerate(zip(a, b, strict=True))]
        keep = np.flatnonzero(np.array(found) >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(np.array(found)[keep], pa.float64())], ["a", "b", "similarity"])


def _shared_weight(sets: list[tuple[np.ndarray, np.ndarray]], columns: int = 2_000) -> np.ndarray:
    """[x, y]: the share of x's weight on elements that y has too, for weighted sets (sorted distinct elements, weights), by products of incidence
    matrices, ``columns`` elements at a time; elements of one set alone are left out."""
    flat, of = np.concatenate([e for e, _ in sets]), np.repeat(np.arange(len(sets)), [e.size for e, _ in sets])
    share = np.concatenate([w / max(1, w.sum()) for _, w in sets])
    _, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    often = n > 1
    number = np.cumsum(often) - 1
    keep = often[at]
    at, of, share = number[at[keep]], of[keep], share[keep]
    order = np.argsort(at, kind="stable")
    at, of, share = at[order], of[order], share[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(often.sum()), columns):
        a, b = np.searchsorted(at, [first, first + columns])
        held, has = np.zeros((len(sets), columns), np.float32), np.zeros((len(sets), columns), np.float32)
        held[of[a:b], at[a:b] - first] = share[a:b]
        has[of[a:b], at[a:b] - first] = 1
        out += held @ has.T
    return out


def _block(table: pa.Table, k: int, least: float) -> pa.Table:
    """Verified links (a, b, similarity) between different parts inside one pair of blocks, enough to connect what the block connects.

    An element d gives a similarity at most the smaller of its shares of the two texts' weights, so a pair whose common elements hold less than
    ``least`` of either text's weight can't be similar enough; all others are verified, likely ones first, but for pairs that are connected by then."""
    t = table.combine_chunks()
    cid, part, side, one = t["cid"].to_pylist(), np.asarray(t["part"]), np.asarray(t["side"]), t["kind"][0].as_py() == 0 and t["i"][0].as_py() == t["j"][0].as_py()
    sets = []
    for x in t["text"]:
        elements, _, weight = weighted(*windows(*word_hashes([x.as_py()]), k))
        sets.append((elements, weight))
    left = np.arange(len(cid)) if one else np.flatnonzero(side == 0)
    right = left if one else np.flatnonzero(side == 1)
    out: list[tuple] = []
    if left.size and right.size:
        share = _shared_weight(sets)
        bound = np.minimum(share, share.T)[np.ix_(left, right)]
        bound[part[left][:, None] == part[right][None, :]] = 0
        if one:
            bound[np.tril_indices(left.size)] = 0
        x_of, y_of = np.nonzero(bound >= least - 0.001)
        root = {p: p for p in part.tolist()}

        def top(p: int) -> int:
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        for i in np.argsort(-bound[x_of, y_of], kind="stable").tolist():
            x, y = int(left[x_of[i]]), int(right[y_of[i]])
            p, q = top(int(part[x])), top(int(part[y]))
            if p != q and (j := probability_jaccard(sets[x], sets[y])) >= least:
                root[p] = q
                out.append((cid[x], cid[y], j))
    return pa.table({n: pa.array([o[i] for o in out], kind) for i, (n, kind) in enumerate((("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())))})


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text (null: empty) and 128 bits of hash that stand for the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("key"), t.alias("text"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit("second"), t).alias("h2"))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, least: float = 0.8, block_texts: int = 300) -> tuple[DataFrame, DataFrame]:
    """(classes, links). classes: one row per distinct text, (h1, h2, cid, component, component_key): its number, the number of its near-duplicate class, and
    the smallest key in that. links: verified pairs (a, b, similarity) of different texts by number, enough to connect each class.

    1. A signature per text; texts that are equal count once. 2. Bands of 4 registers: a pair of probability Jaccard 0.8 shares none of the 32 with
    probability 5e-8. 3. In each bucket every text is verified, on whole texts, against the first and against one that the bucket's hash picks: linear in
    the bucket, however hot, and as buckets pick different ones, nearly all links of a hot group are found. 4. Texts of buckets that still hold several
    components meet, by the largest component of the bucket, in blocks of ``block_texts``: those outside the largest component against it and
    each other, so that a few stragglers of a hot group cost a pass over it. Tasks bound and verify the pairs that aren't yet connected, so that no
    list of pairs is ever made."""
    keyed = _keyed(docs, key, text)
    signed = keyed.select("key", "h1", "h2", "text").mapInArrow(partial(_sign, k=k, m=REGISTERS), "key long, h1 long, h2 long, n long, sig array<int>")
    classes = stage(signed.groupBy("h1", "h2").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("sig").alias("sig")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    rows = REGISTERS // BANDS
    band = F.array(*[F.xxhash64(F.lit(b), *[F.get("sig", b * rows + j) for j in range(rows)]) for b in range(BANDS)])
    bands = classes.where("n > 0").select("cid", F.explode(band).alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.min("cid").alias("head"), F.min_by("cid", F.xxhash64("bucket", "cid")).alias("other"), F.count("*").alias("size")).where("size > 1")
    shared = stage(bands.join(buckets, "bucket").select("bucket", "cid", "head", "other"), "buckets")  # only buckets of two and more
    ends = F.explode(F.array("head", "other"))
    star = shared.select("cid", ends.alias("end")).where("cid <> end").select(F.greatest("cid", "end").alias("a"), F.least("cid", "end").alias("b")).distinct()

    def fetch(named: DataFrame) -> DataFrame:
        """Rows with a number, with its text. Of equal texts, the row with the class's smallest key stands for all; repeated rows of that key count once."""
        named = named.join(classes.select("cid", "h1", "h2", "key"), "cid")
        own = [c for c in named.columns if c not in ("h1", "h2", "key")]
        return keyed.join(named, (keyed.h1 == named.h1) & (keyed.h2 == named.h2) & keyed.key.eqNullSafe(named.key)).select(*own, "text").dropDuplicates(["cid"])

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar enough, on whole texts."""
        pairs = stage(pairs, "pairs")
        texts = stage(fetch(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()), "texts")
        both = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
        return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(partial(_verify, k=k, least=least), "a long, b long, similarity double"), "links")

    links = verified(star)
    parts = stage(connected_components(links), "components")
    here = shared.join(parts.withColumnRenamed("id", "cid"), "cid", "left").select("bucket", "cid", F.coalesce("component", "cid").alias("part"))
    sizes = here.groupBy("bucket", "part").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    # Texts of buckets with several components, under the largest component there: texts that share a bucket share that.
    opened = stage(here.join(sizes, "bucket").select("cid", "part", F.col("main.part").alias("group")).distinct(), "open")
    if not opened.isEmpty():
        rest = stage(opened.join(fetch(opened.select("cid").distinct()), "cid").withColumn("out", F.col("part") != F.col("group")), "rest")
        n_blocks = lambda c: F.ceil(F.count_if(c) / F.lit(block_texts)).cast("int")
        blocks = rest.groupBy("group").agg(n_blocks(F.col("out")).alias("n_out"), n_blocks(~F.col("out")).alias("n_main"))
        mine = F.when(F.col("out"), F.col("n_out")).otherwise(F.col("n_main"))
        dealt = rest.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("cid"), mine).cast("int"))
        # Texts outside the group's largest part meet that (kind 1) and each other (kind 0); the largest part's own pairs are connected already.
        row = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
        each = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array())
        own = F.col("own")
        meets = F.when(
            F.col("out"),
            F.concat(each(F.col("n_main"), lambda o: row(1, own, o, F.lit(0))), each(F.col("n_out"), lambda o: row(0, F.least(own, o), F.greatest(own, o), (own > o).cast("int")))),
        ).otherwise(each(F.col("n_out"), lambda o: row(1, o, own, F.lit(1))))
        dealt = dealt.select("group", F.explode(meets).alias("at"), "cid", "part", "text").select("group", "at.*", "cid", "part", "text")

        def block(table: pa.Table) -> pa.Table:
            return _block(table, k, least)

        links = links.union(stage(dealt.groupBy("group", "kind", "i", "j").applyInArrow(block, "a long, b long, similarity double"), "links"))
        parts = stage(connected_components(links), "components")
    found = classes.join(parts.withColumnRenamed("id", "cid"), "cid", "left").select("h1", "h2", "cid", "key", F.coalesce("component", "cid").alias("component"))
    keys = found.groupBy("component").agg(F.min("key").alias("component_key"))
    return stage(found.join(keys, "component").select("h1", "h2", "cid", "component", "component_key"), "decided"), links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, least: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: key, component_id (smallest key of its near-duplicate class, its own included), kept (key = component_id).

    Texts are linked if their probability Jaccard over k-word shingles, weighted by count, is at least ``least``; classes are what links connect.
    A text of fewer words has one shingle, all its words. Equal texts share a class, those without words too, which link with nothing else. A
    null text is empty. Rows with a null key belong to a class, with its smallest key, and aren't kept; if no row of a class has a key, its
    component_id is null. Repeated rows each give their row. Other columns are not read; no rows give none."""
    classes, _ = near_classes(docs, key, text, k, least)
    found = _keyed(docs, key, text).drop("text").join(classes, ["h1", "h2"])
    return found.select(F.col("key").alias(key), F.col("component_key").alias("component_id"), F.coalesce(F.col("key") == F.col("component_key"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their near-duplicate class: the one with the smallest key (of repeated rows with that key
    and text, one; of a class without keys, one)."""
    classes, _ = near_classes(docs, key, text, k, least)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(whole_row(docs).alias("row"), docs[key].cast("long").alias("key"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit("second"), t).alias("h2"))
    # The class's own text is the one whose number the smallest key has: other texts with that key (repeated keys) go as well.
    heads = _keyed(docs, key, text).drop("text").join(classes, ["h1", "h2"]).where(F.col("key").eqNullSafe(F.col("component_key")))
    heads = heads.groupBy("component").agg(F.min(F.struct("cid", "key", "h1", "h2")).alias("head")).select("head.*").drop("cid")
    kept = rows.join(heads, rows.key.eqNullSafe(heads.key) & (rows.h1 == heads.h1) & (rows.h2 == heads.h2), "left_semi")
    return kept.dropDuplicates(["key", "h1", "h2"]).select("row.*")
