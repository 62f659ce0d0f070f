"""Hard-negative mining by a full sort of every anchor's scores (operator 12).

Anchors are a stated share of the rows and meet all rows, in blocks of bounded size: each pair of an anchor block and a row block is one task's group. There
all scores of an anchor are computed as whole numbers and sorted by score and id. The first pass keeps what may be an anchor's positives; the second
finds each positive's upper limit in the sorted scores by binary search and reads the next different-label rows down to the lower limit. What blocks
found is merged by the same order, so the rows are those of one sort over the whole table."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.llm.common import stage

#: Scaled components are held within this, so that scores of 4,096 of them times 5 are longs.
MOST = 2**24


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """cid, key, label and vectors of a block, in order of key."""
    table = table.sort_by([("key", "ascending"), ("cid", "ascending")]).combine_chunks()
    x = np.asarray(table["q"].combine_chunks().flatten()).reshape(len(table), -1)
    return np.asarray(table["cid"]), np.asarray(table["key"]), np.asarray(table["label"]), x


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products: in doubles, where those are exact, else in longs."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(rows).max(initial=0)) * rows.shape[1]
    if most < 2**53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def _positives(left: pa.Table, right: pa.Table, most: int, chunk: int = 64) -> pa.Table:
    """Of each anchor (left) the first ``most`` other rows of its label in this block (right)."""
    out: list[list] = [[], [], [], []]
    if len(left) and len(right):
        a_cid, _, a_label, a = _side(left)
        cid, key, label, x = _side(right)
        for at in range(0, len(a), chunk):
            scores = _scores(a[at : at + chunk], x)
            for i, own in enumerate(scores, at):
                same = np.flatnonzero((label == a_label[i]) & (cid != a_cid[i]))
                best = same[np.lexsort((cid[same], key[same], -own[same]))[:most]]
                for column, values in zip(out, (np.full(best.size, a_cid[i]), cid[best], key[best], own[best]), strict=True):
                    column.append(values)
    return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for n, c in zip(("anchor", "positive", "key", "score"), out, strict=True)})


def _negatives(left: pa.Table, right: pa.Table, most: int, chunk: int = 64) -> pa.Table:
    """Of each anchor (left, with its positives) and positive the first ``most`` rows of another label between its limits in this block (right)."""
    out: list[list] = [[], [], [], [], []]
    if len(left) and len(right):
        left = left.sort_by([("key", "ascending"), ("cid", "ascending")])
        positives = left["positives"].to_pylist()
        a_cid, _, a_label, a = _side(left)
        cid, key, label, x = _side(right)
        for at in range(0, len(a), chunk):
            scores = _scores(a[at : at + chunk], x)
            order = np.argsort(-scores, axis=1, kind="stable")  # rows stand by key, so ties do
            for i in range(len(order)):
                ranked = order[i][label[order[i]] != a_label[at + i]]
                falling = -scores[i][ranked]
                for p in positives[at + i]:
                    first = np.searchsorted(falling, -p["score"], "left")
                    # 80 p <= 100 s is 4 p <= 5 s
                    best = ranked[first : first + most]
                    best = best[4 * p["score"] <= 5 * scores[i][best]]
                    for column, values in zip(out, (np.full(best.size, a_cid[at + i]), np.full(best.size, p["cid"]), cid[best], key[best], scores[i][best]), strict=True):
                        column.append(values)
    return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for n, c in zip(("anchor", "positive", "negative", "key", "score"), out, strict=True)})


def hard_negatives(
    vectors: DataFrame, anchor: Column | None = None, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256, positives: int = 5, negatives: int = 5, anchor_rows: int = 16384, block_rows: int = 16384
) -> DataFrame:
    """A row per anchor, positive and negative: anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.

    ``anchor``: condition over key that names the anchors (by default, keys divisible by 100). Components x become floor(scale x), held within 2^24; a
    score is their inner product, higher first, ties by smaller key (then in a fixed order of rows). Positives: the first ``positives`` other rows
    of the anchor's label; negatives of each: the first ``negatives`` rows of other labels with 80 p <= 100 s <= 100 p. Fewer, if there are no more.

    Rows with a null key, label or vector, an empty vector, or a null or non-finite component take no part; vectors of different lengths don't meet.
    Repeated keys and rows are rows each, as anchors too. Other columns are not read; no rows give none.

    Rows go once to each block of ``anchor_rows`` anchors, anchors once to each block of ``block_rows`` rows, whatever their labels: a label of a
    third of all rows makes no group larger. Each block pair sends at most ``positives`` rows an anchor, then ``negatives`` a positive."""
    spark = vectors.sparkSession
    anchor = F.pmod("key", F.lit(100)) == 0 if anchor is None else anchor
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    sound = (F.size("x") > 0) & ~F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("x", lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), scale * x))))).cast("int"))
    rows = rows.where(F.col("key").isNotNull() & F.col("label").isNotNull() & sound).select(F.monotonically_increasing_id().alias("cid"), "key", "label", F.size("x").alias("d"), anchor.alias("anchor"), whole.alias("q"))
    rows = stage(rows, "vectors")  # cid is fixed from here on
    sizes = rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).collect()
    n_rows = {x["d"]: max(math.ceil(x["n"] / block_rows), min(32, math.ceil(x["n"] / 1024))) for x in sizes}  # small tables still make a few tasks
    n_anchors = {x["d"]: math.ceil(x["anchors"] / anchor_rows) for x in sizes}

    def by_size(counts: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for kv in counts.items() for v in kv]), F.col("d")) if counts else F.lit(0)

    block = lambda counts, salt: F.pmod(F.xxhash64(F.lit(salt), "cid"), by_size(counts))
    others = lambda counts: F.explode(F.when(by_size(counts) > 0, F.sequence(F.lit(0).cast("long"), by_size(counts).cast("long") - 1)))
    dealt = rows.withColumn("b", block(n_rows, "rows")).withColumn("a", others(n_anchors)).groupBy("d", "a", "b")

    def anchors_of(df: DataFrame) -> DataFrame:
        return df.withColumn("a", block(n_anchors, "anchors")).withColumn("b", others(n_rows)).groupBy("d", "a", "b")

    def best_same(left: pa.Table, right: pa.Table) -> pa.Table:
        return _positives(left, right, positives)

    def next_others(left: pa.Table, right: pa.Table) -> pa.Table:
        return _negatives(left, right, negatives)

    asked = rows.where("anchor").select(*[F.col(c).alias(c) for c in rows.columns])  # columns of their own, apart from those of all rows
    found = anchors_of(asked).cogroup(dealt).applyInArrow(best_same, "anchor long, positive long, key long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "key", "positive")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    found = stage(found, "positives")
    limits = found.groupBy("anchor").agg(F.collect_list(F.struct(F.col("positive").alias("cid"), "score")).alias("positives")).withColumnRenamed("anchor", "cid")
    near = anchors_of(asked.join(limits, "cid")).cogroup(dealt).applyInArrow(next_others, "anchor long, positive long, negative long, key long, score long")
    next_down = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "key", "negative")
    near = near.withColumn("rank", F.row_number().over(next_down)).where(F.col("rank") <= negatives)
    names = found.join(asked.select(F.col("cid").alias("anchor"), F.col("key").alias("anchor_id")), "anchor").select("anchor", "positive", "anchor_id", F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    return near.join(names, ["anchor", "positive"]).select("anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def shifted_labels(vectors: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """The table with (label + 1) % 10 where the key is divisible by 7."""
    return vectors.withColumn(label, F.when(F.pmod(key, F.lit(7)) == 0, (F.col(label) + 1) % 10).otherwise(F.col(label)))


#: DuckDB SQL of the query over embeddings (all anchors against all rows).
SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
