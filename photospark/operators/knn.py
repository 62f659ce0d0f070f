"""Exact k-nearest-neighbour join of a feature table with itself.

A tree of cuts, made from a bounded sample, deals the points to leaves of about equal size; the boxes of leaves hold all their points, so the sample decides cost
and not results. Each point's k-th distance within its own block of its leaf bounds how far its neighbours can be; it then goes to just the leaves whose box is
within that bound, found by walking down the tree. Blocks of leaves and chunks of askers are of bounded size, whatever the leaf. Equal rows are one point of
the search, so a value that a third of all rows share makes no block larger."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite
from photospark.sources.io import stage

SLACK = 1e-9  # for rounding: asks a few leaves more, changes no result


@dataclass(frozen=True)
class Tree:
    """A full binary tree in heap order: a point goes right where its column ``axis`` is above ``cut``. low, high: the boxes of all nodes."""

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    @property
    def depth(self) -> int:
        return (len(self.axis) + 1).bit_length() - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.cut[node])
        return node - len(self.axis)

    def boxed(self, low: np.ndarray, high: np.ndarray) -> Tree:
        """With the boxes of the leaves, and of all nodes above."""
        levels = [(low, high)]
        while len(levels[0][0]) > 1:
            least, most = levels[0]
            levels.insert(0, (np.minimum(least[0::2], least[1::2]), np.maximum(most[0::2], most[1::2])))
        return Tree(self.axis, self.cut, np.concatenate([x for x, _ in levels]), np.concatenate([x for _, x in levels]))

    def within(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves whose box is within the row's bound."""
        row, leaf = zip((np.zeros(0, np.int64), np.zeros(0, np.int64)), *self.reached(x, bound), strict=True)
        return np.concatenate(row), np.concatenate(leaf)

    def reached(self, x: np.ndarray, bound: np.ndarray, most: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same, some at a time: where a step down the tree would hold over ``most`` pairs of row and node,
        halves of them go down by themselves, so that what is held doesn't grow with the leaves that rows reach."""
        waiting = [(0, np.arange(len(x)), np.zeros(len(x), np.int64))]
        while waiting:
            level, row, node = waiting.pop()
            if len(row) > most:
                half = len(row) // 2
                waiting += [(level, row[half:], node[half:]), (level, row[:half], node[:half])]
                continue
            off = np.maximum(0, np.maximum(self.low[node] - x[row], x[row] - self.high[node]))
            near = np.sqrt((off * off).sum(axis=1)) <= bound[row] + SLACK
            row, node = row[near], node[near]
            if level == self.depth:
                yield row, node - len(self.axis)
            elif len(row):
                waiting.append((level + 1, np.repeat(row, 2), np.stack([2 * node + 1, 2 * node + 2], axis=1).ravel()))


def make_tree(sample: np.ndarray, depth: int) -> Tree:
    """Cuts at the middle of the widest column, level by level."""
    axis, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    held = {0: sample}
    for node in range(len(axis)):
        x = held.pop(node)
        if len(x):
            axis[node] = int((x.max(axis=0) - x.min(axis=0)).argmax())
            cut[node] = float(np.median(x[:, axis[node]]))
        right = x[:, axis[node]] > cut[node]
        held[2 * node + 1], held[2 * node + 2] = x[~right], x[right]
    return Tree(axis, cut)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _closest(ids: np.ndarray, x: np.ndarray, bound: np.ndarray, others: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, other, distance): of each row the k others next to it and within its bound, ties by id. others must be sorted."""
    out: list[list[np.ndarray]] = [[], [], []]
    some = max(1, 2_000_000 // max(1, y.size))
    for at in range(0, len(x), some):
        own = ids[at : at + some]
        d = np.sqrt(((x[at : at + some, None, :] - y[None, :, :]) ** 2).sum(-1))
        d[own[:, None] == others[None, :]] = np.inf
        order = np.argsort(np.round(d, 12), axis=1, kind="stable")[:, :k]
        best = np.take_along_axis(d, order, 1)
        keep = (best <= bound[at : at + some, None] + SLACK) & np.isfinite(best)
        for column, values in zip(out, (np.repeat(own, keep.sum(axis=1)), others[order][keep], best[keep]), strict=True):
            column.append(values)
    return tuple(np.concatenate([np.zeros(0, t), *c]) for c, t in zip(out, (np.int64, np.int64, float), strict=True))


def _of_points(points: DataFrame, n: int, d: int, k: int, block_rows: int, most_leaves: int, sample_rows: int) -> DataFrame:
    """(id, other, distance) of the k points next to each, in order of rounded distance and id."""
    depth = 0
    while (block_rows << depth) < n and (1 << depth) < most_leaves:
        depth += 1
    sample = points.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow() if depth else None
    tree = make_tree(_matrix(sample["v"]), depth) if depth else Tree(np.zeros(0, np.int64), np.zeros(0))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaves(_matrix(b.column(1)))), b.column(0), b.column(1)], ["leaf", "id", "v"])

    dealt = points.select("id", "v").mapInArrow(deal, "leaf long, id long, v array<double>")
    ends = [f(F.get("v", F.lit(i))).alias(f"{name}{i}") for i in range(d) for name, f in (("low", F.min), ("high", F.max))]
    boxes = {x["leaf"]: x for x in dealt.groupBy("leaf").agg(F.count("*").alias("n"), *ends).collect()}
    low, high, size = np.full((1 << depth, d), np.inf), np.full((1 << depth, d), -np.inf), np.zeros(1 << depth, np.int64)
    for leaf, x in boxes.items():
        low[leaf], high[leaf], size[leaf] = [x[f"low{i}"] for i in range(d)], [x[f"high{i}"] for i in range(d)], x["n"]
    tree, blocks = tree.boxed(low, high), np.maximum(1, -(-size // (2 * block_rows)))
    spark = points.sparkSession
    plan = spark.createDataFrame([(int(i), int(b)) for i, b in enumerate(blocks)], "leaf long, n_blocks int")  # most_leaves rows at most
    data = dealt.join(F.broadcast(plan), "leaf").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks").cast("long")))

    def bounds(table: pa.Table) -> pa.Table:
        x, ids = _matrix(table["v"]), np.asarray(table["id"])
        bound = np.full(len(x), np.inf)
        if len(x) > k:
            some = max(1, 2_000_000 // x.size)
            for at in range(0, len(x), some):
                own = np.sqrt(((x[at : at + some, None, :] - x[None, :, :]) ** 2).sum(-1))
                bound[at : at + some] = np.partition(own, k, axis=1)[:, k]  # itself is the 0th
        return pa.table({"id": ids, "v": table["v"], "bound": bound})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, leaf in tree.reached(_matrix(b.column(1)), np.asarray(b.column(2))):
                for at in range(0, len(row), 20_000):
                    some = b.take(pa.array(row[at : at + 20_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[at : at + 20_000]), *some.columns], ["leaf", "id", "v", "bound"])

    bounded = data.groupBy("leaf", "block").applyInArrow(bounds, "id long, v array<double>, bound double")
    asked = stage(bounded.mapInArrow(ask, "leaf long, id long, v array<double>, bound double"), "asked")
    chunks = asked.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(4.0 * block_rows)).alias("n_chunks"))  # most_leaves rows at most
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c).cast("long") - 1))
    askers = asked.join(F.broadcast(chunks), "leaf").join(F.broadcast(plan), "leaf").withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.col("n_chunks").cast("long"))).withColumn("block", each("n_blocks"))
    held = data.join(F.broadcast(chunks), "leaf").withColumn("chunk", each("n_chunks"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, others, distance = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(left) and len(right):
            right = right.sort_by("id")
            ids, others, distance = _closest(np.asarray(left["id"]), _matrix(left["v"]), np.asarray(left["bound"]), np.asarray(right["id"]), _matrix(right["v"]), k)
        return pa.table({"id": ids, "other": others, "distance": distance})

    keys = ["leaf", "block", "chunk"]
    own = [F.col(c).alias(c) for c in ("leaf", "block", "chunk", "id", "v")]
    met = askers.groupBy(*keys).cogroup(held.select(*own).groupBy(*keys)).applyInArrow(meet, "id long, other long, distance double")
    first = Window.partitionBy("id").orderBy(F.round("distance", 12), "other")
    return met.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k).drop("place")


def neighbours(df: DataFrame, columns: list[str], k: int, block_rows: int = 1024, most_leaves: int = 16_384, sample_rows: int = 65_536) -> DataFrame:
    """(star_id, other, distance, rank): of each row the k nearest others, exactly, ties (distances equal to 12 places) by id.

    Rows with a missing, NaN or infinite value have no neighbours and are nobody's. star_id: whole numbers; rows that repeat an id aren't each other's
    neighbours. To the driver come a sample of ``sample_rows`` points, and a box for each leaf (``most_leaves`` at most, whatever the table)."""
    values = [finite(F.col(c).cast("double")) for c in columns]
    rows = df.select(F.col("star_id").cast("long").alias("star_id"), F.array(*values).alias("v")).where(~F.exists("v", lambda x: x.isNull()))
    rows = stage(rows, "rows")
    points = stage(rows.groupBy("v").agg(F.min("star_id").alias("id"), F.count("*").alias("w")), "points")
    n, total = points.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    if not n:
        return df.sparkSession.createDataFrame([], "star_id long, other long, distance double, rank int")
    near = _of_points(points, n, len(columns), k, block_rows, most_leaves, sample_rows)
    rank = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(F.round("distance", 12), "other"))
    if n == total:
        return near.select(F.col("id").alias("star_id"), "other", "distance").withColumn("rank", rank("star_id"))
    near = stage(near, "near")
    # Of the rows of one point only the first k + 1 by id can be anyone's neighbour, and each row of a point picks from the same k + 1.
    members = rows.join(points.select("v", "id"), "v").select("id", "star_id")
    first = members.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("star_id"))).where(F.col("place") <= k + 1).select("id", F.col("star_id").alias("other"))
    there = near.select(F.col("id").alias("point"), F.col("other").alias("id"), "distance").join(first, "id").select("point", "other", "distance")
    offered = there.union(first.select(F.col("id").alias("point"), "other", F.lit(0.0).alias("distance"))).distinct()
    offered = offered.withColumn("place", rank("point")).where(F.col("place") <= k + 1).select(F.col("point").alias("id"), "other", "distance")
    out = members.join(offered, "id").where("other <> star_id").select("star_id", "other", "distance")
    return out.withColumn("rank", rank("star_id")).where(F.col("rank") <= k)
