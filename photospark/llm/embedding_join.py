"""Exact metric range join of embeddings (operator 1).

The metric is the angle. Pivots partition the vectors: each has the cell of its nearest pivot. If x is at home in cell i and y in cell j, and their angle is at
most r, then by the triangle inequality angle(x, p_j) <= angle(x, p_i) + 2 r, and angle(x, p_j) <= R_j + r with R_j the largest angle from p_j in its cell:
x is copied to the cells j < i that both allow. So each linked pair meets in one cell, and cells join independently, in blocks of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from photospark.llm.common import connected_components, stage

SLACK = 1e-6  # for rounding of angles: copies a few vectors more, changes no link


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    x = np.asarray(column.flatten()).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, k: int, radius: float) -> np.ndarray:
    """Farthest-first from the first vector of a sample, until k or until all of it is within ``radius`` of one."""
    chosen = [0]
    nearest = np.arccos(np.clip(sample @ sample[0], -1, 1))
    while len(chosen) < k and nearest.max() > radius:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.arccos(np.clip(sample @ sample[chosen[-1]], -1, 1)))
    return sample[chosen]


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches split by the length of their vectors (column 1)."""
    for batch in batches:
        sizes = np.asarray(batch.column(1).value_lengths())
        for d in np.unique(sizes).tolist():
            yield d, batch.filter(pa.array(sizes == d))


def _cells(x: np.ndarray, pivots: np.ndarray, reach: np.ndarray | None, r: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home cell, angle to its pivot, and a matrix of the cells that get a copy."""
    angle = np.arccos(np.clip(x @ pivots.T, -1, 1))
    home = angle.argmin(axis=1)
    own = angle[np.arange(len(x)), home]
    copies = np.zeros(angle.shape, bool)
    if reach is not None:
        copies = (angle <= own[:, None] + 2 * r + SLACK) & (angle <= reach + r + SLACK) & (np.arange(angle.shape[1]) < home[:, None])
    return home, own, copies


def _survey(batches: Iterator[pa.RecordBatch], pivots: dict, reach: dict | None, r: float) -> Iterator[pa.RecordBatch]:
    """(size, cell, n, copies, angle): vectors at home and copied to the cell, and the largest angle at home."""
    out = []
    for d, batch in _by_size(batches):
        home, own, copies = _cells(_unit(batch.column(1)), pivots[d], reach and reach[d], r)
        for c in range(len(pivots[d])):
            out.append((d, c, int((home == c).sum()), int(copies[:, c].sum()), float(own[home == c].max(initial=0))))
    columns = [*zip(*out, strict=True)] or [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["size", "cell", "n", "copies", "angle"])


def _deal(batches: Iterator[pa.RecordBatch], pivots: dict, reach: dict, blocks: dict, r: float) -> Iterator[pa.RecordBatch]:
    """A row per block pair that a vector takes part in: (size, cell, a, b, side, cid, w, vector). Home blocks count up from 0, those of copies down from -1."""
    for d, batch in _by_size(batches):
        home, _, copies = _cells(_unit(batch.column(1)), pivots[d], reach[d], r)
        cid = batch.column(0).to_pylist()
        index, keys = [], []
        for i, c in enumerate(home.tolist()):
            n_home, n_copies = blocks[d, c]
            own = cid[i] * 0x9E3779B1 % n_home
            keys += [(c, min(own, o), max(own, o), int(own > o)) for o in range(n_home)] + [(c, own, -1 - o, 0) for o in range(n_copies)]
            index += [i] * (n_home + n_copies)
            for c in np.flatnonzero(copies[i]).tolist():
                n_home, n_copies = blocks[d, c]
                keys += [(c, o, -1 - cid[i] * 0x9E3779B1 % n_copies, 1) for o in range(n_home)]
                index += [i] * n_home
        for at in range(0, len(index), 20_000):
            some = batch.take(pa.array(index[at : at + 20_000]))
            cols = [*zip(*keys[at : at + 20_000], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(some), pa.int32()), *(pa.array(c, pa.int32()) for c in cols), some.column(0), some.column(2), some.column(1)], ["size", "cell", "a", "b", "side", "cid", "w", "vector"])


def _join(table: pa.Table, least: float) -> pa.Table:
    """Of a pair of blocks: (kind 0, cid, null, linked vectors) and (kind 1, cid, cid, null) edges that span what links connect."""
    table = table.combine_chunks()
    side, self_pair = np.asarray(table["side"]), table["a"][0].as_py() == table["b"][0].as_py()
    cid, w, x = np.asarray(table["cid"]), np.asarray(table["w"]), _unit(table["vector"].chunk(0))
    left = np.flatnonzero(side == 0)
    right = left if self_pair else np.flatnonzero(side == 1)
    hits = np.zeros((left.size, right.size), bool)
    for i in range(0, left.size, 1024):
        hits[i : i + 1024] = x[left[i : i + 1024]] @ x[right].T >= least
    if self_pair:
        np.fill_diagonal(hits, False)
    rows, cols = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
    hits = hits[np.ix_(rows, cols)]
    left, right = left[rows], right[cols]
    degree = [(cid[left], hits @ w[right])] if self_pair else [(cid[left], hits @ w[right]), (cid[right], w[left] @ hits)]
    edges, row_open, col_open = [], np.ones(left.size, bool), np.ones(right.size, bool)
    for i in range(left.size):
        if not row_open[i]:
            continue
        row_open[i], root, front = False, cid[left[i]], np.array([i])
        while front.size:
            reached = hits[front].any(axis=0) & col_open
            col_open &= ~reached
            edges += [(root, c) for c in cid[right[reached]].tolist() if c != root]
            front = np.flatnonzero(hits[:, reached].any(axis=1) & row_open)
            row_open[front] = False
            edges += [(root, c) for c in cid[left[front]].tolist()]
    ids = np.concatenate([np.zeros(0, np.int64), *(d[0] for d in degree)])
    n = np.concatenate([np.zeros(0, np.int64), *(d[1] for d in degree)])
    a, b = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    kind = np.append(np.zeros(ids.size, np.int32), np.ones(a.size, np.int32))
    return pa.table({"kind": kind, "a": np.append(ids, a), "b": pa.array(np.append(np.zeros(ids.size, np.int64), b)), "n": np.append(n, np.zeros(a.size, np.int64))})


def embedding_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, most_pivots: int = 256, sample_rows: int = 2048, block_rows: int = 4096) -> DataFrame:
    """One row per row of ``vectors``: key, n_links (other rows whose cosine is at least ``least``, in double precision), component_id (smallest key that
    links reach, its own included), kept (key = component_id).

    A vector that is null, empty, zero or holds a null or non-finite component links with nothing; vectors of different lengths don't link. Equal
    vectors are one point of the join that counts as many (so thousands of copies cost one). Repeated keys and rows each give their row and
    count each; a null key counts as a link but has no say in component_id, and isn't kept. Other columns are not read.
    To the driver come pivots (8 to ``most_pivots``, one for ``block_rows`` points, from a bounded sample that decides cost, not links) and a count per cell."""
    spark, r = vectors.sparkSession, math.acos(least)
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    sound = (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vector", F.when(sound, F.col("vector")))
    points = rows.where("vector is not null").groupBy("vector").agg(F.count("*").alias("w"), F.min("key").alias("key"))
    points = stage(points.select(F.monotonically_increasing_id().alias("cid"), "vector", "w", "key"), "points")
    about = points.groupBy(F.size("vector").alias("d")).count().collect()
    longest = max((x["d"] for x in about), default=1)
    sample = points.orderBy(F.xxhash64("vector"), "cid").limit(max(2, min(sample_rows, 16_000_000 // (8 * longest)))).select("vector").collect()
    pivots = {}
    for x in about:
        own = np.array([s["vector"] for s in sample if len(s["vector"]) == x["d"]]).reshape(-1, x["d"])
        own = own / np.abs(own).max(axis=1, keepdims=True)
        own = own / np.linalg.norm(own, axis=1, keepdims=True)
        pivots[x["d"]] = choose_pivots(own, min(most_pivots, max(8, x["count"] // block_rows)), r) if len(own) else np.eye(1, x["d"])
    flat = points.select("cid", "vector", "w")
    survey = "size int, cell int, n long, copies long, angle double"
    first = flat.mapInArrow(partial(_survey, pivots=pivots, reach=None, r=r), survey).groupBy("size", "cell").agg(F.max("angle").alias("angle")).collect()
    reach = {d: np.zeros(len(p)) for d, p in pivots.items()}
    for x in first:
        reach[x["size"]][x["cell"]] = x["angle"]
    sizes = flat.mapInArrow(partial(_survey, pivots=pivots, reach=reach, r=r), survey).groupBy("size", "cell").agg(F.sum("n").alias("n"), F.sum("copies").alias("copies")).collect()
    blocks = {(x["size"], x["cell"]): (math.ceil(x["n"] / block_rows) or 1, math.ceil(x["copies"] / block_rows)) for x in sizes}
    dealt = flat.mapInArrow(partial(_deal, pivots=pivots, reach=reach, blocks=blocks, r=r), "size int, cell int, a int, b int, side int, cid long, w long, vector array<double>")

    def join(table: pa.Table) -> pa.Table:
        return _join(table, least)

    found = stage(dealt.groupBy("size", "cell", "a", "b").applyInArrow(join, "kind int, a long, b long, n long"), "links")
    degree = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    parts = stage(connected_components(found.where("kind = 1").select("a", "b")).withColumnRenamed("id", "cid"), "components")
    known = points.join(degree, "cid", "left").join(parts, "cid", "left").select("vector", "key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component"))
    smallest = known.groupBy("component").agg(F.min("key").alias("component_id"))
    known = known.join(smallest, "component").select("vector", "n_links", "component_id", F.lit(True).alias("sound"))
    out = rows.join(known, "vector", "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))


#: DuckDB SQL of embedding_links over embeddings (all pairs; components by walking links).
SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS norm FROM v),
s AS (SELECT * FROM u WHERE norm > 0 AND isfinite(norm)),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.vec_id <> b.vec_id AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
d AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c LEFT JOIN d ON c.vec_id = d.vec_id"""
