"""The k-nearest-neighbour join against all pairs."""

import numpy as np
import pytest

from photospark.operators import knn, ml


def brute(rows, k):
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    out = set()
    for i, own in zip(ids, x):
        d = np.sqrt(((x - own) ** 2).sum(axis=1))
        order = sorted((round(d[j], 12), ids[j]) for j in range(len(ids)) if ids[j] != i)
        out |= {(i, other, rank) for rank, (_, other) in enumerate(order[:k], 1)}
    return out


def rows_of(kind):
    r = np.random.default_rng(4)
    if kind == "spread":
        x = r.normal(size=(400, 3))
    elif kind == "clusters":  # far apart, some of few rows
        x = np.concatenate([r.normal(size=(n, 3)) * 0.1 + 50 * i for i, n in enumerate((3, 200, 5, 150))])
    else:  # a third of all rows are equal, and values tie
        x = np.concatenate([np.ones((150, 3)), r.integers(0, 3, (300, 3)).astype(float)])
    return [(int(i), v.tolist()) for i, v in zip(r.permutation(10 * len(x))[: len(x)], x)]


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal"])
@pytest.mark.parametrize("block", [16, 1024])
def test_neighbours(spark, kind, block):
    rows = rows_of(kind)
    df = spark.createDataFrame([(i, *v) for i, v in rows], "star_id long, a double, b double, c double")
    got = knn.neighbours(df, ["a", "b", "c"], 7, block_rows=block, sample_rows=120)
    assert {(r.star_id, r.other, r["rank"]) for r in got.collect()} == brute(rows, 7)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None), (4, nan), (5, inf), (6, 5.0), (6, 5.5)], "star_id long, a double")
    got = {(r.star_id, r.other) for r in knn.neighbours(df, ["a"], 5).collect()}
    assert got == {(1, 2), (1, 6), (2, 1), (2, 6), (6, 1), (6, 2)}
    assert knn.neighbours(df.limit(0), ["a"], 5).count() == 0
    assert knn.neighbours(df.where("star_id = 1"), ["a"], 5).count() == 0


def test_leaves_out_of_reach_are_not_asked():
    r = np.random.default_rng(5)
    x = r.uniform(size=(4096, 2))
    tree = knn.make_tree(x, 6)
    leaf = tree.leaves(x)
    assert np.bincount(leaf, minlength=64).max() < 200
    low = np.array([x[leaf == i].min(axis=0) for i in range(64)])
    high = np.array([x[leaf == i].max(axis=0) for i in range(64)])
    row, found = tree.boxed(low, high).within(x, np.full(4096, 0.03))
    assert len(row) < 3 * 4096  # of 64 leaves
    pairs = {(int(a), int(b)) for a, b in zip(row, found)}
    for i in range(0, 4096, 97):
        for j in np.flatnonzero(((x - x[i]) ** 2).sum(axis=1) <= 0.03**2):
            assert (i, int(leaf[j])) in pairs


def test_reach(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(11)], "star_id long, a double")
    assert ml.reach_of(df, ["a"], 3, 0.5) == 1.0 and ml.reach_of(df, ["a"], 3, 1.0) == 2.0


def test_the_walk_down_the_tree_is_bounded_in_memory():
    """What asking for leaves holds does not grow with the leaves that rows reach."""
    import tracemalloc

    x = np.random.default_rng(1).normal(0, 0.125, (8192, 8))
    tree = knn.make_tree(x, 9)
    leaf = tree.leaves(x)
    low, high = np.full((512, 8), np.inf), np.full((512, 8), -np.inf)
    np.minimum.at(low, leaf, x)
    np.maximum.at(high, leaf, x)
    tree = tree.boxed(low, high)
    tracemalloc.start()
    pairs, most = set(), 0
    for row, found in tree.reached(x[:2000], np.full(2000, 0.25), most=5_000):
        most = max(most, len(row))
        pairs |= {(int(r), int(f)) for r, f in zip(row[::50], found[::50])}
    tracemalloc.stop()
    assert most <= 5_000 and pairs
    tracemalloc.start()
    total = sum(len(row) for row, _ in tree.reached(x, np.full(len(x), 0.25)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total > 500_000 and peak < 40_000_000, (total, peak)
    row, found = tree.within(x[:500], np.full(500, 0.25))
    off = np.maximum(0, np.maximum(low[None] - x[:500, None], x[:500, None] - high[None]))
    assert sorted(zip(row, found)) == sorted(zip(*np.nonzero(np.sqrt((off * off).sum(-1)) <= 0.25)))
