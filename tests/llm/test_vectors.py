"""Operators 11 and 12 against brute force on whole tables and odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from photospark.llm import hard_negatives, queries, whitening

CLASHES = ", cid string, key string, d int, q string, component string, anchor string, at string, n string"
EXTRA = ("x", "x", 1, "x", "x", "x", "x", "x")
NAN, INF = float("nan"), float("inf")


def test_remainder_restores_whole_numbers():
    values = np.array([0, 1, -1, 2**80 + 7, -(2**80) - 7, 10**24, -(10**24)], object)
    ps = whitening.primes(2**81)
    assert len(ps) == len(set(ps)) and math.prod(ps) > 2**82 and all(p < 2**21 for p in ps)
    got = whitening.remainder({p: np.array([int(v) % p for v in values]) for p in ps})
    assert [int(v) for v in got] == [int(v) for v in values]


def brute_whitening(vectors):
    """x, exact n x - S (whole numbers), and exact scatter of it."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - total[i] for i in range(d)] for r in x]
    scatter = [[sum(r[i] * r[j] for r in z) for j in range(d)] for i in range(d)]
    return n, z, scatter


def test_whitening(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(40, 40))
    vectors = (rng.normal(size=(300, 40)) @ mix).tolist()
    rows = [*enumerate(vectors), (None, vectors[0]), (7, vectors[7]), (900, None), (901, [None] + [1.0] * 39), (902, [NAN] * 40), (903, [INF] + [0.0] * 39), (904, [])]
    df = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], "vec_id long, embedding array<double>" + CLASHES)
    got = whitening.whiten(df.repartition(5)).toPandas()
    sound = [v for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, z, scatter = brute_whitening(sound)
    assert n == 302 and len(got) == 302 * 32 and set(got.n) == {302}
    v = np.array([[float(Fraction(t, n**3)) for t in row] for row in scatter])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    want = np.array([[float(Fraction(t, n)) for t in r] for r in z]) @ u / np.sqrt(e)
    deviation = [sum(t * t for t in r) for r in z]
    keys = [i for i, x in rows if x in sound]
    for i in (0, 3, 299):
        own = got[got.vec_id == i].sort_values("component")
        assert own.deviation.tolist() == [deviation[keys.index(i)]] * 32 == [int(x) for x in own.deviation_exact]
        assert np.abs(np.abs(own.whitened) - np.abs(want[keys.index(i)])).max() < 1e-9
    assert np.abs(got[got.vec_id == 3].sort_values("component").explained - e / np.trace(v)).max() < 1e-12
    assert len(got[got.vec_id == 7]) == 64 and got.vec_id.isna().sum() == 32 and got.identity_error.max() < 1e-10
    table = got[got.vec_id.between(8, 299)].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert (np.abs((table - want[8:300])).max(axis=0) < 1e-9).sum() + (np.abs((table + want[8:300])).max(axis=0) < 1e-9).sum() == 32
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_of_odd_tables(spark):
    one = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id", "component").collect()
    alone = one([(1, [0.5, 2.0])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = one([(i, [float(i), float(i)]) for i in range(4)])  # one direction only
    assert [r.whitened is None for r in flat] == [False, True] * 4 and abs(flat[0].explained - 1) < 1e-12 and flat[0].identity_error < 1e-12
    mixed = one([(1, [1.0]), (2, [3.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])])  # each length by itself
    assert [(r.vec_id, r.n) for r in mixed] == [(1, 2), (2, 2), (3, 2), (3, 2), (4, 2), (4, 2)] and [abs(round(r.whitened, 12)) for r in mixed[:2]] == [1, 1]
    huge = one([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [1e12, -1e12])])  # entries are held within 2^62; sums beyond a long
    n, z, _ = brute_whitening([[2.0**56, 1.0], [-(2.0**56), 2.0], [1e12, -1e12]])
    assert [r.deviation for r in huge] == [None if sum(t * t for t in r) >= 2**63 else sum(t * t for t in r) for r in z for _ in range(2)]


def brute_negatives(rows, step=100):
    sound = [(k, lab, [max(-(2**24), min(2**24, math.floor(256 * c))) for c in v]) for k, v, lab in rows if k is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, (k, lab, v) in enumerate(sound):
        if k % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, other) for m, (j, other, w) in enumerate(sound) if m != i and len(w) == len(v))
        for p, j, _, other in [s for s in scored if s[3] == lab][:5]:
            near = [s for s in scored if s[3] != lab and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(k, j, r, s[1], -p, -s[0]) for r, s in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [40, 16384])
def test_hard_negatives(spark, block):
    r, rng = random.Random(6), np.random.default_rng(6)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(size=12) * 0.6).round(1).tolist(), r.randrange(3) if i % 4 else 0) for i in range(240)]
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 1), (301, rows[0][1], 1), (100, rows[100][1], rows[100][2])]  # ties, repeated rows, an anchor that repeats
    rows += [(None, rows[1][1], 0), (400, None, 0), (500, rows[2][1], None), (600, [NAN] * 12, 0), (700, [], 1), (800, [1.0, 2.0], 0), (801, [1.0, 1.5], 0), (802, [1.0, 1.4], 2), (900, [1e300] + [0.0] * 11, 1)]
    df = spark.createDataFrame([(i, v, lab, *EXTRA) for i, v, lab in rows], "vec_id long, embedding array<double>, label int" + CLASHES)
    got = sorted(tuple(x) for x in hard_negatives.hard_negatives(df.repartition(3), anchor_rows=max(2, block // 20), block_rows=block).collect())
    want = brute_negatives(rows)
    assert len(want) > 50 and got == want
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_hard_negatives_of_one_table_part(spark):
    rows = [(100 * i, [float(i), 1.0], 0) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert hard_negatives.hard_negatives(df).count() == 0  # one label: no negatives
    assert {c.label for c in hard_negatives.shifted_labels(df.withColumn("vec_id", df.vec_id * 7)).collect()} == {1}


def test_queries_cover_their_tables(spark, sf):
    got = queries.op11_whitening(spark, sf).toPandas()
    assert got.vec_id.nunique() == 500 and len(got) == 500 * 32 and got.identity_error.max() < 1e-10
