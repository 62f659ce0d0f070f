"""The period against twice the period."""

import math
import random

from photospark.operators import period


def curve(spark, shape, n=600, seed=1):
    r = random.Random(seed)
    t = sorted(r.uniform(0, 60) for _ in range(n))
    rows = [(1, i, x, 100 * (shape(x) + r.gauss(0, 0.002)), 0.2, 0) for i, x in enumerate(t)]
    return spark.createDataFrame(rows + [(1, n, 61.0, 5000.0, 0.2, 0), (1, n + 1, 61.5, 100.0, 0.2, 1), (2, 0, 1.0, 3.0, 0.1, 0)], "star_id int, row int, btjd double, flux double, flux_error double, quality int")


def test_equal_waves_keep_the_period(spark):
    got = period.clipped_search(curve(spark, lambda x: 1 + 0.05 * math.sin(2 * math.pi * x / 2.5))).collect()
    assert len(got) == 1 and got[0].n_points == 600  # the far point is clipped, the bad one not read, the short star passed over
    assert abs(got[0].period - 2.5) < 0.02 and not got[0].is_doubled and got[0].best_period == got[0].period


def test_unequal_waves_double_it(spark):
    """An ellipsoidal star: two waves a turn, one deeper."""
    got = period.clipped_search(curve(spark, lambda x: 1 - 0.05 * math.cos(4 * math.pi * x / 3.0) - 0.01 * math.cos(2 * math.pi * x / 3.0))).first()
    assert abs(got.period - 1.5) < 0.02 and got.is_doubled and abs(got.best_period - 3.0) < 0.04 and got.significance > 3


def test_constant_and_empty(spark):
    df = curve(spark, lambda x: 1.0).limit(0)
    assert period.clipped_search(df).count() == 0
    flat = spark.createDataFrame([(1, i, float(i), 7.0, 0.1, 0) for i in range(60)] + [(2, i, float(i), 0.0, 0.1, 0) for i in range(60)], df.schema)
    assert period.clipped_search(flat).count() == 0
