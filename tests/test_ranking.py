"""Places and percentiles against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from photospark.operators import coverage, ranking


def test_numbered(spark):
    r = random.Random(7)
    rows = [(r.choice(["hot", "hot", "hot", "a", None]), r.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, i long").repartition(5)
    got = ranking.numbered(df, ["v", "i"]).collect()
    assert sorted(x.place for x in got) == list(range(2000))
    assert [x.i for x in sorted(got, key=lambda x: x.place)] == [i for _, v, i in sorted(rows, key=lambda x: (x[1], x[2]))]
    got = ranking.numbered(df, ["v", "i"], ["g"]).collect()
    for g in ("hot", "a", None):
        own = sorted((x for x in got if x.g == g), key=lambda x: x.place)
        assert [x.place for x in own] == list(range(len(own))) and [x.i for x in own] == [i for k, v, i in sorted(rows, key=lambda x: (x[1], x[2])) if k == g]
    assert ranking.numbered(df.limit(0), ["v"]).count() == 0


def test_a_group_is_many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        df = spark.range(20_000).select(F.lit("all").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("v"), "id")
        got = ranking.numbered(df, ["v", "id"], ["g"])
        ids = got.orderBy("place").select("place", "v", "id").toPandas()
        assert ids.place.tolist() == list(range(20_000)) and ids[["v", "id"]].apply(tuple, axis=1).is_monotonic_increasing
        files = df.select(F.format_string("f%08d", "v").alias("filename")).distinct()
        listed = coverage.file_listing(files).toPandas().sort_values("file_idx")
        assert listed.filename.is_monotonic_increasing and listed.file_idx.tolist() == list(range(len(listed)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("most", [3, 40, 100_000])
def test_percentiles(spark, most):
    r = np.random.default_rng(8)
    groups = {"even": r.normal(size=400), "odd": r.lognormal(0, 30, 401), "equal": np.ones(300), "two": np.array([1.0] * 150 + [2.0] * 150), "wide": np.array([-1e308, 1e308, 0.0, 1e-300, 5.0]), "one": np.array([7.0]), "signs": -r.lognormal(0, 5, 250), "steps": r.integers(0, 5, 500).astype(float)}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("even", None), ("even", float("nan")), ("odd", float("inf")), ("none", None), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {x.g: x for x in ranking.percentiles(df, ["g"], {"mid": (F.col("v"), 0.5), "low": (F.col("v"), 0.3), "neg": (-F.col("v"), 0.95)}, most=most, bins=8).collect()}
    assert set(got) == {*groups, "none", None} and got["none"].mid is None and got[None].mid == 3.5
    for g, x in groups.items():
        for name, p, values in (("mid", 0.5, x), ("low", 0.3, x), ("neg", 0.95, -x)):
            at = (len(x) - 1) * p
            ordered = np.sort(values)
            lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            want = (1 - (at - np.floor(at))) * lo + (at - np.floor(at)) * hi
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=1e-300), (g, name)


def test_percentile_of_all_rows(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert ranking.percentiles(df, [], {"mid": (F.col("v"), 0.5), "p": (F.col("v"), 0.3001)}, most=10, bins=16).first() == (500.0, pytest.approx(300.1))


def test_calibration_order(spark):
    rows = [("b", True, None, 2.0), ("a", True, None, 2.0), ("c", False, "broken", 1.0), ("d", True, None, None), ("e", True, None, 1.5), ("f", None, None, 9.0)]
    got = {r.filename: r.epoch for r in coverage.calibration_order(spark.createDataFrame(rows, "filename string, valid boolean, error string, mjd_obs double")).collect()}
    assert got == {"e": 0, "a": 1, "b": 2, "c": None, "d": None, "f": None}


def test_camera_ccds(spark):
    rows = spark.createDataFrame([("1-2",), ("1-2/",), ("4-3",), ("x",), (None,), ("1-",)], "folder string")
    assert sorted(map(tuple, coverage.camera_ccds(rows).collect())) == [(1, 2), (4, 3)]
