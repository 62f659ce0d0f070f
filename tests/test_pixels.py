"""WCS and exact apertures against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from photospark.operators import aperture, wcs

HEADER = {"CRPIX1": 1025.0, "CRPIX2": 1025.0, "CRVAL1": 359.95, "CRVAL2": -66.5, "CD1_1": -0.0057, "CD1_2": 0.0009, "CD2_1": 0.0008, "CD2_2": 0.0058, "A_ORDER": 3, "A_2_0": 3e-6, "A_1_1": -2e-6, "A_0_3": 1e-9, "B_0_2": -4e-6, "B_2_1": 2e-9, "B_4_0": 1e-13}


def images(spark, headers):
    rows = [(i, 1, wcs.wcs_of(h) if h else None) for i, h in enumerate(headers)]
    return spark.createDataFrame(rows, f"image int, field int, wcs {wcs.WCS}")


def test_round_trip(spark):
    r = random.Random(1)
    points = [(i, r.uniform(0, 2048), r.uniform(0, 2048)) for i in range(400)]
    df = spark.createDataFrame(points, "star_id int, px double, py double").crossJoin(images(spark, [HEADER]))
    sky = wcs.pixel_to_sky(df, x="px", y="py")
    back = wcs.sky_to_pixel(sky).collect()
    assert max(math.hypot(b.x - b.px, b.y - b.py) for b in back) < 1e-6 and all(b.settled and b.solved for b in back)
    assert all(0 <= b.ra < 360 and -90 <= b.dec <= 90 for b in back)
    # The pixel of the reference point counts from 0: one less than the keyword.
    at = wcs.pixel_to_sky(spark.createDataFrame([(1024.0, 1024.0)], "x double, y double").crossJoin(images(spark, [HEADER]))).first()
    assert abs(at.ra - 359.95) < 1e-9 and abs(at.dec + 66.5) < 1e-9


def test_header_forms():
    assert wcs.wcs_of({"CRPIX1": 1}) is None and wcs.wcs_of({}) is None
    old = {k: v for k, v in HEADER.items() if not k.startswith(("CD", "A_", "B_"))} | {"CDELT1": -0.01, "CDELT2": 0.02, "PC1_2": 0.5}
    row = wcs.wcs_of(old)
    assert (row["cd1_1"], row["cd1_2"], row["cd2_1"], row["cd2_2"]) == (-0.01, -0.005, 0.0, 0.02) and set(row["a"]) == {0.0}
    assert wcs.wcs_of(old | {"CDELT1": 0.0}) is None  # not invertible


def test_steps_for_rows_that_do_not_settle():
    a = np.zeros((3, len(wcs.TERMS)))
    a[1, 0] = 0.02  # strong distortion: whole steps from the start run away or settle late
    a[2, 0] = 10.0  # no place has this distortion
    b = np.zeros_like(a)
    f, g = np.array([3.0, 30.0, -5.0]), np.array([4.0, 1.0, 1.0])
    u, v, settled, solved = wcs.solve(f, g, a, b, 2, 60, 1e-7)
    assert settled.tolist() == [True, False, False] and solved.tolist() == [True, True, False]
    assert abs(u[1] + 0.02 * u[1] ** 2 - 30) < 1e-7 and (u[0], v[0]) == (3.0, 4.0)


def test_places_fall_back_to_reference_places(spark):
    stars = spark.createDataFrame(
        [(1, 359.95, -66.5, 10.0, 11.0), (2, None, None, 20.0, 21.0), (3, 100.0, 10.0, 30.0, 31.0), (4, 100.0, 10.0, None, None), (5, 359.95, -66.4, None, None), (6, None, None, -5.0, 3.0)], "star_id int, ra double, dec double, ref_x double, ref_y double"
    ).withColumn("field", F.lit(1))
    seen = Observation("wcs")
    got = {(r.image, r.star_id): r for r in wcs.star_positions(stars, images(spark, [HEADER, None]), ["field"], 2048, 2048, seen).collect()}
    assert len(got) == 12
    assert {k: got[0, k].source for k in range(1, 7)} == {1: "wcs", 2: "reference", 3: "reference", 4: None, 5: "wcs", 6: None}
    assert {got[1, k].source for k in (1, 2, 3)} == {"reference"} and got[1, 5].source is None and got[1, 5].x is None
    assert abs(got[0, 1].x - 1024) < 1e-6 and (got[0, 3].x, got[0, 3].y) == (30.0, 31.0)
    assert seen.get == {"eligible": 4, "reference_fallback": 2, "unsettled": 2, "solved_later": 0}
    assert wcs.star_positions(stars.limit(0), images(spark, [HEADER]), ["field"], 9, 9).count() == 0


def area(dx, dy, r, n=400):
    xs = dx - 0.5 + (np.arange(n) + 0.5) / n
    half = np.sqrt(np.maximum(0, r * r - xs * xs))
    return np.maximum(0, np.minimum(half, dy + 0.5) - np.maximum(-half, dy - 0.5)).mean()


def test_overlap_is_exact(spark):
    r = random.Random(2)
    rows = [(r.uniform(-5, 5), r.uniform(-5, 5)) for _ in range(500)] + [(0.0, 0.0), (2.5, 0.0), (3.5, 0.0), (9.0, 9.0)]
    got = aperture.with_overlaps(spark.createDataFrame(rows, "dx double, dy double"), {"s": 0.3, "m": 3.0, "l": 4.2}).collect()
    for g in got:
        for name, radius in (("s", 0.3), ("m", 3.0), ("l", 4.2)):
            assert abs(g[name] - area(g.dx, g.dy, radius)) < 2e-4
    grid = aperture.with_overlaps(spark.range(-6, 7).select(F.col("id").alias("i")).crossJoin(spark.range(-6, 7)).select((F.col("i") + 0.37).alias("dx"), (F.col("id") - 0.11).alias("dy")), {"m": 3.0})
    assert abs(grid.agg(F.sum("m")).first()[0] - 9 * math.pi) < 1e-12


def frame(spark, value, width=40, height=30, image=1):
    rows = [(image, x, y, value(x, y)) for x in range(width) for y in range(height)]
    return spark.createDataFrame(rows, "image int, x int, y int, value double")


META = "image int, width int, height int, median double, deviation double, gain double, exposure double"


def test_apertures(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(5, 1, (40, 30))
    pixels = frame(spark, lambda x, y: float(noise[x, y]) + (50.0 if (x, y) == (20, 15) else 0.0) if (x, y) != (33, 25) else None)
    at = [(1, 1, 20.2, 14.9), (1, 2, 3.0, 15.0), (1, 3, -1.0, 4.0), (1, 4, 33.0, 24.0), (1, 5, None, 4.0), (2, 6, 5.0, 5.0), (1, 7, 0.0, 0.0), (1, 7, 0.0, 0.0)]
    got = aperture.aperture_photometry(pixels, spark.createDataFrame(at, "image int, star_id int, x double, y double"), spark.createDataFrame([(1, 40, 30, 5.0, 1.0, 5.2, 2.0)], META)).collect()
    assert sorted(r.star_id for r in got) == [1, 2, 3, 4, 5, 6, 7, 7]
    by = {r.star_id: r for r in got}

    def brute(x, y, radius):
        return sum(area(i - x, j - y, radius, 2000) * (noise[i, j] + (50.0 if (i, j) == (20, 15) else 0.0)) for i in range(40) for j in range(30))

    for star, x, y in ((1, 20.2, 14.9), (2, 3.0, 15.0), (7, 0.0, 0.0)):
        ring = sum(area(i - x, j - y, 8.0, 2000) - area(i - x, j - y, 5.0, 2000) for i in range(40) for j in range(30))
        background = (brute(x, y, 8.0) - brute(x, y, 5.0)) / ring
        for radius, name in ((3.0, "flux"), (2.0, "flux_r2"), (4.0, "flux_r4")):
            net = brute(x, y, radius) - background * math.pi * radius**2
            assert abs(by[star][name] - net / 2) < 2e-2
        net, full = by[star].flux * 2, math.pi * 9
        assert abs(by[star].flux_error - math.sqrt(abs(net) / 5.2 + full * by[star].background / 5.2 + full / 5.2**2) / 2) < 1e-9
    assert [by[k].quality for k in (1, 3, 5, 6)] == [0, 3, 3, 3] and by[3].flux is None and by[6].flux is None
    assert by[4].flux is None and by[2].quality in (1, 2)  # a pixel without a value is touched
    assert by[7].quality == (2 if by[7].flux < 0 else 1)


def test_margins_and_coordinates(spark):
    s = spark.createDataFrame([(1, 10.0, 10.0), (2, 9.9, 20.0), (3, 40.0, 30.0), (4, 40.1, 30.0), (5, None, 20.0)], "star_id int, x double, y double")
    assert [r.star_id for r in aperture.edge_margin(s, 50, 40).orderBy("star_id").collect()] == [1, 3]
    c = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, float("nan"))], "star_id int, ra double, dec double")
    assert [r.star_id for r in aperture.valid_coordinates(c).collect()] == [1]


@pytest.mark.parametrize("name", ["wcs_positions", "aperture_exact"])
def test_queries_use_all_stars_and_frames(spark, sf, name):
    from photospark.plans import registry

    got = registry.QUERIES[name](spark, sf).select("image", "star_id").toPandas()
    assert got.image.nunique() == 5 and len(got) == 5 * got.star_id.nunique() == len(got.drop_duplicates())


def test_places_taken_back_to_the_sky_in_one_pass(spark):
    r = random.Random(5)
    rows = [(i, 1, 359.95 + r.uniform(-8, 8), -66.5 + r.uniform(-8, 8), 5.0, None) for i in range(200)] + [(200, 1, None, 3.0, 5.0, 6.0), (201, 2, 359.95, -66.5, None, None)]
    stars = spark.createDataFrame(rows, "star_id int, field int, ra double, dec double, ref_x double, ref_y double")
    frames = images(spark, [HEADER, None, HEADER | {"CRVAL1": 0.5}])
    got = wcs.star_positions(stars, frames, ["field"], 2048, 2048, sky=True)
    assert got.count() == 3 * 201  # a field without images has no rows
    rows = wcs.pixel_to_sky(got.join(frames.select("image", "wcs"), "image")).where("source = 'wcs'").collect()
    assert len(rows) > 20 and all(abs(a.ra - a.sky_ra) < 1e-9 and abs(a.dec - a.sky_dec) < 1e-9 for a in rows)
    assert got.where("sky_ra is not null and source is distinct from 'wcs'").count() == 0


@pytest.mark.parametrize("name", ["wcs_positions", "wcs_sky", "edge_margin"])
def test_pairs_of_one_field_are_made_in_many_tasks(spark, sf, name):
    from photospark.plans import registry

    tasks = registry.QUERIES[name](spark, sf).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 1, tasks


def test_rows_of_a_star_stand_together(spark, sf):
    """Written, its number and reference place pack into little; image by image they took 16 bytes a row and more."""
    from photospark.plans import registry

    rows = registry.QUERIES["wcs_positions"](spark, sf).select("star_id", F.spark_partition_id().alias("task")).toPandas()
    runs = (rows != rows.shift()).any(axis=1).sum()
    assert rows.star_id.nunique() <= runs < 1.1 * rows.star_id.nunique()


def test_places_of_images_with_wcs_of_their_own(spark):
    """Against the columns of sky_to_pixel, with and without the pairs that are left out beforehand."""
    r = random.Random(11)
    headers = [HEADER, HEADER | {"A_2_0": 9e-6, "CD1_2": 0.002}, None, HEADER | {"CRVAL2": -62.0, "B_2_1": -5e-9}, HEADER | {"CRVAL1": 180.0}, HEADER | {"CRPIX1": -300.0, "CRPIX2": 2500.0}]
    rows = [(i, 1, None if i % 17 == 4 else (359.95 + r.uniform(-16, 16)) % 360, -66.5 + r.uniform(-7, 7), None if i % 5 == 2 else r.uniform(-50, 2100), None if i % 7 == 2 else r.uniform(0, 2048)) for i in range(600)]
    stars, frames = spark.createDataFrame(rows, "star_id int, field int, ra double, dec double, ref_x double, ref_y double"), images(spark, headers)
    plain = wcs.sky_to_pixel(stars.crossJoin(frames.select("image", "wcs")))
    inside = lambda x, y: (x >= 0) & (y >= 0) & (x < 2048) & (y < 2048)
    by = F.coalesce(inside(F.col("x"), F.col("y")), F.lit(False))
    plain = plain.withColumns({"by": by, "px": F.when(by, F.col("x")).otherwise(F.coalesce("ref_x", "x")), "py": F.when(by, F.col("y")).otherwise(F.coalesce("ref_y", "y"))})
    want = {(w.image, w.star_id): w for w in plain.withColumn("source", F.when(F.col("by"), "wcs").when(inside(F.col("px"), F.col("py")), "reference")).collect()}
    assert 100 < sum(w.by for w in want.values()) < 3000
    for settled in (True, False):
        got = wcs.star_positions(stars, frames, ["field"], 2048, 2048, settled=settled).collect()
        assert len(got) == len(want) == 3600
        for g in got:
            w = want[g.image, g.star_id]
            assert g.source == w.source and (not settled or g.settled == w.settled)
            assert all((a is None and b is None) or abs(a - b) < 1e-8 for a, b in ((g.x, w.px), (g.y, w.py)))


def test_pairs_outside_the_frame_are_left_out_beforehand():
    """None that a WCS places inside is lost, at the pole and behind the meridian too; of stars far away no pair is left to work on."""
    r = random.Random(13)
    headers = [None, HEADER] + [HEADER | {"CRVAL1": r.uniform(0, 360), "CRVAL2": r.choice([90.0, -89.9, r.uniform(-80, 80)]), "CRPIX1": r.uniform(-500, 2500), "A_2_0": r.uniform(-2e-5, 2e-5), "CD1_1": r.choice([-0.0057, 0.01])} for _ in range(40)]
    frames = wcs.Frames([wcs.wcs_of(h) if h else None for h in headers], 2048, 2048)
    inside = 0
    for h in headers[1:]:
        ra, dec = (np.array([h[k] + r.gauss(0, 8) for _ in range(150)]) for k in ("CRVAL1", "CRVAL2"))
        some, every = (frames.places(ra, np.clip(dec, -90, 90), np.full(150, always)) for always in (False, True))
        key = lambda c: set(zip(c[0][c[4]], c[1][c[4]], strict=True))
        assert key(some) == key(every) and len(every[0]) == 150 * 41 > 2 * len(some[0])
        inside += len(key(every))
    assert inside > 1000
    one = wcs.Frames([wcs.wcs_of(HEADER)] * 3, 2048, 2048)
    assert [len(c) for c in one.places(np.array([200.0, np.nan, 359.95]), np.array([-66.5, -66.5, 40.0]), np.zeros(3, bool))] == [0] * 7


def test_only_places_by_wcs(spark):
    r = random.Random(14)
    rows = [(i, 1, 359.95 + r.uniform(-16, 16), -66.5 + r.uniform(-7, 7), 5.0, None) for i in range(300)]
    stars, frames = spark.createDataFrame(rows, "star_id int, field int, ra double, dec double, ref_x double, ref_y double"), images(spark, [HEADER, None, HEADER | {"CRVAL2": -62.0}])
    place = lambda **more: {(x.image, x.star_id): x for x in wcs.star_positions(stars, frames, ["field"], 2048, 2048, sky=True, **more).where("source = 'wcs'").collect()}
    every, only = place(), place(by_wcs=True)
    assert every.keys() == only.keys() and len(only) > 50
    assert all(a.settled == only[k].settled and all(abs(a[c] - only[k][c]) < 1e-9 for c in ("x", "y", "sky_ra", "sky_dec")) for k, a in every.items())


def test_rounding_in_tasks_is_that_of_columns(spark):
    from photospark.plans import registry

    r = random.Random(12)
    ties = [k / 1e6 + 5e-7 - registry.NUDGE for k in range(-300, 300)] + [r.randrange(10**9) / 1e6 + 4.63e-7 for _ in range(2000)]
    values = [*ties, *(r.uniform(-3000, 3000) for _ in range(2000)), *(10.0 ** r.uniform(-9, 22) for _ in range(500)), 0.0, -0.0, -1e-8, float("nan"), float("inf"), float("-inf")]
    want = [x[0] for x in spark.createDataFrame([(v,) for v in values], "v double").select(F.round(F.col("v") + F.lit(registry.NUDGE), 6)).collect()]
    assert np.array_equal(registry.rounded(np.array(values)), np.array(want), equal_nan=True)


def test_apertures_over_tiles_make_no_row_of_place_and_pixel(spark):
    """A frame of several tiles with a lost, a double and some null pixels, against sums over the columns of with_overlaps."""
    r = random.Random(7)
    rows = [(1, x, y, None if (x * 31 + y) % 97 == 0 else r.uniform(0, 9)) for x in range(150) for y in range(70) if (x, y) != (64, 64)] + [(1, 63, 30, 5.5)]
    pixels = spark.createDataFrame(rows, "image int, x int, y int, value double")
    at = [(1, i, r.uniform(0, 150), r.uniform(0, 70)) for i in range(150)] + [(1, 900 + i, 64.0 * i, 32.0) for i in range(3)] + [(1, 950, 63.5, 63.5)]
    places = spark.createDataFrame(at, "image int, star_id int, x double, y double")
    got = aperture.aperture_photometry(pixels, places, spark.createDataFrame([(1, 150, 70, 5.0, 1.0, 5.2, 1.0)], META))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "cx" not in plan
    dx, dy = F.col("p.x") - F.col("s.x"), F.col("p.y") - F.col("s.y")
    pairs = places.alias("s").join(pixels.alias("p"), (F.abs(dx) < 8.5) & (F.abs(dy) < 8.5)).select("star_id", "value", dx.alias("dx"), dy.alias("dy"))
    pairs = aperture.with_overlaps(pairs, {"w": 3.0, "i": 5.0, "o": 8.0}).withColumn("ring", F.greatest(F.lit(0.0), F.col("o") - F.col("i")))
    total = lambda w: F.when(F.count_if((F.col(w) > 1e-9) & F.col("value").isNull()) == 0, F.sum(F.when(F.col(w) > 1e-9, F.col(w) * F.col("value"))))
    want = {x.star_id: x for x in pairs.groupBy("star_id").agg(total("w").alias("w"), total("ring").alias("ring"), F.sum("ring").alias("area")).collect()}
    rows, full = got.collect(), 0
    assert len(rows) == len(at)
    for g in rows:
        w = want[g.star_id]
        assert (g.background is None) == (w.ring is None) and (g.flux is None) == (w.w is None or w.ring is None)
        if g.flux is not None:
            full += 1
            assert abs(g.background - w.ring / w.area) < 1e-9 and abs(g.flux - (w.w - w.ring / w.area * math.pi * 9)) < 1e-9
    assert full > 5


def test_places_are_used_where_they_are_made(spark, sf):
    """No place is sent on: nothing stands between the tasks that make them and the result."""
    from photospark.plans import registry

    plan = registry.QUERIES["aperture_exact"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in above, above


def test_apertures_of_stars_on_images(spark):
    """Against apertures over a table of places: a drifting WCS, one per image or none, images without pixels, lost, double and null pixels, odd statistics."""
    r = random.Random(15)
    base = {"CRPIX1": 20.0, "CRPIX2": 15.0, "CRVAL1": 100.0, "CRVAL2": 10.0, "CD1_1": -0.0057, "CD1_2": 0.0, "CD2_1": 0.0, "CD2_2": 0.0058, "A_2_0": 2e-4, "B_1_1": -1e-4}
    headers = [None if i % 3 == 1 else base | {"CRVAL1": 100.0 + 0.01 * i, "B_1_1": -1e-4 * (i % 2)} for i in range(12)]
    odd = {2: {"exposure": None}, 3: {"exposure": 0.0}, 4: {"gain": 0.0}, 5: {"deviation": None}, 6: {"median": None}, 7: {"gain": None}}
    stats = [{"width": 40, "height": 30, "median": 5.0, "deviation": 1.0, "gain": 5.2, "exposure": 2.0} | odd.get(i, {}) for i in range(12)]
    names = list(stats[0])
    frames = spark.createDataFrame([(i, 1, wcs.wcs_of(h) if h else None, *[t[c] for c in names]) for i, (h, t) in enumerate(zip(headers, stats, strict=True))], f"image int, field int, wcs {wcs.WCS}, width int, height int, median double, deviation double, gain double, exposure double")
    value = lambda x, y, i: None if (x * 7 + y * 3 + i) % 211 == 0 else r.uniform(0, 9) - 4 * (i == 9)
    rows = [(i, x, y, value(x, y, i)) for i in range(11) for x in range(40) for y in range(30) if not (i == 8 and x < 25)] + [(2, 5, 5, 3.0), (3, -4, 2, 50.0), (3, 44, 29, float("inf"))]
    pixels = spark.createDataFrame(rows, "image int, x int, y int, value double")
    near = lambda lo, hi: None if r.random() < 0.1 else r.uniform(lo, hi)
    some = [(k, 1, near(99.85, 100.2), near(9.9, 10.1), near(-5, 45), near(-5, 35)) for k in range(300)] + [(300, 1, None, None, 0.0, 0.0), (301, 2, 100.0, 10.0, 5.0, 5.0), (302, 1, None, None, float("nan"), 3.0)]
    stars = spark.createDataFrame(some, "star_id int, field int, ra double, dec double, ref_x double, ref_y double")
    places = wcs.star_positions(stars, frames, ["field"], 40, 30)
    want = {(x.image, x.star_id): x for x in aperture.aperture_photometry(pixels, places, frames).collect()}
    got = aperture.star_apertures(pixels, stars, frames, ["field"], 40, 30).collect()
    assert len(got) == len(want) == 12 * 302
    same = lambda a, b: (a is None and b is None) or (a is not None and b is not None and (abs(a - b) < 1e-9 or a != a and b != b))
    for g in got:
        w = want[g.image, g.star_id]
        assert g.quality == w.quality and all(same(g[c], w[c]) for c in ("x", "y", "background", "flux_r2", "flux_r3", "flux_r4", "flux_error_r2", "flux_error_r3", "flux_error_r4")), (g, w)
        assert same(g.flux_r3, w.flux)
    assert {g.quality for g in got} == {0, 1, 2, 3} and sum(g.flux_r3 is None for g in got if g.quality < 3) > 50 and sum(g.flux_r3 is not None for g in got) > 500
