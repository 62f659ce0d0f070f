"""Small literal fixtures: edge cases, metamorphic properties, recovered signals."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from photospark import schema as S
from photospark.operators import coverage, crossmatch, features, image, lightcurve, ml, period, quality, score
from photospark.sources import io
from photospark.streaming.ingest import ingest

PHOT = "star_id long, row long, epoch int, btjd double, flux double, flux_error double, quality int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, i, i, float(i), 10.0, 0.5, 0) for i in range(12)]  # constant
    rows += [(2, 100 + i, i, float(i), 10.0 + (i % 3), 0.5, 0) for i in range(12)] + [(2, 150, 12, 12.0, 1000.0, 0.5, 0), (2, 151, 13, 13.0, -1000.0, 0.5, 0)]
    rows += [(3, 200, 0, 0.0, NAN, 0.5, 0), (3, 201, 1, 1.0, 5.0, None, 0), (3, 202, 2, 2.0, 5.0, 0.0, 0), (3, 203, 3, 3.0, 5.0, -1.0, 0), (3, 204, 4, 4.0, INF, 1.0, 0), (3, 205, 5, 5.0, None, 1.0, 0)]
    rows += [(4, 300, 0, 0.0, 7.0, 1.0, 1)]  # no good row
    rows += [(5, 400, 0, 0.0, 7.0, 1.0, 0)]  # one
    rows += [(6, 500, 0, 0.0, 7.0, 1.0, 0), (6, 501, 1, 1.0, 9.0, 1.0, 0)]  # two
    return spark.createDataFrame(rows, PHOT)


def by_star(df):
    return {r.star_id: r for r in df.collect()}


def test_stats_of_odd_stars(odd):
    s = by_star(features.star_stats(odd))
    assert s[1].mad == 0 and s[1].amplitude == 0 and s[1].n_outliers == 0 and s[1].stetson_j == 0
    assert s[3].n_total == 6 and s[3].n_good == 6 and s[3].median_flux == 5.0 and s[3].max_flux == 5.0
    assert s[4].n_good == 0 and s[4].median_flux is None and s[4].n_outliers is None
    assert s[5].reduced_chi2 == 0 and s[5].stetson_j is None and s[6].stetson_j is None
    assert math.isclose(s[6].reduced_chi2, 2.0)


def test_masks_of_odd_rows(odd):
    epochs = odd.select("epoch").distinct().select("epoch", (F.col("epoch") == 7).alias("is_bad"))
    cm = odd.select("epoch").distinct().select("epoch", F.lit(1.0).alias("cm"))
    m = {r.row: r for r in quality.create_masks(odd, epochs, cm, 70).collect()}
    assert m[7].mask_reason == "bad_epoch" and m[1].mask_bits == 0
    assert m[150].mask_bits & S.OUTLIER_POS and m[151].mask_bits & S.OUTLIER_NEG and m[151].mask_bits & S.LOW_SNR
    assert all(m[r].mask_bits & S.INVALID for r in (200, 201, 202, 203, 204, 205))
    assert not m[202].mask_bits & S.LOW_SNR and m[203].mask_bits & S.LOW_SNR and m[300].mask_reason == "quality|edge"
    assert m[0].mask_bits & S.EDGE and not m[1].mask_bits & S.EDGE


def test_artifact_window_ends_are_inside(spark):
    rows = [(1, i, i, t, 1.0, 1.0, 0) for i, t in enumerate((3214.999, 3215.0, 3218.0, 3221.0, 3221.001))]
    assert [r.btjd for r in quality.without_artifacts(spark.createDataFrame(rows, PHOT), 70).orderBy("btjd").collect()] == [3214.999, 3221.001]
    with pytest.raises(ValueError):
        quality.good_data(spark.createDataFrame(rows, PHOT), True)


def test_gap_of_exactly_three_hours(spark):
    times = [0.0, 0.125, 0.25, 0.376, 0.5]
    rows = [(s, 10 * s + i, i, t, 10.0 + s, 1.0, 0 if i < 4 else 1) for s in range(3) for i, t in enumerate(times)]
    e = {r.epoch: r for r in quality.epoch_qc(spark.createDataFrame(rows, PHOT)).collect()}
    assert [e[i].is_after_gap for i in range(5)] == [False, False, False, True, False]
    assert e[4].reason == "no_data" and e[4].is_bad and "after_momentum_dump" in e[3].reason


def test_presets_are_nested(spark, sf):
    from photospark.sources import views

    c = quality.clean(views.phot_survey(spark, sf), 70, views.star_catalog(spark, sf)).cache()
    n = [quality.preset(c, p).count() for p in ("minimal", "balanced", "strict")]
    assert n[0] > n[1] > n[2] > 500
    seen = {r.bit: r.n for r in quality.mask_summary(c).collect()}
    assert all(0 < seen[b] < seen["total"] / 2 for b in ("quality", "invalid", "bad_epoch", "outlier_pos", "outlier_neg", "edge", "artifact", "low_snr"))
    c.unpersist()


def test_survey_has_both_kinds(spark, sf):
    """Of every flag the survey view has rows with it and rows without, so that twins prove something."""
    from photospark.sources import views

    phot = views.phot_survey(spark, sf)
    stars = quality.quiet_stars(quality.star_qc(phot, views.star_catalog(spark, sf))).collect()
    for flag in ("is_edge_star", "is_quiet_star"):
        assert {r[flag] for r in stars} == {True, False}
    epochs = quality.epoch_qc(phot).collect()
    assert 0 < sum(r.is_bad for r in epochs) < len(epochs) / 2
    assert {x for r in epochs for x in r.reason.split("|")} >= {"high_scatter", "shifted_median", "low_valid", "after_momentum_dump"}


def test_nearest_neighbour_at_any_distance(spark):
    rows = [(1, 0.0, 0.0, 10.0), (2, 3.0, 4.0, 20.0), (3, 900.0, 0.0, 30.0), (4, 905.0, 50.0, 5.0), (5, 905.0, 50.0, 7.0), (6, -4000.0, 9.0, 1.0)]
    got = {r.star_id: r for r in crossmatch.neighbours(spark.createDataFrame(rows, "star_id long, x double, y double, flux double")).collect()}
    for i, x, y, f in rows:
        d, _, flux = min((math.hypot(x - a, y - b), j, g) for j, a, b, g in rows if (a, b) != (x, y))
        assert math.isclose(got[i].nn_dist_arcsec, 21 * d) and math.isclose(got[i].nn_flux_ratio, flux / f)
    assert got[1].contam_ratio_126arcsec == 2.0 and got[3].contam_ratio_126arcsec == 0.0


def test_empty_tables(spark):
    none = spark.createDataFrame([], PHOT)
    for f in (features.star_stats, features.stat_features, quality.epoch_qc, quality.star_qc, lightcurve.padded_sequences, lightcurve.sigma_clip, period.periodic_features):
        assert f(none).count() == 0
    assert quality.clean(none, 70).count() == 0 and score.variability_scores(features.star_stats(none)).count() == 0


def test_normalise_twice_is_once(odd):
    once = lightcurve.normalize(odd)
    twice = lightcurve.normalize(once)
    a, b = ({r.row: r.flux for r in x.collect()} for x in (once, twice))
    assert all(x == b[k] or (x is None and b[k] is None) or math.isclose(x, b[k]) or x != x for k, x in a.items())
    with pytest.raises(ValueError):
        lightcurve.normalize(odd, "best")


def test_fold_is_periodic_in_t0(odd):
    a, b = ({r.row: r.phase for r in lightcurve.phase_fold(odd, 2.5, t0).collect()} for t0 in (0.25, 2.75))
    assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
    half = lightcurve.phase_fold(odd, 2.0, 0.0).where("btjd = 1.0").first()
    assert half.phase == 0.5


def test_padding(odd):
    s = by_star(lightcurve.padded_sequences(odd, 20))
    assert len(s[6].x) == 20 and len(s[6].mask) == 20 and s[6].x[2] == [0.0] * 3 and s[6].mask[:3] == [True, True, False]
    s = by_star(lightcurve.padded_sequences(odd, 20, zero=False))
    assert s[6].x[2] == [None] * 3


def signal(spark, f, days=27.0, step=0.02, seed=0):
    r = np.random.default_rng(seed)
    t = np.sort(r.choice(np.arange(0, days, step), 600, replace=False))
    y = f(t) + r.normal(0, 0.002, t.size)
    return spark.createDataFrame([(1, i, i, float(a), float(b), 0.002, 0) for i, (a, b) in enumerate(zip(t, y))], PHOT)


def test_sinusoid_is_found(spark):
    s = signal(spark, lambda t: 10 + 0.5 * np.sin(2 * np.pi * t / 0.87))
    assert abs(period.periodic_features(s).first().period_1 - 0.87) < 0.01
    grid = period.frequency_grid(spark, 400, 5.0, 0.5)
    assert abs(period.top_frequencies(period.lomb_scargle_grid(s, grid), 1).first().period - 0.87) < 0.02


def test_eclipse_is_found(spark):
    s = signal(spark, lambda t: np.where(t % 4.29 < 0.15, 0.9, 1.0))
    b = period.box_least_squares(s, 2000).first()
    assert min(abs(b.period - 4.29 * k) for k in (1, 2, 3)) < 0.05 and 0.07 < b.depth < 0.13


def test_boxes_are_brute_force():
    rng = np.random.default_rng(3)
    t, periods, durations = np.sort(rng.uniform(0, 20, 40)), np.linspace(0.5, 15, 60), np.linspace(0.01, 0.2, 3)
    y, error = rng.normal(10, 1, 40), rng.uniform(0.5, 2, 40)
    x, f, w = t - t[0], y / np.median(y), (np.median(y) / error) ** 2
    w /= w.sum()
    f = f - (w * f).sum()
    best = 0.0
    for p in periods:
        for d in durations:
            for begin in x % p:
                inside = (x % p - begin) % p <= d
                r, s = w[inside].sum(), (w * f)[inside].sum()
                if s < 0 and 0 < r < 1 - 1e-12:
                    best = max(best, s * s / (r * (1 - r)))
    (got,) = period._boxes(t, y, error, periods, durations, cells=300)
    assert abs(got["power"] - best) < 1e-9 and got == period._boxes(t, y, error, periods, durations)[0]
    assert period._boxes(t[:19], y[:19], error[:19], periods, durations) == [{}] == period._boxes(t, -y, error, periods, durations)


def test_series_of_odd_stars(spark):
    rows = [(1, i, i * 0.5, 5.0, 0.1, 0) for i in range(60)] + [(2, i, float(i), float("nan"), None, 0) for i in range(3)] + [(None, 0, 1.0, 2.0, 0.1, 0), (3, 0, 1.0, 2.0, 0.1, 7)]
    s = spark.createDataFrame(rows, "star_id long, row long, btjd double, flux double, flux_error double, quality int")
    assert {(r.star_id, r.n_points) for r in period.periodic_features(s).collect()} == {(1, 60), (2, 0), (3, 0), (None, 1)}
    assert period.box_least_squares(s, 20).where("star_id <> 1 and power is not null").count() == 0
    assert period.grid_peaks(s, 50).count() == 0 and period.box_search(s, [2.0]).count() == 0
    assert lightcurve.pivot_epochs(s.withColumn("epoch", (F.col("row") % 3).cast("int")), least=1).columns[-1] == "quality_2"


def test_crossmatch_edges(spark):
    left = spark.createDataFrame([(1, 359.9999, 10.0), (2, 10.0, 89.9999), (3, 50.0, 0.0), (4, 50.0, 0.0), (5, 120.0, -89.99999), (6, 0.0, 45.0)], "star_id long, ra double, dec double")
    right = spark.createDataFrame([(11, 0.0001, 10.0), (12, 190.0, 89.9999), (13, 50.0, 3 / 3600), (14, 50.0, -3 / 3600), (15, 300.0, -89.99999)], "star_id long, ra double, dec double")
    m = {r.star_id: r for r in crossmatch.nearest(left, right, 3.0000001).collect()}
    assert (m[1].match_id, m[2].match_id, m[3].match_id, m[5].match_id, m[6].match_id) == (11, 12, 13, 15, None)
    assert m[3].n_candidates == 2 and m[4].match_id == 13
    assert crossmatch.nearest(left, right, 2.9, strict=True, how="inner").count() == 3


def test_crossmatch_is_brute_force(spark):
    r = np.random.default_rng(3)
    a = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(r.uniform(0, 360, 300), np.degrees(np.arcsin(r.uniform(-1, 1, 300)))))]
    b = [(i + 1000, (x + r.normal() * 0.5 / max(0.02, math.cos(math.radians(y)))) % 360, max(-90, min(90, y + r.normal() * 0.5))) for i, x, y in a]
    A, B = (spark.createDataFrame(x, "star_id long, ra double, dec double") for x in (a, b))
    tol = 1800.0

    def sep(p, q):
        x, y = (np.array([math.cos(math.radians(d)) * math.cos(math.radians(ra)), math.cos(math.radians(d)) * math.sin(math.radians(ra)), math.sin(math.radians(d))]) for ra, d in (p, q))
        return math.degrees(2 * math.asin(min(1, np.linalg.norm(x - y) / 2))) * 3600

    want = {i: sorted((sep((x, y), (u, v)), j) for j, u, v in b if sep((x, y), (u, v)) <= tol) for i, x, y in a}
    for r_ in crossmatch.nearest(A, B, tol).collect():
        assert r_.n_candidates == len(want[r_.star_id]) and r_.match_id == (want[r_.star_id][0][1] if want[r_.star_id] else None)


def test_matches_are_not_broadcast_and_reach_few_cells(spark):
    stars = spark.range(2000).select(F.col("id").alias("star_id"), (F.col("id") * 0.17).alias("ra"), (F.col("id") * 0.08 - 80).alias("dec"))
    for df in (crossmatch.nearest(stars, stars, 3.0), crossmatch.mutual_nearest(stars, stars, 3.0)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    left, right = (stars.select(F.col("star_id").alias(f"{s}_id"), F.col("ra").alias(f"{s}_ra"), F.col("dec").alias(f"{s}_dec")) for s in "lr")
    seen, inner = [], type(left).join
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(left), "join", lambda df, *a: seen.append(df.count()) or inner(df, *a))
        assert crossmatch.candidate_pairs(left, right, 200.0).count() == 2000
    assert seen[0] < 3 * 2000  # once it was nine rows each


def test_stars_in_one_place_meet_once(spark):
    rows = [(i, float(i % 4), 0.0, 1.0) for i in range(2000)]
    met, inner = [], crossmatch._within
    with pytest.MonkeyPatch.context() as m:
        m.setattr(crossmatch, "_within", lambda a, b, r: met.append(inner(a, b, r).count()) or inner(a, b, r))
        got = {r.star_id: r for r in crossmatch.neighbours(spark.createDataFrame(rows, "star_id long, x double, y double, flux double")).collect()}
    assert max(met) == 12 and len(got) == 2000
    assert got[1996].nn_dist_arcsec == 21 and got[1996].contam_ratio_84arcsec == 1500.0


def test_median_frame_takes_all_images(spark):
    pixels = spark.range(301).select(F.col("id").cast("int").alias("image"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.col("id").cast("double").alias("value"))
    assert image.median_frame(pixels).first().value == 150.0  # of the first 100 it would be 49.5
    assert image.median_frame(pixels, 100).first().value == 49.5


def test_stars_in_one_place_share_their_pixels(spark):
    """As many rows of pixels for 50 stars in a place as for one, and the same values for all; over tile borders too."""
    grid = spark.range(80 * 70).select(F.lit(0).alias("image"), (F.col("id") % 80).cast("double").alias("x"), F.floor(F.col("id") / 80).cast("double").alias("y"), (F.col("id") * 37 % 101).cast("double").alias("value"))
    at = [(30.3, 31.9), (32.0, 32.0), (63.6, 40.2)]
    stars = spark.createDataFrame([(i, *at[i % 3]) for i in range(150)], "star_id long, x double, y double")
    met, inner = [], image._met
    with pytest.MonkeyPatch.context() as m:
        m.setattr(image, "_met", lambda *a: met.append(inner(*a).count()) or inner(*a))
        flux, centre = ({r.star_id: r for r in f(grid, stars).collect()} for f in (image.aperture_flux, image.centroids))
    assert max(met) <= 3 * 27 * 27 and len(flux) == len(centre) == 150
    values = {(x, y): float((y * 80 + x) * 37 % 101) for x in range(80) for y in range(70)}
    for i, (x, y) in enumerate(at):
        d = {p: math.hypot(p[0] - x, p[1] - y) for p in values}
        ring = [values[p] for p in d if 5 <= d[p] <= 8]
        net = sum(values[p] for p in d if d[p] <= 3) - sum(ring) / len(ring) * math.pi * 9
        box = {p: v for p, v in values.items() if abs(p[0] - round(x)) <= 4 and abs(p[1] - round(y)) <= 4}
        w = {p: max(0.0, v - float(np.median(list(box.values())))) for p, v in box.items()}
        for j in range(i, 150, 3):
            assert math.isclose(flux[j].net, net, abs_tol=1e-9) and math.isclose(centre[j].x_centroid, sum(w[p] * p[0] for p in w) / sum(w.values()))


def test_scores_of_equal_stars_are_half(odd):
    s = score.variability_scores(features.star_stats(odd.where("star_id = 1"))).first()
    assert math.isclose(s.variability_score, 0.5)


def test_isolation_forest_flags_the_far_point(spark):
    r = np.random.default_rng(1)
    df = spark.createDataFrame([(i, *map(float, r.normal(size=2))) for i in range(200)] + [(999, 30.0, 30.0)], "star_id long, a double, b double")
    assert ml.isolation_scores(df, ["a", "b"], trees=50).orderBy(F.desc("score")).first().star_id == 999
    one, two = ml.split(df)
    assert one.count() + two.count() == 201


def test_cadence_needs_a_whole_step(spark):
    with pytest.raises(ValueError):
        coverage.cadence_skip(spark.createDataFrame([("a", 0)], "filename string, file_idx int"), 0)


def test_fits(spark):
    card = lambda k, v: f"{k:<8}= {v:>20}".ljust(80)
    first = "".join([card("SIMPLE", "T"), card("BITPIX", 8), card("NAXIS", 0), card("SECTOR", 70), card("TSTART", 1000.0), card("TSTOP", 1000.5), card("EXPOSURE", 0.25), "DATE-OBS= '2024-01-01'".ljust(80), "END".ljust(80)]).ljust(2880)
    second = "".join([card("XTENSION", "'IMAGE   '"), card("BITPIX", -32), card("NAXIS", 2), card("NAXIS1", 3), card("NAXIS2", 2), card("GAINA", 5.0), card("GAINB", 6.0), "END".ljust(80)]).ljust(2880)
    data = first.encode() + second.encode() + np.arange(6, dtype=">f4").tobytes().ljust(2880, b"\0")
    units = [*image.fits_units(data)]
    assert units[0][1] is None and units[1][1].tolist() == [[0, 1, 2], [3, 4, 5]]
    files = spark.createDataFrame([("/x/a.fits", bytearray(data)), ("/x/b.fits", bytearray(b"no"))], "path string, content binary")
    a, b = image.fits_metadata(files).orderBy("filename").collect()
    assert a.valid and a.sector == 70 and a.btjd_mid == 1000.25 and a.exposure_time == 21600.0 and a.gain == 5.5 and a.date_obs == "2024-01-01"
    assert not b.valid and b.error


def test_tangent_projection_round_trip(spark):
    df = spark.createDataFrame([(100.5, 20.25), (99.0, 21.5), (101.75, 18.0)], "ra double, dec double")
    x, y = image.tan_to_pixel(F.col("ra"), F.col("dec"), 100.0, 20.0, 0.005, 1024.0, 1024.0)
    df = df.withColumns({"x": x, "y": y})
    ra, dec = image.pixel_to_tan(F.col("x"), F.col("y"), 100.0, 20.0, 0.005, 1024.0, 1024.0)
    for r in df.withColumns({"ra2": ra, "dec2": dec}).collect():
        assert math.isclose(r.ra, r.ra2, abs_tol=1e-9) and math.isclose(r.dec, r.dec2, abs_tol=1e-9)


def test_stream_restarts_without_loss_or_repeats(spark, odd, tmp_path):
    at = f"file://{tmp_path}"
    for part in (0, 1):
        odd.where(F.col("row") % 2 == part).write.mode("append").parquet(f"{at}/in")
        for _ in range(2):
            ingest(spark, f"{at}/in", odd.schema, f"{at}/out", f"{at}/state", odd.where("star_id < 5").select("star_id").distinct())
    assert sorted(r.row for r in spark.read.parquet(f"{at}/out").collect()) == sorted(r.row for r in odd.where("star_id < 5").collect())


def test_readers_and_sinks(spark, odd, tmp_path):
    at = f"file://{tmp_path}"
    odd.withColumnsRenamed({"flux": "flux_raw", "flux_error": "flux_err", "quality": "quality_flag"}).write.parquet(f"{at}/p.parquet")
    back = io.normalize_photometry(io.first_existing(spark, [f"{at}/none.csv", f"{at}/p.parquet"]))
    assert {"flux", "flux_error", "quality"} <= set(back.columns) and back.where("isnan(flux)").count() == 0
    with pytest.raises(FileNotFoundError):
        io.first_existing(spark, [f"{at}/none.json"])
    io.write_photometry(back.selectExpr("*", "70 as sector", "1 as camera", "2 as ccd").selectExpr("cast(star_id as string) as star_id", "epoch", "btjd", "flux", "flux_error", "quality", "sector", "camera", "ccd"), f"{at}/phot")
    assert io.read_photometry(spark, f"{at}/phot", 70).count() == odd.count() and io.read_photometry(spark, f"{at}/phot", 71).count() == 0


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    def session(master, at=None):
        conf = SimpleNamespace(get=lambda k, default=None: at)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=master, getConf=lambda: conf))

    assert io.shared_dir(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert io.shared_dir(session("local[2]")) == io.shared_dir(session("local[2]"))
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            io.shared_dir(session(master))


def test_dbscan_of_a_long_chain(spark):
    stars = spark.createDataFrame([(i, 0.9 * i, 0.0) for i in range(150)] + [(500, 0.0, 50.0)], "star_id long, x double, y double")
    got = {r.star_id: r.cluster for r in ml.dbscan(stars, ["x", "y"], 1.0, 2).collect()}
    assert got == {i: 0 for i in range(150)} | {500: None}


def test_dbscan_of_equal_rows_broadcasts_no_table(spark):
    """Equal rows count as often as they stand there; no join's side, which grows with the table, is collected at the driver."""
    import random

    r = random.Random(4)
    places = [(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(150)] + [(9.0, 9.0)] * 40 + [(9.5, 9.0), (20.0, 0.0)] + [(30.0, 0.0)] * 3
    stars = spark.createDataFrame([(1000 - i, x, y) for i, (x, y) in enumerate(places)] + [(5, None, 0.0)], "star_id long, x double, y double")
    frame = ml.dbscan(stars, ["x", "y"], 0.5, 4)
    got = {x.star_id: x.cluster for x in frame.collect()}
    assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    ids = [1000 - i for i in range(len(places))]
    near = {a: {b for b, q in zip(ids, places) if math.hypot(p[0] - q[0], p[1] - q[1]) <= 0.5} for a, p in zip(ids, places)}
    core = {a for a in ids if len(near[a]) >= 4}
    label = {a: a for a in core}
    while (new := {a: min(label[b] for b in near[a] & core) for a in core}) != label:
        label = new
    assert got == {a: min((label[b] for b in near[a] & core), default=None) for a in ids} | {5: None}


def test_command_line(spark, sf, tmp_path):
    from photospark import cli
    from photospark.sources import views

    source = str(tmp_path / "phot")
    views.phot_survey(spark, sf).where("star_id < 5").write.parquet(source)
    for command in ("stats", "export", "find-variables"):
        target = str(tmp_path / command)
        cli.main([command, source, target, "--min-amplitude", "0", "--min-chi2", "0"])
        assert spark.read.parquet(target).count() > 0
