"""Cleaning over large epochs, its scans, and error fallbacks."""

import random
import re

from pyspark.sql import functions as F

from photospark.operators import quality
from photospark.plans import registry
from photospark.sources import views


def rows(df, *columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=str)


def test_large_epochs_give_the_same_rows(spark, sf):
    phot = views.phot_survey(spark, sf)
    columns = "epoch btjd median_flux mean_flux median_error n_valid n_total median_flux_good mad_flux time_gap scatter_norm is_bad reason".split()
    assert rows(quality.epoch_qc(phot, large=True), *columns) == rows(quality.epoch_qc(phot, large=False), *columns)
    stars = quality.quiet_stars(quality.star_qc(phot, views.star_catalog(spark, sf)))
    assert rows(quality.common_mode(phot, stars, large=True), "epoch", "cm") == rows(quality.common_mode(phot, stars), "epoch", "cm")


def test_quiet_limit_by_counts(spark, sf, monkeypatch):
    stars = quality.star_qc(views.phot_survey(spark, sf), views.star_catalog(spark, sf))
    want = rows(quality.quiet_stars(stars), "star_id", "is_quiet_star")
    monkeypatch.setattr(quality, "LARGE", 10)
    assert rows(quality.quiet_stars(stars), "star_id", "is_quiet_star") == want


def test_the_result_scans_the_photometry_once(spark, sf):
    """Tables of epochs, stars and common mode are read as written."""
    plan = registry.QUERIES["ml_anomaly"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet[^\n]*events\.parquet", plan)) <= 1


def test_stars_grow_and_epochs_do_not(spark, sf):
    large = views.phot_survey(spark, sf.replace("sf0.01", "sf0.1")).agg(F.count_distinct("star_id"), F.count_distinct("epoch")).first()
    assert tuple(large) == (500, 200)


def test_error_fallback(spark):
    r = random.Random(3)
    flux = {1: [r.gauss(100, 2) for _ in range(20)], 2: [50.0, 52.0, 54.0], 3: [10.0] * 12}
    data = [(s, 100 * s + i, i, float(i), v, v, 0.5 if s == 3 else None, 1 if (s, i) == (1, 0) else 0) for s, vs in flux.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "star_id int, row int, epoch int, btjd double, flux double, flux_cm double, flux_error double, mask_bits int")
    good = sorted(flux[1][1:])
    mid = good[9]
    mad = sorted(abs(v - mid) for v in good)[9]
    got = {x.star_id: x.flux_error for x in quality.mask_to_quality(df).collect()}
    assert abs(got[1] - 1.4826 * mad) < 1e-12 and got[2] == 0.52 and got[3] == 0.5
    none = {x.star_id: x.flux_error for x in quality.mask_to_quality(df.drop("flux_error"), for_transit=True).collect()}
    assert none[3] == 0.0 and none[2] == 0.52
