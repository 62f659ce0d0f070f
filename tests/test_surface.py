"""Functions called from SQL."""

import math

import pytest

from photospark.functions import surface
from photospark.sources import views


@pytest.fixture(scope="module")
def session(spark, sf):
    surface.register(spark)
    views.phot_survey(spark, sf).createOrReplaceTempView("phot")
    return spark


def test_scalars(session):
    row = session.sql("SELECT separation_arcsec(10, 20, 10, 20.5) AS s, phase_of(7.25, 2, 0.25) AS p, phase_of(1, 0, 0) AS n, magnitude(100, 20) AS m, magnitude(-1, 20) AS z").first()
    assert abs(row.s - 1800) < 1e-6 and row.p == 0.5 and row.n is None and row.m == 15 and row.z is None


def test_scalars_are_inlined(session):
    plan = session.sql("SELECT separation_arcsec(flux, 1, 2, 3) FROM phot")._jdf.queryExecution().optimizedPlan().toString()
    assert "asin" in plan.lower() and "python" not in plan.lower()


def test_aggregates(session):
    got = {r.star_id: r for r in session.sql("SELECT star_id, robust_scatter(flux) AS s, stetson(btjd, flux, flux_error) AS j, best_period(btjd, flux) AS p FROM phot WHERE quality = 0 GROUP BY star_id").collect()}
    assert len(got) == 50
    want = {r.star_id: r.mad for r in session.sql("SELECT star_id, median(abs(flux - mid)) * 1.4826 AS mad FROM (SELECT *, median(flux) OVER (PARTITION BY star_id) AS mid FROM phot WHERE quality = 0) GROUP BY star_id").collect()}
    assert all(math.isclose(got[k].s, want[k], rel_tol=1e-9) for k in want)
    # Stars 4, 13, ... of the survey move with a saw of 36 epochs: three days, and nine tenths of a gap of half a day.
    assert abs(got[4].p - 3.45) < 0.1 and got[4].j > got[1].j
    none = session.sql("SELECT robust_scatter(x) AS s, best_period(x, x) AS p FROM VALUES (CAST(NULL AS DOUBLE)) t(x)").first()
    assert none.s is None and none.p is None


def test_tables(session):
    gaps = session.sql("SELECT s.id, g.* FROM (SELECT 1 AS id, array(3.0D, 1.0D, NULL, 1.1D) AS t UNION ALL SELECT 2, NULL) s, LATERAL observation_gaps(s.t, 3.0D) g").collect()
    assert [(r.id, r.gap_start, r.gap_end) for r in gaps] == [(1, 1.1, 3.0)]
    found = session.sql("SELECT f.* FROM (SELECT transform(sequence(0, 899), i -> IF(i = 465, 100D, 1D + (i * 7 % 11) / 10)) AS v) s, LATERAL find_sources(30, 30, s.v) f").collect()
    assert [(r.x, r.y) for r in found] == [(15.0, 15.0)]
    assert session.sql("SELECT * FROM find_sources(0, 0, CAST(NULL AS ARRAY<DOUBLE>))").count() == 0
