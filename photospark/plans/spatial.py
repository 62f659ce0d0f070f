"""Queries: sky matching and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from photospark.operators import crossmatch as X
from photospark.plans import sql as Q
from photospark.plans.registry import query
from photospark.sources import views

_SKY = f"WITH a AS ({Q.SKY_A}), b AS ({Q.SKY_B})"
_PAIRS = f", j AS (SELECT b.star_id AS bid, b.ra AS bra, b.dec AS bdec, a.star_id AS aid, {Q.sep('b.ra', 'b.dec', 'a.ra', 'a.dec')} AS sep FROM b JOIN a ON abs(a.dec - b.dec) < 0.06)"


def _a(spark, d):
    return views.sky(spark, d)


def _b(spark, d):
    return views.sky(spark, d, True)


@query("crossmatch_le", "star_id match_id sep*", f"{_SKY}{_PAIRS}, n AS (SELECT bid, arg_min(aid, {{'s': sep, 'i': aid}}) AS match_id, min(sep) AS sep FROM j WHERE sep <= 1.85 GROUP BY bid) SELECT b.star_id, match_id, sep FROM b LEFT JOIN n ON b.star_id = n.bid")
def _(spark, d):
    return X.nearest(_b(spark, d), _a(spark, d), 1.85)


_MATCHES = f"""{_SKY}{_PAIRS}, n AS (SELECT bid, any_value(bra) AS ra, any_value(bdec) AS dec, arg_min(aid, {{'s': sep, 'i': aid}}) AS aid FROM j WHERE sep < 3 GROUP BY bid),
matches AS (SELECT star_id AS unified_id, 1 AS sector, star_id AS original_id, ra, dec FROM a UNION ALL SELECT aid, 2, bid, ra, dec FROM n)"""


def _matches(spark, d):
    return X.crossmatch_sectors({1: _a(spark, d), 2: _b(spark, d)}, 3.0)


@query("crossmatch_sectors", "unified_id sector original_id ra* dec*", f"{_MATCHES} SELECT * FROM matches")
def _(spark, d):
    return _matches(spark, d)


@query("combine_photometry", "star_id sector row btjd* flux*",
       f"{_MATCHES}, p AS ({Q.PHOT_E}), s AS (SELECT *, CAST(epoch % 2 + 1 AS INTEGER) AS sector FROM p) SELECT unified_id AS star_id, s.sector, row, btjd, flux FROM s JOIN matches m ON s.sector = m.sector AND s.star_id = m.original_id")
def _(spark, d):
    return X.combine_photometry(_matches(spark, d), views.phot_events(spark, d).withColumn("sector", (F.col("epoch") % 2 + 1).cast("int")))


@query("stars_in_all", "unified_id n_sectors", f"{_MATCHES} SELECT unified_id, count(DISTINCT sector) AS n_sectors FROM matches GROUP BY unified_id HAVING count(DISTINCT sector) = (SELECT count(DISTINCT sector) FROM matches)")
def _(spark, d):
    return X.stars_in_all(_matches(spark, d))


@query("nearest_with_count", "star_id match_id sep* n_candidates match_quality",
       f"{_SKY}{_PAIRS}, n AS (SELECT bid, arg_min(aid, {{'s': sep, 'i': aid}}) AS match_id, min(sep) AS sep, count(*) AS n FROM j WHERE sep <= 200 GROUP BY bid) SELECT b.star_id, match_id, sep, coalesce(n, 0) AS n_candidates, CASE WHEN sep < 25 THEN 'high' WHEN sep < 40 THEN 'medium' WHEN sep IS NOT NULL THEN 'low' END AS match_quality FROM b LEFT JOIN n ON b.star_id = n.bid")
def _(spark, d):
    return X.nearest(_b(spark, d), _a(spark, d), 200.0).withColumn("match_quality", X.match_quality(F.col("sep")))


_OTHERS = "SELECT star_id + 1000000 AS star_id, ra + 0.02 AS ra, dec FROM a WHERE star_id % 3 = 0"


@query("close_miss", "star_id match_id sep* is_match is_close_miss",
       f"""WITH a AS ({Q.SKY_A}), o AS ({_OTHERS}), j AS (SELECT a.star_id AS id, o.star_id AS oid, {Q.sep('a.ra', 'a.dec', 'o.ra', 'o.dec')} AS sep FROM a JOIN o ON abs(a.dec - o.dec) < 0.06), n AS (SELECT id, arg_min(oid, {{'s': sep, 'i': oid}}) AS match_id, min(sep) AS sep FROM j WHERE sep <= 120 GROUP BY id)
       SELECT a.star_id, match_id, sep, coalesce(sep <= 60, false) AS is_match, coalesce(sep > 60 AND sep < 120, false) AS is_close_miss FROM a LEFT JOIN n ON a.star_id = n.id""")  # fmt: skip
def _(spark, d):
    a = _a(spark, d)
    return X.close_misses(a, a.where("star_id % 3 = 0").select((F.col("star_id") + 1000000).alias("star_id"), (F.col("ra") + 0.02).alias("ra"), "dec"))


@query("tic_lookup", "star_id tic_id teff*", f"WITH a AS ({Q.SKY_A}), t AS (SELECT s_suppkey AS star_id, s_name AS tic_id, s_acctbal AS teff FROM supplier) SELECT a.star_id, coalesce(tic_id, CAST(a.star_id AS VARCHAR)) AS tic_id, teff FROM a LEFT JOIN t ON a.star_id = t.star_id")
def _(spark, d):
    t = views.table(spark, d, "supplier").select(F.col("s_suppkey").alias("star_id"), F.col("s_name").alias("tic_id"), F.col("s_acctbal").alias("teff"))
    return X.lookup_attributes(_a(spark, d), t).withColumn("tic_id", F.coalesce("tic_id", F.col("star_id").cast("string")))


_PIX = "SELECT c_custkey AS star_id, CAST(c_custkey * 37 % 211 AS DOUBLE) AS x, CAST(c_custkey * 53 % 197 AS DOUBLE) AS y, 1000 + c_acctbal / 10 AS flux FROM customer"


@query("neighbors_contam", "star_id nn_dist_arcsec* nn_flux_ratio* contam_ratio_84arcsec* contam_ratio_126arcsec*",
       f"""WITH s AS ({_PIX}), j AS (SELECT a.star_id, a.flux, b.star_id AS o, b.flux AS f, sqrt((a.x-b.x)**2 + (a.y-b.y)**2) AS d FROM s a JOIN s b ON a.star_id <> b.star_id), k AS (SELECT * FROM j WHERE d > 0),
       g AS (SELECT star_id, min(d) AS d, arg_min(f, {{'d': d, 'o': o}}) AS f, sum(f) FILTER (WHERE d <= 4) AS i, sum(f) FILTER (WHERE d <= 6) AS u FROM k GROUP BY star_id)
       SELECT s.star_id, d * 21 AS nn_dist_arcsec, f / flux AS nn_flux_ratio, coalesce(i / flux, 0) AS contam_ratio_84arcsec, coalesce(u / flux, 0) AS contam_ratio_126arcsec FROM s LEFT JOIN g ON s.star_id = g.star_id""")  # fmt: skip
def _(spark, d):
    k = F.col("c_custkey")
    return X.neighbours(views.table(spark, d, "customer").select(k.alias("star_id"), (k * 37 % 211).cast("double").alias("x"), (k * 53 % 197).cast("double").alias("y"), (1000 + F.col("c_acctbal") / 10).alias("flux")))


@query("nearest_planar", "star_id distance*", f"WITH a AS ({Q.SKY_A}) SELECT star_id, sqrt((ra - 120.5)**2 + (dec + 10.25)**2) AS distance FROM a ORDER BY distance, star_id LIMIT 1")
def _(spark, d):
    return X.nearest_planar(_a(spark, d), 120.5, -10.25)


@query("sky_grid", "star_id i j ra* dec*",
       f"WITH a AS ({Q.SKY_A}), g AS (SELECT star_id, dec, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, ra + (i - 2) * (94 * 21.0 / 3600) / cos(radians(dec)) AS r FROM a CROSS JOIN (SELECT unnest(range(5)) AS i) CROSS JOIN (SELECT unnest(range(5)) AS j)) SELECT star_id, i, j, r - 360 * floor(r / 360) AS ra, dec + (j - 2) * (94 * 21.0 / 3600) AS dec FROM g")
def _(spark, d):
    return X.sky_grid(_a(spark, d), 5)


@query("separation_summary", "match_quality n median_sep* max_sep*",
       f"{_SKY}{_PAIRS}, n AS (SELECT bid, min(sep) AS sep FROM j WHERE sep <= 200 GROUP BY bid) SELECT CASE WHEN sep < 25 THEN 'high' WHEN sep < 40 THEN 'medium' ELSE 'low' END AS match_quality, count(*) AS n, median(sep) AS median_sep, max(sep) AS max_sep FROM n GROUP BY 1")
def _(spark, d):
    return X.separation_summary(X.nearest(_b(spark, d), _a(spark, d), 200.0))


@query("mutual_nearest", "star_id match_id sep*",
       f"{_SKY}{_PAIRS}, x AS (SELECT bid, arg_min(aid, {{'s': sep, 'i': aid}}) AS aid, min(sep) AS sep FROM j WHERE sep <= 3 GROUP BY bid), y AS (SELECT aid, arg_min(bid, {{'s': sep, 'i': bid}}) AS bid FROM j WHERE sep <= 3 GROUP BY aid) SELECT x.bid AS star_id, x.aid AS match_id, sep FROM x JOIN y ON x.aid = y.aid AND x.bid = y.bid")
def _(spark, d):
    return X.mutual_nearest(_b(spark, d), _a(spark, d), 3.0)


@query("closest_source", "star_id distance*", f"WITH s AS ({_PIX}) SELECT star_id, sqrt((x - 100.2)**2 + (y - 55.7)**2) AS distance FROM s ORDER BY distance, star_id LIMIT 1")
def _(spark, d):
    k = F.col("c_custkey")
    return X.closest_source(views.table(spark, d, "customer").select(k.alias("star_id"), (k * 37 % 211).cast("double").alias("x"), (k * 53 % 197).cast("double").alias("y")), 100.2, 55.7)


@query("zone_counts", "zone n", f"WITH a AS ({Q.SKY_A}) SELECT CAST(floor((dec + 90) / 10) AS BIGINT) AS zone, count(*) AS n FROM a GROUP BY 1")
def _(spark, d):
    return X.zone_counts(_a(spark, d))


@query("review_list", "star_id review_url", f"WITH a AS ({Q.SKY_A}) SELECT star_id, printf('https://viewer.example.org/?coord=%.5f,%.5f', ra, dec) AS review_url FROM a")
def _(spark, d):
    from photospark.operators.coverage import review_list

    return review_list(_a(spark, d), "https://viewer.example.org/")


@query("fixed_sample", "star_id", f"WITH a AS ({Q.SKY_A}) SELECT star_id FROM a ORDER BY md5('42:' || CAST(star_id AS VARCHAR)), star_id LIMIT 9")
def _(spark, d):
    from photospark.operators.coverage import fixed_sample

    return fixed_sample(_a(spark, d), 9)
