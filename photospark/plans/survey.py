"""Queries: coverage, feature-table operators, pixels, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from photospark.functions.stats import finite
from photospark.operators import coverage as C
from photospark.operators import image as I
from photospark.operators import ml as M
from photospark.plans import sql as Q
from photospark.plans.registry import query
from photospark.sources import views

# A sector is a month; in even months a seventh of the orders makes gaps.
_SECTOR = "CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER)"
_SOME = "(o_custkey % 7 = 0 OR month(o_orderdate) % 2 = 1)"
_DAYS = f"SELECT {_SECTOR} AS sector, CAST(o_orderdate AS DATE) AS date FROM orders WHERE {_SOME}"


def _days(spark, d):
    return views.table(spark, d, "orders").where(_SOME).select(F.expr(_SECTOR).alias("sector"), F.col("o_orderdate").cast("date").alias("date"))


_GAPS = f"""d AS (SELECT DISTINCT sector, date FROM ({_DAYS})), n AS (SELECT *, lead(date) OVER (PARTITION BY sector ORDER BY date) AS next FROM d), g AS (SELECT *, greatest(date_diff('day', date, next) - 1, 0) AS gap FROM n)"""
_QUALITY = f"""WITH {_GAPS}, s AS (SELECT sector, min(date) AS date_start, max(date) AS date_end, count(*) AS n_days, CAST(least(date_diff('day', min(date), max(date)) + 1, 30) AS INTEGER) AS n_expected, CAST(count(*) FILTER (WHERE gap > 0) AS BIGINT) AS n_gaps,
CAST(coalesce(max(gap), 0) AS INTEGER) AS largest_gap, CAST(coalesce(sum(gap), 0) AS BIGINT) AS total_gap FROM g GROUP BY sector), c AS (SELECT *, 100.0 * n_days / n_expected AS coverage FROM s),
q AS (SELECT *, CASE WHEN coverage >= 90 AND largest_gap <= 1 AND n_days >= 25 THEN 'excellent' WHEN coverage >= 80 AND largest_gap <= 3 AND n_days >= 20 THEN 'good' WHEN coverage >= 60 AND largest_gap <= 7 AND n_days >= 15 THEN 'fair'
WHEN coverage >= 40 AND n_days >= 10 THEN 'poor' ELSE 'bad' END AS quality FROM c)"""
_LEVEL = "list_position(['excellent', 'good', 'fair', 'poor', 'bad', 'unknown'], quality)"


@query("obs_gaps", "sector gap_index gap_start* gap_end* gap_hours* missed",
       f"""WITH p AS ({Q.PHOT_E}), t AS (SELECT CAST(star_id % 10 AS INTEGER) AS sector, btjd AS t FROM p), n AS (SELECT *, lead(t) OVER (PARTITION BY sector ORDER BY t) AS e FROM t)
       SELECT sector, CAST(row_number() OVER (PARTITION BY sector ORDER BY t) AS INTEGER) AS gap_index, t AS gap_start, e AS gap_end, (e - t) * 24 AS gap_hours, CAST(floor((e - t) / (1 / 144.0)) AS INTEGER) - 1 AS missed FROM n WHERE e - t > 1.5 * 2.0 / 24""")  # fmt: skip
def _(spark, d):
    return C.observation_gaps(views.phot_events(spark, d).select((F.col("star_id") % 10).cast("int").alias("sector"), F.col("btjd").alias("t")), 1 / 144.0, 2.0)


@query("day_gaps", "sector gap_start gap_end gap_days", f"WITH {_GAPS} SELECT sector, date AS gap_start, next AS gap_end, CAST(gap AS INTEGER) AS gap_days FROM g WHERE gap > 0")
def _(spark, d):
    return C.day_gaps(_days(spark, d))


@query("sector_quality", "sector date_start date_end n_days n_expected n_gaps largest_gap total_gap coverage* quality", f"{_QUALITY} SELECT * FROM q")
def _(spark, d):
    return C.sector_quality(_days(spark, d))


@query("rank_sectors", "sector quality coverage* rank", f"{_QUALITY} SELECT *, CAST(row_number() OVER (ORDER BY {_LEVEL}, coverage DESC, sector) AS INTEGER) AS rank FROM q")
def _(spark, d):
    return C.rank_sectors(C.sector_quality(_days(spark, d)))


@query("best_sector", "sector quality coverage*", f"{_QUALITY} SELECT * FROM q WHERE {_LEVEL} <= 5 ORDER BY {_LEVEL}, sector LIMIT 1")
def _(spark, d):
    return C.best_sector(C.sector_quality(_days(spark, d)), "bad")


@query("manifest", "sector n_files n_valid n_invalid mjd_start* mjd_end* span_days* missing_days completeness*",
       f"""WITH {_GAPS}, f AS (SELECT {_SECTOR} AS sector, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 48622.0 AS mjd, o_orderkey % 7 <> 0 AS valid FROM orders WHERE {_SOME}),
       a AS (SELECT sector, count(*) AS n_files, CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS n_valid, CAST(count(*) FILTER (WHERE NOT valid) AS BIGINT) AS n_invalid, min(mjd) FILTER (WHERE valid) AS mjd_start, max(mjd) FILTER (WHERE valid) AS mjd_end FROM f GROUP BY sector),
       m AS (SELECT sector, CAST(sum(gap) AS BIGINT) AS missing_days FROM g WHERE gap > 0 GROUP BY sector)
       SELECT a.*, mjd_end - mjd_start AS span_days, coalesce(missing_days, 0) AS missing_days, n_valid / CAST(n_valid + coalesce(missing_days, 0) AS DOUBLE) AS completeness FROM a LEFT JOIN m ON a.sector = m.sector""")  # fmt: skip
def _(spark, d):
    files = views.table(spark, d, "orders").where(_SOME).select(F.expr(_SECTOR).alias("sector"), F.format_string("f%09d.fits", "o_orderkey").alias("filename"), (F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) + 48622.0).alias("mjd_obs"), (F.col("o_orderkey") % 7 != 0).alias("valid"))
    return C.manifest(files, _days(spark, d))


@query("date_range_days", "date sector", f"WITH d AS ({_DAYS}) SELECT CAST(r.date AS DATE) AS date, min(sector) AS sector FROM (SELECT unnest(generate_series(DATE '1996-02-01', DATE '1996-04-30', INTERVAL 1 DAY)) AS date) r LEFT JOIN d ON d.date = CAST(r.date AS DATE) GROUP BY r.date")
def _(spark, d):
    return C.days_to_sectors(_days(spark, d), "1996-02-01", "1996-04-30")


_FILES = "SELECT DISTINCT printf('ffic_%05d.fits', epoch) AS filename FROM p"


@query("cadence_skip", "filename file_idx", Q.with_p(f", f AS ({_FILES}), l AS (SELECT filename, CAST(row_number() OVER (ORDER BY filename) - 1 AS INTEGER) AS file_idx FROM f) SELECT * FROM l WHERE file_idx % 6 = 0"))
def _(spark, d):
    return C.cadence_skip(C.file_listing(views.phot_events(spark, d).select(F.format_string("ffic_%05d.fits", "epoch").alias("filename")).distinct()), 6)


_HEADERS = f"""f AS (SELECT {_SECTOR} AS sector, printf('f%09d.fits', o_orderkey) AS filename, CASE WHEN o_orderkey % 31 <> 4 THEN date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 48622.0 END AS mjd_obs, o_orderkey % 7 <> 0 AS valid FROM orders WHERE {_SOME})"""


def _headers(spark, d):
    mjd = F.when(F.col("o_orderkey") % 31 != 4, F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) + 48622.0)
    return views.table(spark, d, "orders").where(_SOME).select(F.expr(_SECTOR).alias("sector"), F.format_string("f%09d.fits", "o_orderkey").alias("filename"), mjd.alias("mjd_obs"), (F.col("o_orderkey") % 7 != 0).alias("valid"))


@query("calibration_order", "filename epoch", f"WITH {_HEADERS} SELECT filename, CASE WHEN valid AND mjd_obs IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY valid AND mjd_obs IS NOT NULL ORDER BY mjd_obs, filename) - 1 AS INTEGER) END AS epoch FROM f")
def _(spark, d):
    """Files by their time of observation, numbered in many tasks; broken ones stay."""
    return C.calibration_order(_headers(spark, d))


@query("sectors", "sector n_files", f"WITH {_HEADERS} SELECT sector, count(*) AS n_files FROM f GROUP BY sector")
def _(spark, d):
    return C.sectors(_headers(spark, d))


@query("camera_ccds", "camera ccd", "SELECT DISTINCT CAST(1 + n_regionkey % 4 AS INTEGER) AS camera, CAST(1 + n_nationkey % 4 AS INTEGER) AS ccd FROM nation JOIN customer ON c_nationkey = n_nationkey")
def _(spark, d):
    """Pairs of camera and CCD from the names of files."""
    n, c = views.table(spark, d, "nation"), views.table(spark, d, "customer")
    names = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.format_string("%d-%d", 1 + F.col("n_regionkey") % 4, 1 + F.col("n_nationkey") % 4).alias("folder"))
    return C.camera_ccds(names)


@query("unprocessed_files", "filename file_idx", Q.with_p(f", f AS ({_FILES}), l AS (SELECT filename, CAST(row_number() OVER (ORDER BY filename) - 1 AS INTEGER) AS file_idx FROM f) SELECT * FROM l WHERE file_idx % 6 <> 0"))
def _(spark, d):
    files = C.file_listing(views.phot_events(spark, d).select(F.format_string("ffic_%05d.fits", "epoch").alias("filename")).distinct())
    return C.unprocessed(files, C.cadence_skip(files, 6))


@query("spectral_classes", "spectral_class n", "SELECT CASE WHEN t > 30000 THEN 'O' WHEN t > 10000 THEN 'B' WHEN t > 7500 THEN 'A' WHEN t > 6000 THEN 'F' WHEN t > 5200 THEN 'G' WHEN t > 3700 THEN 'K' ELSE 'M' END AS spectral_class, count(*) AS n FROM (SELECT c_acctbal + 2500 AS t FROM customer) GROUP BY 1")
def _(spark, d):
    return views.table(spark, d, "customer").groupBy(C.spectral_class(F.col("c_acctbal") + 2500).alias("spectral_class")).agg(F.count("*").alias("n"))


_F = [f"f{i}" for i in range(1, 9)]


def _feat(spark, d):
    return views.features(spark, d)


@query("impute_scale", "star_id " + " ".join(f"{c}*" for c in _F[:4]),
       f"WITH a AS (SELECT star_id, " + ", ".join(f"CASE WHEN {c} <= 0.3 THEN {c} END AS {c}" for c in _F[:4]) + f" FROM ({Q.FEAT})), b AS (SELECT star_id, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM a)) AS {c}" for c in _F[:4])
       + " FROM a) SELECT star_id, " + ", ".join(f"({c} - (SELECT median({c}) FROM b)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM b) AS {c}" for c in _F[:4]) + " FROM b")
def _(spark, d):
    df = _feat(spark, d).withColumns({c: F.when(F.col(c) <= 0.3, F.col(c)) for c in _F[:4]})
    return M.scale(M.impute(df, _F[:4]), _F[:4])


@query("standard_scale", "star_id f1* f2*", f"WITH b AS ({Q.FEAT}) SELECT star_id, " + ", ".join(f"({c} - (SELECT avg({c}) FROM b)) / (SELECT stddev_pop({c}) FROM b) AS {c}" for c in _F[:2]) + " FROM b")
def _(spark, d):
    return M.scale(_feat(spark, d), _F[:2], robust=False)


@query("corr_pairs", "a b r*", f"WITH t AS ({Q.FEAT}) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM t HAVING abs(corr({a}, {b})) > 0.03" for i, a in enumerate(_F) for b in _F[i + 1 :]))
def _(spark, d):
    return M.correlated_pairs(_feat(spark, d), _F, 0.03)


@query("mahalanobis", "star_id distance* is_outlier",
       f"""WITH t AS (SELECT star_id, f1, f2 FROM ({Q.FEAT})), s AS (SELECT avg(f1) m1, avg(f2) m2, var_samp(f1) + 1e-6 a, var_samp(f2) + 1e-6 b, covar_samp(f1, f2) c FROM t),
       x AS (SELECT star_id, sqrt(greatest(((f1-m1)*(f1-m1)*b - 2*(f1-m1)*(f2-m2)*c + (f2-m2)*(f2-m2)*a) / (a*b - c*c), 0)) AS distance FROM t, s) SELECT star_id, distance, distance > (SELECT quantile_cont(distance, 0.95) FROM x) AS is_outlier FROM x""")  # fmt: skip
def _(spark, d):
    return M.mahalanobis(_feat(spark, d), ["f1", "f2"])


_NN = f"""WITH t AS ({Q.FEAT}), d AS (SELECT a.star_id, b.star_id AS o, sqrt({' + '.join(f'(a.{c}-b.{c})*(a.{c}-b.{c})' for c in _F)}) AS distance FROM t a JOIN t b ON a.star_id <> b.star_id),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY star_id ORDER BY round(distance, 12), o) AS rank FROM d) WHERE rank <= 20), k AS (SELECT star_id, distance AS kd FROM n WHERE rank = 20),
r AS (SELECT n.star_id, 1 / (avg(greatest(distance, kd)) + 1e-10) AS lrd FROM n JOIN k ON n.o = k.star_id GROUP BY n.star_id), l AS (SELECT n.star_id, avg(r2.lrd) / max(r1.lrd) AS lof FROM n JOIN r r1 ON n.star_id = r1.star_id JOIN r r2 ON n.o = r2.star_id GROUP BY n.star_id)"""


def _lof(spark, d):
    return M.local_outlier_factor(_feat(spark, d), _F, 20)


@query("lof", "star_id lof*", f"{_NN} SELECT * FROM l")
def _(spark, d):
    return _lof(spark, d)


_MAHA = """, s AS (SELECT avg(f1) m1, avg(f2) m2, var_samp(f1) + 1e-6 a, var_samp(f2) + 1e-6 b, covar_samp(f1, f2) c FROM t),
x AS (SELECT star_id, sqrt(greatest(((f1-m1)*(f1-m1)*b - 2*(f1-m1)*(f2-m2)*c + (f2-m2)*(f2-m2)*a) / (a*b - c*c), 0)) AS distance FROM t, s), z AS (SELECT x.star_id, distance, lof FROM x JOIN l ON x.star_id = l.star_id)"""


@query("combined_rank", "star_id combined*", f"{_NN}{_MAHA} SELECT * FROM (SELECT star_id, distance / sd + lof / sl AS combined FROM z, (SELECT stddev_samp(distance) AS sd, stddev_samp(lof) AS sl FROM z)) ORDER BY round(combined, 9) DESC, star_id LIMIT 20")
def _(spark, d):
    return M.combined_rank(M.mahalanobis(_feat(spark, d), ["f1", "f2"]).select("star_id", "distance").join(_lof(spark, d), "star_id"), ["distance", "lof"])


@query("combined_rank_all", "star_id combined*")
def _(spark, d):
    """Distance, neighbour density and isolation together."""
    df = _feat(spark, d)
    scores = M.mahalanobis(df, ["f1", "f2"]).select("star_id", "distance").join(_lof(spark, d), "star_id").join(M.isolation_scores(df, _F).select("star_id", "score"), "star_id")
    return M.combined_rank(scores, ["distance", "lof", "score"])


_VOTES = f"{_NN}{_MAHA} SELECT star_id, v AS votes, v >= 2 AS is_strong FROM (SELECT star_id, CAST(distance > pd AS INT) + CAST(lof > pl AS INT) AS v FROM z, (SELECT quantile_cont(distance, 0.95) AS pd, quantile_cont(lof, 0.95) AS pl FROM z))"


def _votes(spark, d):
    lof = _lof(spark, d)
    flagged = lof.crossJoin(F.broadcast(lof.agg(F.percentile("lof", F.lit(0.95)).alias("limit")))).select("star_id", (F.col("lof") > F.col("limit")).alias("far"))
    return M.votes(M.mahalanobis(_feat(spark, d), ["f1", "f2"]).join(flagged, "star_id"), ["is_outlier", "far"])


@query("votes_rank", "star_id votes is_strong", _VOTES)
def _(spark, d):
    return _votes(spark, d)


@query("vote_counts", "votes n", f"SELECT votes, count(*) AS n FROM ({_VOTES}) GROUP BY votes")
def _(spark, d):
    return M.vote_counts(_votes(spark, d))


_EPS = f"""t AS (SELECT star_id, f1, f2 FROM ({Q.FEAT})), pairs AS (SELECT a.star_id AS a, b.star_id AS b, sqrt((a.f1-b.f1)*(a.f1-b.f1) + (a.f2-b.f2)*(a.f2-b.f2)) AS d FROM t a JOIN t b ON true),
       fifth AS (SELECT d FROM (SELECT d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rank FROM pairs) WHERE rank = 5), e AS (SELECT a, b FROM pairs WHERE d <= (SELECT quantile_cont(d, 0.9) FROM fifth))"""


_CLUSTERS = f"""WITH RECURSIVE {_EPS}, c AS (SELECT a FROM e GROUP BY a HAVING count(*) >= 5),
       w AS (SELECT a, a AS b FROM c UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a JOIN c ON c.a = e.b), l AS (SELECT a, min(b) AS label FROM w GROUP BY a)
       SELECT t.star_id, min(label) AS cluster FROM t LEFT JOIN e ON t.star_id = e.a LEFT JOIN l ON e.b = l.a GROUP BY t.star_id"""


def _dbscan(spark, d):
    df = _feat(spark, d)
    return M.dbscan(df, ["f1", "f2"], M.reach_of(df, ["f1", "f2"]))


@query("dbscan", "star_id cluster", _CLUSTERS)
def _(spark, d):
    return _dbscan(spark, d)


@query("cluster_centres", "cluster n f1* f2*", f"SELECT cluster, count(*) AS n, avg(f1) AS f1, avg(f2) AS f2 FROM ({_CLUSTERS}) c JOIN ({Q.FEAT}) v ON c.star_id = v.star_id GROUP BY cluster")
def _(spark, d):
    """Centres and sizes of the clusters, noise included."""
    return M.cluster_centres(_dbscan(spark, d).join(_feat(spark, d), "star_id"), ["f1", "f2"])


@query("iforest", "star_id score* is_outlier")
def _(spark, d):
    return M.isolation_scores(_feat(spark, d), _F)


@query("kmeans", "star_id cluster")
def _(spark, d):
    return M.kmeans(_feat(spark, d), _F[:4])


@query("pca", "star_id pc1* pc2*")
def _(spark, d):
    return M.principal_components(_feat(spark, d), _F)


_PIXELS = Q.FRAMES
#: Stars of the pixel queries: suppliers, in the frame and around it.
_SPOTS = "(SELECT s_suppkey AS star_id, s_suppkey * 7 % 540 / CAST(10.0 AS DOUBLE) - CAST(1.9629 AS DOUBLE) AS x, s_suppkey * 11 % 440 / CAST(10.0 AS DOUBLE) - CAST(1.9783 AS DOUBLE) AS y FROM supplier)"


def _pixels(spark, d):
    return views.frames(spark, d)


def _spots(spark, d):
    k = F.col("s_suppkey")
    return views.table(spark, d, "supplier").select(k.alias("star_id"), (k * 7 % 540 / F.lit(10.0) - 1.9629).alias("x"), (k * 11 % 440 / F.lit(10.0) - 1.9783).alias("y"))


_APERTURE = f"""WITH p AS ({_PIXELS}), s AS (SELECT star_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM {_SPOTS}), j AS (SELECT image, star_id, value, sqrt((p.x-s.x)**2 + (p.y-s.y)**2) AS d FROM p CROSS JOIN s),
g AS (SELECT image, star_id, CAST(count(value) FILTER (WHERE d <= 3) AS BIGINT) AS n_pixels, sum(value) FILTER (WHERE d <= 3) AS total, avg(value) FILTER (WHERE d >= 5 AND d <= 8) AS background FROM j GROUP BY image, star_id),
n AS (SELECT g.*, x, y, total - coalesce(background, 0) * pi() * 9 AS net FROM g JOIN s ON g.star_id = s.star_id),
a AS (SELECT *, CASE WHEN x < 0 OR y < 0 OR x >= 48 OR y >= 48 THEN 3 WHEN net < 0 THEN 2 WHEN least(x, y) < 6 OR greatest(x, y) > 48 - 6 THEN 1 ELSE 0 END AS quality FROM n)"""


@query("aperture_center", "image star_id n_pixels background* net* flux* quality", f"{_APERTURE} SELECT *, net / 2 AS flux FROM a")
def _(spark, d):
    return I.aperture_flux(_pixels(spark, d), _spots(spark, d), exposure=2.0, edge=48.0)


@query("ccd_error", "image star_id error* legacy* cutout*",
       f"{_APERTURE} SELECT image, star_id, sqrt(abs(net)/5.2 + n_pixels*pi()*background/5.2 + n_pixels*pi()*(0.3/5.2)*(0.3/5.2))/2 AS error, CASE WHEN net/5.2 + n_pixels*pi()*background/5.2 + n_pixels*pi()*(0.3/5.2)*(0.3/5.2) >= 0 THEN sqrt(net/5.2 + n_pixels*pi()*background/5.2 + n_pixels*pi()*(0.3/5.2)*(0.3/5.2))/2 END AS legacy, sqrt(abs(net) + 28*background + 28*0.09) AS cutout FROM a")
def _(spark, d):
    a = I.aperture_flux(_pixels(spark, d), _spots(spark, d), edge=48.0)
    c = [F.col("net"), F.col("background"), F.lit(0.3), F.col("n_pixels")]
    return a.select("image", "star_id", I.ccd_error(*c, exposure=2.0).alias("error"), I.legacy_error(*c, exposure=2.0).alias("legacy"), I.cutout_error(*c[:3], F.lit(28)).alias("cutout"))


@query("centroid", "image star_id x_centroid* y_centroid*",
       f"""WITH p AS ({_PIXELS}), s AS (SELECT star_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM {_SPOTS}), b AS (SELECT image, star_id, p.x, p.y, value, s.x AS sx, s.y AS sy FROM p JOIN s ON abs(p.x - round(s.x)) <= 4 AND abs(p.y - round(s.y)) <= 4),
       m AS (SELECT *, greatest(value - median(value) OVER (PARTITION BY image, star_id), 0) AS w FROM b) SELECT image, star_id, CASE WHEN sum(w) > 0 THEN sum(w*x)/sum(w) ELSE max(sx) END AS x_centroid, CASE WHEN sum(w) > 0 THEN sum(w*y)/sum(w) ELSE max(sy) END AS y_centroid FROM m GROUP BY image, star_id""")  # fmt: skip
def _(spark, d):
    return I.centroids(_pixels(spark, d), _spots(spark, d))


_GROWTH = f"WITH p AS ({_PIXELS}), c AS (SELECT image, CAST(radius AS INTEGER) AS radius, sum(value) AS total FROM p CROSS JOIN (SELECT unnest(range(1, 10)) AS radius) WHERE sqrt((x-20)**2 + (y-24)**2) <= radius GROUP BY image, radius)"


@query("curve_growth", "image radius total*", f"{_GROWTH} SELECT * FROM c")
def _(spark, d):
    return I.curve_of_growth(_pixels(spark, d), 20.0, 24.0)


@query("optimal_radius", "image radius", f"{_GROWTH}, s AS (SELECT *, lead(total) OVER (PARTITION BY image ORDER BY radius) - total AS step FROM c) SELECT image, arg_min(radius, {{'s': step, 'r': radius}}) AS radius FROM s WHERE step IS NOT NULL GROUP BY image")
def _(spark, d):
    return I.optimal_radius(I.curve_of_growth(_pixels(spark, d), 20.0, 24.0))


@query("median_frame", "y* x* value*", f"WITH p AS ({_PIXELS}) SELECT y, x, median(CAST(value AS DOUBLE)) AS value FROM p GROUP BY y, x")
def _(spark, d):
    return I.median_frame(_pixels(spark, d))


_KSTEPS = "".join(f", k{i} AS (SELECT t, m, e - (e - 42.0 / 76 * sin(e) - m) / (1 - 42.0 / 76 * cos(e)) AS e FROM {'k0' if i == 1 else f'k{i - 1}'})" for i in range(1, 11))


@query("orbit_sim", "t* x* y* distance* moon_distance*",
       f"""WITH a AS (SELECT DISTINCT CAST(epoch AS DOUBLE) * CAST(0.25 AS DOUBLE) AS t FROM ({Q.PHOT_E})), k0 AS (SELECT t, 2*pi()/13.7*t - 2*pi() * floor(t / 13.7) AS m, 2*pi()/13.7*t - 2*pi() * floor(t / 13.7) AS e FROM a){_KSTEPS},
       o AS (SELECT t, 38 * 6371.0 * (cos(e) - 42.0 / 76) AS x, 38 * 6371.0 * sqrt(1 - (42.0/76) * (42.0/76)) * sin(e) AS y FROM k10) SELECT *, sqrt(x*x + y*y) AS distance, sqrt((x - 384400.0*cos(2*pi()/27.3*t))**2 + (y - 384400.0*sin(2*pi()/27.3*t))**2) AS moon_distance FROM o""")  # fmt: skip
def _(spark, d):
    return I.orbit_positions(views.phot_events(spark, d).select((F.col("epoch").cast("double") * 0.25).alias("t")).distinct())


@query("star_detection", "image star_id x* y*")
def _(spark, d):
    whole = _pixels(spark, d).withColumn("value", F.coalesce(finite("value"), F.lit(10.0)))
    images = whole.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("y", "x", "value"))).alias("s"))
    return I.detect(images.select(F.col("image").cast("string").alias("image"), F.lit(views.FRAME_HEIGHT).alias("height"), F.lit(views.FRAME_WIDTH).alias("width"), F.col("s.value").alias("values")))


@query("stream_ingest", "star_id n_points mean_flux*", Q.with_p("SELECT star_id, count(*) AS n_points, avg(flux) AS mean_flux FROM p GROUP BY star_id"))
def _(spark, d):
    """The photometry written as files, taken in as a stream in two runs, and summed up."""
    import uuid

    from photospark.sources.io import shared_dir
    from photospark.streaming.ingest import ingest

    root = shared_dir(spark) + f"/stream-{uuid.uuid4().hex}"
    p = views.phot_events(spark, d)
    for part in (0, 1):
        p.where(F.col("row") % 2 == part).write.mode("append").parquet(f"{root}/source")
        ingest(spark, f"{root}/source", p.schema, f"{root}/target", f"{root}/state")
    return spark.read.schema(p.schema).parquet(f"{root}/target").groupBy("star_id").agg(F.count("*").alias("n_points"), F.avg("flux").alias("mean_flux"))


@query("archive_urls", "filename url", Q.with_p(f", f AS (SELECT DISTINCT epoch, printf('ffic_%05d.fits', epoch) AS filename FROM p) SELECT filename, printf('https://archive.example.org/s%04d/%d-%d/%s', 70, 1, 2, filename) AS url FROM f"))
def _(spark, d):
    files = views.phot_events(spark, d).select(F.lit(70).alias("sector"), F.lit(1).alias("camera"), F.lit(2).alias("ccd"), F.format_string("ffic_%05d.fits", "epoch").alias("filename")).distinct()
    return C.archive_urls(files, "https://archive.example.org")
