"""Queries: transforms, sequences, and period search."""

from __future__ import annotations

from pyspark.sql import functions as F

from photospark.operators import features, lightcurve, period
from photospark.plans import sql as Q
from photospark.plans.registry import query
from photospark.sources import views

E, L = views.phot_events, views.phot_lineitem

for _method, _norm in {"median": "median(flux)", "mean": "avg(flux)", "first": "arg_min(flux, {'t': btjd, 'r': row})"}.items():

    @query(f"normalize_{_method}", "star_id row flux* flux_error*",
           Q.with_p(f", m AS (SELECT star_id, {_norm} AS m FROM p WHERE quality = 0 GROUP BY star_id) SELECT p.star_id, row, coalesce(flux / nullif(m, 0), flux) AS flux, coalesce(flux_error / nullif(m, 0), flux_error) AS flux_error FROM p LEFT JOIN m ON p.star_id = m.star_id"))
    def _(spark, d, method=_method):
        return lightcurve.normalize(E(spark, d), method)


_G = ", g AS (SELECT *, count(*) OVER s AS n, median(flux) OVER s AS mid, avg(btjd) OVER s AS tm, avg(flux) OVER s AS fm FROM p WHERE quality = 0 WINDOW s AS (PARTITION BY star_id))"


@query("detrend_linear", "star_id row detrended*",
       Q.with_p(_G + ", c AS (SELECT star_id, regr_slope(flux, btjd) AS b, regr_intercept(flux, btjd) AS a FROM g GROUP BY star_id) SELECT g.star_id, row, CASE WHEN n >= 3 THEN flux - (a + b * btjd) + mid ELSE flux END AS detrended FROM g JOIN c ON g.star_id = c.star_id"))
def _(spark, d):
    return lightcurve.detrend(E(spark, d), "linear")


@query("detrend_division", "star_id row detrended*",
       Q.with_p(_G + ", c AS (SELECT star_id, regr_slope(flux, btjd) AS b, regr_intercept(flux, btjd) AS a FROM g GROUP BY star_id) SELECT g.star_id, row, flux / nullif(a + b * btjd, 0) AS detrended FROM g JOIN c ON g.star_id = c.star_id"))
def _(spark, d):
    return lightcurve.detrend_by_division(E(spark, d))


@query("detrend_poly2", "star_id row detrended*",
       Q.with_p(_G + """, u AS (SELECT *, btjd - tm AS u FROM g), s AS (SELECT star_id, avg(u*u) m2, avg(u*u*u) m3, avg(u*u*u*u) m4, avg(flux) y0, avg(flux*u) y1, avg(flux*u*u) y2 FROM u GROUP BY star_id),
       c AS (SELECT *, (m2*y2 - m3*y1 - m2*m2*y0) / nullif(m2*m4 - m2*m2*m2 - m3*m3, 0) AS a2 FROM s) SELECT u.star_id, row, CASE WHEN n >= 3 THEN coalesce(flux - (y0 - a2*m2 + (y1 - a2*m3) / nullif(m2, 0) * u + a2*u*u) + mid, flux) ELSE flux END AS detrended FROM u JOIN c ON u.star_id = c.star_id"""))  # fmt: skip
def _(spark, d):
    return lightcurve.detrend(E(spark, d), "polynomial")


@query("detrend_median5", "star_id row detrended*",
       Q.with_p(_G + """, o AS (SELECT star_id, list(flux ORDER BY btjd, row) AS f, list(row ORDER BY btjd, row) AS r, count(*) AS n, median(flux) AS mid FROM p WHERE quality = 0 GROUP BY star_id),
       i AS (SELECT star_id, f, r, n, mid, unnest(range(1, n + 1)) AS k FROM o),
       w AS (SELECT *, [f[CASE WHEN k + x < 1 THEN least(1 - (k + x), n) WHEN k + x > n THEN greatest(2 * n + 1 - (k + x), 1) ELSE k + x END] FOR x IN [-2, -1, 0, 1, 2]] AS v FROM i)
       SELECT star_id, r[k] AS row, CASE WHEN n >= 3 THEN f[k] - list_median(v) + mid ELSE f[k] END AS detrended FROM w"""))  # fmt: skip
def _(spark, d):
    return lightcurve.detrend(E(spark, d), "median_filter")


_FOLD = ", f AS (SELECT *, (btjd - min(btjd) OVER (PARTITION BY star_id)) / 4.29 AS x FROM p WHERE quality = 0), turn AS (SELECT *, x - floor(x) AS turn FROM f), folded AS (SELECT *, CASE WHEN turn > 0.5 THEN turn - 1 ELSE turn END AS phase FROM turn)"


@query("phase_fold", "star_id row phase* flux*", Q.with_p(_FOLD + " SELECT * FROM folded"))
def _(spark, d):
    return lightcurve.phase_fold(E(spark, d), 4.29)


@query("phase_bins", "star_id bin center* n median_flux* error*",
       Q.with_p(_FOLD + """, b AS (SELECT star_id, CAST(floor((phase + 0.5) * 20) + 1 AS INTEGER) AS bin, flux FROM folded WHERE phase < 0.5), a AS (SELECT star_id, bin, count(*) AS n, median(flux) AS median_flux, stddev_pop(flux) / sqrt(count(*)) AS error FROM b GROUP BY star_id, bin)
       SELECT s.star_id, k.bin, -0.5 + (k.bin - 0.5) / 20 AS center, coalesce(n, 0) AS n, median_flux, error FROM (SELECT DISTINCT star_id FROM folded) s CROSS JOIN (SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS bin) k LEFT JOIN a ON a.star_id = s.star_id AND a.bin = k.bin"""))  # fmt: skip
def _(spark, d):
    return lightcurve.phase_bins(lightcurve.phase_fold(E(spark, d), 4.29), 20)


@query("extended_phase", "star_id row extended*",
       Q.with_p(_FOLD + ", e AS (SELECT star_id, row, unnest([CASE WHEN phase < 0 THEN phase + 1 ELSE phase END, CASE WHEN phase < 0 THEN phase ELSE phase - 1 END]) AS extended FROM folded) SELECT * FROM e WHERE extended >= -0.5 AND extended < 1"))
def _(spark, d):
    return lightcurve.extended_phase(lightcurve.phase_fold(E(spark, d), 4.29))


@query("time_bins", "star_id bin n btjd* median_flux* error*",
       Q.with_p(", b AS (SELECT *, CAST(floor((btjd - min(btjd) OVER (PARTITION BY star_id)) / 2.0) AS INTEGER) AS bin FROM p WHERE quality = 0) SELECT star_id, bin, count(*) AS n, avg(btjd) AS btjd, median(flux) AS median_flux, stddev_pop(flux) / sqrt(count(*)) AS error FROM b GROUP BY star_id, bin HAVING count(*) >= 5"))
def _(spark, d):
    return lightcurve.time_bins(E(spark, d), 2.0)


_FIRST = ", f AS (SELECT star_id, epoch, arg_min(flux, {'t': btjd, 'r': row}) AS flux, arg_min(flux_error, {'t': btjd, 'r': row}) AS flux_error, arg_min(quality, {'t': btjd, 'r': row}) AS quality FROM p GROUP BY star_id, epoch), n AS (SELECT star_id, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_detections FROM p GROUP BY star_id), e AS (SELECT DISTINCT epoch FROM p), w AS (SELECT n.star_id, n_detections, e.epoch, flux, flux_error, quality FROM n CROSS JOIN e LEFT JOIN f ON f.star_id = n.star_id AND f.epoch = e.epoch)"


@query("pivot_wide", "star_id n_detections epoch flux* flux_error* quality", Q.with_p(f"{_FIRST} SELECT * FROM w WHERE n_detections >= 3"))
def _(spark, d):
    """The wide table of all epochs, shown by rows."""
    return lightcurve.epoch_rows(lightcurve.epoch_maps(E(spark, d), 3), E(spark, d))


@query("master_table", "star_id epoch flux* flux_error* flag", Q.with_p(f"{_FIRST} SELECT *, coalesce(quality, 5) AS flag FROM w"))
def _(spark, d):
    """The master table of all epochs, shown by rows."""
    return lightcurve.epoch_rows(lightcurve.epoch_maps(E(spark, d), 0), E(spark, d)).withColumn("flag", F.coalesce("quality", F.lit(5)))


@query("tensor", "star_id n_real total*",
       Q.with_p(""", m AS (SELECT *, median(flux) OVER (PARTITION BY star_id) AS m, row_number() OVER (PARTITION BY star_id ORDER BY btjd, row) AS i FROM p)
       SELECT star_id, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_real, sum(i * (flux / m + 2 * flux_error / m + 3 * quality)) AS total FROM m WHERE i <= 200 GROUP BY star_id"""))  # fmt: skip
def _(spark, d):
    """Padded sequences of 200, summed up by place and channel."""
    s = lightcurve.padded_sequences(E(spark, d))
    total = F.aggregate(F.transform("x", lambda v, i: (i + 1) * (F.get(v, F.lit(0)) + 2 * F.get(v, F.lit(1)) + 3 * F.get(v, F.lit(2)))), F.lit(0.0), lambda a, v: a + v)
    return s.select("star_id", F.size(F.filter("mask", lambda v: v)).cast("long").alias("n_real"), total.alias("total"))


@query("stat_features", "star_id n_points mean* median* std* skewness* kurtosis* mad* iqr* p5* p10* p25* p75* p90* p95* range* amplitude* rms* cv* beyond_1std* beyond_2std* beyond_3std* weighted_mean* weighted_std* time_span* mean_abs_diff* max_abs_diff* autocorr*",
       Q.with_p(""", g AS (SELECT *, avg(flux) OVER s AS m, median(flux) OVER s AS mid, stddev_pop(flux) OVER s AS sd, lag(flux) OVER (PARTITION BY star_id ORDER BY btjd, row) AS before, sum(flux / (flux_error * flux_error)) OVER s / sum(1 / (flux_error * flux_error)) OVER s AS wm FROM p WHERE quality = 0 WINDOW s AS (PARTITION BY star_id))
       SELECT star_id, count(*) AS n_points, avg(flux) AS mean, median(flux) AS median, stddev_pop(flux) AS std, skewness(flux) * (count(*) - 2) / sqrt(count(*) * CAST(count(*) - 1 AS DOUBLE)) AS skewness, kurtosis_pop(flux) AS kurtosis, median(abs(flux - mid)) AS mad, quantile_cont(flux, 0.75) - quantile_cont(flux, 0.25) AS iqr, """
       + ", ".join(f"quantile_cont(flux, {x / 100}) AS p{x}" for x in (5, 10, 25, 75, 90, 95)) + ", " + ", ".join(f"avg(CAST(abs(flux - m) > {k} * sd AS INT)) AS beyond_{k}std" for k in (1, 2, 3))
       + """, max(flux) - min(flux) AS range, (max(flux) - min(flux)) / median(flux) AS amplitude, sqrt(avg(flux * flux)) AS rms, stddev_pop(flux) / avg(flux) AS cv, sum(flux / (flux_error * flux_error)) / sum(1 / (flux_error * flux_error)) AS weighted_mean, sqrt(sum((flux - wm) * (flux - wm) / (flux_error * flux_error)) / sum(1 / (flux_error * flux_error))) AS weighted_std,
       max(btjd) - min(btjd) AS time_span, avg(abs(flux - before)) AS mean_abs_diff, max(abs(flux - before)) AS max_abs_diff, corr(flux, before) AS autocorr FROM g GROUP BY star_id HAVING count(*) >= 3"""))  # fmt: skip
def _(spark, d):
    return features.stat_features(E(spark, d))


@query("epoch_list", "star_id n_detections epochs", Q.with_p("SELECT star_id, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_detections, array_to_string(list_sort(list_distinct(list(epoch) FILTER (WHERE quality = 0))), ',') AS epochs FROM p GROUP BY star_id"))
def _(spark, d):
    return lightcurve.detection_epochs(E(spark, d)).select("star_id", "n_detections", F.array_join(F.transform("epochs_detected", lambda e: e.cast("string")), ",").alias("epochs"))


@query("light_arrays", "star_id n first_flux* last_flux*", Q.with_p("SELECT star_id, count(*) AS n, arg_min(flux, {'t': btjd, 'r': row}) AS first_flux, arg_max(flux, {'t': btjd, 'r': row}) AS last_flux FROM p WHERE quality = 0 GROUP BY star_id"))
def _(spark, d):
    a = lightcurve.to_arrays(E(spark, d))
    return a.select("star_id", F.size("flux").cast("long").alias("n"), F.element_at("flux", 1).alias("first_flux"), F.element_at("flux", -1).alias("last_flux"))


_CLIPS = "".join(f", c{i} AS (SELECT star_id, f FROM (SELECT star_id, f, median(f) OVER s AS m, stddev_pop(f) OVER s AS sd FROM c{i - 1} WINDOW s AS (PARTITION BY star_id)) WHERE abs(f - m) <= 3 * sd)" for i in range(1, 6))


@query("sigma_clip", "star_id n mean* median* std*", Q.with_p(f", c0 AS (SELECT star_id, flux AS f FROM p){_CLIPS} SELECT star_id, count(*) AS n, avg(f) AS mean, median(f) AS median, stddev_pop(f) AS std FROM c5 GROUP BY star_id"))
def _(spark, d):
    return lightcurve.sigma_clip(E(spark, d))


_LS = """, g AS (SELECT star_id, btjd AS t, flux - avg(flux) OVER s AS y, count(*) OVER s AS n, min(btjd) OVER s AS t0 FROM p WHERE quality = 0 WINDOW s AS (PARTITION BY star_id)),
k AS (SELECT CAST(i AS INTEGER) AS i, CAST(1 AS DOUBLE) / 15 + i * ((CAST(10 AS DOUBLE) - CAST(1 AS DOUBLE) / 15) / 9999) AS freq FROM (SELECT unnest(range(10000)) AS i)),
w AS (SELECT star_id, i, freq, y, cos(2 * pi() * freq * (t - t0)) AS c, sin(2 * pi() * freq * (t - t0)) AS s FROM g CROSS JOIN k WHERE n >= 50),
q AS (SELECT star_id, i, freq, sum(y*c) yc, sum(y*s) ys, sum(c*c) cc, sum(s*s) ss, sum(c*s) cs, sum(y*y) yy FROM w GROUP BY star_id, i, freq),
a AS (SELECT *, atan2(2 * cs, cc - ss) / 2 AS tau FROM q),
b AS (SELECT star_id, i, freq, yy, yc * cos(tau) + ys * sin(tau) AS yc2, ys * cos(tau) - yc * sin(tau) AS ys2, cc*cos(tau)*cos(tau) + 2*cs*sin(tau)*cos(tau) + ss*sin(tau)*sin(tau) AS cc2, ss*cos(tau)*cos(tau) - 2*cs*sin(tau)*cos(tau) + cc*sin(tau)*sin(tau) AS ss2 FROM a),
periodogram AS (SELECT star_id, i, freq, (CASE WHEN cc2 > 1e-9 THEN yc2*yc2/cc2 ELSE 0 END + CASE WHEN ss2 > 1e-9 THEN ys2*ys2/ss2 ELSE 0 END) / yy AS power FROM b WHERE yy > 0),
peaks AS (SELECT star_id, CAST(rank AS INTEGER) AS rank, i, freq, power, 1 / freq AS period FROM (SELECT *, row_number() OVER (PARTITION BY star_id ORDER BY round(power, 9) DESC, i) AS rank FROM periodogram) WHERE rank <= 5)"""


@query("ls_fixed_grid", "star_id i freq* power*", Q.with_p(f"{_LS} SELECT * FROM peaks WHERE rank = 1"))
def _(spark, d):
    """The best of 10,000 frequencies."""
    return period.grid_peaks(E(spark, d))


@query("top_freqs", "star_id rank i power* period*", Q.with_p(f"{_LS} SELECT * FROM peaks"))
def _(spark, d):
    return period.grid_peaks(E(spark, d), k=5)


@query("ls_features", "star_id n_points total_power* power_ratio_top* period_1* power_1*")
def _(spark, d):
    return period.periodic_features(E(spark, d))


@query("bls_simple", "star_id period* start* n_in n_out depth* power*",
       Q.with_p(""", g AS (SELECT star_id, btjd - min(btjd) OVER s AS t, flux AS f, count(*) OVER s AS n FROM p WHERE quality = 0 WINDOW s AS (PARTITION BY star_id)),
       k AS (SELECT i, CAST(0.5 AS DOUBLE) + i * (CAST(14.5 AS DOUBLE) / 99) AS period, j, j * (CAST(0.98 AS DOUBLE) / 19) AS start FROM (SELECT unnest(range(100)) AS i) CROSS JOIN (SELECT unnest(range(20)) AS j)),
       w AS (SELECT star_id, i, period, j, start, f, t / period - floor(t / period) AS x FROM g CROSS JOIN k WHERE n >= 50), v AS (SELECT *, x >= start AND x < start + CAST(0.02 AS DOUBLE) AS inside FROM w),
       s AS (SELECT star_id, i, period, j, start, CAST(count(*) FILTER (WHERE inside) AS BIGINT) AS n_in, CAST(count(*) FILTER (WHERE NOT inside) AS BIGINT) AS n_out, median(f) FILTER (WHERE NOT inside) - median(f) FILTER (WHERE inside) AS depth FROM v GROUP BY star_id, i, period, j, start),
       r AS (SELECT *, depth * sqrt(n_in * n_out / CAST(n_in + n_out AS DOUBLE)) AS power FROM s WHERE n_in >= 3 AND n_out >= 10 AND depth > 0) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY star_id ORDER BY round(power, 9) DESC, i, j) AS rank FROM r) WHERE rank = 1"""))  # fmt: skip
def _(spark, d):
    return period.box_search(E(spark, d), [0.5 + i * (14.5 / 99) for i in range(100)])


@query("bls_full", "star_id period* duration* depth* power*")
def _(spark, d):
    return period.box_least_squares(E(spark, d))


_DOUBLE = f"""WITH p AS ({Q.PHOT_C}), g AS (SELECT star_id, btjd AS t, flux / median(flux) OVER s AS f, count(*) OVER s AS n FROM p WHERE quality = 0 AND flux IS NOT NULL WINDOW s AS (PARTITION BY star_id)),
m AS (SELECT *, median(f) OVER (PARTITION BY star_id) AS mid FROM g WHERE n >= 50), o AS (SELECT *, median(abs(f - mid)) OVER (PARTITION BY star_id) AS mad FROM m),
c AS (SELECT star_id, f, t - min(t) OVER s AS x, f - avg(f) OVER s AS y FROM o WHERE abs(f - mid) < 5 * 1.4826 * mad WINDOW s AS (PARTITION BY star_id)),
k AS (SELECT CAST(i AS INTEGER) AS i, CAST(0.05 AS DOUBLE) + i * (CAST(4.95 AS DOUBLE) / 2999) AS freq FROM (SELECT unnest(range(3000)) AS i)),
w AS (SELECT star_id, i, freq, y, cos(2 * pi() * freq * x) AS c, sin(2 * pi() * freq * x) AS s FROM c CROSS JOIN k),
q AS (SELECT star_id, i, freq, sum(y*c) yc, sum(y*s) ys, sum(c*c) cc, sum(s*s) ss, sum(c*s) cs, sum(y*y) yy FROM w GROUP BY star_id, i, freq), a AS (SELECT *, atan2(2 * cs, cc - ss) / 2 AS tau FROM q),
b AS (SELECT star_id, i, freq, yy, yc * cos(tau) + ys * sin(tau) AS yc2, ys * cos(tau) - yc * sin(tau) AS ys2, cc*cos(tau)*cos(tau) + 2*cs*sin(tau)*cos(tau) + ss*sin(tau)*sin(tau) AS cc2, ss*cos(tau)*cos(tau) - 2*cs*sin(tau)*cos(tau) + cc*sin(tau)*sin(tau) AS ss2 FROM a),
z AS (SELECT star_id, i, freq, round((CASE WHEN cc2 > 1e-9 THEN yc2*yc2/cc2 ELSE 0 END + CASE WHEN ss2 > 1e-9 THEN ys2*ys2/ss2 ELSE 0 END) / yy, 9) AS power FROM b),
best AS (SELECT star_id, i, power, 1 / freq AS period FROM (SELECT *, row_number() OVER (PARTITION BY star_id ORDER BY power DESC, i) AS rank FROM z) WHERE rank = 1),
h AS (SELECT c.star_id, f, least(19, CAST(floor((x / (2 * period) - floor(x / (2 * period))) * 20) AS INTEGER)) AS bin FROM c JOIN best ON c.star_id = best.star_id),
e AS (SELECT *, median(f) OVER (PARTITION BY star_id, bin) AS centre, count(*) OVER (PARTITION BY star_id, bin) AS n_bin, median(f) OVER (PARTITION BY star_id) AS whole, count(*) OVER (PARTITION BY star_id) AS n_points FROM h),
v AS (SELECT *, 1.4826 * median(abs(f - centre)) OVER (PARTITION BY star_id) AS noise FROM e),
r AS (SELECT star_id, bin, any_value(centre) AS centre, any_value(whole) - any_value(centre) AS depth, 1.2533 * any_value(noise) / sqrt(count(*)) AS spread FROM v WHERE n_bin >= 3 GROUP BY star_id, bin),
l AS (SELECT *, arg_min(bin, {{'c': centre, 'b': bin}}) OVER (PARTITION BY star_id) AS first FROM r), j AS (SELECT *, least((bin - first + 20) % 20, (first - bin + 20) % 20) AS across FROM l),
u AS (SELECT star_id, max(depth) FILTER (WHERE across = 0) AS depth, max(spread) FILTER (WHERE across = 0) AS s1, arg_min(depth, {{'c': centre, 'b': bin}}) FILTER (WHERE across >= 8) AS depth_opposite, arg_min(spread, {{'c': centre, 'b': bin}}) FILTER (WHERE across >= 8) AS s2 FROM j GROUP BY star_id),
x AS (SELECT best.*, (SELECT count(*) FROM c WHERE c.star_id = best.star_id) AS n_points, depth, depth_opposite, CASE WHEN sqrt(s1 * s1 + s2 * s2) > 0 THEN abs(depth - depth_opposite) / sqrt(s1 * s1 + s2 * s2) END AS significance FROM best LEFT JOIN u ON best.star_id = u.star_id)
SELECT *, CASE WHEN coalesce(significance > 3, false) THEN 2 * period ELSE period END AS best_period, coalesce(significance > 3, false) AS is_doubled FROM x"""


@query("clipped_search", "star_id n_points i period* power* depth* depth_opposite* significance* best_period* is_doubled", _DOUBLE)
def _(spark, d):
    """Clipped search over 3,000 frequencies, and the period against twice the period, for every star of the survey with 50 good points."""
    return period.clipped_search(views.phot_survey(spark, d))
