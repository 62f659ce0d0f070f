"""DuckDB views and expressions that the SQL twins share."""

PHOT_E = """SELECT user_id AS star_id, event_id AS row, CAST(floor((epoch_us(ts) - 1704067200000000) / CAST(21600000000.0 AS DOUBLE)) AS INTEGER) AS epoch,
CAST(3208.0 AS DOUBLE) + (epoch_us(ts) - 1704067200000000) / CAST(86400000000.0 AS DOUBLE) AS btjd, value + 1.0 AS flux,
CAST(0.5 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (event_id % 50) AS flux_error, CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS quality FROM events"""
PHOT_L = """SELECT l_partkey AS star_id, l_orderkey * 10 + l_linenumber AS row, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS epoch,
date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) + l_linenumber / CAST(8.0 AS DOUBLE) AS btjd, l_extendedprice / CAST(1000.0 AS DOUBLE) AS flux,
CAST(0.1 AS DOUBLE) + l_quantity / CAST(100.0 AS DOUBLE) AS flux_error, CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS quality FROM lineitem"""
PHOT_C = """SELECT star_id, row, epoch, CAST(3208.0 AS DOUBLE) + epoch / CAST(12.0 AS DOUBLE) + floor(epoch / CAST(40.0 AS DOUBLE)) * CAST(0.5 AS DOUBLE) AS btjd,
CASE WHEN row % 211 <> 5 THEN base * (CAST(1.0 AS DOUBLE) + (CAST(CASE WHEN epoch % 31 = 11 THEN 0.4 ELSE 0.02 END AS DOUBLE) * (part - 0.5) + CASE WHEN star_id % 9 = 4 THEN CAST(0.1 AS DOUBLE) * (epoch % 36 - 18) / CAST(18.0 AS DOUBLE) ELSE 0.0 END))
 * CAST(CASE WHEN row % 499 = 3 THEN 1.5 WHEN row % 701 = 11 THEN 0.3 WHEN epoch % 29 = 7 THEN 1.2 ELSE 1.0 END AS DOUBLE) END AS flux,
CASE WHEN row % 307 = 7 THEN 0.0 WHEN row % 401 = 9 THEN NULL WHEN star_id % 11 = 3 THEN base * CAST(0.5 AS DOUBLE) ELSE base * CAST(0.005 AS DOUBLE) END AS flux_error,
CASE WHEN row % 37 = 0 THEN 1 WHEN row % 53 = 0 THEN 2 WHEN epoch % 43 = 13 AND star_id % 5 < 3 THEN 4 WHEN star_id % 10 = 6 AND event_type IN ('error', 'signup') THEN 1 WHEN star_id % 10 = 9 AND epoch % 4 < 3 THEN 1 ELSE 0 END AS quality
FROM (SELECT event_id AS row, event_id % n AS star_id, CAST(event_id // n AS INTEGER) AS epoch, event_type, value - floor(value) AS part, CAST(100.0 AS DOUBLE) + 10 * (event_id % n % 7) AS base FROM events, (SELECT greatest(1, count(*) // 200) AS n FROM events))"""
FRAMES = """SELECT CAST(event_id // 2000 AS INTEGER) AS image, CAST(event_id % 50 AS DOUBLE) AS x, CAST(event_id // 50 % 40 AS DOUBLE) AS y,
CASE WHEN event_id % 1499 <> 7 AND event_id % 997 <> 5 THEN 10.0 + value * CAST(0.1 AS DOUBLE) + CASE WHEN (event_id % 50 - 20) * (event_id % 50 - 20) + (event_id // 50 % 40 - 24) * (event_id // 50 % 40 - 24) <= 4 THEN 100.0 + event_id // 2000 ELSE 0 END END AS value FROM events"""
SKY_A = """SELECT c_custkey AS star_id, 360.0 * (c_custkey * CAST(0.6180339887498949 AS DOUBLE) - floor(c_custkey * CAST(0.6180339887498949 AS DOUBLE))) AS ra,
degrees(asin(2.0 * (c_custkey * CAST(0.7548776662466927 AS DOUBLE) - floor(c_custkey * CAST(0.7548776662466927 AS DOUBLE))) - 1.0)) AS dec FROM customer"""
SKY_B = f"SELECT star_id, ra + CAST(0.0005 AS DOUBLE) * sin(star_id) AS ra, dec + CAST(0.0005 AS DOUBLE) * cos(star_id) AS dec FROM ({SKY_A}) WHERE star_id % 5 <> 0"
FEAT = "SELECT vec_id AS star_id, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS f{i}" for i in range(1, 9)) + " FROM embeddings"


def sep(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Separation in arcsec."""
    h = f"(pow(sin(radians({dec1} - {dec2}) / 2), 2) + cos(radians({dec1})) * cos(radians({dec2})) * pow(sin(radians({ra1} - {ra2}) / 2), 2))"
    return f"degrees(2 * asin(least(1.0, sqrt({h})))) * 3600"


STATS = """g AS (SELECT *, avg(flux) OVER s AS mean, median(flux) OVER s AS mid, stddev_pop(flux) OVER s AS std FROM p WHERE quality = 0 WINDOW s AS (PARTITION BY star_id)),
h AS (SELECT *, (flux - mean) / flux_error AS r FROM g),
j AS (SELECT *, r * lead(r) OVER (PARTITION BY star_id ORDER BY btjd, row) AS pair FROM h),
a AS (SELECT star_id, count(*) AS n, avg(flux) AS mean_flux, median(flux) AS median_flux, stddev_pop(flux) AS std_flux, min(flux) AS min_flux, max(flux) AS max_flux,
 CASE WHEN median(flux) = 0 THEN 0 ELSE (max(flux) - min(flux)) / median(flux) END AS amplitude, median(flux_error) AS median_error, median(flux / flux_error) AS median_snr,
 min(btjd) AS btjd_start, max(btjd) AS btjd_end, max(btjd) - min(btjd) AS time_span_days, median(abs(flux - mid)) AS mad,
 CASE WHEN median(flux) = 0 THEN 0 ELSE (quantile_cont(flux, 0.95) - quantile_cont(flux, 0.05)) / median(flux) END AS amplitude_robust, quantile_cont(flux, 0.75) - quantile_cont(flux, 0.25) AS iqr,
 CAST(count(*) FILTER (WHERE abs(flux - mean) > 3 * std) AS BIGINT) AS n_outliers, CASE WHEN count(*) > 1 THEN sum(r * r) / (count(*) - 1) ELSE 0 END AS reduced_chi2,
 CASE WHEN count(*) > 2 THEN sum(sign(pair) * sqrt(abs(pair))) * sqrt(count(*) / CAST(count(*) - 1 AS DOUBLE)) END AS stetson_j FROM j GROUP BY star_id),
t AS (SELECT star_id, count(*) AS n_total, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_good FROM p GROUP BY star_id),
stats AS (SELECT t.star_id, n_total, n_good, n_good / CAST(n_total AS DOUBLE) AS completeness, a.* EXCLUDE (star_id, n), n_outliers / CAST(n AS DOUBLE) AS outlier_fraction FROM t LEFT JOIN a ON t.star_id = a.star_id)"""
STATS_COLUMNS = """star_id n_total n_good completeness* mean_flux* median_flux* std_flux* min_flux* max_flux* amplitude* median_error* median_snr* btjd_start* btjd_end*
time_span_days* mad* amplitude_robust* iqr* n_outliers outlier_fraction* reduced_chi2* stetson_j*"""


def stats(phot: str, rest: str) -> str:
    return f"WITH p AS ({phot}), {STATS} {rest}"


SCORES = """c AS (SELECT *, log10(greatest(coalesce(amplitude_robust, 0), 1e-5)) + 5 AS amplitude_score, log10(greatest(coalesce(reduced_chi2, 0), 0.01)) AS chi2_score, abs(coalesce(stetson_j, 0)) AS stetson_score,
 1 - 10 * least(coalesce(outlier_fraction, 0), 0.1) AS penalty FROM stats),
m AS (SELECT min(amplitude_score) a0, max(amplitude_score) a1, min(chi2_score) c0, max(chi2_score) c1, min(stetson_score) s0, max(stetson_score) s1 FROM c),
scored AS (SELECT c.*, (0.35 * CASE WHEN a1 > a0 THEN (amplitude_score - a0) / (a1 - a0) ELSE 0.5 END + 0.25 * CASE WHEN c1 > c0 THEN (chi2_score - c0) / (c1 - c0) ELSE 0.5 END
 + 0.20 * CASE WHEN s1 > s0 THEN (stetson_score - s0) / (s1 - s0) ELSE 0.5 END + 0.20 * 0.5) * penalty AS variability_score FROM c, m)"""

#: epoch_qc, star_qc, quiet stars, common mode and masks over p, as CTEs.
EPOCHS = """eg AS (SELECT epoch, median(flux) AS median_flux_good, list(flux) AS fs FROM p WHERE quality = 0 GROUP BY epoch),
eo AS (SELECT p.epoch, median(abs(flux - median_flux_good)) AS mad_flux FROM p JOIN eg ON p.epoch = eg.epoch WHERE quality = 0 GROUP BY p.epoch),
eb AS (SELECT epoch, min(btjd) AS btjd, median(flux) AS median_flux, avg(flux) AS mean_flux, stddev_samp(flux) AS std_flux, median(flux_error) AS median_error,
 CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_valid, count(*) AS n_total FROM p GROUP BY epoch),
ec AS (SELECT eb.*, median_flux_good, mad_flux, n_valid / CAST(n_total AS DOUBLE) AS frac_good, btjd - lag(btjd) OVER (ORDER BY btjd, eb.epoch) AS time_gap
 FROM eb LEFT JOIN eg ON eb.epoch = eg.epoch LEFT JOIN eo ON eb.epoch = eo.epoch),
ed AS (SELECT *, coalesce(time_gap > 3.0 / 24, false) AS is_after_gap, median_flux_good / nullif((SELECT median(median_flux_good) FROM ec), 0) AS median_flux_norm, mad_flux / nullif((SELECT median(mad_flux) FROM ec), 0) AS scatter_norm FROM ec),
ee AS (SELECT *, (SELECT coalesce(median(abs(scatter_norm - 1)), 1.0) FROM ed) AS u, (SELECT coalesce(median(abs(median_flux_norm - 1)), 1.0) FROM ed) AS v FROM ed),
ef AS (SELECT *, n_valid = 0 AS none, coalesce(scatter_norm > 1 + 5 * u, true) AS scatter, coalesce(abs(median_flux_norm - 1) > 3 * v, true) AS shifted, frac_good < 0.5 AS low FROM ee),
epochs AS (SELECT *, none OR scatter OR shifted OR low OR is_after_gap AS is_bad, concat_ws('|', CASE WHEN none THEN 'no_data' END, CASE WHEN scatter AND NOT none THEN 'high_scatter' END,
 CASE WHEN shifted AND NOT none THEN 'shifted_median' END, CASE WHEN low AND NOT none THEN 'low_valid' END, CASE WHEN is_after_gap THEN 'after_momentum_dump' END) AS reason FROM ef)"""
STARS = """sg AS (SELECT star_id, median(flux) AS m FROM p WHERE quality = 0 GROUP BY star_id),
so AS (SELECT p.star_id, median(abs(flux - m)) AS robust_scatter_mad FROM p JOIN sg ON p.star_id = sg.star_id WHERE quality = 0 GROUP BY p.star_id),
sb AS (SELECT star_id, count(*) AS n_total, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_valid, median(flux) AS median_flux, avg(flux) AS mean_flux, stddev_samp(flux) AS std_flux, median(flux_error) AS median_error FROM p GROUP BY star_id),
stars AS (SELECT sb.*, robust_scatter_mad, n_valid / CAST((SELECT count(DISTINCT epoch) FROM p) AS DOUBLE) AS completeness, median_flux / nullif(median_error, 0) AS snr,
 CASE WHEN sb.star_id % 3 <> 0 THEN 'T' || sb.star_id END AS tic_id, sb.star_id * 397 % 2048 NOT BETWEEN 50 AND 1998 OR sb.star_id * 911 % 2048 NOT BETWEEN 50 AND 1998 AS is_edge_star FROM sb LEFT JOIN so ON sb.star_id = so.star_id),
quiet AS (SELECT *, coalesce(completeness >= 0.9 AND robust_scatter_mad <= (SELECT quantile_cont(robust_scatter_mad, 0.3) FROM stars) AND NOT is_edge_star AND median_flux > 0, false) AS is_quiet_star FROM stars)"""
COMMON = """chosen AS (SELECT star_id FROM quiet WHERE is_quiet_star OR NOT EXISTS (SELECT 1 FROM quiet WHERE is_quiet_star)),
cr AS (SELECT p.epoch, flux / nullif(m, 0) AS relative FROM p JOIN chosen ON p.star_id = chosen.star_id JOIN sg ON p.star_id = sg.star_id WHERE quality = 0),
cm AS (SELECT x.epoch, coalesce(median(relative), 1.0) AS cm FROM (SELECT DISTINCT epoch FROM p) x LEFT JOIN cr ON x.epoch = cr.epoch GROUP BY x.epoch)"""
MASKS = """ma AS (SELECT p.*, epochs.is_bad, flux / nullif(cm, 0) AS flux_cm, quality <> 0 AS bad, (flux IS NULL OR flux_error IS NULL OR flux_error <= 0) AS invalid FROM p JOIN epochs ON p.epoch = epochs.epoch JOIN cm ON p.epoch = cm.epoch),
mb AS (SELECT *, CASE WHEN NOT bad AND NOT invalid THEN flux_cm END AS ok FROM ma),
mc AS (SELECT *, median(ok) OVER (PARTITION BY star_id) AS mid, count(ok) OVER (PARTITION BY star_id) AS n_ok FROM mb),
md AS (SELECT *, median(abs(ok - mid)) OVER (PARTITION BY star_id) AS mad FROM mc),
me AS (SELECT *, CASE WHEN n_ok >= 5 AND mad > 0 THEN (ok - mid) / (mad * 1.4826) END AS off, (SELECT min(btjd) FROM p) AS t0, (SELECT max(btjd) FROM p) AS t1 FROM md),
mf AS (SELECT *, coalesce(off > 5, false) AS pos, coalesce(off < -10, false) AS neg, btjd < t0 + 0.5 OR btjd > t1 - 0.5 AS edge, btjd BETWEEN 3215.0 AND 3221.0 AS artifact, coalesce(CASE WHEN flux_error = 0 THEN flux < 0 ELSE flux / flux_error < 3 END, false) AS low FROM me),
cleaned AS (SELECT *, CAST(CAST(bad AS INT) + 2 * CAST(invalid AS INT) + 4 * CAST(is_bad AS INT) + 8 * CAST(pos AS INT) + 16 * CAST(neg AS INT) + 32 * CAST(edge AS INT) + 64 * CAST(artifact AS INT) + 128 * CAST(low AS INT) AS INTEGER) AS mask_bits,
 concat_ws('|', CASE WHEN bad THEN 'quality' END, CASE WHEN invalid THEN 'invalid' END, CASE WHEN is_bad THEN 'bad_epoch' END, CASE WHEN pos THEN 'outlier_pos' END, CASE WHEN neg THEN 'outlier_neg' END,
 CASE WHEN edge THEN 'edge' END, CASE WHEN artifact THEN 'artifact:scattered_light' END, CASE WHEN low THEN 'low_snr' END) AS mask_reason FROM mf)"""


def cleaned(rest: str, phot: str = PHOT_C) -> str:
    return f"WITH p AS ({phot}), {EPOCHS}, {STARS}, {COMMON}, {MASKS} {rest}"


def with_p(rest: str, phot: str = PHOT_E) -> str:
    return f"WITH p AS ({phot}) {rest}"
