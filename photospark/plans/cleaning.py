"""Queries: quality control, masks, and the features made from cleaned data."""

from __future__ import annotations

from photospark import schema as S
from photospark.operators import features, quality
from photospark.plans import sql as Q
from photospark.plans.registry import query
from photospark.sources import views
from photospark.sources.io import stage

E = views.phot_survey


def _stars(spark, d):
    return quality.star_qc(E(spark, d), views.star_catalog(spark, d))


def _tables(spark, d):
    return quality.clean_tables(E(spark, d), 70, views.star_catalog(spark, d))


def _cleaned(spark, d):
    return _tables(spark, d).rows


@query("epoch_qc", "epoch btjd* median_flux* mean_flux* std_flux* median_error* n_valid n_total frac_good* time_gap* is_after_gap median_flux_good* mad_flux* median_flux_norm* scatter_norm* is_bad reason", Q.with_p(f", {Q.EPOCHS} SELECT * FROM epochs", Q.PHOT_C))
def _(spark, d):
    return quality.epoch_qc(E(spark, d))


@query("star_qc", "star_id n_total n_valid median_flux* mean_flux* std_flux* median_error* completeness* robust_scatter_mad* snr* tic_id is_edge_star", Q.with_p(f", {Q.STARS} SELECT * FROM stars", Q.PHOT_C))
def _(spark, d):
    return _stars(spark, d)


@query("quiet_stars", "star_id robust_scatter_mad* is_quiet_star",
       Q.with_p(f", {Q.STARS} SELECT star_id, robust_scatter_mad, is_quiet_star FROM quiet", Q.PHOT_C))
def _(spark, d):
    return quality.quiet_stars(_stars(spark, d))


@query("common_mode", "epoch cm*", Q.with_p(f", {Q.STARS}, {Q.COMMON} SELECT * FROM cm", Q.PHOT_C))
def _(spark, d):
    return quality.common_mode(E(spark, d), stage(quality.quiet_stars(stage(_stars(spark, d), "stars")), "stars"))


@query("mask_bits", "star_id row epoch flux_cm* mask_bits mask_reason", Q.cleaned("SELECT * FROM cleaned"))
def _(spark, d):
    return _cleaned(spark, d)


@query("mask_summary", "bit n", Q.cleaned("SELECT unnest(['total', 'any', 'quality', 'invalid', 'bad_epoch', 'outlier_pos', 'outlier_neg', 'edge', 'artifact', 'low_snr']) AS bit, unnest([count(*), count(*) FILTER (WHERE mask_bits > 0), " + ", ".join(f"count(*) FILTER (WHERE mask_bits & {1 << i} > 0)" for i in range(8)) + "]) AS n FROM cleaned"))
def _(spark, d):
    return quality.mask_summary(_cleaned(spark, d))


for _name, _bits in S.PRESETS.items():

    @query(f"preset_{_name}", "star_id row flux_cm* mask_bits", Q.cleaned(f"SELECT * FROM cleaned WHERE mask_bits & {_bits} = 0"))
    def _(spark, d, name=_name):
        return quality.preset(_cleaned(spark, d), name)


@query("transit_flags", "star_id row flux* quality_flag", Q.cleaned("SELECT star_id, row, flux_cm AS flux, CAST(mask_bits & 7 <> 0 AS INTEGER) AS quality_flag FROM cleaned"))
def _(spark, d):
    return quality.mask_to_quality(_cleaned(spark, d), for_transit=True)


@query("normal_flags", "star_id row flux* quality_flag", Q.cleaned("SELECT star_id, row, flux, CAST(mask_bits <> 0 AS INTEGER) AS quality_flag FROM cleaned"))
def _(spark, d):
    return quality.mask_to_quality(_cleaned(spark, d), use_flux_cm=False)


_FALLBACK = Q.cleaned(""", f AS (SELECT star_id, row, flux, mask_bits = 0 AS ok FROM cleaned), m AS (SELECT *, median(CASE WHEN ok THEN flux END) OVER s AS mid, count(CASE WHEN ok THEN flux END) OVER s AS n, median(flux) OVER s AS whole FROM f WINDOW s AS (PARTITION BY star_id)),
       d AS (SELECT *, median(abs(CASE WHEN ok THEN flux END - mid)) OVER (PARTITION BY star_id) AS mad FROM m) SELECT star_id, row, CASE WHEN n > 10 THEN 1.4826 * mad ELSE whole * 0.01 END AS flux_error FROM d""")


@query("error_fallback", "star_id row flux_error*", _FALLBACK)
def _(spark, d):
    """Errors of lightcurves whose table has none."""
    return quality.mask_to_quality(_cleaned(spark, d).drop("flux_error"), use_flux_cm=False)


@query("cleaning_report", "n_points n_stars n_epochs btjd_min* btjd_max* n_masked frac_masked*",
       Q.cleaned("SELECT count(*) AS n_points, count(DISTINCT star_id) AS n_stars, count(DISTINCT epoch) AS n_epochs, min(btjd) AS btjd_min, max(btjd) AS btjd_max, CAST(count(*) FILTER (WHERE mask_bits > 0) AS BIGINT) AS n_masked, avg(CAST(mask_bits > 0 AS INT)) AS frac_masked FROM cleaned"))
def _(spark, d):
    return quality.cleaning_report(_cleaned(spark, d))


def _ml(mask: int, complete: float, least: int) -> str:
    return Q.cleaned(f""", f AS (SELECT c.star_id, tic_id, flux_cm AS f, flux_error AS e, median(flux_cm) OVER (PARTITION BY c.star_id) AS mid2 FROM cleaned c JOIN stars ON c.star_id = stars.star_id WHERE mask_bits & {mask} = 0 AND stars.completeness >= {complete}),
    g AS (SELECT *, median(abs(f - mid2)) OVER (PARTITION BY star_id) AS mad2 FROM f)
    SELECT star_id, max(tic_id) AS tic_id, count(*) AS n_points, avg(f) AS mean_flux, median(f) AS median_flux, stddev_samp(f) AS std_flux, max(mad2) AS mad_flux, (max(f) - min(f)) / median(f) AS amplitude, (quantile_cont(f, 0.95) - quantile_cont(f, 0.05)) / median(f) AS amplitude_robust,
     sum(((f - mid2) / e) ** 2) / (count(*) - 1) AS reduced_chi2, skewness(f) AS skewness, kurtosis(f) AS kurtosis, avg(CAST(mad2 > 0 AND abs(f - mid2) > 2 * 1.4826 * mad2 AS INT)) AS beyond_2sigma, avg(CAST(mad2 > 0 AND abs(f - mid2) > 3 * 1.4826 * mad2 AS INT)) AS beyond_3sigma,
     median(e) AS median_error, median(f) / median(e) AS snr, count(*) / CAST((SELECT count(DISTINCT epoch) FROM cleaned) AS DOUBLE) AS completeness FROM g GROUP BY star_id HAVING count(*) >= {least}""")


_ML = "star_id tic_id n_points completeness* mean_flux* median_flux* std_flux* mad_flux* amplitude* amplitude_robust* reduced_chi2* skewness* kurtosis* beyond_2sigma* beyond_3sigma* median_error* snr*"


@query("ml_anomaly", _ML, _ml(*S.ML_MASKS["anomaly"], 10))
def _(spark, d):
    t = _tables(spark, d)
    return features.ml_features(t.rows, t.stars, "anomaly", t.epochs)


@query("ml_classification", _ML, _ml(*S.ML_MASKS["classification"], 10))
def _(spark, d):
    t = _tables(spark, d)
    return features.ml_features(t.rows, t.stars, "classification", t.epochs)
