"""Queries: selection, statistics, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from photospark.functions import surface
from photospark.operators import features, quality, score
from photospark.plans import sql as Q
from photospark.plans.registry import query
from photospark.sources import views

E, L = views.phot_events, views.phot_lineitem


@query("good_data", "star_id row epoch btjd* flux*", Q.with_p("SELECT * FROM p WHERE quality = 0"))
def _(spark, d):
    return quality.good_data(E(spark, d))


@query("artifact_exclusion", "star_id row btjd* flux*", Q.with_p("SELECT * FROM p WHERE quality = 0 AND NOT btjd BETWEEN 3215.0 AND 3221.0"))
def _(spark, d):
    return quality.good_data(E(spark, d), True, 70)


@query("star_stats", Q.STATS_COLUMNS, Q.stats(Q.PHOT_L, "SELECT * FROM stats"))
def _(spark, d):
    return features.star_stats(L(spark, d))


@query("star_stats_events", Q.STATS_COLUMNS, Q.stats(Q.PHOT_E, "SELECT * FROM stats"))
def _(spark, d):
    return features.star_stats(E(spark, d))


@query("stetson_j", "star_id stetson_j*", Q.stats(Q.PHOT_E, "SELECT star_id, stetson_j FROM stats"))
def _(spark, d):
    return features.star_stats(E(spark, d)).select("star_id", "stetson_j")


@query("quality_filter", "star_id completeness* median_snr*", Q.stats(Q.PHOT_L, "SELECT * FROM stats WHERE coalesce(completeness, 0) >= 0.5 AND coalesce(median_snr, 0) >= 5"))
def _(spark, d):
    return features.quality_filter(features.star_stats(L(spark, d)))


@query("variable_filter", "star_id amplitude* reduced_chi2*", Q.stats(Q.PHOT_L, "SELECT * FROM stats WHERE amplitude >= 0.01 AND reduced_chi2 >= 2"))
def _(spark, d):
    return features.variable_filter(features.star_stats(L(spark, d)))


@query("min_detections", "star_id n_detections", Q.with_p("SELECT star_id, count(*) AS n_detections FROM p WHERE quality = 0 GROUP BY star_id HAVING count(*) >= 3", Q.PHOT_L))
def _(spark, d):
    return features.min_detections(L(spark, d))


@query("stats_summary", "n_stars median_completeness* median_snr* median_amplitude* n_variable",
       Q.stats(Q.PHOT_L, "SELECT count(*) AS n_stars, median(completeness) AS median_completeness, median(median_snr) AS median_snr, median(amplitude) AS median_amplitude, CAST(count(*) FILTER (WHERE amplitude > 0.01) AS BIGINT) AS n_variable FROM stats"))
def _(spark, d):
    return features.stats_summary(features.star_stats(L(spark, d)))


@query("run_summary", "n_measurements n_stars n_epochs btjd_start* btjd_end* span_days* n_good good_fraction* completeness*",
       Q.with_p("SELECT count(*) AS n_measurements, count(DISTINCT star_id) AS n_stars, count(DISTINCT epoch) AS n_epochs, min(btjd) AS btjd_start, max(btjd) AS btjd_end, max(btjd) - min(btjd) AS span_days, CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_good, avg(CAST(quality = 0 AS INT)) AS good_fraction, count(*) / CAST(count(DISTINCT star_id) * count(DISTINCT epoch) AS DOUBLE) AS completeness FROM p"))
def _(spark, d):
    return quality.run_summary(E(spark, d))


@query("quality_counts", "epoch n_points frac_bad* frac_negative* median_error* median_flux*",
       Q.with_p("SELECT epoch, count(*) AS n_points, avg(CAST(quality <> 0 AS INT)) AS frac_bad, avg(CAST(flux < 0 AS INT)) AS frac_negative, median(flux_error) AS median_error, median(flux) AS median_flux FROM p GROUP BY epoch"))
def _(spark, d):
    """Exploratory quality by epoch."""
    return E(spark, d).groupBy("epoch").agg(
        F.count("*").alias("n_points"), F.avg((F.col("quality") != 0).cast("int")).alias("frac_bad"), F.avg((F.col("flux") < 0).cast("int")).alias("frac_negative"), F.median("flux_error").alias("median_error"), F.median("flux").alias("median_flux")
    )


@query("quality_values", "quality n", Q.with_p("SELECT quality, count(*) AS n FROM p GROUP BY quality", Q.PHOT_L))
def _(spark, d):
    return L(spark, d).groupBy("quality").agg(F.count("*").alias("n"))


@query("cadence_median", "cadence*", Q.with_p("SELECT median(gap) AS cadence FROM (SELECT t - lag(t) OVER (ORDER BY t) AS gap FROM (SELECT epoch, min(btjd) AS t FROM p GROUP BY epoch))"))
def _(spark, d):
    """Median step between the times of successive epochs."""
    from pyspark.sql.window import Window

    t = E(spark, d).groupBy("epoch").agg(F.min("btjd").alias("t"))
    return t.select((F.col("t") - F.lag("t").over(Window.orderBy("t"))).alias("gap")).agg(F.median("gap").alias("cadence"))


@query("variability_score", "star_id amplitude_score* chi2_score* stetson_score* penalty* variability_score*", Q.stats(Q.PHOT_L, f", {Q.SCORES} SELECT * FROM scored"))
def _(spark, d):
    return score.variability_scores(features.star_stats(L(spark, d)))


@query("top_candidates", "star_id amplitude_robust* outlier_fraction* variability_score*",
       Q.stats(Q.PHOT_E, f", {Q.SCORES} SELECT * FROM scored WHERE amplitude_robust >= 0.01 AND outlier_fraction <= 0.05 ORDER BY variability_score DESC, star_id LIMIT 20"))
def _(spark, d):
    """Statistics, quality, scores and the twenty best."""
    return score.variable_candidates(score.variability_scores(features.star_stats(E(spark, d))), top=20)


@query("candidate_summary", "n_stars median_amplitude* max_amplitude* max_score*",
       Q.stats(Q.PHOT_L, f", {Q.SCORES} SELECT count(*) AS n_stars, median(amplitude_robust) AS median_amplitude, max(amplitude_robust) AS max_amplitude, max(variability_score) AS max_score FROM scored"))
def _(spark, d):
    return score.candidate_summary(score.variability_scores(features.star_stats(L(spark, d))))


_SECTORED = f"SELECT *, CAST(epoch % 3 AS INTEGER) AS sector FROM ({Q.PHOT_E})"
_CVZ = f"""WITH p AS ({_SECTORED}), g AS (SELECT sector, star_id, quantile_cont(flux, 0.05) AS lo, quantile_cont(flux, 0.95) AS hi, count(*) AS n FROM p WHERE quality = 0 GROUP BY sector, star_id),
m AS (SELECT p.sector, p.star_id, median(flux) AS mid FROM p JOIN g ON p.sector = g.sector AND p.star_id = g.star_id WHERE quality = 0 AND flux > lo AND flux < hi AND n >= 10 GROUP BY p.sector, p.star_id),
c AS (SELECT p.star_id, p.row, p.sector, p.btjd, p.flux / mid AS flux, p.flux_error / mid AS flux_error, p.quality AS quality_flag FROM p JOIN m ON p.sector = m.sector AND p.star_id = m.star_id WHERE mid > 0)"""


def _sectors(spark, d):
    return E(spark, d).withColumn("sector", (F.col("epoch") % 3).cast("int"))


@query("cvz_normalize", "star_id row sector btjd* flux* flux_error* quality_flag", f"{_CVZ} SELECT * FROM c")
def _(spark, d):
    return score.cvz_normalize(_sectors(spark, d))


@query("cvz_variables", "star_id n_points median_flux* amplitude* reduced_chi2*",
       f"""{_CVZ}, v AS (SELECT *, median(flux) OVER (PARTITION BY star_id) AS mid FROM c WHERE quality_flag = 0 AND flux_error > 0),
       s AS (SELECT star_id, count(*) AS n_points, median(flux) AS median_flux, (quantile_cont(flux, 0.95) - quantile_cont(flux, 0.05)) / median(flux) AS amplitude, sum(((flux - mid) / flux_error) ** 2) / greatest(count(*) - 1, 1) AS reduced_chi2 FROM v GROUP BY star_id)
       SELECT * FROM s WHERE n_points >= 30 AND median_flux > 0 AND amplitude >= 0.01 AND reduced_chi2 >= 0.5""")  # fmt: skip
def _(spark, d):
    return score.cvz_variables(score.cvz_normalize(_sectors(spark, d)), chi2=0.5, least=30)


@query("notebook_variable_pred", "star_id amplitude* reduced_chi2* median_snr*", Q.stats(Q.PHOT_L, "SELECT * FROM stats WHERE amplitude > 0.01 AND reduced_chi2 > 1 AND median_snr > 10"))
def _(spark, d):
    return features.star_stats(L(spark, d)).where("amplitude > 0.01 and reduced_chi2 > 1 and median_snr > 10")


_STRICT = Q.cleaned(f", z AS (SELECT star_id, row, epoch, btjd, flux_cm AS flux, flux_error, 0 AS quality FROM cleaned WHERE mask_bits = 0), {Q.STATS.replace(' FROM p ', ' FROM z ')}")


@query("transit_pred", "star_id amplitude_robust* median_snr*", f"{_STRICT} SELECT * FROM stats WHERE amplitude_robust > 0.001 AND amplitude_robust < 0.03 AND median_snr > 20")
def _(spark, d):
    """Quiet, bright stars among the cleaned ones, in which a transit would show."""
    cleaned = quality.preset(quality.clean(views.phot_survey(spark, d), 70, views.star_catalog(spark, d)), "strict")
    p = cleaned.select("star_id", "row", "epoch", "btjd", F.col("flux_cm").alias("flux"), "flux_error", F.lit(0).alias("quality"))
    return features.star_stats(p).where("amplitude_robust > 0.001 and amplitude_robust < 0.03 and median_snr > 20")


@query("error_and_magnitude_bands", "star_id row flux_error* flux*",
       Q.with_p("SELECT * FROM p WHERE flux_error < (SELECT quantile_cont(flux_error, 0.99) FROM p) AND flux BETWEEN (SELECT quantile_cont(flux, 0.05) FROM p) AND (SELECT quantile_cont(flux, 0.95) FROM p)"))
def _(spark, d):
    """Rows without the worst percent of errors, inside the middle nine tenths of brightness."""
    p = E(spark, d)
    ends = p.agg(F.percentile("flux_error", F.lit(0.99)).alias("e"), F.percentile("flux", F.lit(0.05)).alias("lo"), F.percentile("flux", F.lit(0.95)).alias("hi"))
    return p.crossJoin(F.broadcast(ends)).where("flux_error < e and flux between lo and hi")


@query("sql_functions", "star_id scatter* j*", Q.stats(Q.PHOT_E, "SELECT star_id, 1.4826 * mad AS scatter, stetson_j AS j FROM stats WHERE mad IS NOT NULL"))
def _(spark, d):
    """Scatter and Stetson's J by the functions that SQL users call."""
    surface.register(spark)
    return spark.sql("SELECT star_id, robust_scatter(flux) AS scatter, stetson(btjd, flux, flux_error) AS j FROM {p} WHERE quality = 0 GROUP BY star_id", p=E(spark, d))
