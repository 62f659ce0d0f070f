"""Per-star statistics and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark import schema as S
from photospark.functions.stats import finite, kurtosis_corrected, pct, ratio, robust_amplitude, skew_corrected


def star_stats(phot: DataFrame) -> DataFrame:
    """Lightcurve statistics over good rows, in one shuffle by star: about the mean with population deviation; null where a star has no good row."""
    star, good = Window.partitionBy("star_id"), F.col("quality") == 0
    df = phot.select("star_id", "row", "btjd", "quality", F.when(good, finite("flux")).alias("f"), F.when(good, finite("flux_error")).alias("e"), F.when(good, F.col("btjd")).alias("t"))
    df = df.withColumns({"mean": F.avg("f").over(star), "mid": F.median("f").over(star), "std": F.stddev_pop("f").over(star)})
    df = df.withColumns({"r": ratio(F.col("f") - F.col("mean"), "e"), "far": F.abs(F.col("f") - F.col("mean")) > 3 * F.col("std")})
    df = df.withColumn("pair", F.col("r") * F.lead("r").over(Window.partitionBy("star_id", "quality").orderBy("btjd", "row")))
    n, chi2 = F.count("f"), F.sum(F.col("r") * F.col("r"))
    n_d, far = n.cast("double"), F.count_if("far")
    s = df.groupBy("star_id").agg(
        F.count("*").alias("n_total"), F.count_if(F.col("quality") == 0).alias("n_good"), ratio(F.count_if(F.col("quality") == 0), F.count("*")).alias("completeness"), F.avg("f").alias("mean_flux"), F.median("f").alias("median_flux"),
        F.stddev_pop("f").alias("std_flux"), F.min("f").alias("min_flux"), F.max("f").alias("max_flux"), F.when(F.median("f") == 0, 0.0).otherwise(ratio(F.max("f") - F.min("f"), F.median("f"))).alias("amplitude"),
        F.median("e").alias("median_error"), F.median(ratio("f", "e")).alias("median_snr"), F.min("t").alias("btjd_start"), F.max("t").alias("btjd_end"), (F.max("t") - F.min("t")).alias("time_span_days"),
        F.median(F.abs(F.col("f") - F.col("mid"))).alias("mad"), robust_amplitude("f").alias("amplitude_robust"), (pct("f", 0.75) - pct("f", 0.25)).alias("iqr"),
        F.when(n > 0, far).alias("n_outliers"), ratio(far, n).alias("outlier_fraction"), F.when(n > 1, chi2 / (n_d - 1)).when(n == 1, 0.0).alias("reduced_chi2"),
        F.when(n > 2, F.coalesce(F.sum(F.sign("pair") * F.sqrt(F.abs("pair"))), F.lit(0.0)) * F.sqrt(n_d / (n_d - 1))).alias("stetson_j"),
    )
    return s


def quality_filter(stats: DataFrame, completeness: float = 0.5, snr: float = 5.0) -> DataFrame:
    return stats.where((F.coalesce("completeness", F.lit(0.0)) >= completeness) & (F.coalesce("median_snr", F.lit(0.0)) >= snr))


def variable_filter(stats: DataFrame, amplitude: float = 0.01, chi2: float = 2.0) -> DataFrame:
    return stats.where((F.coalesce("amplitude", F.lit(0.0)) >= amplitude) & (F.coalesce("reduced_chi2", F.lit(0.0)) >= chi2))


def min_detections(phot: DataFrame, least: int = 3) -> DataFrame:
    return phot.groupBy("star_id").agg(F.count_if(F.col("quality") == 0).alias("n_detections")).where(F.col("n_detections") >= least)


def stats_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count("*").alias("n_stars"), F.median("completeness").alias("median_completeness"), F.median("median_snr").alias("median_snr"), F.median("amplitude").alias("median_amplitude"),
        F.count_if(F.col("amplitude") > 0.01).alias("n_variable"),
    )


def stat_features(phot: DataFrame, least: int = 3) -> DataFrame:
    """Features over good rows in time order: biased moments, about the mean with its deviation; weighted ones only if every error is positive."""
    star = Window.partitionBy("star_id")
    g = phot.where("quality = 0").select("star_id", "row", "btjd", finite("flux").alias("f"), finite("flux_error").alias("e")).where("f is not null")
    order = star.orderBy("btjd", "row")
    g = g.withColumns({"before": F.lag("f").over(order), "mean": F.avg("f").over(star), "mid": F.median("f").over(star), "std": F.stddev_pop("f").over(star)})
    z, n, d = F.abs(F.col("f") - F.col("mean")), F.count("f"), F.abs(F.col("f") - F.col("before"))
    w = F.when(F.col("e") > 0, 1 / (F.col("e") * F.col("e")))
    g = g.withColumn("wmean", F.sum(F.col("f") * w).over(star) / F.sum(w).over(star))
    all_positive = F.count_if(F.coalesce(F.col("e") <= 0, F.lit(True))) == 0
    s = g.groupBy("star_id").agg(
        n.alias("n_points"), F.avg("f").alias("mean"), F.median("f").alias("median"), F.stddev_pop("f").alias("std"), F.skewness("f").alias("skewness"), F.kurtosis("f").alias("kurtosis"),
        F.median(F.abs(F.col("f") - F.col("mid"))).alias("mad"), (pct("f", 0.75) - pct("f", 0.25)).alias("iqr"), *[pct("f", p / 100).alias(f"p{p}") for p in (5, 10, 25, 75, 90, 95)],
        (F.max("f") - F.min("f")).alias("range"), ratio(F.max("f") - F.min("f"), F.median("f")).alias("amplitude"), F.sqrt(F.avg(F.col("f") * F.col("f"))).alias("rms"), ratio(F.stddev_pop("f"), F.avg("f")).alias("cv"),
        *[ratio(F.count_if(z > k * F.col("std")), n).alias(f"beyond_{k}std") for k in (1, 2, 3)],
        F.when(all_positive, F.sum(F.col("f") * w) / F.sum(w)).alias("weighted_mean"),
        F.when(all_positive, F.sqrt(F.sum((F.col("f") - F.col("wmean")) * (F.col("f") - F.col("wmean")) * w) / F.sum(w))).alias("weighted_std"), (F.max("btjd") - F.min("btjd")).alias("time_span"),
        F.avg(d).alias("mean_abs_diff"), F.max(d).alias("max_abs_diff"), F.corr("f", "before").alias("autocorr"),
    )
    return s.where(F.col("n_points") >= least)


def ml_features(cleaned: DataFrame, star_table: DataFrame, mode: str, epochs: DataFrame | None = None, least: int = 10) -> DataFrame:
    """Features of cleaned flux for a mode (its mask and completeness), with tic_id if star_table has it: sample deviation, corrected moments, deviations about the
    median by MAD. ``epochs``, a table of one row per epoch, saves counting them."""
    mask, complete = S.ML_MASKS[mode]
    epochs = cleaned.agg(F.count_distinct("epoch").alias("n_epochs")) if epochs is None else epochs.agg(F.count("epoch").alias("n_epochs"))
    tic_id = F.col("tic_id") if "tic_id" in star_table.columns else F.lit(None).cast("string").alias("tic_id")
    kept = star_table.where(F.col("completeness") >= complete).select("star_id", tic_id)
    df = cleaned.where(F.col("mask_bits").bitwiseAND(mask) == 0).select("star_id", "flux_cm", "flux_error").join(kept, "star_id").select("star_id", "tic_id", F.col("flux_cm").alias("f"), F.col("flux_error").alias("e"))
    star = Window.partitionBy("star_id")
    df = df.withColumn("mid", F.median("f").over(star)).withColumn("mad", F.median(F.abs(F.col("f") - F.col("mid"))).over(star))
    far, n, m = F.abs(F.col("f") - F.col("mid")), F.count("f"), F.median("f")
    r = ratio(F.col("f") - F.col("mid"), "e")
    beyond = lambda k: ratio(F.count_if((F.col("mad") > 0) & (far > k * S.MAD_TO_SIGMA * F.col("mad"))), n)
    s = df.groupBy("star_id").agg(
        F.max("tic_id").alias("tic_id"), n.alias("n_points"), F.avg("f").alias("mean_flux"), m.alias("median_flux"), F.stddev_samp("f").alias("std_flux"), F.max("mad").alias("mad_flux"), ratio(F.max("f") - F.min("f"), m).alias("amplitude"),
        ratio(pct("f", 0.95) - pct("f", 0.05), m).alias("amplitude_robust"), F.when(n > 1, F.sum(r * r) / (n.cast("double") - 1)).alias("reduced_chi2"), skew_corrected("f").alias("skewness"), kurtosis_corrected("f").alias("kurtosis"),
        beyond(2).alias("beyond_2sigma"), beyond(3).alias("beyond_3sigma"), F.median("e").alias("median_error"), ratio(m, F.median("e")).alias("snr"),
    )
    return s.where(F.col("n_points") >= least).crossJoin(F.broadcast(epochs)).withColumn("completeness", ratio("n_points", "n_epochs")).drop("n_epochs")
