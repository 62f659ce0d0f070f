"""Variability scores, candidates, and normalised multi-sector variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite, holds, pct, ratio, robust_amplitude

#: Weights of the components.
WEIGHTS = {"amplitude": 0.35, "chi2": 0.25, "stetson": 0.20, "period": 0.20}


def variability_scores(stats: DataFrame) -> DataFrame:
    """stats with component scores, scaled over all stars (0.5 if constant), weighted, less a penalty for outliers. The only exchange is one row of
    minima and maxima."""
    at = lambda c, d: F.coalesce(F.col(c) if c in stats.columns else F.lit(None).cast("double"), F.lit(d))
    df = stats.withColumns({
        "amplitude_score": F.log10(F.greatest(at("amplitude_robust", 0.0), F.lit(1e-5))) + 5, "chi2_score": F.log10(F.greatest(at("reduced_chi2", 0.0), F.lit(0.01))), "stetson_score": F.abs(at("stetson_j", 0.0)),
        "period_score": at("power_ratio", 0.0), "penalty": 1 - 10 * F.least(at("outlier_fraction", 0.0), F.lit(0.1)),
    })
    parts = [f"{c}_score" for c in WEIGHTS]
    ends = df.agg(*[F.min(c).alias(f"{c}_lo") for c in parts], *[F.max(c).alias(f"{c}_hi") for c in parts])
    df = df.crossJoin(F.broadcast(ends))
    scaled = {c: F.when(F.col(f"{c}_hi") > F.col(f"{c}_lo"), (F.col(c) - F.col(f"{c}_lo")) / (F.col(f"{c}_hi") - F.col(f"{c}_lo"))).otherwise(0.5) for c in parts}
    total = sum((w * scaled[f"{c}_score"] for c, w in WEIGHTS.items()), F.lit(0.0))
    return df.withColumn("variability_score", total * F.col("penalty")).drop(*[f"{c}_{x}" for c in parts for x in ("lo", "hi")])


def variable_candidates(scored: DataFrame, amplitude: float = 0.01, outliers: float = 0.05, chi2: float | None = None, score: float | None = None, top: int | None = None) -> DataFrame:
    keep = holds(F.col("amplitude_robust") >= amplitude) & holds(F.col("outlier_fraction") <= outliers)
    if chi2 is not None:
        keep &= holds(F.col("reduced_chi2") >= chi2)
    if score is not None:
        keep &= holds(F.col("variability_score") >= score)
    found = scored.where(keep).orderBy(F.desc("variability_score"), "star_id")
    return found.limit(top) if top else found


def candidate_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n_stars"), F.median("amplitude_robust").alias("median_amplitude"), F.max("amplitude_robust").alias("max_amplitude"), F.max("variability_score").alias("max_score"))


def cvz_normalize(phot: DataFrame, least: int = 10) -> DataFrame:
    """All rows of a (sector, star) over the median of its good flux strictly between p5 and p95; groups with fewer good rows or no positive median go."""
    group = Window.partitionBy("sector", "star_id")
    df = phot.withColumn("g", F.when(F.col("quality") == 0, finite("flux")))
    df = df.withColumns({"lo": pct("g", 0.05).over(group), "hi": pct("g", 0.95).over(group), "n": F.count("g").over(group)})
    df = df.withColumn("mid", F.median(F.when((F.col("g") > F.col("lo")) & (F.col("g") < F.col("hi")), F.col("g"))).over(group))
    return df.where((F.col("n") >= least) & (F.col("mid") > 0)).select("star_id", "row", "sector", "btjd", (F.col("flux") / F.col("mid")).alias("flux"), (F.col("flux_error") / F.col("mid")).alias("flux_error"), F.col("quality").alias("quality_flag"))


def cvz_variables(phot: DataFrame, amplitude: float = 0.01, chi2: float = 2.0, least: int = 100) -> DataFrame:
    """Variable stars of a combined table: finite rows of positive error, reduced chi-square about the median."""
    df = phot.where("quality_flag = 0").select("star_id", finite("flux").alias("f"), finite("flux_error").alias("e")).where("f is not null and e > 0")
    df = df.withColumn("mid", F.median("f").over(Window.partitionBy("star_id")))
    r, n = (F.col("f") - F.col("mid")) / F.col("e"), F.count("*")
    s = df.groupBy("star_id").agg(n.alias("n_points"), F.median("f").alias("median_flux"), robust_amplitude("f").alias("amplitude"), (F.sum(r * r) / F.greatest(n - 1, F.lit(1))).alias("reduced_chi2"))
    return s.where((F.col("n_points") >= least) & (F.col("median_flux") > 0) & (F.col("amplitude") >= amplitude) & (F.col("reduced_chi2") >= chi2)).orderBy(F.desc("amplitude"), "star_id")
