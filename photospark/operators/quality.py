"""Quality control and cleaning: epochs, stars, common mode, bit masks, presets. Input rows: star_id, epoch, btjd, flux, flux_error, quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark import schema as S
from photospark.functions.stats import finite, holds, pct, ratio
from photospark.operators.ranking import any_group_over, medians, percentiles
from photospark.sources.io import stage

P = S.CleanParams()


def artifact_windows(spark: SparkSession, sector: int) -> DataFrame:
    """The sector's windows (a fixed, small table)."""
    return spark.createDataFrame([w for w in S.ARTIFACT_WINDOWS if w[0] == sector], "sector int, first double, last double, description string")


def good_data(phot: DataFrame, exclude_artifacts: bool = False, sector: int | None = None) -> DataFrame:
    """Rows of quality 0, on request without those in an artifact window of the sector, which then must be given."""
    good = phot.where("quality = 0")
    if not exclude_artifacts:
        return good
    if sector is None:
        raise ValueError("the artifact windows are those of a sector")
    return without_artifacts(good, sector)


def without_artifacts(phot: DataFrame, sector: int) -> DataFrame:
    """Rows outside the sector's windows, both ends of which are inside."""
    w = F.broadcast(artifact_windows(phot.sparkSession, sector))
    return phot.join(w, phot.btjd.between(w["first"], w["last"]), "left_anti")


#: Rows of a group beyond which its medians come from counts, not from one buffer.
LARGE = 4_000_000
#: Rows of an epoch or star table up to which it is broadcast.
SMALL = 200_000


def small(df: DataFrame) -> DataFrame:
    """A staged table, broadcast if its count says that it is small."""
    return F.broadcast(df) if df.count() <= SMALL else df


def epoch_qc(phot: DataFrame, params: S.CleanParams = P, large: bool | None = None) -> DataFrame:
    """One row per epoch with its verdict (and btjd_last, the epoch's last time).

    One scan and one shuffle by epoch, written to the shared folder; what follows works on that table of one row per epoch. Where an epoch has over LARGE rows
    (``large``; found out by a count if not told), medians come from counts in many tasks instead of one group's buffer; the rows are the same."""
    good = F.when(F.col("quality") == 0, finite("flux"))
    phot = phot.select("epoch", "btjd", "quality", finite("flux").alias("flux"), finite("flux_error").alias("flux_error"), good.alias("good"))
    sums = [
        F.min("btjd").alias("btjd"), F.max("btjd").alias("btjd_last"), F.avg("flux").alias("mean_flux"), F.stddev_samp("flux").alias("std_flux"), F.count_if(F.col("quality") == 0).alias("n_valid"), F.count("*").alias("n_total"),
    ]
    if any_group_over(phot, ["epoch"], LARGE) if large is None else large:
        mids = stage(percentiles(phot, ["epoch"], {"median_flux": (F.col("flux"), 0.5), "median_error": (F.col("flux_error"), 0.5), "median_flux_good": (F.col("good"), 0.5)}), "medians")
        keyed = phot.join(small(mids.select(F.col("epoch").alias("e"), "median_flux_good")), F.col("epoch").eqNullSafe(F.col("e")))
        off = percentiles(keyed, ["epoch"], {"mad_flux": (F.abs(F.col("good") - F.col("median_flux_good")), 0.5)})
        e = phot.groupBy("epoch").agg(*sums)
        for other in (mids, off):
            e = e.join(other.withColumnRenamed("epoch", "e"), F.col("epoch").eqNullSafe(F.col("e")), "left").drop("e")
    else:
        phot = phot.withColumn("off", F.abs(F.col("good") - F.median("good").over(Window.partitionBy("epoch"))))
        e = phot.groupBy("epoch").agg(*sums, F.median("flux").alias("median_flux"), F.median("flux_error").alias("median_error"), F.median("good").alias("median_flux_good"), F.median("off").alias("mad_flux"))
    e = stage(e, "epochs")
    e = e.withColumn("frac_good", ratio("n_valid", "n_total")).withColumn("time_gap", F.col("btjd") - F.lag("btjd").over(Window.orderBy("btjd", "epoch")))  # a row per epoch
    e = e.withColumn("is_after_gap", holds(F.col("time_gap") > params.gap_hours / 24.0))
    overall = e.agg(F.median("median_flux_good").alias("m"), F.median("mad_flux").alias("s"))
    e = e.crossJoin(F.broadcast(overall)).withColumn("median_flux_norm", ratio("median_flux_good", "m")).withColumn("scatter_norm", ratio("mad_flux", "s")).drop("m", "s")
    spread = e.agg(F.coalesce(F.median(F.abs(F.col("scatter_norm") - 1)), F.lit(1.0)).alias("u"), F.coalesce(F.median(F.abs(F.col("median_flux_norm") - 1)), F.lit(1.0)).alias("v"))
    e = e.crossJoin(F.broadcast(spread))  # a single row
    none = F.col("n_valid") == 0
    scatter = F.coalesce(F.col("scatter_norm") > 1 + params.bad_epoch_scatter_sigma * F.col("u"), F.lit(True))
    shifted = F.coalesce(F.abs(F.col("median_flux_norm") - 1) > params.bad_epoch_median_sigma * F.col("v"), F.lit(True))
    low = F.col("frac_good") < params.least_frac_good
    named = {"no_data": none, "high_scatter": scatter & ~none, "shifted_median": shifted & ~none, "low_valid": low & ~none, "after_momentum_dump": F.col("is_after_gap")}
    return e.withColumns({"is_bad": none | scatter | shifted | low | F.col("is_after_gap"), "reason": F.concat_ws("|", *[F.when(c, n) for n, c in named.items()])}).drop("u", "v")


def star_qc(phot: DataFrame, catalog: DataFrame | None = None, params: S.CleanParams = P, epochs: DataFrame | None = None) -> DataFrame:
    """One row per star (and median_flux_good). catalog (star_id, tic_id, ra, dec, ref_x, ref_y) adds its columns and the edge flag (false where unknown);
    ``epochs``, a table of one row per epoch, saves counting them. A star's rows are as many as its epochs, so they fit a buffer."""
    epochs = phot.agg(F.count_distinct("epoch").alias("n_epochs")) if epochs is None else epochs.agg(F.count("epoch").alias("n_epochs"))
    good = F.when(F.col("quality") == 0, finite("flux"))
    p = phot.select("star_id", "epoch", "quality", finite("flux").alias("flux"), finite("flux_error").alias("flux_error"), good.alias("good"))
    p = p.withColumn("off", F.abs(F.col("good") - F.median("good").over(Window.partitionBy("star_id"))))
    s = p.groupBy("star_id").agg(
        F.count("epoch").alias("n_total"), F.count_if(F.col("quality") == 0).alias("n_valid"), F.median("flux").alias("median_flux"), F.avg("flux").alias("mean_flux"), F.stddev_samp("flux").alias("std_flux"),
        F.median("flux_error").alias("median_error"), F.median("off").alias("robust_scatter_mad"), F.median("good").alias("median_flux_good"),
    )
    s = s.crossJoin(F.broadcast(epochs)).withColumns({"completeness": ratio("n_valid", "n_epochs"), "snr": ratio("median_flux", "median_error")}).drop("n_epochs")
    if catalog is None:
        return s.withColumn("is_edge_star", F.lit(False))
    inner, outer = F.lit(params.edge_pixels), F.lit(params.frame_pixels - params.edge_pixels)
    edge = holds((F.col("ref_x") < inner) | (F.col("ref_x") > outer) | (F.col("ref_y") < inner) | (F.col("ref_y") > outer))
    return s.join(catalog.select("star_id", "tic_id", "ra", "dec", "ref_x", "ref_y"), "star_id", "left").withColumn("is_edge_star", edge)


def quiet_stars(star_table: DataFrame, params: S.CleanParams = P) -> DataFrame:
    """star_table with is_quiet_star: complete, of low scatter, off the edge, of positive median. The percentile over all stars comes from counts where they are
    over LARGE."""
    mad = F.col("robust_scatter_mad")
    if any_group_over(star_table, [], LARGE):
        limit = percentiles(star_table, [], {"limit": (mad, params.quiet_mad_percentile)})
    else:
        limit = star_table.agg(pct(mad, params.quiet_mad_percentile).alias("limit"))
    quiet = holds((F.col("completeness") >= params.quiet_completeness) & (mad <= F.col("limit")) & ~F.col("is_edge_star") & (F.col("median_flux") > 0))
    return star_table.crossJoin(F.broadcast(limit)).withColumn("is_quiet_star", quiet).drop("limit")


def common_mode(phot: DataFrame, star_table: DataFrame, epochs: DataFrame | None = None, large: bool = False) -> DataFrame:
    """(epoch, cm): median over the quiet stars (over all, if none is quiet) of flux over the star's median, good rows; 1 where there is none. One scan: the
    star's median comes with its row of the star table. ``epochs``, a table of one row per epoch, saves finding them; ``large``: epochs beyond one buffer."""
    flagged = star_table.crossJoin(F.broadcast(star_table.agg(F.count_if("is_quiet_star").alias("n_quiet")))).where("is_quiet_star or n_quiet = 0").select("star_id", F.col("median_flux_good").alias("mid"))
    good = phot.where("quality = 0").select("star_id", "epoch", finite("flux").alias("flux"))
    cm = medians(good.join(flagged, "star_id"), ["epoch"], {"cm": ratio("flux", "mid")}, large)
    named = (phot if epochs is None else epochs).select("epoch").distinct()
    return named.join(cm, "epoch", "left").select("epoch", F.coalesce("cm", F.lit(1.0)).alias("cm"))


def create_masks(phot: DataFrame, epochs: DataFrame, cm: DataFrame, sector: int, params: S.CleanParams = P) -> DataFrame:
    """phot with flux_cm, mask_bits and mask_reason. epochs: (epoch, is_bad), on request with btjd and btjd_last, else the ends of time are looked up; cm: (epoch,
    cm). The two become one table that is written and, if its count says so, broadcast: few epochs would make a skewed join. One shuffle by star."""
    known = {"btjd", "btjd_last"} <= set(epochs.columns)
    both = stage(epochs.select("epoch", "is_bad", *(["btjd", "btjd_last"] if known else [])).join(cm, "epoch", "left"), "verdicts")
    df = phot.join(small(both.select("epoch", "is_bad", "cm")), "epoch", "left")
    flux, error = finite("flux"), finite("flux_error")
    df = df.withColumn("flux_cm", ratio(flux, F.coalesce("cm", F.lit(1.0))))
    bad, invalid = holds(F.col("quality") != 0), flux.isNull() | error.isNull() | (error <= 0)
    star = Window.partitionBy("star_id")
    df = df.withColumn("ok", F.when(~bad & ~invalid, F.col("flux_cm"))).withColumns({"mid": F.median("ok").over(star), "n_ok": F.count("ok").over(star)})
    df = df.withColumn("mad", F.median(F.abs(F.col("ok") - F.col("mid"))).over(star))
    off = F.when((F.col("n_ok") >= params.outlier_points) & (F.col("mad") > 0), (F.col("ok") - F.col("mid")) / (F.col("mad") * S.MAD_TO_SIGMA))
    ends = (both.agg(F.min("btjd").alias("t0"), F.max("btjd_last").alias("t1")) if known else phot.agg(F.min("btjd").alias("t0"), F.max("btjd").alias("t1")))
    w = artifact_windows(phot.sparkSession, sector)
    df = df.crossJoin(F.broadcast(ends)).join(F.broadcast(w), F.col("btjd").between(w["first"], w["last"]), "left")
    edge = (F.col("btjd") < F.col("t0") + params.edge_days) | (F.col("btjd") > F.col("t1") - params.edge_days)
    snr = F.when(error == 0, flux < 0).otherwise(ratio(flux, error) < params.snr_threshold)
    found = {
        "quality": bad, "invalid": invalid, "bad_epoch": F.col("is_bad"), "outlier_pos": off > params.outlier_sigma_pos, "outlier_neg": off < -params.outlier_sigma_neg, "edge": edge,
        "artifact": F.col("description").isNotNull(), "low_snr": snr,
    }
    bits = F.lit(0)
    for name, c in found.items():
        bits = bits.bitwiseOR(F.when(holds(c), S.BITS[name]).otherwise(0))
    reason = F.concat_ws("|", *[F.when(holds(c), F.concat(F.lit("artifact:"), "description") if name == "artifact" else F.lit(name)) for name, c in found.items()])
    return df.select(*phot.columns, "flux_cm", bits.cast("int").alias("mask_bits"), reason.alias("mask_reason"))


@dataclass(frozen=True)
class Cleaned:
    """What cleaning makes: the rows with masks, and the tables of epochs, stars (with is_quiet_star) and common mode, written to the shared folder."""

    rows: DataFrame
    epochs: DataFrame
    stars: DataFrame
    common_mode: DataFrame


def clean_tables(phot: DataFrame, sector: int, catalog: DataFrame | None = None, params: S.CleanParams = P) -> Cleaned:
    """The whole of cleaning: masks from epoch quality, star quality, quiet stars and common mode. Four scans of the photometry: one for each of the three
    tables, and that of the rows; later steps read the tables."""
    large = any_group_over(phot, ["epoch"], LARGE)
    epochs = epoch_qc(phot, params, large)
    stars = stage(quiet_stars(stage(star_qc(phot, catalog, params, epochs), "stars"), params), "stars")
    cm = common_mode(phot, stars, epochs, large)
    return Cleaned(create_masks(phot, epochs, cm, sector, params), epochs, stars, cm)


def clean(phot: DataFrame, sector: int, catalog: DataFrame | None = None, params: S.CleanParams = P) -> DataFrame:
    """The rows of ``clean_tables``."""
    return clean_tables(phot, sector, catalog, params).rows


def preset(cleaned: DataFrame, name: str) -> DataFrame:
    return cleaned.where(F.col("mask_bits").bitwiseAND(S.PRESETS[name]) == 0)


def mask_summary(cleaned: DataFrame) -> DataFrame:
    """Rows with each bit, with any, and in all: one row (bit, n) each."""
    sums = cleaned.agg(F.count("*").alias("total"), F.count_if(F.col("mask_bits") > 0).alias("any"), *[F.count_if(F.col("mask_bits").bitwiseAND(b) > 0).alias(n) for n, b in S.BITS.items()])
    return sums.unpivot([], ["total", "any", *S.BITS], "bit", "n")


def mask_to_quality(cleaned: DataFrame, for_transit: bool = False, use_flux_cm: bool = True) -> DataFrame:
    """Lightcurve rows: flux, and quality_flag 1 where a mask bit counts (for transits only quality, invalid and bad epoch). A table without flux_error, or a
    star none of whose errors is finite, gets one value a star: 1.4826 times the median deviation of the good fluxes, if over ten of them, else
    one percent of the median of all."""
    bits = F.col("mask_bits").bitwiseAND(S.TRANSIT_BITS) if for_transit else F.col("mask_bits")
    out = cleaned.withColumns({"flux": F.col("flux_cm" if use_flux_cm else "flux"), "quality_flag": (bits != 0).cast("int"), "flux_error": F.col("flux_error") if "flux_error" in cleaned.columns else F.lit(None).cast("double")})
    star = Window.partitionBy("star_id")
    good = F.when(F.col("quality_flag") == 0, finite("flux"))
    out = out.withColumn("_good", good).withColumns({"_known": F.count(finite("flux_error")).over(star), "_n": F.count("_good").over(star), "_mid": F.median("_good").over(star), "_all": F.median(finite("flux")).over(star)})
    out = out.withColumn("_mad", F.median(F.abs(F.col("_good") - F.col("_mid"))).over(star))
    fallback = F.when(F.col("_n") > 10, S.MAD_TO_SIGMA * F.col("_mad")).otherwise(F.col("_all") * 0.01)
    error = F.when(F.col("_known") == 0, fallback).otherwise(F.col("flux_error"))
    return out.select("star_id", "row", "epoch", "btjd", "flux", error.alias("flux_error"), "quality_flag")


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    masked = F.count_if(F.col("mask_bits") > 0)
    return cleaned.agg(F.count("*").alias("n_points"), F.count_distinct("star_id").alias("n_stars"), F.count_distinct("epoch").alias("n_epochs"), F.min("btjd").alias("btjd_min"), F.max("btjd").alias("btjd_max"), masked.alias("n_masked"), ratio(masked, F.count("*")).alias("frac_masked"))


def run_summary(phot: DataFrame) -> DataFrame:
    """Counts, span and completeness of a run; 0 where there is nothing."""
    good = F.count_if(F.col("quality") == 0)
    return phot.agg(
        F.count("*").alias("n_measurements"), F.count_distinct("star_id").alias("n_stars"), F.count_distinct("epoch").alias("n_epochs"), F.min("btjd").alias("btjd_start"), F.max("btjd").alias("btjd_end"),
        (F.max("btjd") - F.min("btjd")).alias("span_days"), good.alias("n_good"), F.coalesce(ratio(good, F.count("*")), F.lit(0.0)).alias("good_fraction"),
        F.coalesce(ratio(F.count("*"), F.count_distinct("star_id") * F.count_distinct("epoch")), F.lit(0.0)).alias("completeness"),
    )
