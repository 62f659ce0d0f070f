"""Coverage of observations: gaps, sector quality and ranking, manifests, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import ratio
from photospark.operators.ranking import numbered

#: Qualities of a sector, best first.
LEVELS = ["excellent", "good", "fair", "poor", "bad", "unknown"]


def observation_gaps(times: DataFrame, exposure_days: float, longest_hours: float = 1.0, by: str = "sector") -> DataFrame:
    """Gaps of over 1.5 times ``longest_hours`` between successive times of a sector (rows: sector, t): start, end, hours, exposures missed, number."""
    order = Window.partitionBy(by).orderBy("t")
    gap = F.lead("t").over(order) - F.col("t")
    g = times.withColumns({"end": F.lead("t").over(order), "gap": gap}).where(F.col("gap") > 1.5 * longest_hours / 24.0)
    missed = F.floor(F.col("gap") / exposure_days).cast("int") - 1
    return g.select(by, F.row_number().over(order).alias("gap_index"), F.col("t").alias("gap_start"), F.col("end").alias("gap_end"), (F.col("gap") * 24.0).alias("gap_hours"), missed.alias("missed"))


def day_gaps(days: DataFrame, by: str = "sector") -> DataFrame:
    """Gaps between observation days of a sector (rows: sector, date; repeated days count once)."""
    d = days.select(by, "date").distinct()
    after = F.lead("date").over(Window.partitionBy(by).orderBy("date"))
    return d.select(by, F.col("date").alias("gap_start"), after.alias("gap_end"), (F.datediff(after, "date") - 1).alias("gap_days")).where("gap_days > 0")


def _level(coverage: Column, largest: Column, days: Column) -> Column:
    return (
        F.when((coverage >= 90) & (largest <= 1) & (days >= 25), "excellent").when((coverage >= 80) & (largest <= 3) & (days >= 20), "good")
        .when((coverage >= 60) & (largest <= 7) & (days >= 15), "fair").when((coverage >= 40) & (days >= 10), "poor").otherwise("bad")
    )


def sector_quality(days: DataFrame, by: str = "sector") -> DataFrame:
    """One row per sector: days observed and expected (30 at most), coverage in percent, gaps, and the level."""
    d = days.select(by, "date").distinct()
    after = F.lead("date").over(Window.partitionBy(by).orderBy("date"))
    d = d.withColumn("gap", F.greatest(F.datediff(after, "date") - 1, F.lit(0)))
    s = d.groupBy(by).agg(
        F.min("date").alias("date_start"), F.max("date").alias("date_end"), F.count("*").alias("n_days"), F.least(F.datediff(F.max("date"), F.min("date")) + 1, F.lit(30)).alias("n_expected"),
        F.count_if(F.col("gap") > 0).alias("n_gaps"), F.coalesce(F.max("gap"), F.lit(0)).alias("largest_gap"), F.coalesce(F.sum("gap"), F.lit(0)).alias("total_gap"),
    )
    s = s.withColumn("coverage", ratio(F.col("n_days").cast("double"), "n_expected") * 100)
    return s.withColumn("quality", _level(F.col("coverage"), F.col("largest_gap"), F.col("n_days")))


def _order(c: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), c)


def rank_sectors(quality: DataFrame, by: str = "sector") -> DataFrame:
    """Sectors by level, then coverage."""
    keyed = quality.withColumns({"_level": _order(F.col("quality")), "_less": -F.col("coverage")})
    return numbered(keyed, ["_level", "_less", by], name="rank").withColumn("rank", F.col("rank").cast("int") + 1).drop("_level", "_less")


def best_sector(quality: DataFrame, least: str = "good", by: str = "sector") -> DataFrame:
    """The best sector of at least a level; of equal ones the lowest number. No row if there is none."""
    ok = quality.where(_order(F.col("quality")) <= LEVELS.index(least) + 1)
    return ok.agg(F.min(F.struct(_order(F.col("quality")).alias("o"), F.col(by), "quality", "coverage")).alias("b")).where("b is not null").select(f"b.{by}", "b.quality", "b.coverage")


def manifest(files: DataFrame, days: DataFrame) -> DataFrame:
    """One row per sector from (sector, filename, mjd_obs, valid, error) and (sector, date): counts, span, completeness = valid / (valid + missing days)."""
    f = files.groupBy("sector").agg(F.count("*").alias("n_files"), F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_invalid"), F.min(F.when(F.col("valid"), F.col("mjd_obs"))).alias("mjd_start"), F.max(F.when(F.col("valid"), F.col("mjd_obs"))).alias("mjd_end"))
    missing = day_gaps(days).groupBy("sector").agg(F.sum("gap_days").alias("missing_days"))
    m = f.join(missing, "sector", "left").withColumn("missing_days", F.coalesce("missing_days", F.lit(0)))
    return m.withColumns({"span_days": F.col("mjd_end") - F.col("mjd_start"), "completeness": F.coalesce(ratio(F.col("n_valid").cast("double"), F.col("n_valid") + F.col("missing_days")), F.lit(0.0))})


def days_to_sectors(days: DataFrame, first: str, last: str) -> DataFrame:
    """For each day of a range the lowest sector that observed it, or null. The calendar is made by Spark."""
    spark = days.sparkSession
    calendar = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return calendar.join(days.groupBy("date").agg(F.min("sector").alias("sector")), "date", "left")


def file_listing(files: DataFrame) -> DataFrame:
    """Files (filename) with their place in name order, which is time order, from 0, numbered in many tasks."""
    return numbered(files, ["filename"], name="file_idx").withColumn("file_idx", F.col("file_idx").cast("int"))


def calibration_order(files: DataFrame) -> DataFrame:
    """Metadata rows (filename, valid, error, mjd_obs) with ``epoch``: the place, from 0, of the valid files in order of time, then name; rows that failed, or
    have no time, stay without one."""
    ready = F.col("valid") & F.col("mjd_obs").isNotNull() & ~F.isnan("mjd_obs")
    placed = numbered(files.where(ready), ["mjd_obs", "filename"], name="epoch").withColumn("epoch", F.col("epoch").cast("int"))
    return placed.unionByName(files.where(~F.coalesce(ready, F.lit(False))).withColumn("epoch", F.lit(None).cast("int")))


def sectors(files: DataFrame) -> DataFrame:
    """The sectors that have files, with their number."""
    return files.where("sector is not null").groupBy("sector").agg(F.count("*").alias("n_files"))


def camera_ccds(folders: DataFrame) -> DataFrame:
    """The distinct (camera, ccd) of folders named camera-ccd; other names give none."""
    parts = F.regexp_extract("folder", r"^(\d+)-(\d+)/?$", 1), F.regexp_extract("folder", r"^(\d+)-(\d+)/?$", 2)
    return folders.select(*[F.when(p != "", p).cast("int").alias(n) for n, p in zip(("camera", "ccd"), parts, strict=True)]).where("camera is not null").distinct()


def cadence_skip(listing: DataFrame, n: int) -> DataFrame:
    """Every nth file by place, from the first."""
    if not isinstance(n, int) or n < 1:
        raise ValueError("the step must be a whole number of at least 1")
    return listing.where(F.col("file_idx") % n == 0)


def unprocessed(listing: DataFrame, done: DataFrame, most: int | None = None) -> DataFrame:
    """Files that aren't done yet, on request only the first ``most``."""
    left = listing.join(done, "filename", "left_anti")
    return left.orderBy("file_idx").limit(most) if most else left


def spectral_class(teff: Column) -> Column:
    """Fixed boundaries of effective temperature in kelvin."""
    c = F.when(teff > 30000, "O")
    for limit, name in ((10000, "B"), (7500, "A"), (6000, "F"), (5200, "G"), (3700, "K")):
        c = c.when(teff > limit, name)
    return c.when(teff.isNotNull(), "M")


def archive_urls(files: DataFrame, base: str) -> DataFrame:
    """Address of each file (sector, camera, ccd, filename) below an archive's root."""
    return files.withColumn("url", F.format_string(base.rstrip("/") + "/s%04d/%d-%d/%s", "sector", "camera", "ccd", "filename"))


def fixed_sample(df: DataFrame, n: int, key: str = "star_id", seed: str = "42") -> DataFrame:
    """The n rows whose hashed key comes first: the same ones every time (a report, not a filter)."""
    return df.orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), key).limit(n)


def review_list(candidates: DataFrame, address: str) -> DataFrame:
    """Candidates with the page of a viewer for their position."""
    return candidates.withColumn("review_url", F.format_string(address + "?coord=%.5f,%.5f", "ra", "dec"))
