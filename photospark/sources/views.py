"""Photometry and sky views over general tables (events, lineitem, customer, embeddings)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from photospark.operators.wcs import tangent_wcs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def phot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour epochs from events; row is a tie-break."""
    us = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("star_id"), F.col("event_id").alias("row"), F.floor(us / F.lit(21600000000.0)).cast("int").alias("epoch"), (F.lit(3208.0) + us / F.lit(86400000000.0)).alias("btjd"),
        (F.col("value") + 1.0).alias("flux"), (F.lit(0.5) + F.lit(0.01) * (F.col("event_id") % 50)).alias("flux_error"),
        F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2).otherwise(0).alias("quality"),
    )


#: Epochs of phot_survey at any size of the table.
EPOCHS = 200


def survey_stars(spark: SparkSession, sf_dir: str) -> int:
    """Stars of phot_survey: they grow with the table, its epochs don't."""
    return max(1, table(spark, sf_dir, "events").count() // EPOCHS)


def phot_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stars at 200 epochs (a last one may be cut short), from events by number: two hours apart with a gap after each 40, incomplete stars, shifted, noisy and
    lost epochs, outliers on both sides, low signals, and rows with null, NaN and zero fluxes or errors. For quality control and cleaning."""
    n, star, epoch = F.col("event_id"), F.col("star_id"), F.col("epoch")
    stars = survey_stars(spark, sf_dir)
    rows = table(spark, sf_dir, "events").select("event_id", (n % stars).alias("star_id"), F.expr(f"event_id div {stars}").cast("int").alias("epoch"), "event_type", (F.col("value") - F.floor("value")).alias("part"))
    base = F.lit(100.0) + 10 * (star % 7)
    shape = F.when(epoch % 31 == 11, 0.4).otherwise(0.02) * (F.col("part") - 0.5) + F.when(star % 9 == 4, F.lit(0.1) * (epoch % 36 - 18) / F.lit(18.0)).otherwise(0.0)
    lift = F.when(n % 499 == 3, 1.5).when(n % 701 == 11, 0.3).when(epoch % 29 == 7, 1.2).otherwise(1.0)
    error = F.when(n % 307 == 7, 0.0).when(n % 401 == 9, float("nan")).when(star % 11 == 3, base * 0.5).otherwise(base * 0.005)
    odd_type = F.col("event_type").isin("error", "signup")
    quality = F.when(n % 37 == 0, 1).when(n % 53 == 0, 2).when((epoch % 43 == 13) & (star % 5 < 3), 4).when((star % 10 == 6) & odd_type, 1).when((star % 10 == 9) & (epoch % 4 < 3), 1).otherwise(0)
    btjd = F.lit(3208.0) + epoch / F.lit(12.0) + F.floor(epoch / F.lit(40.0)) * F.lit(0.5)
    return rows.select("star_id", n.alias("row"), "epoch", btjd.alias("btjd"), F.when(n % 211 != 5, base * (F.lit(1.0) + shape) * lift).alias("flux"), error.alias("flux_error"), quality.alias("quality"))


def star_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of phot_survey's stars; some near the edge of the frame, some without tic_id."""
    k = F.col("star_id")
    stars = spark.range(survey_stars(spark, sf_dir)).select(F.col("id").alias("star_id"))
    return stars.select(
        "star_id", F.when(k % 3 != 0, F.concat(F.lit("T"), k.cast("string"))).alias("tic_id"), (k * 7.0).alias("ra"), (k - 25.0).alias("dec"), (k * 397 % 2048).cast("double").alias("ref_x"), (k * 911 % 2048).cast("double").alias("ref_y")
    )


def phot_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly epochs from lineitem, 30 points a star."""
    day = F.datediff("l_shipdate", F.lit("1995-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("star_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("int").alias("epoch"),
        (day + F.col("l_linenumber") / F.lit(8.0)).alias("btjd"), (F.col("l_extendedprice") / 1000.0).alias("flux"), (F.lit(0.1) + F.col("l_quantity") / 100.0).alias("flux_error"),
        F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("quality"),
    )


def sky(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Stars from customers spread over the sphere; the second view is moved by about 1.8 arcsec and lacks every fifth star."""
    k = F.col("c_custkey")
    frac = lambda v: v - F.floor(v)
    ra, dec = 360.0 * frac(k * F.lit(0.6180339887498949)), F.degrees(F.asin(2.0 * frac(k * F.lit(0.7548776662466927)) - 1.0))
    rows = table(spark, sf_dir, "customer")
    if not second:
        return rows.select(k.alias("star_id"), ra.alias("ra"), dec.alias("dec"))
    return rows.where(k % 5 != 0).select(k.alias("star_id"), (ra + 0.0005 * F.sin(k)).alias("ra"), (dec + 0.0005 * F.cos(k)).alias("dec"))


def features(spark: SparkSession, sf_dir: str, n: int = 8) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("star_id"), *[F.element_at("embedding", i + 1).cast("double").alias(f"f{i + 1}") for i in range(n)])


#: Frames of events: width, height, and degrees a pixel of their fields.
FRAME_WIDTH, FRAME_HEIGHT, PIXEL = 50, 40, 21.0 / 3600


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels (image, x, y, value) from events by number: frames of 50 by 40, a bright spot in each, noise from the values, and some pixels null or NaN."""
    n = F.col("event_id")
    x, y = n % FRAME_WIDTH, F.expr(f"event_id div {FRAME_WIDTH}") % FRAME_HEIGHT
    image = F.expr(f"event_id div {FRAME_WIDTH * FRAME_HEIGHT}")
    spot = F.when((x - 20) * (x - 20) + (y - 24) * (y - 24) <= 4, 100.0 + image).otherwise(0.0)
    value = F.when(n % 1499 == 7, float("nan")).when(n % 997 != 5, F.lit(10.0) + F.col("value") * F.lit(0.1) + spot)
    return table(spark, sf_dir, "events").select(image.cast("int").alias("image"), x.cast("double").alias("x"), y.cast("double").alias("y"), value.alias("value"))


def frame_wcs(image: Column, x: float, y: float, a: list[float], b: list[float]) -> Column:
    """The WCS of a frame, which drifts from frame to frame; every seventh has none."""
    return F.when(image % 7 != 3, tangent_wcs(F.lit(120.0) + image * F.lit(0.001), F.lit(30.0) - image * F.lit(0.0005), x, y, PIXEL, a, b))


def field_stars(spark: SparkSession, sf_dir: str, name: str, key: str, across: float, x: float, y: float) -> DataFrame:
    """Stars of a table in a field of ``across`` pixels about (120, 30), with reference places; some without a position, some without a reference place."""
    k = F.col(key)
    frac = lambda v: v - F.floor(v)
    east, north = frac(k * F.lit(0.6180339887498949)) - 0.5, frac(k * F.lit(0.7548776662466927)) - 0.5
    ra, dec = F.lit(120.0) - east * F.lit(across * PIXEL) / F.lit(0.8660254037844387), F.lit(30.0) + north * F.lit(across * PIXEL)
    return table(spark, sf_dir, name).select(
        k.alias("star_id"), F.lit(1).alias("field"), F.when(k % 10 != 4, ra).alias("ra"), F.when(k % 21 != 9, dec).alias("dec"), F.when(k % 15 != 2, east * across + x).alias("ref_x"), F.when(k % 15 != 2, north * across + y).alias("ref_y")
    )
