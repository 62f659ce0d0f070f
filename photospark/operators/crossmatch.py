"""Sky cross-matching by declination zones and right-ascension cells: an equi-join on cells, then the exact separation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from photospark import schema as S
from photospark.functions.stats import ratio, separation_arcsec
from photospark.sources.io import stage

#: Beyond this declination one cell holds a whole zone.
POLE = 89.5


def _zone(dec: Column, height: float) -> Column:
    return F.floor((dec + 90) / F.lit(height)).cast("long")


def _cells_in(zone: Column, height: float, width: float) -> Column:
    """Number of equal RA cells of a zone, each at least ``width`` degrees of the sky wide anywhere in the zone and its neighbours."""
    far = F.least(F.lit(90.0), F.greatest(F.abs((zone - 1) * F.lit(height) - 90), F.abs((zone + 2) * F.lit(height) - 90)))
    return F.when(far > POLE, 1).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0 / width) * F.cos(F.radians(far))))).cast("long")


def candidate_pairs(left: DataFrame, right: DataFrame, tol_arcsec: float) -> DataFrame:
    """All (left, right) rows within the tolerance, with ``sep`` in arcsec. Columns must differ in name but for ra and dec (l_ra, l_dec, r_ra, r_dec here).

    The right side stands in one cell; the left side looks into the zones and cells that the tolerance reaches from where it stands (RA wraps round; near the
    poles a zone is one cell). Cells are four reaches wide or more, so that a row stands in about two cells and not in nine. Neither side is broadcast."""
    tol = tol_arcsec / 3600.0
    height, reach = max(4 * tol, 1 / 60), 1.5 * tol
    width = max(4 * reach, 1 / 60)
    r = right.withColumn("zone", _zone(F.col("r_dec"), height)).withColumn("n_cells", _cells_in(F.col("zone"), height, width))
    r = r.withColumn("cell", F.pmod(F.floor(F.col("r_ra") / 360.0 * F.col("n_cells")).cast("long"), F.col("n_cells"))).drop("n_cells")
    zones = F.array_distinct(F.array(*[_zone(F.col("l_dec") + k * 1.01 * tol, height) for k in (-1, 1)]))
    l = left.withColumn("zone", F.explode(zones)).withColumn("n_cells", _cells_in(F.col("zone"), height, width))
    here = F.col("l_ra") / 360.0 * F.col("n_cells")
    l = l.withColumn("cell", F.explode(F.array_distinct(F.array(*[F.pmod(F.floor(here + k * reach / width).cast("long"), F.col("n_cells")) for k in (-1, 1)])))).drop("n_cells")
    sep = separation_arcsec(F.col("l_ra"), F.col("l_dec"), F.col("r_ra"), F.col("r_dec"))
    return l.join(r.hint("merge"), ["zone", "cell"]).drop("zone", "cell").withColumn("sep", sep).where(F.col("sep") <= tol_arcsec)


def nearest(left: DataFrame, right: DataFrame, tol_arcsec: float, strict: bool = False, how: str = "left") -> DataFrame:
    """left rows (star_id, ra, dec) with match_id and sep of the nearest right row (star_id, ra, dec) within the tolerance (below it, if strict), ties by id,
    and n_candidates; how: left keeps unmatched rows, inner doesn't. Many left rows may have one match."""
    l = left.select("star_id", F.col("ra").alias("l_ra"), F.col("dec").alias("l_dec"))
    r = right.select(F.col("star_id").alias("match_id"), F.col("ra").alias("r_ra"), F.col("dec").alias("r_dec"))
    pairs = candidate_pairs(l, r, tol_arcsec)
    if strict:
        pairs = pairs.where(F.col("sep") < tol_arcsec)
    best = pairs.groupBy("star_id").agg(F.min(F.struct("sep", "match_id")).alias("b"), F.count("*").alias("n_candidates")).select("star_id", "b.match_id", "b.sep", "n_candidates")
    out = left.join(best.hint("merge"), "star_id", how)
    return out.withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))


def match_quality(sep: Column) -> Column:
    return F.when(sep < 25, "high").when(sep < 40, "medium").when(sep.isNotNull(), "low")


def crossmatch_sectors(catalogs: dict[int, DataFrame], tol_arcsec: float = 3.0) -> DataFrame:
    """(unified_id, sector, original_id, ra, dec): stars of the lowest sector name the rest; each other star goes to its nearest one below the tolerance."""
    first, *others = sorted(catalogs)
    base = catalogs[first]
    out = base.select(F.col("star_id").alias("unified_id"), F.lit(first).alias("sector"), F.col("star_id").alias("original_id"), "ra", "dec")
    for s in others:
        m = nearest(catalogs[s], base, tol_arcsec, strict=True, how="inner")
        out = out.unionByName(m.select(F.col("match_id").alias("unified_id"), F.lit(s).alias("sector"), F.col("star_id").alias("original_id"), "ra", "dec"))
    return out


def combine_photometry(matches: DataFrame, photometry: DataFrame) -> DataFrame:
    """Photometry rows (sector, star_id, ...) of matched stars under the unified id."""
    m = matches.select("unified_id", "sector", F.col("original_id").alias("star_id"))
    return photometry.join(m, ["sector", "star_id"]).drop("star_id").withColumnRenamed("unified_id", "star_id").orderBy("star_id", "btjd", "row")


def stars_in_all(matches: DataFrame) -> DataFrame:
    """Stars that every sector has, with the number of sectors."""
    total = matches.agg(F.count_distinct("sector").alias("total"))
    per = matches.groupBy("unified_id").agg(F.count_distinct("sector").alias("n_sectors"))
    return per.crossJoin(F.broadcast(total)).where("n_sectors = total").drop("total")


def lookup_attributes(stars: DataFrame, attributes: DataFrame, key: str = "star_id") -> DataFrame:
    """Left equi-join to a table of attributes, which Spark broadcasts if it finds it small."""
    return stars.join(attributes, key, "left")


def close_misses(left: DataFrame, right: DataFrame, tol_arcsec: float = 60.0, far_arcsec: float = 120.0) -> DataFrame:
    """Nearest right row within ``far_arcsec``: is_match within the tolerance, is_close_miss between the two; null separation beyond."""
    m = nearest(left, right, far_arcsec)
    return m.withColumns({"is_match": F.coalesce(F.col("sep") <= tol_arcsec, F.lit(False)), "is_close_miss": F.coalesce((F.col("sep") > tol_arcsec) & (F.col("sep") < far_arcsec), F.lit(False))})


def nearest_planar(stars: DataFrame, ra: float, dec: float) -> DataFrame:
    """The star nearest in plain (ra, dec), as one row."""
    d = F.sqrt((F.col("ra") - ra) * (F.col("ra") - ra) + (F.col("dec") - dec) * (F.col("dec") - dec))
    return stars.withColumn("distance", d).orderBy("distance", "star_id").limit(1)


def _within(places: DataFrame, others: DataFrame, radius: float) -> DataFrame:
    """Rows (x, y, d, nearest, total): other places at a distance over 0 and at most ``radius``, by an equi-join on cells of the radius."""
    at = lambda c, k=0: (F.floor(F.col(c) / F.lit(radius)) + k).cast("long")
    right = others.select(F.col("x").alias("o_x"), F.col("y").alias("o_y"), "nearest", "total", at("x").alias("cx"), at("y").alias("cy"))
    left = places.select("x", "y").withColumn("cx", F.explode(F.array(*[at("x", k) for k in (-1, 0, 1)]))).withColumn("cy", F.explode(F.array(*[at("y", k) for k in (-1, 0, 1)])))
    d = F.hypot(F.col("x") - F.col("o_x"), F.col("y") - F.col("o_y"))
    return left.join(right.hint("merge"), ["cx", "cy"]).withColumn("d", d).where((F.col("d") > 0) & (F.col("d") <= radius)).select("x", "y", "d", "nearest", "total")


def neighbours(stars: DataFrame, radius: float = 6.0, inner: float = 4.0) -> DataFrame:
    """Pixel-plane neighbours (rows star_id, x, y, flux): distance in arcsec and flux ratio of the nearest, at any distance, and flux sums within the two
    radii over the own flux. Stars in one place have the same neighbours, none of them each other: so places meet, each with its first star and the sum
    of its fluxes, by a self-join on cells of the radius. Places that find none there look again in cells of four times the width, until all
    have one or the cells cover the frame: those are few and lonely, so wide cells stay cheap. A star alone keeps nulls and 0."""
    places = stage(stars.where("x is not null and y is not null").groupBy("x", "y").agg(F.min(F.struct(F.col("star_id").alias("o_id"), F.col("flux").alias("o_flux"))).alias("nearest"), F.sum("flux").alias("total")), "places")
    nn = F.min(F.struct("d", "nearest.o_id", "nearest.o_flux")).alias("nn")
    got = _within(places, places, radius).groupBy("x", "y").agg(nn, F.sum(F.when(F.col("d") <= inner, F.col("total"))).alias("s_in"), F.sum("total").alias("s_out"))
    got = stage(got, "neighbours")  # rounds below look at what was found, and don't find it again
    far = places.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    extent, reach = math.hypot(*(v or 0.0 for v in far)), radius
    nearest = got.select("x", "y", "nn")
    lonely = places.join(nearest, ["x", "y"], "left_anti")
    while reach < extent and not (lonely := stage(lonely, "lonely")).isEmpty():
        reach *= 4
        found = stage(_within(lonely, places, reach).groupBy("x", "y").agg(nn), "nearest")
        nearest, lonely = nearest.union(found), lonely.join(found, ["x", "y"], "left_anti")
    out = stars.select("star_id", "flux", "x", "y").join(nearest.hint("merge"), ["x", "y"], "left").join(got.drop("nn").hint("merge"), ["x", "y"], "left")
    return out.select(
        "star_id", (F.col("nn.d") * S.ARCSEC_PER_PIXEL).alias("nn_dist_arcsec"), ratio("nn.o_flux", "flux").alias("nn_flux_ratio"), F.coalesce(ratio("s_in", "flux"), F.lit(0.0)).alias("contam_ratio_84arcsec"),
        F.coalesce(ratio("s_out", "flux"), F.lit(0.0)).alias("contam_ratio_126arcsec"),
    )


def sky_grid(stars: DataFrame, n: int, pixels: int = 99, overlap: int = 5) -> DataFrame:
    """Centres of an n by n grid of cutouts around each star (star_id, ra, dec); right ascension steps widen with 1 / cos(dec)."""
    step = (pixels - overlap) * S.ARCSEC_PER_PIXEL / 3600.0
    places = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = stars.select("star_id", "ra", "dec", places.alias("i")).withColumn("j", places)
    off = lambda c: (F.col(c) - F.lit((n - 1) / 2.0)) * F.lit(step)
    return grid.select("star_id", "i", "j", F.pmod(F.col("ra") + off("i") / F.cos(F.radians("dec")), F.lit(360.0)).alias("ra"), (F.col("dec") + off("j")).alias("dec"))


def separation_summary(matches: DataFrame) -> DataFrame:
    """Count, median and largest separation by quality of match."""
    return matches.where("sep is not null").groupBy(match_quality(F.col("sep")).alias("match_quality")).agg(F.count("*").alias("n"), F.median("sep").alias("median_sep"), F.max("sep").alias("max_sep"))


def mutual_nearest(left: DataFrame, right: DataFrame, tol_arcsec: float) -> DataFrame:
    """Pairs that are each other's nearest within the tolerance."""
    a = nearest(left, right, tol_arcsec, how="inner").select("star_id", "match_id", "sep")
    b = nearest(right, left, tol_arcsec, how="inner").select(F.col("star_id").alias("match_id"), F.col("match_id").alias("star_id"))
    return a.join(b.hint("merge"), ["star_id", "match_id"])


def closest_source(sources: DataFrame, x: float, y: float) -> DataFrame:
    """The source (star_id, x, y) nearest to a pixel, with its distance, as one row."""
    return sources.withColumn("distance", F.hypot(F.col("x") - x, F.col("y") - y)).orderBy("distance", "star_id").limit(1)


def zone_counts(stars: DataFrame, height: float = 10.0) -> DataFrame:
    """Stars per declination zone: a look at how evenly a join by zones is dealt."""
    return stars.groupBy(_zone(F.col("dec"), height).alias("zone")).agg(F.count("*").alias("n"))
