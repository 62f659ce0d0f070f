"""Lightcurve transforms: normalise, detrend, fold, bin, pivot, padded sequences. Input rows: star_id, row (tie-break), btjd, flux, flux_error, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite, pct, ratio


def _star():
    return Window.partitionBy("star_id")


def _good(c: str) -> Column:
    return F.when(F.col("quality") == 0, finite(c))


def normalize(phot: DataFrame, method: str = "median") -> DataFrame:
    """Flux and error over the star's good median, mean or first value; unchanged where there is none (or it is 0)."""
    by = {"median": F.median(_good("flux")).over(_star()), "mean": F.avg(_good("flux")).over(_star()), "first": F.min_by(_good("flux"), F.when(_good("flux").isNotNull(), F.struct("btjd", "row"))).over(_star())}
    if method not in by:
        raise ValueError(f"unknown method {method}")
    df = phot.withColumn("norm", by[method])
    return df.withColumns({c: F.coalesce(ratio(c, "norm"), F.col(c)) for c in ("flux", "flux_error")}).drop("norm")


def detrend(phot: DataFrame, method: str = "linear") -> DataFrame:
    """Good rows less a fit (or the running median of five, edges reflected), plus the median; fewer than three good rows stay as they are."""
    g = phot.where("quality = 0")
    n, mid = F.count("flux").over(_star()), F.median("flux").over(_star())
    if method == "linear":
        fit = F.regr_intercept("flux", "btjd").over(_star()) + F.regr_slope("flux", "btjd").over(_star()) * F.col("btjd")
    elif method == "polynomial":
        # Least squares in u = t - mean(t), by sums; u has mean 0.
        g = g.withColumn("u", F.col("btjd") - F.avg("btjd").over(_star()))
        m = {k: F.avg(F.pow("u", F.lit(float(k)))).over(_star()) for k in (2, 3, 4)}
        y = {k: F.avg(F.col("flux") * F.pow("u", F.lit(float(k)))).over(_star()) for k in (0, 1, 2)}
        g = g.withColumns({f"m{k}": c for k, c in m.items()} | {f"y{k}": c for k, c in y.items()})
        d = F.col("m2") * F.col("m4") - F.col("m2") * F.col("m2") * F.col("m2") - F.col("m3") * F.col("m3")
        a2 = ratio(F.col("m2") * F.col("y2") - F.col("m3") * F.col("y1") - F.col("m2") * F.col("m2") * F.col("y0"), d)
        a1 = ratio(F.col("y1") - a2 * F.col("m3"), "m2")
        fit = F.col("y0") - a2 * F.col("m2") + a1 * F.col("u") + a2 * F.col("u") * F.col("u")
    elif method == "median_filter":
        order = _star().orderBy("btjd", "row")
        last = _star().orderBy(F.desc("btjd"), F.desc("row"))
        g = g.withColumns({"i": F.row_number().over(order), "k": F.row_number().over(last)})
        near = {j: (F.lead if j > 0 else F.lag)("flux", abs(j)).over(order) for j in (-2, -1, 1, 2)}
        own = F.col("flux")
        # Reflected edges: ... b a | a b c ... y z | z y ...
        b2 = F.when(F.col("i") == 1, F.coalesce(near[1], own)).when(F.col("i") == 2, near[-1]).otherwise(near[-2])
        b1 = F.when(F.col("i") == 1, own).otherwise(near[-1])
        a1 = F.when(F.col("k") == 1, own).otherwise(near[1])
        a2 = F.when(F.col("k") == 1, F.coalesce(near[-1], own)).when(F.col("k") == 2, near[1]).otherwise(near[2])
        fit = F.get(F.array_sort(F.array(b2, b1, own, a1, a2)), F.lit(2))
    else:
        raise ValueError(f"unknown method {method}")
    flux = F.when(n >= 3, F.coalesce(F.col("flux") - fit + mid, F.col("flux"))).otherwise(F.col("flux"))
    return g.withColumn("detrended", flux).select(*phot.columns, "detrended")


def phase_fold(phot: DataFrame, period: float, t0: float | None = None) -> DataFrame:
    """Good rows with phase in (-0.5, 0.5]; t0 is the star's first good time unless given."""
    g = phot.where("quality = 0")
    start = F.lit(float(t0)) if t0 is not None else F.min("btjd").over(_star())
    turn = F.pmod((F.col("btjd") - start) / F.lit(float(period)), F.lit(1.0))
    return g.withColumn("phase", F.when(turn > 0.5, turn - 1).otherwise(turn))


def phase_bins(folded: DataFrame, n_bins: int = 50, low: float = -0.5, high: float = 0.5) -> DataFrame:
    """(star_id, bin, center, n, median_flux, error) for every bin of every star; error is the population deviation over sqrt(n); a phase at ``high`` is
    in no bin; empty bins have n 0 and nulls."""
    at = F.width_bucket("phase", F.lit(low), F.lit(high), F.lit(n_bins))
    got = folded.withColumn("bin", at.cast("int")).where(F.col("bin").between(1, n_bins)).groupBy("star_id", "bin").agg(F.count("flux").alias("n"), F.median("flux").alias("median_flux"), (F.stddev_pop("flux") / F.sqrt(F.count("flux"))).alias("error"))
    grid = folded.select("star_id").distinct().select("star_id", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
    step = (high - low) / n_bins
    return grid.join(got, ["star_id", "bin"], "left").select("star_id", "bin", (F.lit(low) + (F.col("bin") - 0.5) * F.lit(step)).alias("center"), F.coalesce("n", F.lit(0)).alias("n"), "median_flux", "error")


def extended_phase(folded: DataFrame) -> DataFrame:
    """Phases in [-0.5, 1): each point of positive turn a second time, one turn on or back."""
    turn = F.pmod("phase", F.lit(1.0))
    return folded.select("*", F.explode(F.array(turn, turn - 1)).alias("extended")).where("extended >= -0.5 and extended < 1")


def time_bins(phot: DataFrame, width: float = 0.05, least: int = 5) -> DataFrame:
    """Good rows by steps of ``width`` days from the star's first: median and error of each bin with ``least`` points."""
    g = phot.where("quality = 0").withColumn("bin", F.floor((F.col("btjd") - F.min("btjd").over(_star())) / F.lit(width)).cast("int"))
    n = F.count("flux")
    return g.groupBy("star_id", "bin").agg(n.alias("n"), F.avg("btjd").alias("btjd"), F.median("flux").alias("median_flux"), (F.stddev_pop("flux") / F.sqrt(n)).alias("error")).where(F.col("n") >= least)


def detrend_by_division(phot: DataFrame) -> DataFrame:
    """Good rows over their linear fit."""
    fit = F.regr_intercept("flux", "btjd").over(_star()) + F.regr_slope("flux", "btjd").over(_star()) * F.col("btjd")
    return phot.where("quality = 0").withColumn("detrended", ratio("flux", fit))


def epochs_found(phot: DataFrame, most: int = 5000) -> list[int]:
    """The epochs of a table in order; an error beyond ``most``, which no wide table holds."""
    found = [r[0] for r in phot.select("epoch").where("epoch is not null").distinct().orderBy("epoch").take(most + 1)]
    if len(found) > most:
        raise ValueError(f"more than {most} epochs: name those of the wide table")
    return found


def pivot_epochs(phot: DataFrame, epochs: list[int] | None = None, least: int = 1) -> DataFrame:
    """A wide row per star: flux, error and quality of each listed epoch (all that occur by default; the first row by tie-break), and the count of good rows."""
    epochs = epochs_found(phot) if epochs is None else epochs
    first = phot.groupBy("star_id", "epoch").agg(*[F.min_by(c, F.struct("btjd", "row")).alias(c) for c in ("flux", "flux_error", "quality")])
    wide = first.groupBy("star_id").pivot("epoch", epochs).agg(F.first("flux").alias("flux"), F.first("flux_error").alias("flux_error"), F.first("quality").alias("quality"))
    n = phot.groupBy("star_id").agg(F.count_if(F.col("quality") == 0).alias("n_detections"))
    out = wide.join(n, "star_id").where(F.col("n_detections") >= least)
    return out.select("star_id", "n_detections", *[F.col(f"{e}_{c}").alias(f"{c}_{e}") for e in epochs for c in ("flux", "flux_error", "quality")])


def master_table(phot: DataFrame, epochs: list[int] | None = None) -> DataFrame:
    """pivot_epochs for every star, with flag 5 where an epoch wasn't processed."""
    epochs = epochs_found(phot) if epochs is None else epochs
    wide = pivot_epochs(phot, epochs, 0)
    return wide.select("star_id", *[c for e in epochs for c in (F.col(f"flux_{e}"), F.col(f"flux_error_{e}"), F.coalesce(f"quality_{e}", F.lit(5)).alias(f"flag_{e}"))])


def epoch_maps(phot: DataFrame, least: int = 1) -> DataFrame:
    """(star_id, n_detections, by_epoch): the wide row as a map from epoch to flux, flux_error and quality (of an epoch's rows the first by tie-break). One shuffle,
    whatever the number of epochs; no column for each of them."""
    cells = F.array_sort(F.collect_list(F.when(F.col("epoch").isNotNull(), F.struct("epoch", "btjd", "row", "flux", "flux_error", "quality"))))
    s = phot.groupBy("star_id").agg(F.count_if(F.col("quality") == 0).alias("n_detections"), cells.alias("s")).where(F.col("n_detections") >= least)
    first = F.filter("s", lambda v, i: (i == 0) | (F.get("s", i - 1)["epoch"] != v["epoch"]))
    return s.select("star_id", "n_detections", F.map_from_entries(F.transform(first, lambda v: F.struct(v["epoch"], F.struct(v["flux"].alias("flux"), v["flux_error"].alias("flux_error"), v["quality"].alias("quality"))))).alias("by_epoch"))


def epoch_rows(maps: DataFrame, phot: DataFrame) -> DataFrame:
    """The maps as rows, one for each star and each epoch that any star has: star_id, n_detections, epoch, flux, flux_error, quality (null where the star has none)."""
    epochs = phot.where("epoch is not null").select("epoch").distinct().agg(F.sort_array(F.collect_list("epoch")).alias("epochs"))  # one row
    rows = maps.crossJoin(F.broadcast(epochs)).select("star_id", "n_detections", "by_epoch", F.explode("epochs").alias("epoch"))
    return rows.select("star_id", "n_detections", "epoch", F.try_element_at("by_epoch", F.col("epoch")).alias("cell")).select("star_id", "n_detections", "epoch", "cell.*")


def padded_sequences(phot: DataFrame, length: int = 200, zero: bool = True) -> DataFrame:
    """(star_id, x, mask): the first ``length`` rows in time as [flux, error, quality], flux and error over the star's median of all rows, padded with
    zeros (or nulls); mask is true for rows of quality 0."""
    p = phot.select("star_id", "row", "btjd", finite("flux").alias("f"), finite("flux_error").alias("e"), "quality")
    fill = (lambda c: F.coalesce(c, F.lit(0.0))) if zero else (lambda c: c)
    step = F.array(fill(ratio("f", "m")), fill(ratio("e", "m")), F.col("quality").cast("double"))
    p = p.withColumn("m", F.median("f").over(_star())).withColumn("i", F.row_number().over(_star().orderBy("btjd", "row"))).where(F.col("i") <= length)
    s = p.groupBy("star_id").agg(F.array_sort(F.collect_list(F.struct("i", step.alias("x"), (F.col("quality") == 0).alias("ok")))).alias("s"))
    pad = F.lit(length) - F.size("s")
    empty = F.array(*[F.lit(0.0) if zero else F.lit(None).cast("double")] * 3)
    return s.select("star_id", F.concat(F.transform("s", lambda v: v["x"]), F.array_repeat(empty, pad)).alias("x"), F.concat(F.transform("s", lambda v: v["ok"]), F.array_repeat(F.lit(False), pad)).alias("mask"))


def to_arrays(phot: DataFrame, good_only: bool = True) -> DataFrame:
    """Times, fluxes and errors of each star as arrays in time order."""
    g = phot.where("quality = 0") if good_only else phot
    s = g.groupBy("star_id").agg(F.array_sort(F.collect_list(F.struct("btjd", "row", "flux", "flux_error"))).alias("s"))
    return s.select("star_id", *[F.col(f"s.{c}").alias(c) for c in ("btjd", "flux", "flux_error")])


def detection_epochs(phot: DataFrame) -> DataFrame:
    """Count of good rows and the sorted epochs that have any."""
    return phot.groupBy("star_id").agg(F.count_if(F.col("quality") == 0).alias("n_detections"), F.array_sort(F.collect_set(F.when(F.col("quality") == 0, F.col("epoch")))).alias("epochs_detected"))


def sigma_clip(phot: DataFrame, sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """Mean, median and deviation of each star's flux after ``rounds`` of clipping about the median."""
    df = phot.select("star_id", finite("flux").alias("f"))
    for _ in range(rounds):
        df = df.withColumns({"m": F.median("f").over(_star()), "s": F.stddev_pop("f").over(_star())}).select("star_id", F.when(F.abs(F.col("f") - F.col("m")) <= sigma * F.col("s"), F.col("f")).alias("f"))
    return df.groupBy("star_id").agg(F.count("f").alias("n"), F.avg("f").alias("mean"), F.median("f").alias("median"), F.stddev_pop("f").alias("std"))


def percentile_band(phot: DataFrame, low: float, high: float) -> DataFrame:
    """The star's percentiles of good flux."""
    return phot.where("quality = 0").groupBy("star_id").agg(pct("flux", low).alias("low"), pct("flux", high).alias("high"))
