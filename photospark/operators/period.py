"""Period search: Lomb-Scargle on a shared grid in SQL and per star in numpy, and box searches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from photospark.functions.stats import finite, ratio
from photospark.schema import MAD_TO_SIGMA


def _star():
    return Window.partitionBy("star_id")


def frequency_grid(spark, n: int, longest: float, shortest: float) -> DataFrame:
    """n frequencies from 1 / longest to 1 / shortest, evenly spaced (a table of n rows)."""
    lo, hi = 1.0 / longest, 1.0 / shortest
    return spark.range(n).select(F.col("id").cast("int").alias("i"), (F.lit(lo) + F.col("id") * F.lit((hi - lo) / max(1, n - 1))).alias("freq"))


def lomb_scargle_grid(phot: DataFrame, grid: DataFrame, least: int = 10) -> DataFrame:
    """(star_id, i, freq, power): classic periodogram (mean removed, phase offset tau), normalised by the sum of squares, for each star and frequency of
    a small grid (broadcast). Terms are summed per (star, frequency) before the shuffle."""
    g = phot.where("quality = 0").select("star_id", F.col("btjd").alias("t"), finite("flux").alias("f")).where("f is not null")
    g = g.withColumns({"y": F.col("f") - F.avg("f").over(_star()), "n": F.count("f").over(_star()), "t0": F.min("t").over(_star())}).where(F.col("n") >= least)
    w = F.lit(2 * np.pi) * F.col("freq") * (F.col("t") - F.col("t0"))
    terms = g.crossJoin(F.broadcast(grid)).select("star_id", "i", "freq", "y", F.cos(w).alias("c"), F.sin(w).alias("s"))
    c, s, y = F.col("c"), F.col("s"), F.col("y")
    sums = terms.groupBy("star_id", "i", "freq").agg(F.sum(y * c).alias("yc"), F.sum(y * s).alias("ys"), F.sum(c * c).alias("cc"), F.sum(s * s).alias("ss"), F.sum(c * s).alias("cs"), F.sum(y * y).alias("yy"))
    tau = F.atan2(2 * F.col("cs"), F.col("cc") - F.col("ss")) / 2
    a, b = F.cos(tau), F.sin(tau)
    yc, ys = F.col("yc") * a + F.col("ys") * b, F.col("ys") * a - F.col("yc") * b
    cc = F.col("cc") * a * a + 2 * F.col("cs") * a * b + F.col("ss") * b * b
    ss = F.col("ss") * a * a - 2 * F.col("cs") * a * b + F.col("cc") * b * b
    power = ratio(F.coalesce(ratio(yc * yc, F.when(cc > 1e-9, cc)), F.lit(0.0)) + F.coalesce(ratio(ys * ys, F.when(ss > 1e-9, ss)), F.lit(0.0)), "yy")
    return sums.select("star_id", "i", "freq", power.alias("power"))


def top_frequencies(periodogram: DataFrame, k: int = 5) -> DataFrame:
    """The k strongest frequencies of each star by rank."""
    by = _star().orderBy(F.desc(F.round("power", 9)), "i")
    return periodogram.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("star_id", "rank", "i", "freq", "power", (1 / F.col("freq")).alias("period"))


def floating_mean_power(t: np.ndarray, y: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """Periodogram with a fitted mean, standard normalisation, unit weights; in blocks of frequencies of bounded size."""
    y = y - y.mean()
    out = np.empty(freq.size)
    for i in range(0, freq.size, max(1, 2_000_000 // max(1, t.size))):
        w = 2 * np.pi * np.outer(freq[i : i + max(1, 2_000_000 // max(1, t.size))], t - t[0])
        c, s = np.cos(w), np.sin(w)
        c -= c.mean(axis=1, keepdims=True)
        s -= s.mean(axis=1, keepdims=True)
        yc, ys, cc, ss, cs = (c * y).mean(1), (s * y).mean(1), (c * c).mean(1), (s * s).mean(1), (c * s).mean(1)
        d = cc * ss - cs * cs
        out[i : i + len(yc)] = np.where(d > 1e-12, (yc * yc * ss + ys * ys * cc - 2 * yc * ys * cs) / np.where(d > 1e-12, d, 1), 0) / max((y * y).mean(), 1e-300)
    return out


def _per_star(phot: DataFrame, kernel: Callable[..., list[dict]], types: dict[str, pa.DataType]) -> DataFrame:
    """Rows (star_id, and the columns of ``types``) that ``kernel`` makes of each star's good finite points: times, fluxes and errors (NaN where
    unknown) in time order. The points of a star become arrays in one shuffle, whose partitions stay as many as set since the work on a star
    is far more than its bytes say; a batch holds many stars."""
    parts = int(phot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    phot = phot.select("star_id", "row", "btjd", "flux", "flux_error", "quality").repartition(parts, "star_id")
    point = F.when((F.col("quality") == 0) & finite("flux").isNotNull(), F.struct("btjd", "row", "flux", finite("flux_error").alias("flux_error")))
    series = phot.groupBy("star_id").agg(F.array_sort(F.collect_list(point)).alias("s")).select("star_id", "s.btjd", "s.flux", "s.flux_error")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, point in enumerate(zip(*batch.columns[1:], strict=True)):
                rows = kernel(*(np.asarray(c.values.to_numpy(zero_copy_only=False), float) for c in point))
                found += rows
                owner += [i] * len(rows)
            columns = [pa.array([r.get(c) for r in found], t) for c, t in types.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *columns], ["star_id", *types])

    names = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.bool_(): "boolean"}
    kind = phot.schema["star_id"].dataType.simpleString()
    return series.mapInArrow(run, ", ".join([f"star_id {kind}", *(f"{c} {names[t]}" for c, t in types.items())]))


def classic_power(t: np.ndarray, y: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """Periodogram of lomb_scargle_grid (no floating mean) of one series, in blocks of frequencies of bounded size."""
    y = y - y.mean()
    out = np.zeros(freq.size)
    step = max(1, 1_000_000 // max(1, t.size))
    total = (y * y).sum()
    for i in range(0, freq.size if total > 0 else 0, step):
        w = 2 * np.pi * np.outer(freq[i : i + step], t - t[0])
        c, s = np.cos(w), np.sin(w)
        yc, ys = c @ y, s @ y
        cc, cs = (c * c).sum(axis=1), (c * s).sum(axis=1)
        ss = t.size - cc
        tau = np.arctan2(2 * cs, cc - ss) / 2
        a, b = np.cos(tau), np.sin(tau)
        along, across = yc * a + ys * b, ys * a - yc * b
        cc2, ss2 = cc * a * a + 2 * cs * a * b + ss * b * b, ss * a * a - 2 * cs * a * b + cc * b * b
        out[i : i + step] = (np.where(cc2 > 1e-9, along**2 / np.maximum(cc2, 1e-9), 0) + np.where(ss2 > 1e-9, across**2 / np.maximum(ss2, 1e-9), 0)) / total
    return out


def grid_peaks(phot: DataFrame, n: int = 10_000, longest: float = 15.0, shortest: float = 0.1, least: int = 50, k: int = 1) -> DataFrame:
    """(star_id, rank, i, freq, power, period): the ``k`` strongest of ``n`` frequencies evenly spaced from 1 / longest to 1 / shortest, for stars with
    ``least`` good points; ties by frequency. A constant star has no rows."""
    lo, hi = 1.0 / longest, 1.0 / shortest
    freq = lo + np.arange(n) * ((hi - lo) / max(1, n - 1))

    def peaks(t: np.ndarray, y: np.ndarray, error: np.ndarray) -> list[dict]:
        if t.size < max(1, least) or y.min() == y.max():
            return []
        power = classic_power(t, y, freq)
        best = np.lexsort((freq, -np.round(power, 9)))[:k]
        return [{"rank": r, "i": int(j), "freq": freq[j], "power": power[j], "period": 1 / freq[j]} for r, j in enumerate(best, 1)]

    return _per_star(phot, peaks, {"rank": pa.int32(), "i": pa.int32(), "freq": pa.float64(), "power": pa.float64(), "period": pa.float64()})


PERIODIC = {"n_points": pa.int64()} | dict.fromkeys(["total_power", "power_ratio_top", *(f"{c}_{i}" for i in range(1, 6) for c in ("freq", "power", "period"))], pa.float64())


def _periodic(t: np.ndarray, y: np.ndarray, error: np.ndarray) -> list[dict]:
    out = {"n_points": t.size}
    if t.size >= 10 and t[-1] > t[0] and np.median(np.diff(t)) > 0 and y.std() > 0:
        span, step = t[-1] - t[0], np.median(np.diff(t))
        freq = np.arange(1 / span, 1 / (2 * step), 1 / (5 * span))
        if freq.size:
            power = floating_mean_power(t, y, freq)
            top = np.lexsort((freq, -power))[:5]
            out |= {"total_power": power.sum(), "power_ratio_top": power[top[0]] / max(power.sum(), 1e-300)}
            for r, j in enumerate(top, 1):
                out |= {f"freq_{r}": freq[j], f"power_{r}": power[j], f"period_{r}": 1 / freq[j]}
    return [out]


def periodic_features(phot: DataFrame) -> DataFrame:
    """Per star: total power, the five strongest frequencies, and the strongest's share, on the star's own grid (5 samples a peak between 1/span and
    1/(2 median step)); nulls for fewer than ten points or a constant. A star's series is one row."""
    return _per_star(phot, _periodic, PERIODIC)


def _phase_boxes(t: np.ndarray, y: np.ndarray, error: np.ndarray, periods: np.ndarray, starts: np.ndarray, width: float, least: tuple[int, int, int], cells: int = 500_000) -> list[dict]:
    if t.size < max(1, least[0]):
        return []
    order = np.argsort(y, kind="stable")
    x, y = (t - t[0])[order], y[order]
    rank = np.arange(1, y.size + 1)

    def median(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of the values counted in ``seen``, running along the sorted ones: n in all."""
        low, high = ((seen >= k[..., None]).argmax(axis=2) for k in ((n + 1) // 2, n // 2 + 1))
        return (y[low] + y[high]) / 2

    found = []
    step = max(1, cells // (y.size * starts.size))
    for i in range(0, periods.size, step):
        phase = ((x / periods[i : i + step, None]) % 1.0)[:, None]
        seen = np.cumsum((phase >= starts[:, None]) & (phase < starts[:, None] + width), axis=2)
        n_in = seen[:, :, -1]
        n_out = y.size - n_in
        depth = median(rank - seen, n_out) - median(seen, n_in)
        power = depth * np.sqrt(n_in * n_out / (n_in + n_out))
        power[(n_in < least[1]) | (n_out < least[2]) | (depth <= 0)] = -np.inf
        j, k = np.unravel_index(np.round(power, 9).argmax(), power.shape)
        if np.isfinite(power[j, k]):
            found.append({"period": periods[i + j], "start": starts[k], "n_in": int(n_in[j, k]), "n_out": int(n_out[j, k]), "depth": depth[j, k], "power": power[j, k]})
    return [max(found, key=lambda r: round(r["power"], 9))] if found else []


def box_search(phot: DataFrame, periods: list[float], width: float = 0.02, n_phases: int = 20, least: int = 50, least_in: int = 3, least_out: int = 10) -> DataFrame:
    """Per star with ``least`` good points the best box of ``width`` in phase over ``periods`` and ``n_phases`` starts from 0 to 1 - width: depth is the median
    outside less the median inside, above 0, and power the depth times sqrt(n_in n_out / (n_in + n_out)); ties by period, then start."""
    types = {"period": pa.float64(), "start": pa.float64(), "n_in": pa.int64(), "n_out": pa.int64(), "depth": pa.float64(), "power": pa.float64()}
    starts = np.arange(n_phases) * ((1 - width) / max(1, n_phases - 1))
    return _per_star(phot, partial(_phase_boxes, periods=np.array(periods, float), starts=starts, width=width, least=(least, least_in, least_out)), types)


BOX = dict.fromkeys(["period", "t0", "duration", "depth", "power"], pa.float64())


#: Powers closer than this share of them are equal: sums in another order differ by less.
EQUAL = 1e-11


def _short_boxes(phase: np.ndarray, period: np.ndarray, w: np.ndarray, wy: np.ndarray, durations: np.ndarray, best: float, most: float) -> tuple[float, list[tuple[np.ndarray, ...]]] | None:
    """The best strength from ``best`` on, and (strength, period's place, duration's place, start, depth) of boxes about as strong, or None where the boxes hold
    over ``most`` points in all.

    A box from each point takes in the next ones, one after the other, as long as one lies within the longest duration: where boxes are short that is far less
    than a search per duration. A box is that of the shortest duration which holds its points, if one ends before the next point. Boxes that are weaker than
    the best one known aren't looked at further."""
    m, n = phase.shape
    longest, found = durations[-1], []
    twice = [np.hstack([phase, phase + period]), np.hstack([w, w]), np.hstack([wy, wy])]
    r, s, own = np.zeros((m, n)), np.zeros((m, n)), np.zeros((m, n))
    place, start = None, phase
    for step in range(n):
        most -= r.size
        if most < 0:
            return None
        if place is None:
            ends, more_r, more_s = (c[:, step + shift : step + shift + n] for c, shift in zip(twice, (1, 0, 0), strict=True))
        else:
            ends, more_r, more_s = (c.ravel()[place + step + shift] for c, shift in zip(twice, (1, 0, 0), strict=True))
        r, s = r + more_r, s + more_s
        later = ends - start if step + 1 < n else np.full(r.shape, np.inf)
        power = s * s / (r * (1 - r))
        good = (power >= best * (1 - EQUAL)) & (s < 0) & (own <= longest) & (r > 0) & (r < 1 - 1e-12)
        if good.any():
            k = np.searchsorted(durations, own[good])
            fits = durations[k] < later[good]
            at = np.flatnonzero(good)[fits]
            if len(at):
                p, rr, ss = (c.ravel()[at] for c in (power, r, s))
                where = at if place is None else place[at]
                width = n if place is None else 2 * n
                best = max(best, p.max())
                strong = p >= best * (1 - EQUAL)
                found.append(tuple(c[strong] for c in (p, where // width, k[fits], where % width, -ss / (rr * (1 - rr)))))
        on = later <= longest
        share = np.count_nonzero(on) / on.size
        if not share:
            break
        own = later
        if share < 0.4:
            # Few are left: these by themselves.
            place = (np.arange(m)[:, None] * (2 * n) + np.arange(n))[on] if place is None else place[on]
            r, s, own, start = r[on], s[on], own[on], start[on]
    return best, found


def _searched_boxes(phase: np.ndarray, period: np.ndarray, w: np.ndarray, wy: np.ndarray, durations: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same by a search for the end of each duration's boxes."""
    m, n = phase.shape
    each, zero = np.arange(m), np.zeros((m, 1))
    cw, cy = (np.hstack([zero, np.cumsum(np.hstack([c, c]), axis=1)]) for c in (w, wy))
    # The phases of each period, twice round, in a stretch of their own, so that one search serves all periods.
    shift = each[:, None] * (3 * period.max())
    rounds = (np.hstack([phase, phase + period]) + shift).ravel()
    strength = np.empty((m, durations.size))
    at, depth = np.empty(strength.shape, int), np.empty(strength.shape)
    for k, d in enumerate(durations):
        end = np.searchsorted(rounds, (phase + d + shift).ravel(), "right").reshape(phase.shape) - each[:, None] * (2 * n)
        r, s = np.take_along_axis(cw, end, axis=1) - cw[:, :n], np.take_along_axis(cy, end, axis=1) - cy[:, :n]
        ok = (r > 0) & (r < 1 - 1e-12) & (s < 0)
        spread = np.where(ok, r * (1 - r), 1)
        p = np.where(ok, s * s / spread, -np.inf)
        at[:, k] = p.argmax(axis=1)
        strength[:, k] = p.max(axis=1)
        depth[:, k] = np.take_along_axis(-s / spread, at[:, k, None], axis=1)[:, 0]
    k = strength.argmax(axis=1)
    return strength[each, k], k, at[each, k], depth[each, k]


def _boxes(t: np.ndarray, y: np.ndarray, error: np.ndarray, periods: np.ndarray, durations: np.ndarray, cells: int = 20_000, short: int = 30) -> list[dict]:
    n, mid = t.size, np.median(y) if t.size else 0
    if n < 20 or not mid > 0:
        return [{}]
    start, x, y, error = t[0], t - t[0], y / mid, error / mid
    known = np.isfinite(error) & (error > 0)
    w = np.where(known, 1 / np.where(known, error, 1) ** 2, 0)
    w = w / w.sum() if w.sum() > 0 else np.full(n, 1 / n)
    wy = w * (y - (w * y).sum())
    best, held = 0.0, []
    with np.errstate(all="ignore"):
        for i in range(0, periods.size, max(1, cells // n)):
            period = periods[i : i + max(1, cells // n), None]
            phase = x % period
            order = np.argsort(phase, axis=1)
            phase = np.take_along_axis(phase, order, axis=1)
            found = None
            if n * durations[-1] < short * period[0, 0]:
                found = _short_boxes(phase, period, w[order], wy[order], durations, best, short * phase.size)
            if found is None:
                strength, k, at, depth = _searched_boxes(phase, period, w[order], wy[order], durations)
                found = max(best, strength.max()), [(strength, np.arange(len(strength)), k, at, depth)]
            best = found[0]
            for p, row, k, at, depth in found[1]:
                strong = np.flatnonzero((p > 0) & (p >= best * (1 - EQUAL)))
                held += [(p[e], i + row[e], k[e], at[e], depth[e], phase[row[e], at[e]]) for e in strong]
            held = [h for h in held if h[0] >= best * (1 - EQUAL)]
    if not held:
        return [{}]
    # Of boxes as strong the first by period, then duration, then start.
    power, j, k, _, depth, begin = min(held, key=lambda h: h[1:4])
    return [{"power": power, "period": periods[j], "t0": start + begin + durations[k] / 2, "duration": durations[k], "depth": depth}]


def box_least_squares(phot: DataFrame, n_periods: int = 5000, durations: int = 10) -> DataFrame:
    """Per star the best box of least squares on median-normalised good flux: periods from 0.5 to 15 days, durations from 0.01 to 0.2; nulls for fewer than
    20 points or a median that isn't above 0; ties by period, then duration."""
    return _per_star(phot, partial(_boxes, periods=np.linspace(0.5, 15, n_periods), durations=np.linspace(0.01, 0.2, durations)), BOX)


DOUBLED = {"n_points": pa.int64(), "i": pa.int32()} | dict.fromkeys(["period", "power", "depth", "depth_opposite", "significance", "best_period"], pa.float64()) | {"is_doubled": pa.bool_()}


def _double(t: np.ndarray, y: np.ndarray, error: np.ndarray, freq: np.ndarray, clip: float, least: int, bins: int, sigma: float) -> list[dict]:
    mid = np.median(y) if y.size else 0.0
    if y.size < max(1, least) or not mid:
        return []
    y = y / mid
    off = np.abs(y - np.median(y))
    keep = off < clip * MAD_TO_SIGMA * np.median(off)
    t, y = t[keep], y[keep]
    if not y.size or y.min() == y.max():
        return []
    x = t - t[0]
    power = np.round(classic_power(t, y, freq), 9)
    at = int(power.argmax())
    period = 1 / freq[at]
    turn = x / (2 * period)
    place = np.minimum(2 * bins - 1, np.floor((turn - np.floor(turn)) * (2 * bins)).astype(int))
    n = np.bincount(place, minlength=2 * bins)
    centre = np.array([np.median(y[place == b]) if n[b] else np.nan for b in range(2 * bins)])
    noise = MAD_TO_SIGMA * np.median(np.abs(y - centre[place]))
    depth, spread = [np.nan, np.nan], [np.nan, np.nan]
    full = [b for b in range(2 * bins) if n[b] >= 3]
    if full:
        first = min(full, key=lambda b: (centre[b], b))
        across = lambda b: min((b - first) % (2 * bins), (first - b) % (2 * bins))
        for i, own in enumerate(([first], [b for b in full if across(b) >= bins - bins // 5])):
            if own:
                b = min(own, key=lambda b: (centre[b], b))
                depth[i], spread[i] = np.median(y) - centre[b], 1.2533 * noise / np.sqrt(n[b])
    width = math.sqrt(spread[0] ** 2 + spread[1] ** 2)
    found = abs(depth[0] - depth[1]) / width if width > 0 else math.nan
    doubled = bool(found > sigma)
    number = lambda v: None if math.isnan(v) else float(v)
    return [{
        "n_points": y.size, "i": at, "period": period, "power": power[at], "depth": number(depth[0]), "depth_opposite": number(depth[1]), "significance": number(found), "best_period": 2 * period if doubled else period, "is_doubled": doubled,
    }]


def clipped_search(phot: DataFrame, n: int = 3000, lowest: float = 0.05, highest: float = 5.0, clip: float = 5.0, least: int = 50, bins: int = 10, sigma: float = 3.0) -> DataFrame:
    """Per star with ``least`` good points: the strongest of ``n`` frequencies of the median-normalised fluxes that lie within ``clip`` robust deviations, and
    whether the period is twice that.

    For that the points are folded with twice the period into ``2 * bins`` bins. The depth of a bin is the median of all less its own (of three points at least).
    The deepest bin is compared with the deepest of those about half a turn away (within a tenth): where they differ by over ``sigma`` times their error
    (from the scatter about the bins' medians) the waves are two, and best_period is twice the period. Null depths where no bin has three points; a
    constant star, and one of median 0, has no row."""
    freq = lowest + np.arange(n) * ((highest - lowest) / max(1, n - 1))
    return _per_star(phot, partial(_double, freq=freq, clip=clip, least=least, bins=bins, sigma=sigma), DOUBLED)
