"""Functions for users of SQL: after ``register(spark)`` they can be called in any statement of the session.

* scalar, as SQL expressions that Spark inlines (no Python): separation_arcsec, phase_of, magnitude
* aggregates of a group, over Arrow: robust_scatter(flux), stetson(btjd, flux, error), best_period(btjd, flux)
* tables: find_sources(height, width, pixels) and observation_gaps(times, hours), one call per row with LATERAL"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from photospark.operators.image import find_stars
from photospark.operators.period import classic_power
from photospark.schema import MAD_TO_SIGMA

SCALARS = {
    "separation_arcsec(ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE) RETURNS DOUBLE": "degrees(2 * asin(least(1.0D, sqrt(pow(sin(radians(dec1 - dec2) / 2), 2) + cos(radians(dec1)) * cos(radians(dec2)) * pow(sin(radians(ra1 - ra2) / 2), 2))))) * 3600",
    "phase_of(btjd DOUBLE, period DOUBLE, epoch DOUBLE) RETURNS DOUBLE": "try_divide(btjd - epoch, period) - floor(try_divide(btjd - epoch, period))",
    "magnitude(flux DOUBLE, zero_point DOUBLE) RETURNS DOUBLE": "CASE WHEN flux > 0 THEN zero_point - 2.5D * log10(flux) END",
}


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _finite(*columns: pd.Series) -> list[np.ndarray]:
    x = [c.to_numpy(float) for c in columns]
    keep = np.all([np.isfinite(v) for v in x], axis=0)
    return [v[keep] for v in x]


@F.pandas_udf(T.DoubleType())
def robust_scatter(flux: pd.Series) -> float:
    """1.4826 times the median deviation from the median; null without a finite value."""
    (f,) = _finite(flux)
    return None if not f.size else float(MAD_TO_SIGMA * np.median(np.abs(f - np.median(f))))


@F.pandas_udf(T.DoubleType())
def stetson(btjd: pd.Series, flux: pd.Series, error: pd.Series) -> float:
    """Stetson's J of successive pairs in time about the mean, scaled by sqrt(n / (n - 1)); null for fewer than three points of a positive error."""
    t, f, e = _finite(btjd, flux, error)
    t, f, e = t[e > 0], f[e > 0], e[e > 0]
    if f.size < 3:
        return None
    r = ((f - f.mean()) / e)[np.argsort(t, kind="stable")]
    pair = r[:-1] * r[1:]
    return float((np.sign(pair) * np.sqrt(np.abs(pair))).sum() * np.sqrt(f.size / (f.size - 1)))


@F.pandas_udf(T.DoubleType())
def best_period(btjd: pd.Series, flux: pd.Series) -> float:
    """The period of the strongest of 3,000 frequencies from 0.05 to 5 a day; null for fewer than ten points or a constant."""
    t, f = _finite(btjd, flux)
    if f.size < 10 or f.min() == f.max():
        return None
    order = np.argsort(t, kind="stable")
    freq = 0.05 + np.arange(3000) * (4.95 / 2999)
    return float(1 / freq[np.round(classic_power(t[order], f[order], freq), 9).argmax()])


@F.udtf(returnType=_doubles("x", "y", "peak"))
class FindSources:
    """Sources of an image given by rows; null images have none."""

    def eval(self, height: int, width: int, pixels: list) -> Iterator[tuple[float, float, float]]:
        if height and width and pixels:
            for x, y, peak in find_stars(np.array([np.nan if v is None else v for v in pixels], float).reshape(height, width)):
                yield float(x), float(y), float(peak)


@F.udtf(returnType=_doubles("gap_start", "gap_end", "gap_hours"))
class ObservationGaps:
    """Gaps of over ``hours`` between successive times (in days), which need not be sorted; null times don't count."""

    def eval(self, times: list, hours: float) -> Iterator[tuple[float, float, float]]:
        t = sorted(v for v in times or [] if v is not None)
        for a, b in zip(t, t[1:]):
            if (b - a) * 24 > hours:
                yield a, b, (b - a) * 24


def register(spark: SparkSession) -> None:
    """Make the functions known to a session."""
    for head, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for name, f in {"robust_scatter": robust_scatter, "stetson": stetson, "best_period": best_period}.items():
        spark.udf.register(name, f)
    spark.udtf.register("find_sources", FindSources)
    spark.udtf.register("observation_gaps", ObservationGaps)
