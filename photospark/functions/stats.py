"""Column builders for statistics. NaN and infinities count as missing; a division by zero gives null; medians and percentiles are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column | str) -> Column:
    """The value, null where it is NaN or infinite."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def ratio(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def holds(c: Column) -> Column:
    """The condition, false where it is null."""
    return F.coalesce(c, F.lit(False))


def pct(c: Column | str, p: float) -> Column:
    """Linearly interpolated percentile."""
    return F.percentile(c, F.lit(p))


def share(condition: Column, n: Column) -> Column:
    return ratio(F.count_if(condition), n)


def robust_amplitude(c: Column | str) -> Column:
    """(p95 - p5) / median; 0 if the median is 0."""
    m = F.median(c)
    return F.when(m == 0, 0.0).otherwise(ratio(pct(c, 0.95) - pct(c, 0.05), m))


def skew_corrected(c: Column | str) -> Column:
    """Bias-corrected sample skewness (three values at least)."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_corrected(c: Column | str) -> Column:
    """Bias-corrected excess kurtosis (four values at least)."""
    n = F.count(c).cast("double")
    return F.when(n > 3, ratio(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation of two positions in degrees, by haversines."""
    a, b = F.radians(dec1), F.radians(dec2)
    h = F.pow(F.sin((a - b) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(ra1 - ra2) / 2), F.lit(2.0))
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))) * 3600
