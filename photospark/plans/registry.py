"""Named queries and their SQL twins. A query is declared with the columns of its result; starred ones are doubles, rounded to six places on both sides."""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
#: Added before rounding on both sides: exact ties (means of few decimals over 64 values) then round alike everywhere.
NUDGE = 3.7e-8
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(x: np.ndarray) -> np.ndarray:
    """The rounding of starred columns for arrays, in tasks that make very many rows: the same doubles as Spark's, which goes by way of decimals."""
    y = np.asarray(x, float) + NUDGE
    with np.errstate(all="ignore"):
        z = np.abs(y) * 1e6
        out = np.copysign(np.floor(z + 0.5), y) / 1e6 + 0.0
        # Near a tie, and where sixth places are beyond a double, the digits of the number itself decide.
        hard = np.flatnonzero((np.abs(z - np.floor(z) - 0.5) < 1e-4 + z * 1e-15) | (z >= 1e15))
    for k in hard:
        out[k] = float(Decimal(repr(float(y[k]))).quantize(Decimal("1e-6"), ROUND_HALF_UP)) + 0.0 if abs(y[k]) < 1e20 else y[k]
    return np.where(np.isfinite(y), out, y)


def query(name: str, columns: str, sql: str | None = None, done: bool = False) -> Callable[[Query], Query]:
    """Register a function as a query that returns ``columns``, with DuckDB SQL that gives the same. ``done``: its tasks have rounded them already."""
    names = columns.split()

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*[F.round(F.col(c[:-1]).cast("double") + F.lit(NUDGE), 6).alias(c[:-1]) if c.endswith("*") and not done else F.col(c.rstrip("*")) for c in names])

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            # Adding zero turns a negative zero, which only one engine's rounding makes, into zero.
            shown = ", ".join(f"round(CAST({c[:-1]} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {c[:-1]}" if c.endswith("*") else c for c in names)
            ORACLES[name] = f"SELECT {shown} FROM ({sql}) AS result"
        return f

    return add


from photospark.plans import cleaning, core, pixels, spatial, survey, transforms  # noqa: E402, F401
