"""Embedding whitening over an exact scatter matrix in residue numbers (operator 11).

Vectors become whole numbers x. With n vectors and sums S, z = n x - S is whole too, and the scatter T = sum of z z' is n^3 times the covariance of x,
centred before anything is multiplied. Tasks multiply z modulo several primes: products of residues fit double precision exactly, so BLAS does them. The
sums of residues of all tasks give every entry of T exactly by Chinese remaindering. Its double is rounded once, and one eigh gives the components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows multiplied at once: with primes under 2^21, residues around 0 and 2^12 rows, sums of products stay under 2^53.
BLOCK, PRIME_BITS = 4096, 21
#: Scaled entries are held within this, so that they and their sums with the shift are longs.
MOST = 2**62


@dataclass(frozen=True)
class Fit:
    """n vectors of one length with entries between ``low`` and ``high`` whose sums are ``total`` (whole numbers of any size, without the shift)."""

    n: int
    total: tuple[int, ...]
    low: int
    high: int

    @property
    def reach(self) -> int:
        """The largest entry that z = n y - total can have."""
        return max(max(self.n * self.high - s, s - self.n * self.low) for s in self.total)


@dataclass(frozen=True)
class Axes:
    """components: a column for each, already divided by the root of its eigenvalue; NaN where that is zero. explained: shares of the trace, or NaN."""

    components: np.ndarray
    explained: np.ndarray


def primes(bound: int) -> list[int]:
    """The largest primes of PRIME_BITS bits, as many as residues need to tell whole numbers from -bound to bound apart."""
    found, product, p = [], 1, 2**PRIME_BITS - 1
    while product <= 2 * bound:
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
        p -= 2
    return found


def remainder(residues: dict[int, np.ndarray]) -> np.ndarray:
    """The whole numbers (Python's, as objects) that have these residues by prime, those nearest to 0."""
    product, out = math.prod(residues), 0
    for p, r in residues.items():
        rest = product // p
        out = out + r.astype(object) * (rest * pow(rest, -1, p))
    out = out % product
    return np.where(out > product // 2, out - product, out)


def _blocks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(length, scaled whole entries, keys) of up to BLOCK vectors of one length."""
    for batch in batches:
        sizes = np.asarray(batch.column(1).value_lengths())
        for d in np.unique(sizes).tolist():
            own = batch.filter(pa.array(sizes == d)) if (sizes != d).any() else batch
            for at in range(0, len(own), BLOCK):
                some = own.slice(at, BLOCK)
                x = np.asarray(some.column(1).flatten()).reshape(len(some), d)
                with np.errstate(over="ignore"):
                    y = np.floor(scale * x)
                yield d, np.where(y >= MOST, MOST, np.where(y <= -MOST, -MOST, np.clip(y, -MOST, MOST - 2**9).astype(np.int64))), some.column(0)


def _survey(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """A row per length: count, sums of the upper and lower 32 bits of each entry, smallest and largest entry."""
    found: dict[int, list] = {}
    for d, y, _ in _blocks(batches, scale):
        new = [len(y), (y >> 32).sum(axis=0), (y & 0xFFFFFFFF).sum(axis=0), int(y.min()), int(y.max())]
        old = found.get(d, new)
        found[d] = new if old is new else [old[0] + new[0], old[1] + new[1], old[2] + new[2], min(old[3], new[3]), max(old[4], new[4])]
    rows = [{"d": d, "n": n, "upper": u, "lower": v, "low": low, "high": high} for d, (n, u, v, low, high) in found.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("d", pa.int32()), ("n", pa.int64()), ("upper", pa.list_(pa.int64())), ("lower", pa.list_(pa.int64())), ("low", pa.int64()), ("high", pa.int64())]))


def _residues(batches: Iterator[pa.RecordBatch], scale: float, fits: dict[int, Fit], by: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """A row per length and prime: the upper triangle of this task's sum of z z' modulo the prime."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for d, y, _ in _blocks(batches, scale):
        for p in by[d]:
            z = (y % p * (fits[d].n % p) - np.array([s % p for s in fits[d].total])) % p
            z = np.where(z > p // 2, z - p, z).astype(np.float64)
            sums[d, p] = (sums.get((d, p), 0) + (z.T @ z).astype(np.int64)) % p
    rows = [{"d": d, "prime": p, "sums": s[np.triu_indices(d)]} for (d, p), s in sums.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("d", pa.int32()), ("prime", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def _deviations(y: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """x - S / n, each rounded once, and the exact sums of (n x - S)^2 (as Python's whole numbers where a long could overflow)."""
    if fit.reach < 2**53 and fit.n * max(-fit.low, fit.high) < 2**62 and len(fit.total) * fit.reach**2 < 2**63:
        z = y * fit.n - np.array(fit.total, np.int64)
        return z / fit.n, (z * z).sum(axis=1)
    z = y.astype(object) * fit.n - np.array(fit.total, object)
    return (z / fit.n).astype(np.float64), (z * z).sum(axis=1)


def _moments(batches: Iterator[pa.RecordBatch], scale: float, fits: dict[int, Fit], axes: dict[int, Axes]) -> Iterator[pa.RecordBatch]:
    """A row per length: sums of whitened values, and of their products (upper triangle)."""
    sums: dict[int, list] = {}
    for d, y, _ in _blocks(batches, scale):
        w = _deviations(y, fits[d])[0] @ axes[d].components
        old = sums.get(d, [0, 0])
        sums[d] = [old[0] + w.sum(axis=0), old[1] + w.T @ w]
    rows = [{"d": d, "sums": np.append(s, p[np.triu_indices(len(s))])} for d, (s, p) in sums.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("d", pa.int32()), ("sums", pa.list_(pa.float64()))]))


_OUT = pa.schema([("key", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()), ("deviation_exact", pa.decimal128(38, 0))])


def _whiten(batches: Iterator[pa.RecordBatch], scale: float, fits: dict[int, Fit], axes: dict[int, Axes], errors: dict[int, float | None]) -> Iterator[pa.RecordBatch]:
    """A row per vector and component."""
    for d, y, keys in _blocks(batches, scale):
        centred, far = _deviations(y, fits[d])
        w = centred @ axes[d].components
        k = w.shape[1]
        each = pa.array(np.repeat(np.arange(len(y)), k))
        far = [int(f) for f in far]
        told = pa.array([f if f < 2**63 else None for f in far], pa.int64())
        exact = pa.array([f if f < 10**38 else None for f in far], pa.decimal128(38, 0))
        number = lambda x: pa.array(x, pa.float64(), mask=np.isnan(x))
        component = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y)))
        n, error = pa.array(np.full(len(y) * k, fits[d].n)), pa.array([errors[d]] * (len(y) * k), pa.float64())
        yield pa.RecordBatch.from_arrays([keys.take(each), component, n, told.take(each), number(w.ravel()), number(np.tile(axes[d].explained, len(y))), error, exact.take(each)], schema=_OUT)


def _axes(scatter: np.ndarray, n: int, most: int) -> Axes:
    """From the exact scatter (objects): eigenvectors by falling eigenvalue. An eigenvalue within rounding of 0 has no direction of its own."""
    d, cube = len(scatter), n**3
    covariance = np.array([[t / cube for t in row] for row in scatter], np.float64)
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    trace = sum(int(scatter[i, i]) for i in range(d)) / cube
    sound = (e > d * np.finfo(float).eps * max(e[0], 0)) & (e > 0)
    root = np.sqrt(np.where(sound, e, np.nan))
    return Axes(u / root, np.where(trace > 0, np.maximum(e, 0) / (trace or 1), np.nan))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64, most: int = 32) -> DataFrame:
    """A row per remaining row of ``vectors`` and component (numbered from 1, ``most`` at most): key, component, n, deviation, whitened, explained,
    identity_error, deviation_exact.

    Rows whose vector is null or holds a null or non-finite entry go; an empty vector has no components. An entry c becomes x = floor(scale c) + 1000000
    (scaled entries are held within 2^62). Vectors of each length are fitted by themselves. n: vectors of the fit; deviation: exact sum of (n x - S)^2,
    null where it is beyond a long, deviation_exact the same as a decimal of 38 digits; whitened: (x - S / n) on the unit eigenvector, over the root of its
    eigenvalue e, null where e is zero within rounding (as of one vector alone, or of equal ones); explained: e over the trace, null where that is 0;
    identity_error: largest entry of the whitened values' covariance less the identity, measured on the values (null if none has a value).
    Null keys and repeated rows keep their rows and count each; other columns are not read. No rows give none.

    Every pass is one scan: tasks send sums per dimension, per pair of dimensions and prime, and per pair of components; these are summed with
    partial sums before the shuffle, and only a matrix (d by d) per length of vectors comes to the driver, however many rows there are."""
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where((F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    fits = _fits(rows, scale)
    scatters = _scatters(rows, scale, fits)
    axes = {d: _axes(t, fits[d].n, most) for d, t in scatters.items()}
    errors = _identity_errors(rows, scale, fits, axes)
    schema = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    return rows.mapInArrow(partial(_whiten, scale=scale, fits=fits, axes=axes, errors=errors), schema).withColumnRenamed("key", key)


def _fits(rows: DataFrame, scale: float) -> dict[int, Fit]:
    each = rows.mapInArrow(partial(_survey, scale=scale), "d int, n long, upper array<long>, lower array<long>, low long, high long")
    each = each.select("d", "n", "low", "high", F.posexplode(F.arrays_zip("upper", "lower")).alias("at", "part"))
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sums = each.groupBy("d", "at").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), whole("part.upper").alias("upper"), whole("part.lower").alias("lower"))
    found: dict[int, dict[int, object]] = {}
    for x in sums.collect():
        found.setdefault(x["d"], {})[x["at"]] = x
    return {d: Fit(at[0]["n"], tuple((int(at[i]["upper"]) << 32) + int(at[i]["lower"]) for i in range(d)), at[0]["low"], at[0]["high"]) for d, at in found.items()}


def _scatters(rows: DataFrame, scale: float, fits: dict[int, Fit]) -> dict[int, np.ndarray]:
    by = {d: primes(f.n * f.reach**2) for d, f in fits.items()}
    each = rows.mapInArrow(partial(_residues, scale=scale, fits=fits, by=by), "d int, prime long, sums array<long>").select("d", "prime", F.posexplode("sums").alias("at", "residue"))
    sums = each.groupBy("d", "prime", "at").agg(F.pmod(F.sum("residue"), F.col("prime")).alias("residue")).toArrow()
    d_of, p_of, at, residue = (np.asarray(sums[c].combine_chunks()) if len(sums) else np.zeros(0, np.int64) for c in ("d", "prime", "at", "residue"))
    out = {}
    for d in fits:
        parts = {}
        for p in by[d]:
            own = (d_of == d) & (p_of == p)
            parts[p] = np.zeros(d * (d + 1) // 2, np.int64)
            parts[p][at[own]] = residue[own]
        out[d] = np.zeros((d, d), object)
        if parts:
            upper = np.triu_indices(d)
            out[d][upper] = remainder(parts)
            out[d].T[upper] = out[d][upper]
    return out


def _identity_errors(rows: DataFrame, scale: float, fits: dict[int, Fit], axes: dict[int, Axes]) -> dict[int, float | None]:
    each = rows.mapInArrow(partial(_moments, scale=scale, fits=fits, axes=axes), "d int, sums array<double>").select("d", F.posexplode("sums").alias("at", "part"))
    found: dict[int, dict[int, float]] = {}
    for x in each.groupBy("d", "at").agg(F.sum("part").alias("sum")).collect():
        found.setdefault(x["d"], {})[x["at"]] = x["sum"]
    out: dict[int, float | None] = {}
    for d, parts in found.items():
        k = axes[d].components.shape[1]
        sums = np.array([parts[i] for i in range(len(parts))]) / fits[d].n
        i, j = np.triu_indices(k)
        off = np.abs(sums[k:] - sums[i] * sums[j] - (i == j))
        out[d] = float(np.nanmax(off)) if (~np.isnan(off)).any() else None
    return out
