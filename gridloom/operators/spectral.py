"""Spectral fields: vorticity/divergence -> wind, synthesis to a grid (MET-9, MET-10, WN-4).

A field is one row with arrays of coefficients in the archive's m-major order (for m in
0..T, for n in m..T).  Both transforms work on whole arrays inside one Arrow-batched UDF each:
no field is taken apart, so there is no window and no shuffle, and fields (time steps x levels x
variables) are what runs in parallel.  Forms that take and give rows ``(keys, n, m, ...)``
pack them first, which is one aggregation.

Memory of a task at T639 with 640 latitudes, for each field of the Arrow batch (whose bytes Spark
bounds): 3.3 MB of coefficients, 6.6 MB of Fourier coefficients, 4.3 MB of grid values; beside
that one Legendre matrix, at most 1.6 MB.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from .layout import dense_entries


def spectral_index(spark: SparkSession, truncation: int) -> DataFrame:
    """(idx, n, m) in the archive's m-major order: for m in 0..T, for n in m..T."""
    t = truncation
    m = spark.range(t + 1).select(F.col("id").cast("int").alias("m"))
    nm = m.select("m", F.explode(F.sequence(F.col("m"), F.lit(t))).alias("n"))
    start = F.col("m") * F.lit(t + 1) - (F.col("m") * (F.col("m") - 1) / 2).cast("int")
    return nm.select((start + F.col("n") - F.col("m")).cast("int").alias("idx"), "n", "m")


def coefficients(truncation: int) -> int:
    """Number of coefficients of a field."""
    return (truncation + 1) * (truncation + 2) // 2


def _order(truncation: int) -> tuple[np.ndarray, np.ndarray]:
    """n and m of each array position."""
    m = np.repeat(np.arange(truncation + 1), np.arange(truncation + 1, 0, -1))
    first = np.cumsum(np.concatenate(([0], np.arange(truncation + 1, 0, -1))))
    return m + np.arange(len(m)) - first[m], m


def position(truncation: int, n="n", m="m") -> Column:
    """Array position of coefficient (n, m)."""
    return (F.col(m) * F.lit(truncation + 1) - F.col(m) * (F.col(m) - 1) / 2 + F.col(n) - F.col(m)).cast("int")


def pack(df: DataFrame, keys: Sequence[str], values: Sequence[str], truncation: int) -> DataFrame:
    """Rows (keys, n, m, values) -> one row a field, an array for each of ``values``; a
    coefficient without a row is zero.  One aggregation: a group is one field, bounded by the
    truncation, and the only shuffle between coefficients and grid."""
    own = F.struct(*[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values])
    zero = F.struct(*[F.lit(0.0).alias(v) for v in values])
    rows = df.where(F.col("m").between(0, F.col("n")) & (F.col("n") <= truncation))
    packed = rows.groupBy(*keys).agg(F.collect_list(F.struct(position(truncation).alias("k"), own.alias("v"))).alias("_e"))
    cells = packed.select(*keys, dense_entries("_e", coefficients(truncation), zero, "field").alias("_e"))

    def aligned(v: str) -> Column:
        return F.transform("_e", lambda e: e["v"][v]).alias(v)
    return cells.select(*keys, *[aligned(v) for v in values])


def unpack(df: DataFrame, keys: Sequence[str], values: Sequence[str], truncation: int) -> DataFrame:
    """One row a field -> rows (keys, n, m, values)."""
    flat = df.select(*keys, F.posexplode(F.arrays_zip(*values)).alias("_i", "_v"))
    # m of a position: the largest m whose first position is not beyond it
    t = 2 * truncation + 3
    m = F.floor((F.lit(t) - F.sqrt(F.lit(float(t * t)) - 8 * F.col("_i"))) / 2 + F.lit(1e-9)).cast("int")
    flat = flat.withColumn("m", m)
    n = F.col("_i") - (F.col("m") * F.lit(truncation + 1) - F.col("m") * (F.col("m") - 1) / 2).cast("int") + F.col("m")
    return flat.select(*keys, n.cast("int").alias("n"), "m", *[F.col(f"_v.{v}").alias(v) for v in values])


def vd2uv_fields(df: DataFrame, truncation: int, radius: float = fixed.EARTH_RADIUS) -> DataFrame:
    """MET-9 on arrays: adds u_re, u_im, v_re, v_im, the spectral (U, V) = (u cos(lat), v cos(lat)),
    to rows with vo_re, vo_im, d_re, d_im.

    psi = -a^2 / (n (n+1)) zeta,  chi = -a^2 / (n (n+1)) D   (n >= 1)
    U = (1/a) [ i m chi + (n-1) eps_n psi_{n-1} - (n+2) eps_{n+1} psi_{n+1} ]
    V = (1/a) [ i m psi - (n-1) eps_n chi_{n-1} + (n+2) eps_{n+1} chi_{n+1} ]
    eps_n = sqrt((n^2 - m^2) / (4 n^2 - 1)).

    The neighbours n-1 and n+1 of one m stand beside a coefficient in the array; factors (zero
    where there is no such neighbour) are made once a task.  A missing coefficient counts as zero;
    a field that lacks one of its arrays is missing.
    """
    a, size = float(radius), coefficients(truncation)
    n, m = _order(truncation)
    names = ("u_re", "u_im", "v_re", "v_im")

    @F.pandas_udf(", ".join(f"{x} array<double>" for x in names))
    def wind(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        nn, mm = n.astype(float), m.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            inverse = np.where(n > 0, -a * a / (nn * (nn + 1.0)), 0.0)
        eps = lambda k: np.where(k > mm, np.sqrt(np.maximum(k * k - mm * mm, 0.0) / (4.0 * k * k - 1.0)), 0.0)
        below = (nn - 1.0) * eps(nn) / a                         # zero at n = m, the first of its m
        above = np.where(n < truncation, (nn + 2.0) * eps(nn + 1.0), 0.0) / a
        mm = mm / a

        def down(x):
            return np.concatenate(([0.0], x[:-1]))

        def up(x):
            return np.concatenate((x[1:], [0.0]))

        for batch in parts:
            out: list = []
            for row in zip(*batch):
                if any(x is None for x in row):
                    out.append((None,) * 4)
                    continue
                field = [np.nan_to_num(np.asarray(x, dtype=float)) * inverse if len(x) == size else None for x in row]
                if any(x is None for x in field):
                    raise ValueError(f"a field of truncation {truncation} has {size} coefficients")
                psi_re, psi_im, chi_re, chi_im = field
                out.append((-mm * chi_im + below * down(psi_re) - above * up(psi_re),
                            mm * chi_re + below * down(psi_im) - above * up(psi_im),
                            -mm * psi_im - below * down(chi_re) + above * up(chi_re),
                            mm * psi_re - below * down(chi_im) + above * up(chi_im)))
            yield pd.DataFrame(out, columns=list(names), dtype=object)

    added = df.withColumn("_uv", wind("vo_re", "vo_im", "d_re", "d_im"))
    return added.select(*df.columns, *[F.col(f"_uv.{x}").alias(x) for x in names])


def vd2uv(df: DataFrame, keys: Sequence[str], radius: float = fixed.EARTH_RADIUS, truncation: int | None = None) -> DataFrame:
    """MET-9 on rows (keys, n, m, vo_re, vo_im, d_re, d_im): rows of the (n, m) that came in.
    ``truncation`` spares a pass for the largest n."""
    t = truncation if truncation is not None else df.agg(F.max("n")).first()[0] or 0
    parts = ["vo_re", "vo_im", "d_re", "d_im"]
    known = F.lit(1.0).alias("known")
    packed = pack(df.select(*keys, "n", "m", *parts, known), keys, [*parts, "known"], t)
    out = ["u_re", "u_im", "v_re", "v_im"]
    return unpack(vd2uv_fields(packed, t, radius), keys, [*out, "known"], t).where("known = 1").select(*keys, "n", "m", *out)


def _legendre(truncation: int, mu: np.ndarray) -> Iterator[np.ndarray]:
    """The matrices of :func:`legendre_matrix` for m = 0..T, one after the other."""
    s = np.sqrt(np.clip(1.0 - mu * mu, 0.0, None))
    pmm = np.ones_like(mu)
    for m in range(truncation + 1):
        if m:
            pmm = pmm * s * np.sqrt((2.0 * m + 1.0) / (2.0 * m))
        yield _legendre_of(truncation, m, mu, pmm)


def _legendre_of(t: int, m: int, mu: np.ndarray, pmm: np.ndarray) -> np.ndarray:
    out = np.zeros((t - m + 1, mu.size))
    out[0] = pmm
    if m + 1 <= t:
        out[1] = mu * np.sqrt(2.0 * m + 3.0) * pmm
    for n in range(m + 2, t + 1):
        a = np.sqrt((4.0 * n * n - 1.0) / (n * n - m * m))
        b = np.sqrt(((n - 1.0) ** 2 - m * m) / (4.0 * (n - 1.0) ** 2 - 1.0))
        out[n - m] = a * (mu * out[n - m - 1] - b * out[n - m - 2])
    return out


def legendre_matrix(truncation: int, m: int, mu: np.ndarray) -> np.ndarray:
    """P(n, m)(mu) for n = m..T (rows) at every latitude (columns), by the
    standard stable recurrences; integral of P^2 over [-1, 1] is 2."""
    mu = np.asarray(mu, float)
    s = np.sqrt(np.clip(1.0 - mu * mu, 0.0, None))
    pmm = np.ones_like(mu)
    for k in range(1, m + 1):
        pmm = pmm * s * np.sqrt((2.0 * k + 1.0) / (2.0 * k))
    return _legendre_of(truncation, m, mu, pmm)


FIELDS_AT_ONCE = 16          # fields that share the Legendre matrices of a pass


def synthesise_fields(fields: DataFrame, re: str, im: str, latitudes: Sequence[float], n_lon, truncation: int,
                      scale: Sequence[float] | None = None, out: str = "values") -> DataFrame:
    """MET-10 on arrays: adds ``out``, the grid values f(lat, lon) = sum_m sum_n P(n,m)(mu) c_nm
    e^{i m lon} (real part, m > 0 counted twice) of each row's coefficients, ring after ring
    in the order of ``latitudes`` (degrees).

    ``n_lon`` is one number for a regular grid, or one per latitude for a reduced Gaussian
    grid (e.g. ``regrid.reduced_gaussian_grid``); a ring of N points takes the wavenumbers below
    N / 2.  ``scale`` is a factor per latitude (1 / cos(lat) turns U into u).

    Latitudes that mirror each other share the Legendre values: P(n,m)(-mu) = (-1)^(n-m)
    P(n,m)(mu), so sums over even and odd n - m give both.  The matrices are made anew for each run of
    ``FIELDS_AT_ONCE`` fields, never kept.  A missing coefficient counts as zero; a field without
    coefficients is missing.
    """
    lats = np.asarray(latitudes, float)
    counts = np.full(len(lats), int(n_lon)) if np.isscalar(n_lon) else np.asarray(n_lon, dtype=int)
    if len(counts) != len(lats) or not len(lats):
        raise ValueError(f"{len(counts)} ring sizes for {len(lats)} latitudes")
    factor = np.ones(len(lats)) if scale is None else np.asarray(scale, float)
    half, which = np.unique(np.abs(lats), return_inverse=True)
    size = coefficients(truncation)

    def grid(rows: list[np.ndarray]) -> list[np.ndarray]:
        c = np.stack(rows)                                       # field x coefficient
        waves = np.empty((len(rows), len(lats), truncation + 1), dtype=complex)
        sign = np.where(lats < 0, -1.0, 1.0)
        at = 0
        for m, p in enumerate(_legendre(truncation, np.sin(np.radians(half)))):
            own = c[:, at:at + len(p)]
            at += len(p)
            even, odd = own[:, 0::2] @ p[0::2], own[:, 1::2] @ p[1::2]
            waves[:, :, m] = even[:, which] + sign * odd[:, which]
        done = []
        for f in waves:
            rings = []
            for lat, n in enumerate(counts):
                kept = min(truncation + 1, (n + 1) // 2)         # a ring resolves no shorter waves
                # irfft gives (1/N)(c_0 + 2 Re sum c_m e^{i m lon}); scale back by N
                spec = np.zeros(n // 2 + 1, dtype=complex)
                spec[:kept] = f[lat, :kept]
                rings.append(np.fft.irfft(spec, n=n) * (n * factor[lat]))
            done.append(np.concatenate(rings))
        return done

    @F.pandas_udf("array<double>")
    def synthesis(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            result: list = [None] * len(a)
            have = [i for i in range(len(a)) if a.iloc[i] is not None and b.iloc[i] is not None]
            for k in range(0, len(have), FIELDS_AT_ONCE):
                run = have[k:k + FIELDS_AT_ONCE]
                rows = [np.nan_to_num(np.asarray(a.iloc[i], float)) + 1j * np.nan_to_num(np.asarray(b.iloc[i], float)) for i in run]
                if any(len(r) != size for r in rows):
                    raise ValueError(f"a field of truncation {truncation} has {size} coefficients")
                for i, values in zip(run, grid(rows)):
                    result[i] = values
            yield pd.Series(result, dtype=object)

    return fields.withColumn(out, synthesis(re, im))


def synthesise(coeffs: DataFrame, keys: Sequence[str], latitudes: Sequence[float], n_lon,
               truncation: int | None = None) -> DataFrame:
    """MET-10 on rows (keys, n, m, re, im): rows (keys, lat_idx, lon_idx, value).  Coefficients are
    packed in one aggregation, see :func:`synthesise_fields`."""
    t = truncation if truncation is not None else coeffs.agg(F.max("n")).first()[0] or 0
    counts = [int(n_lon)] * len(latitudes) if np.isscalar(n_lon) else [int(x) for x in n_lon]
    packed = pack(coeffs.select(*keys, "n", "m", "re", "im"), keys, ["re", "im"], t)
    grid = synthesise_fields(packed, "re", "im", latitudes, counts, t)
    first = np.concatenate(([0], np.cumsum(counts)[:-1])).tolist()
    ring = F.inline(F.array(*[F.struct(F.lit(i).alias("lat_idx"), F.lit(f).alias("_f"), F.lit(n).alias("_n"))
                              for i, (f, n) in enumerate(zip(first, counts))]))
    rows = grid.select(*keys, "values", ring)
    return rows.select(*keys, "lat_idx", F.posexplode(F.slice("values", F.col("_f") + 1, F.col("_n"))).alias("lon_idx", "value"))
