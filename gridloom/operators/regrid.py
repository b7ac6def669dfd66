"""Horizontal regridding and point / line sampling (MET-11, MET-12, MET-17, JN-12).

Interpolation is a sparse linear map: a weights table (src, dst, w) joined to
the field on the source cell, then ``groupBy(dst).agg(sum(w v) / sum(w))``
over the present sources (NULL-aware renormalisation).  In the row layout Spark
broadcasts the weights when their size in bytes allows and else shuffles.  Whole fields
in the chunk layout need neither: :func:`gaussian_to_regular` maps array to array.

Point sampling needs no theta join: the four neighbours of a point follow
from index arithmetic on a regular grid, so sampling is an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def apply_weights(field: DataFrame, weights: DataFrame, keys: Sequence[str], src: str, dst: str,
                  values: Sequence[str]) -> DataFrame:
    """Linear map of ``values`` from ``src`` cells to ``dst`` cells (row layout)."""
    wt = weights.select(F.col(src).alias("_src"), F.col(dst).alias("_dst"), F.col("w").alias("_w"))
    j = field.join(wt, field[src] == wt["_src"])
    aggs = []
    for v in values:
        present = F.col(v).isNotNull()
        num = F.sum(F.when(present, F.col("_w") * F.col(v)))
        den = F.sum(F.when(present, F.col("_w")))
        aggs.append(F.when(den > 0, num / den).alias(v))
    return j.groupBy(*keys, F.col("_dst").alias(dst)).agg(*aggs)


def bilinear_neighbours(points: DataFrame, point_keys: Sequence[str], n_lat: int, n_lon: int,
                        lat0: float, dlat: float, lon0: float, dlon: float,
                        lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(point keys, lat_idx, lon_idx, w): the 4 surrounding cells of each point
    on a regular grid lat = lat0 - i dlat, lon = lon0 + j dlon (longitude wraps)."""
    fi = (F.lit(lat0) - F.col(lat)) / F.lit(dlat)
    fj = F.pmod(F.col(lon) - F.lit(lon0), F.lit(360.0)) / F.lit(dlon)
    i0 = F.least(F.greatest(F.floor(fi), F.lit(0)), F.lit(n_lat - 2)).cast("int")
    j0 = F.floor(fj).cast("int")
    wi = F.least(F.greatest(fi - i0, F.lit(0.0)), F.lit(1.0))
    wj = fj - j0
    corners = F.array(*[
        F.struct((i0 + di).alias("lat_idx"), F.pmod(j0 + dj, F.lit(n_lon)).cast("int").alias("lon_idx"),
                 ((wi if di else (F.lit(1.0) - wi)) * (wj if dj else (F.lit(1.0) - wj))).alias("w"))
        for di in (0, 1) for dj in (0, 1)])
    return points.select(*point_keys, F.explode(corners).alias("_n")).select(
        *point_keys, "_n.lat_idx", "_n.lon_idx", "_n.w").where(F.col("w") > 0)


def nearest_cell(points: DataFrame, point_keys: Sequence[str], n_lat: int, n_lon: int,
                 lat0: float, dlat: float, lon0: float, dlon: float,
                 lat: str = "lat", lon: str = "lon") -> DataFrame:
    """MET-12 / JN-12: nearest grid cell of each point by index arithmetic."""
    i = F.least(F.greatest(F.round((F.lit(lat0) - F.col(lat)) / F.lit(dlat)), F.lit(0)), F.lit(n_lat - 1))
    j = F.pmod(F.round(F.pmod(F.col(lon) - F.lit(lon0), F.lit(360.0)) / F.lit(dlon)).cast("int"), F.lit(n_lon))
    return points.select(*point_keys, i.cast("int").alias("lat_idx"), j.cast("int").alias("lon_idx"))


def sample_points(field: DataFrame, neighbours: DataFrame, point_keys: Sequence[str],
                  keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Interpolate ``values`` of a (keys, lat_idx, lon_idx) field at points.

    The neighbour table (points x 4) is broadcast by Spark when its size allows — the
    usual case (a line, a station list) — so the field is not moved; otherwise both
    sides are shuffled on the cell.
    """
    j = field.join(neighbours, ["lat_idx", "lon_idx"])
    aggs = []
    for v in values:
        present = F.col(v).isNotNull()
        num = F.sum(F.when(present, F.col("w") * F.col(v)))
        den = F.sum(F.when(present, F.col("w")))
        aggs.append(F.when(den > 0, num / den).alias(v))
    return j.groupBy(*point_keys, *keys).agg(*aggs)


def line_points(spark: SparkSession, lat1: float, lon1: float, lat2: float, lon2: float, n: int) -> DataFrame:
    """n equally spaced points on the straight (lat, lon) line, ends included."""
    frac = F.col("id") / F.lit(float(n - 1))
    return spark.range(n).select(F.col("id").cast("int").alias("point_id"),
                                 (F.lit(lat1) + F.lit(lat2 - lat1) * frac).alias("lat"),
                                 (F.lit(lon1) + F.lit(lon2 - lon1) * frac).alias("lon"))


def ring_weights(spark: SparkSession, n_src: int, refine: int) -> DataFrame:
    """Weights from a ring of ``n_src`` cells to one ``refine`` times finer:
    destination d sits between sources floor(d / refine) and the next one
    (cyclic), linear weights; rows = n_src * refine * 2."""
    d = spark.range(n_src * refine).select(F.col("id").cast("int").alias("dst_cell"))
    s0 = (F.col("dst_cell") / refine).cast("int")
    f = (F.col("dst_cell") % refine) / F.lit(float(refine))
    return d.select("dst_cell", F.explode(F.array(
        F.struct(s0.alias("src_cell"), (F.lit(1.0) - f).alias("w")),
        F.struct(((s0 + 1) % n_src).alias("src_cell"), f.alias("w")))).alias("_x")).select(
        "_x.src_cell", "dst_cell", "_x.w").where(F.col("w") > 0)


# ------------------------------------------------------------------ reduced Gaussian grids
def octahedral_counts(n_half: int) -> list[int]:
    """Points per latitude of an octahedral grid: 20 + 4 i on ring i from either pole."""
    north = [20 + 4 * i for i in range(n_half)]
    return north + north[::-1]


def reduced_gaussian_grid(n_half: int, counts: Sequence[int] | None = None) -> tuple:
    """Reduced Gaussian grid with ``n_half`` latitudes per hemisphere.

    Returns (latitudes in degrees, north to south; points per latitude; index of each
    latitude's first cell).  Latitudes are the roots of the Legendre polynomial of degree
    2 n_half.  ``counts`` are the points per latitude of the grid at hand, north to south
    (an archive's own list, for its classic or regular grids; one hemisphere will do, the
    other is its mirror); without them the grid is octahedral.
    """
    x, _ = np.polynomial.legendre.leggauss(2 * n_half)
    lats = np.degrees(np.arcsin(x))[::-1]                 # north -> south
    given = list(octahedral_counts(n_half) if counts is None else counts)
    if len(given) == n_half:
        given += given[::-1]
    if len(given) != 2 * n_half or min(given) < 1:
        raise ValueError(f"{len(given)} counts given for {2 * n_half} latitudes")
    counts = np.array(given, dtype=np.int64)
    return lats, counts, np.concatenate([[0], np.cumsum(counts)[:-1]])


def _gaussian_neighbours(grid: tuple, d: np.ndarray, n_lon_dst: int, lat0: float, dlat: float) -> tuple:
    """(4, len(d)) source cells and weights of destination cells ``d`` of a regular grid."""
    return _ring_neighbours(grid, lat0 - dlat * (d // n_lon_dst), 360.0 * (d % n_lon_dst) / n_lon_dst)


def _ring_neighbours(grid: tuple, lat: np.ndarray, lon: np.ndarray) -> tuple:
    """(4, points) source cells and weights: two rings, two points on each."""
    lats, counts, offsets = grid
    # ring above (j) and below (j + 1): latitudes are descending
    j = np.searchsorted(-lats, -lat, side="right") - 1
    top, bottom = j < 0, j >= len(lats) - 1
    j0 = np.clip(j, 0, len(lats) - 1)
    j1 = np.clip(j + 1, 0, len(lats) - 1)
    span = lats[j0] - lats[j1]
    wy = np.where(top | bottom | (span == 0), np.where(top, 1.0, 0.0),
                  (lats[j0] - lat) / np.where(span == 0, 1.0, span))
    src, w = [], []
    for ring, wr in ((j0, 1.0 - wy), (j1, wy)):
        x = lon / 360.0 * counts[ring]
        i0 = np.floor(x).astype(np.int64)
        for i, wi in ((i0 % counts[ring], 1.0 - (x - i0)), ((i0 + 1) % counts[ring], x - i0)):
            src.append(offsets[ring] + i)
            w.append(wr * wi)
    return np.stack(src), np.stack(w)


def _nearest_on_rings(grid: tuple, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, great-circle distance in degrees) nearest to each point; ties to the smaller cell.

    On a ring the nearest point is the nearest in longitude.  Rings are taken outward from the
    point's latitude until their latitude alone is farther than the best found so far, so near
    a pole, where a point across it may be nearer, they are all looked at."""
    lats, counts, offsets = grid
    best, cell = np.full(len(lat), np.inf), np.full(len(lat), np.iinfo(np.int64).max)
    below = np.searchsorted(-lats, -lat, side="right")
    for s in range(len(lats)):
        busy = False
        for ring in (below - 1 - s, below + s):
            at = np.flatnonzero((ring >= 0) & (ring < len(lats)))
            at = at[np.abs(lats[ring[at]] - lat[at]) <= best[at] + 1e-9]
            if not len(at):
                continue
            busy = True
            r = ring[at]
            x = lon[at] / 360.0 * counts[r]
            for i in (np.floor(x).astype(np.int64) % counts[r], (np.floor(x).astype(np.int64) + 1) % counts[r]):
                a, b = np.radians(lats[r]), np.radians(lat[at])
                half = np.sin((a - b) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(360.0 * i / counts[r] - lon[at]) / 2) ** 2
                dist, c = np.degrees(2 * np.arcsin(np.sqrt(np.minimum(half, 1.0)))), offsets[r] + i
                better = (dist < best[at]) | ((dist == best[at]) & (c < cell[at]))
                best[at[better]], cell[at[better]] = dist[better], c[better]
        if not busy and s > 0:
            break
    return cell, best


def gaussian_point_cells(points: DataFrame, point_keys: Sequence[str], n_half: int, counts: Sequence[int] | None = None,
                         nearest: bool = False, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """JN-12 / MET-12 on a reduced Gaussian grid: (point keys, cell, w), the cells that each point is
    sampled from.  ``nearest``: the one nearest on the sphere (w = 1); otherwise up to four,
    bilinear between the two bracketing rings and the two bracketing points of each (beyond the
    outermost rings the nearest ring).  Rows stay where they are; the grid is a few arrays."""
    grid = reduced_gaussian_grid(n_half, counts)
    keys = points.select(*point_keys)
    schema = ", ".join(f"`{n}` {t}" for n, t in keys.dtypes) + ", cell long, w double"

    def find(batches):
        for pdf in batches:
            y, x = pdf["_lat"].to_numpy(float), pdf["_lon"].to_numpy(float) % 360.0
            src, w = _ring_neighbours(grid, y, x) if not nearest else (_nearest_on_rings(grid, y, x)[0][None, :], np.ones((1, len(y))))
            out = pd.concat([pdf[list(point_keys)]] * len(src), ignore_index=True)
            out["cell"], out["w"] = src.ravel(), w.ravel()
            yield out[out["w"] > 0]
    here = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return here.select(*point_keys, F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")).mapInPandas(find, schema)


def sample_cells(field: DataFrame, cells: DataFrame, point_keys: Sequence[str], keys: Sequence[str], values: Sequence[str],
                 cell: str = "cell") -> DataFrame:
    """``values`` of a (keys, cell) field at points, from :func:`gaussian_point_cells`: one equi-join
    on the cell; the weights of missing sources fall to the others."""
    j = field.join(cells.withColumnRenamed("cell", cell), cell)
    out = []
    for v in values:
        here = F.when(F.col(v).isNotNull(), F.col("w"))
        out.append((F.try_divide(F.sum(here * F.col(v)), F.sum(here))).alias(v))
    return j.groupBy(*point_keys, *keys).agg(*out)


def gaussian_to_regular_weights(spark: SparkSession, n_half: int, n_lat_dst: int, n_lon_dst: int,
                                lat0: float = 90.0, dlat: float | None = None, n_partitions: int | None = None,
                                counts: Sequence[int] | None = None) -> DataFrame:
    """MET-11 weights from a reduced Gaussian grid (``counts``: see
    :func:`reduced_gaussian_grid`) to a regular lat/lon grid (lat = lat0 - i dlat,
    lon = 360 j / n_lon): bilinear between the two bracketing latitude rings and, on each
    ring, the two bracketing points (longitude wraps; beyond the outermost rings the
    nearest ring).

    Generated by Spark, one task per block of destination cells (vectorised
    numpy searches); rows = 4 x destination cells.
    """
    grid = reduced_gaussian_grid(n_half, counts)
    dlat = (2 * lat0) / (n_lat_dst - 1) if dlat is None else dlat
    n_dst = n_lat_dst * n_lon_dst
    parts = n_partitions or max(1, min(n_dst // 200_000 + 1, 10_000))

    def gen(batches):
        for pdf in batches:
            d = pdf["dst_cell"].to_numpy()
            src, w = _gaussian_neighbours(grid, d, n_lon_dst, lat0, dlat)
            keep = w.ravel() > 0
            yield pd.DataFrame({"src_cell": src.ravel()[keep], "dst_cell": np.tile(d, 4)[keep], "w": w.ravel()[keep]})

    dst = spark.range(0, n_dst, 1, parts).select(F.col("id").alias("dst_cell"))
    return dst.mapInPandas(gen, "src_cell long, dst_cell long, w double")


DST_BLOCK = 1 << 17          # destination cells whose neighbours are held at a time


def gaussian_to_regular(fields: DataFrame, values: str, n_half: int, n_lat_dst: int, n_lon_dst: int,
                        lat0: float = 90.0, dlat: float | None = None,
                        counts: Sequence[int] | None = None) -> DataFrame:
    """MET-11 in chunk layout: each row's ``values`` (one field on the reduced Gaussian
    grid, north to south) becomes the row's field on the regular grid, row-major.

    The same weights as :func:`gaussian_to_regular_weights`, applied inside an
    Arrow-batched UDF: rows neither leave their partition nor multiply, and no weights
    table is sent.  A task keeps the neighbours of one block of destination cells at a
    time (8 MB), whatever the grid; memory beyond that is the batch of fields
    itself, so wide grids want small ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    Missing sources are left out and the weights of the others renormalised; a cell
    without any present source, or a null field, is missing.
    """
    grid = reduced_gaussian_grid(n_half, counts)
    n_src = int(grid[1].sum())
    dlat = (2 * lat0) / (n_lat_dst - 1) if dlat is None else dlat
    n_dst = n_lat_dst * n_lon_dst

    @F.pandas_udf("array<double>")
    def regridded(column: pd.Series) -> pd.Series:
        at = [i for i, v in enumerate(column) if v is not None]
        out: list = [None] * len(column)
        if not at:
            return pd.Series(out)
        rows = [np.asarray(column.iloc[i], dtype=float) for i in at]
        if any(len(r) != n_src for r in rows):
            raise ValueError(f"a field of this grid has {n_src} cells")
        done = [np.empty(n_dst) for _ in at]
        for lo in range(0, n_dst, DST_BLOCK):
            d = np.arange(lo, min(lo + DST_BLOCK, n_dst))
            src, w = _gaussian_neighbours(grid, d, n_lon_dst, lat0, dlat)
            for field, res in zip(rows, done):
                v = field[src]
                have = np.where(np.isnan(v), 0.0, w)
                den = have.sum(axis=0)
                num = (have * np.nan_to_num(v)).sum(axis=0)
                res[lo:lo + len(d)] = np.where(den > 0, num / np.where(den > 0, den, 1.0), np.nan)
        for i, res in zip(at, done):
            out[i] = res
        return pd.Series(out)

    missing = F.lit(None).cast("double")
    return fields.withColumn(values, F.transform(regridded(values), lambda x: F.nanvl(x, missing)))
