"""Parcel indices per grid column (MET-13): LCL, LFC, EL, CAPE, CIN.

The ascent is sequential in height.  Each column's levels are gathered into
arrays (one row per column, at most 137 levels — bounded by the level axis
whatever the data volume), and an Arrow-batched pandas UDF runs the ascent
for a whole batch of columns at once, vectorised across columns (the loop
is over levels only).  LFC and EL lie where buoyancy changes sign between levels.  Everything around it (pressure, dewpoint, selection)
stays in DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

LV = 2.501e6  # J kg-1, latent heat of vaporisation


def _es_water(t):
    return fixed.ES_A1 * np.exp(fixed.ES_A3_WATER * (t - fixed.T_ZERO) / (t - fixed.ES_A4_WATER))


def _mixing_ratio_sat(t, p):
    es = _es_water(t)
    return fixed.EPSILON * es / np.maximum(p - es, 1.0)


def _dewpoint(q, p):
    e = q * p / (fixed.EPSILON + (1.0 - fixed.EPSILON) * q)
    ln = np.log(np.maximum(e, 1e-10) / fixed.ES_A1)
    return (fixed.ES_A3_WATER * fixed.T_ZERO - fixed.ES_A4_WATER * ln) / (fixed.ES_A3_WATER - ln)


def _moist_step(t, p0, p1, n_sub: int = 8):
    """Pseudo-adiabatic temperature change from p0 to p1 (Pa), sub-stepped in ln p."""
    lp0, lp1 = np.log(p0), np.log(p1)
    h = (lp1 - lp0) / n_sub
    lp = lp0
    for _ in range(n_sub):
        p = np.exp(lp)
        rs = _mixing_ratio_sat(t, p)
        num = fixed.R_DRY * t + LV * rs
        den = fixed.CP_DRY + LV * LV * rs * fixed.EPSILON / (fixed.R_DRY * t * t)
        t = t + h * num / den
        lp += h
    return t


RESULT_FIELDS = ("lcl_p", "lcl_t", "lfc_p", "el_p", "cape", "cin")


def _pack(rows) -> tuple[np.ndarray, np.ndarray]:
    """Ragged per-column arrays -> (N, L) matrix padded with NaN, and lengths."""
    n = len(rows)
    width = max((len(r) for r in rows), default=0)
    out = np.full((n, max(width, 1)), np.nan)
    lens = np.zeros(n, dtype=int)
    for i, r in enumerate(rows):
        a = np.asarray(r, float)
        out[i, :len(a)] = a
        lens[i] = len(a)
    return out, lens


def _crossing(lnp, buoy, idx, i, j):
    """Pressure where buoyancy is zero between levels i and j, linear in ln p."""
    b0, b1 = buoy[idx, i], buoy[idx, j]
    return np.exp(lnp[idx, i] + b0 / (b0 - b1) * (lnp[idx, j] - lnp[idx, i]))


def batch_indices(ps, ts, qs, mode: str = "surface") -> dict:
    """Indices of a batch of columns, vectorised across columns.

    Rows with a missing p, t or q are dropped per column first (compacted),
    so layers always join adjacent valid levels.
    """
    rows = []
    for a, b, c in zip(ps, ts, qs):
        a, b, c = np.asarray(a, float), np.asarray(b, float), np.asarray(c, float)
        ok = ~(np.isnan(a) | np.isnan(b) | np.isnan(c))
        rows.append((a[ok], b[ok], c[ok]))
    p, lens = _pack([r[0] for r in rows])
    t, _ = _pack([r[1] for r in rows])
    q, _ = _pack([r[2] for r in rows])
    n, width = p.shape
    idx = np.arange(n)
    start = np.zeros(n, dtype=int)
    if mode == "most_unstable":
        with np.errstate(invalid="ignore", divide="ignore"):
            td = _dewpoint(q, p)
            theta_e = t * (100000.0 / p) ** (fixed.R_DRY / fixed.CP_DRY) * np.exp(
                LV * _mixing_ratio_sat(td, p) / (fixed.CP_DRY * t))
        low = p >= (p[:, :1] - 30000.0)
        start = np.argmax(np.where(low & ~np.isnan(theta_e), theta_e, -np.inf), axis=1)
    p0, t0, q0 = p[idx, start], t[idx, start], q[idx, start]
    with np.errstate(invalid="ignore", divide="ignore"):
        td0 = np.minimum(_dewpoint(q0, p0), t0)
        t_lcl = 1.0 / (1.0 / (td0 - 56.0) + np.log(t0 / td0) / 800.0) + 56.0
        p_lcl = p0 * (t_lcl / t0) ** (fixed.CP_DRY / fixed.R_DRY)
        tp = np.full_like(p, np.nan)
        prev_p, prev_t = p_lcl.copy(), t_lcl.copy()
        for i in range(width):
            active = (i >= start) & (i < lens)
            dry = active & (p[:, i] >= p_lcl)
            tp[dry, i] = t0[dry] * (p[dry, i] / p0[dry]) ** (fixed.R_DRY / fixed.CP_DRY)
            moist = active & ~dry
            if moist.any():
                new_t = _moist_step(prev_t[moist], prev_p[moist], p[moist, i])
                prev_t[moist], prev_p[moist] = new_t, p[moist, i]
                tp[moist, i] = new_t
        buoy = tp - t
        lnp = np.log(p)
        cape, cin = np.zeros(n), np.zeros(n)
        lfc, last = np.full(n, np.nan), np.full(n, -1)
        for i in range(1, width):
            valid = (i > start) & (i < lens)
            layer = fixed.R_DRY * 0.5 * (buoy[:, i] + buoy[:, i - 1]) * (lnp[:, i - 1] - lnp[:, i])
            pos = valid & (p[:, i] <= p_lcl) & (buoy[:, i] > 0)
            # buoyant from where buoyancy changes sign, but not below the LCL
            base = np.where(buoy[:, i - 1] <= 0, np.minimum(_crossing(lnp, buoy, idx, i - 1, i), p_lcl), p_lcl)
            lfc = np.where(pos & np.isnan(lfc), base, lfc)
            last = np.where(pos, i, last)
            has_lfc = ~np.isnan(lfc)
            cape += np.where(valid & (layer > 0) & has_lfc, layer, 0.0)
            cin += np.where(valid & (layer < 0) & ~has_lfc, layer, 0.0)
        # buoyant up to where buoyancy changes sign above the last buoyant level; to that level at the top
        above = np.minimum(last + 1, width - 1)
        el = np.where(last + 1 < lens, _crossing(lnp, buoy, idx, last, above), p[idx, last])
        el[last < 0] = np.nan
    short = lens < 2
    for arr in (t_lcl, p_lcl, lfc, el):
        arr[short] = np.nan
    cape[short] = 0.0
    cin[short] = 0.0
    return {"lcl_p": p_lcl, "lcl_t": t_lcl, "lfc_p": lfc, "el_p": el, "cape": cape, "cin": cin}


def parcel_indices(levels: DataFrame, keys: Sequence[str], level: str = "k", p: str = "p", t: str = "t",
                   q: str = "q", mode: str = "surface") -> DataFrame:
    """MET-13 over every column of the grid.

    Each column's levels are gathered into arrays ordered from the surface up
    (``collect_list`` of at most one column of levels, after a map-side
    partial aggregation), then one Arrow-batched pandas UDF runs the ascent
    for a whole batch of columns — no per-group Python round trip.
    """
    key_list = list(keys)
    schema = ", ".join(f"{c} double" for c in RESULT_FIELDS)

    @F.pandas_udf(schema)
    def ascent(ps: pd.Series, ts: pd.Series, qs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(batch_indices(list(ps), list(ts), list(qs), mode), columns=list(RESULT_FIELDS))

    prof = F.sort_array(F.collect_list(F.struct(F.col(p).alias("p"), F.col(t).alias("t"), F.col(q).alias("q"))),
                        asc=False)
    cols = levels.groupBy(*key_list).agg(prof.alias("_c"))
    res = cols.select(*key_list, ascent(F.transform("_c", lambda x: x["p"]), F.transform("_c", lambda x: x["t"]),
                                        F.transform("_c", lambda x: x["q"])).alias("_r"))
    return res.select(*key_list, *[F.col(f"_r.{c}").alias(c) for c in RESULT_FIELDS])
