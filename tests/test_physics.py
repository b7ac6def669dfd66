"""Closed-form cases for the meteorological operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import fixed
from gridloom.operators import met, parcel, regrid, spectral, vertical


def test_isothermal_dry_column_is_hypsometric(spark):
    n, t0, ps = 10, 250.0, 100000.0
    levels = spark.createDataFrame([(0, k, t0, 0.0) for k in range(1, n + 1)], "cell int, k int, t double, q double")
    surface = spark.createDataFrame([(0, math.log(ps), 0.0)], "cell int, lnsp double, zs double")
    p = met.full_level_pressure(levels, surface, met.hybrid_coefficients(spark, n), keys=["cell"])
    g = met.geopotential_on_levels(p, keys=["cell"]).orderBy("k").collect()
    for r in g:
        expected_half = fixed.R_DRY * t0 * math.log(ps / r["p_below"])
        assert r["z_half"] == pytest.approx(expected_half, rel=1e-12, abs=1e-9)
        assert r["z"] > r["z_half"]
    # the bottom half level is the surface
    assert g[-1]["z_half"] == pytest.approx(0.0, abs=1e-9)


def test_relative_humidity_is_100_at_saturation(spark):
    t, p = 280.0, 90000.0
    es = fixed.ES_A1 * math.exp(fixed.ES_A3_WATER * (t - fixed.T_ZERO) / (t - fixed.ES_A4_WATER))
    eps = fixed.EPSILON
    q = eps * es / (p - (1 - eps) * es)          # specific humidity at saturation
    df = spark.createDataFrame([(t, q, p)], "t double, q double, p double")
    r = df.select(met.relative_humidity("t", "q", "p").alias("rh"), met.dewpoint("q", "p").alias("td")).first()
    assert r["rh"] == pytest.approx(100.0, rel=1e-9)
    assert r["td"] == pytest.approx(t, rel=1e-9)


def test_single_harmonic_synthesis(spark):
    # P(1,0) = sqrt(3) mu ; P(1,1) = sqrt(3/2) cos(lat); m > 0 counted twice
    co = spark.createDataFrame([(0, 1, 0, 1.0, 0.0), (0, 1, 1, 0.5, 0.0)], "f int, n int, m int, re double, im double")
    grid = spectral.synthesise(co, ["f"], [40.0, -10.0], 8).collect()
    for r in grid:
        lat = math.radians({0: 40.0, 1: -10.0}[r["lat_idx"]])
        lon = 2 * math.pi * r["lon_idx"] / 8
        expected = math.sqrt(3) * math.sin(lat) + 2 * 0.5 * math.sqrt(1.5) * math.cos(lat) * math.cos(lon)
        assert r["value"] == pytest.approx(expected, abs=1e-12)


def test_solid_body_rotation_wind(spark):
    a, u0 = fixed.EARTH_RADIUS, 10.0
    zeta10 = 2 * u0 / a / math.sqrt(3)          # vorticity of u = U cos(lat)
    rows = [(0, n, 0, zeta10 if n == 1 else 0.0, 0.0, 0.0, 0.0) for n in range(0, 4)]
    co = spark.createDataFrame(rows, "f int, n int, m int, vo_re double, vo_im double, d_re double, d_im double")
    uv = {r["n"]: r for r in spectral.vd2uv(co, ["f"]).collect()}
    assert uv[0]["u_re"] == pytest.approx(2 * u0 / 3, rel=1e-12)
    assert uv[2]["u_re"] == pytest.approx(-2 * u0 / (3 * math.sqrt(5)), rel=1e-12)
    assert uv[1]["u_re"] == pytest.approx(0.0, abs=1e-12)
    assert all(abs(r["v_re"]) < 1e-12 for r in uv.values())


def test_linear_field_bilinear_is_exact(spark):
    field = spark.createDataFrame([(i, j, 2.0 * i + 3.0 * j) for i in range(4) for j in range(6)],
                                  "lat_idx int, lon_idx int, v double")
    pts = spark.createDataFrame([(0, 70.0, 20.0), (1, -10.0, 250.0), (2, 30.0, 60.0)], "pid int, lat double, lon double")
    nb = regrid.bilinear_neighbours(pts, ["pid"], 4, 6, 90.0, 60.0, 0.0, 60.0)
    out = {r["pid"]: r["v"] for r in regrid.sample_points(field, nb, ["pid"], [], ["v"]).collect()}
    for pid, lat, lon in [(0, 70.0, 20.0), (1, -10.0, 250.0), (2, 30.0, 60.0)]:
        assert out[pid] == pytest.approx(2 * (90 - lat) / 60 + 3 * lon / 60, abs=1e-12)


def test_regrid_renormalises_missing_sources(spark):
    field = spark.createDataFrame([(0, 1.0), (1, None)], "src_cell int, value double")
    w = spark.createDataFrame([(0, 0, 0.5), (1, 0, 0.5)], "src_cell int, dst_cell int, w double")
    r = regrid.apply_weights(field, w, [], "src_cell", "dst_cell", ["value"]).first()
    assert r["value"] == 1.0


def test_log_pressure_interpolation_and_constant_extrapolation(spark):
    col = spark.createDataFrame([(0, 10000.0, 200.0), (0, 100000.0, 300.0)], "c int, p double, t double")
    tg = [10000.0, 31622.776601683792, 100000.0, 5000.0, 200000.0]
    out = {r["target"]: r["t"] for r in
           vertical.interpolate_to_targets(col, ["c"], "p", tg, ["t"], log=True, extrapolate=("t",)).collect()}
    assert out[31622.776601683792] == pytest.approx(250.0, abs=1e-9)
    assert out[10000.0] == 200.0 and out[100000.0] == 300.0
    assert out[5000.0] == 200.0 and out[200000.0] == 300.0


def test_hodograph_edge_point_added_once(spark):
    rows = [(0, k, p, float(k), -float(k)) for k, p in enumerate([100.0, 250.0, 400.0, 600.0, 800.0, 950.0], 1)]
    df = spark.createDataFrame(rows, "c int, k int, p double, u double, v double")
    out = vertical.hodograph_bins(df, ["c"], "k", "p", "u", "v", list(fixed.HODOGRAPH_BINS)).collect()
    edges = [r for r in out if r["is_edge"]]
    # bins 700-500 (600), 500-300 (400), 300-200 (250), 200-50 (100) each get the next level once
    assert sorted((r["bin_bottom"], r["k"]) for r in edges) == [(200.0, 2), (300.0, 3), (500.0, 4), (700.0, 5)]


def column_indices(p: np.ndarray, t: np.ndarray, q: np.ndarray, mode: str = "surface") -> dict:
    """Indices of one column; arrays ordered from the surface upwards."""
    ok = ~(np.isnan(p) | np.isnan(t) | np.isnan(q))
    p, t, q = p[ok], t[ok], q[ok]
    out = dict(lcl_p=np.nan, lcl_t=np.nan, lfc_p=np.nan, el_p=np.nan, cape=0.0, cin=0.0)
    if len(p) < 2:
        return out
    start = 0
    if mode == "most_unstable":
        low = p >= p[0] - 30000.0
        td = parcel._dewpoint(q, p)
        theta_e = t * (100000.0 / p) ** (fixed.R_DRY / fixed.CP_DRY) * np.exp(
            parcel.LV * parcel._mixing_ratio_sat(td, p) / (fixed.CP_DRY * t))
        start = int(np.argmax(np.where(low, theta_e, -np.inf)))
    p0, t0, q0 = p[start], t[start], q[start]
    td0 = min(parcel._dewpoint(q0, p0), t0)
    t_lcl = 1.0 / (1.0 / (td0 - 56.0) + np.log(t0 / td0) / 800.0) + 56.0
    p_lcl = p0 * (t_lcl / t0) ** (fixed.CP_DRY / fixed.R_DRY)
    out["lcl_p"], out["lcl_t"] = float(p_lcl), float(t_lcl)
    tp = np.full(len(p), np.nan)
    prev_p, prev_t = p_lcl, t_lcl
    for i in range(start, len(p)):
        if p[i] >= p_lcl:
            tp[i] = t0 * (p[i] / p0) ** (fixed.R_DRY / fixed.CP_DRY)
        else:
            prev_t = parcel._moist_step(prev_t, prev_p, p[i])
            prev_p = p[i]
            tp[i] = prev_t
    buoy = tp - t
    lnp = np.log(p)
    cape = cin = 0.0
    lfc = el = np.nan
    for i in range(start + 1, len(p)):
        b = 0.5 * (buoy[i] + buoy[i - 1])
        layer = fixed.R_DRY * b * (lnp[i - 1] - lnp[i])
        if p[i] <= p_lcl and buoy[i] > 0:
            zero = lambda j: np.exp(lnp[j] + buoy[j] / (buoy[j] - buoy[j + 1]) * (lnp[j + 1] - lnp[j]))
            if np.isnan(lfc):
                lfc = min(zero(i - 1), p_lcl) if buoy[i - 1] <= 0 else p_lcl
            el = zero(i) if i + 1 < len(p) and buoy[i + 1] <= 0 else p[i]
        if layer > 0 and not np.isnan(lfc):
            cape += layer
        elif layer < 0 and np.isnan(lfc):
            cin += layer
    out.update(lfc_p=float(lfc), el_p=float(el), cape=float(cape), cin=float(cin))
    return out


def test_parcel_indices_unstable_column(spark):
    p = np.array([100000.0, 90000.0, 80000.0, 70000.0, 50000.0, 30000.0])
    t = np.array([303.0, 293.0, 286.0, 280.0, 262.0, 235.0])
    q = np.array([0.018, 0.012, 0.008, 0.004, 0.001, 0.0001])
    r = column_indices(p, t, q)
    assert 85000 < r["lcl_p"] < 100000
    assert r["cape"] > 0
    assert r["cin"] <= 0


def test_vectorised_ascent_matches_single_column():
    from gridloom.operators.parcel import batch_indices
    rng = np.random.default_rng(7)
    cols = []
    for _ in range(20):
        p = np.sort(rng.uniform(20000, 101000, 9))[::-1]
        t = 300 - (101000 - p) / 1000 * rng.uniform(0.5, 0.9) + rng.normal(0, 1, 9)
        q = np.clip(0.02 * (p / 101000) ** 3 * rng.uniform(0.2, 1.0, 9), 0, None)
        if rng.random() < 0.3:
            t[3] = np.nan
        cols.append((p, t, q))
    for mode in ("surface", "most_unstable"):
        b = batch_indices([c[0] for c in cols], [c[1] for c in cols], [c[2] for c in cols], mode)
        for i, (p, t, q) in enumerate(cols):
            one = column_indices(p, t, q, mode)
            for k, v in one.items():
                assert np.allclose(b[k][i], v, equal_nan=True, rtol=1e-9, atol=1e-9), (mode, i, k)


def test_legendre_normalisation():
    import numpy as np
    x, w = np.polynomial.legendre.leggauss(40)
    for m in range(0, 6):
        pm = spectral.legendre_matrix(8, m, x)
        gram = (pm * w) @ pm.T
        assert np.allclose(gram, 2 * np.eye(pm.shape[0]), atol=1e-10)


def test_gaussian_to_regular_weights(spark):
    import numpy as np
    lats, counts, offsets = regrid.reduced_gaussian_grid(8)
    assert counts.sum() == 2 * sum(20 + 4 * i for i in range(8))
    w = regrid.gaussian_to_regular_weights(spark, 8, 19, 36)
    sums = {r["dst_cell"]: r["s"] for r in w.groupBy("dst_cell").agg(F.sum("w").alias("s")).collect()}
    assert len(sums) == 19 * 36 and all(abs(s - 1) < 1e-12 for s in sums.values())
    # a field linear in latitude (inside the outermost rings) is reproduced exactly
    src_lat = np.repeat(lats, counts)
    field = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(src_lat)], "src_cell long, value double")
    out = regrid.apply_weights(field, w, [], "src_cell", "dst_cell", ["value"]).collect()
    for r in out:
        lat = 90.0 - 10.0 * (r["dst_cell"] // 36)
        if lats[-1] <= lat <= lats[0]:
            assert r["value"] == pytest.approx(lat, abs=1e-9)


def test_synthesis_on_reduced_gaussian_grid(spark):
    import numpy as np
    lats, counts, _ = regrid.reduced_gaussian_grid(3)
    co = spark.createDataFrame([(0, 1, 1, 0.5, 0.0)], "f int, n int, m int, re double, im double")
    grid = spectral.synthesise(co, ["f"], list(lats), list(counts), truncation=2).collect()
    assert len(grid) == counts.sum()
    for r in grid:
        lat = math.radians(lats[r["lat_idx"]])
        lon = 2 * math.pi * r["lon_idx"] / counts[r["lat_idx"]]
        assert r["value"] == pytest.approx(2 * 0.5 * math.sqrt(1.5) * math.cos(lat) * math.cos(lon), abs=1e-12)


def test_spectral_wind_chain_solid_body(spark):
    """vorticity (spectral) -> U = u cos(lat) (MET-9) -> reduced Gaussian grid (MET-10)
    -> regular lat/lon grid (MET-11): u = U0 cos(lat) everywhere."""
    import numpy as np
    a, u0 = fixed.EARTH_RADIUS, 20.0
    zeta10 = 2 * u0 / a / math.sqrt(3)
    rows = [(0, n, m, zeta10 if (n, m) == (1, 0) else 0.0, 0.0, 0.0, 0.0) for m in range(4) for n in range(m, 4)]
    co = spark.createDataFrame(rows, "f int, n int, m int, vo_re double, vo_im double, d_re double, d_im double")
    uv = spectral.vd2uv(co, ["f"]).select("f", "n", "m", F.col("u_re").alias("re"), F.col("u_im").alias("im"))
    lats, counts, offsets = regrid.reduced_gaussian_grid(4)
    g = spectral.synthesise(uv, ["f"], list(lats), list(counts), truncation=3)
    cell = F.element_at(F.array(*[F.lit(int(o)) for o in offsets]), F.col("lat_idx") + 1) + F.col("lon_idx")
    big_u = g.select(cell.cast("long").alias("src_cell"), "value")
    w = regrid.gaussian_to_regular_weights(spark, 4, 7, 12)
    out = regrid.apply_weights(big_u, w, [], "src_cell", "dst_cell", ["value"]).collect()
    for r in out:
        lat = 90.0 - 30.0 * (r["dst_cell"] // 12)
        if lats[-1] <= lat <= lats[0]:
            # U is exact on the Gaussian rings; between rings the linear
            # interpolation of cos^2 leaves a small, bounded error
            assert abs(r["value"] - u0 * math.cos(math.radians(lat)) ** 2) < 0.05 * u0
    on_rings = {rr["src_cell"]: rr["value"] for rr in big_u.collect()}
    for j, lat in enumerate(lats):
        for i in range(counts[j]):
            assert on_rings[int(offsets[j] + i)] == pytest.approx(u0 * math.cos(math.radians(lat)) ** 2, abs=1e-9)


def test_incomplete_columns_keep_their_rows_and_give_null(spark):
    rows = [(c, k, 280.0, 0.0) for c in (0, 1, 2) for k in (1, 2, 3, 4) if (c, k) != (1, 3)]
    levels = spark.createDataFrame(rows, "cell int, k int, t double, q double")
    surface = spark.createDataFrame([(0, 11.5, 0.0), (1, 11.5, 0.0)], "cell int, lnsp double, zs double")
    p = met.full_level_pressure(levels, surface, met.hybrid_coefficients(spark, 4), keys=["cell"])
    z = {(r["cell"], r["k"]): r["z"] for r in met.geopotential_on_levels(p, keys=["cell"]).collect()}
    assert len(z) == len(rows)
    assert all(z[0, k] is not None for k in (1, 2, 3, 4))
    assert z[1, 4] == z[0, 4] and z[1, 2] is None and z[1, 1] is None      # nothing above the missing level
    assert all(z[2, k] is None for k in (1, 2, 3, 4))                      # no surface


def test_spectral_wind_takes_only_true_neighbours(spark):
    one = [("f", n, 0, float(n), 0.0, 0.0, 0.0) for n in (1, 2, 4)]
    co = "f string, n int, m int, vo_re double, vo_im double, d_re double, d_im double"
    got = {r["n"]: r["u_re"] for r in spectral.vd2uv(spark.createDataFrame(one, co), ["f"]).collect()}
    alone = spectral.vd2uv(spark.createDataFrame(one[2:], co), ["f"]).first()["u_re"]
    assert got[4] == alone                                                 # n = 3 is absent, n = 2 is no neighbour
    assert got[1] != spectral.vd2uv(spark.createDataFrame(one[:1], co), ["f"]).first()["u_re"]
