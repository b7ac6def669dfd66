"""Chunk-layout stores against arrays held in numpy; plans and sizes that do not divide."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import spectral
from gridloom.sinks import chunks as C
from gridloom.sinks import store as ST

BY = C.Chunking(("step", "y", "x"), (50, 5, 7), (12, 2, 3))


def long(spark, arrays, level=None):
    rows = [(v, level, int(i), int(j), int(k), float(a[i, j, k])) for v, a in arrays.items() for i, j, k in zip(*np.nonzero(~np.isnan(a)))]
    return spark.createDataFrame(rows, "variable string, level int, step int, y int, x int, value double")


def back(spark, path, ranges=None):
    got = {}
    for r in C.to_cells(C.read(spark, path, BY, ranges), ["variable", "level"], BY, ranges).collect():
        got.setdefault((r.variable, r.level), np.full(BY.sizes, np.nan))[r.step, r.y, r.x] = np.nan if r.value is None else r.value
    return got


def test_regions_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(0)
    path, keys = str(tmp_path / "s"), ["variable", "level"]
    truth = {(v, lv): rng.random(BY.sizes).round(3) for v, lv in (("t", None), ("t", 500), ("q", 500))}
    truth["t", None][rng.random(BY.sizes) < .3] = np.nan
    parts = [long(spark, {v: a}, lv) for (v, lv), a in truth.items()]
    C.build(parts[0].unionByName(parts[1]).unionByName(parts[2]), path, BY, keys)
    with pytest.raises(Exception):
        C.build(parts[0], path, BY, keys)
    for box in ({"step": (12, 24)}, {"step": (5, 31), "y": (1, 4), "x": (2, 7)}, {"step": (49, 99), "x": (6, 7)}, {"y": (4, 5)}, {"step": (9, 9)}):
        new = rng.random(BY.sizes).round(3) + 10
        new[rng.random(BY.sizes) < .2] = np.nan
        cut = tuple(slice(*BY.whole(box)[n]) for n in BY.names)
        inside = np.full(BY.sizes, np.nan)
        inside[cut] = new[cut]
        C.write_region(spark, path, BY, long(spark, {"t": inside}), box, keys)         # level missing: the single-level array
        if inside[cut].size:
            truth["t", None][cut] = inside[cut]
        spark.catalog.refreshByPath(path)
        got = back(spark, path)
        for k, a in truth.items():
            np.testing.assert_array_equal(got[k], a)
    some = {"step": (20, 30), "y": (1, 3)}
    part = back(spark, path, some)
    np.testing.assert_array_equal(part["q", 500][20:30, 1:3], truth["q", 500][20:30, 1:3])
    assert np.isnan(part["q", 500][:20]).all() and np.isnan(part["q", 500][:, 3:]).all()


def test_write_without_a_store_and_outside_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    a = np.full(BY.sizes, np.nan)
    a[3, 1, 1] = 5.0
    C.write_region(spark, path, BY, long(spark, {"t": a}), {"step": (0, 12)}, ["variable", "level"])
    assert np.nansum(back(spark, path)["t", None]) == 5.0
    with pytest.raises(Exception, match="outside the region"):
        C.write_region(spark, path, BY, long(spark, {"t": a}), {"step": (4, 12)}, ["variable", "level"])
    with pytest.raises(ValueError, match="no such dimension"):
        C.read(spark, path, BY, {"z": (0, 1)})


def test_scan_states_literal_chunk_ranges(spark, tmp_path):
    path = str(tmp_path / "s")
    C.build(long(spark, {"t": np.ones(BY.sizes)}), path, BY, ["variable", "level"])
    plan = C.read(spark, path, BY, {"step": (13, 20), "x": (0, 3)}, F.col("variable") == "t")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "c_step" in filters and "variable" in filters and "c_x" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert "Exchange" not in plan


@pytest.mark.parametrize("steps", [4, 6, 24, 36])
def test_rechunk_moves_no_cell(spark, tmp_path, steps):
    rng = np.random.default_rng(1)
    a = rng.random(BY.sizes)
    rows = C.to_chunks(long(spark, {"t": a}), ["variable"], BY)
    out, to = C.rechunk_first(rows, ["variable"], BY, steps)
    got = np.full(BY.sizes, np.nan)
    for r in C.to_cells(out, ["variable"], to).collect():
        got[r.step, r.y, r.x] = r.value
    np.testing.assert_array_equal(got, a)
    if steps < 12:
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().split("ObjectHashAggregate")[0]
    with pytest.raises(ValueError):
        C.rechunk_first(rows, ["variable"], BY, 5)


# ------------------------------------------------------------------ spectral arrays
def test_wind_on_arrays_needs_no_shuffle_and_equals_rows(spark):
    rng = np.random.default_rng(2)
    t = 9
    n, m = spectral._order(t)
    names = ["vo_re", "vo_im", "d_re", "d_im"]
    data = {f: rng.normal(size=(4, len(n))) for f in range(3)}
    rows = [(f, int(a), int(b), *map(float, x[:, i])) for f, x in data.items() for i, (a, b) in enumerate(zip(n, m))]
    schema = "f int, n int, m int, " + ", ".join(f"{c} double" for c in names)
    df = spark.createDataFrame(rows, schema)
    packed = spectral.pack(df, ["f"], names, t)
    for r in packed.collect():
        np.testing.assert_array_equal(np.array([r[c] for c in names]), data[r.f])
    arrays = spark.createDataFrame([(f, *x.tolist()) for f, x in data.items()], "f int, " + ", ".join(f"{c} array<double>" for c in names))
    out = spectral.vd2uv_fields(arrays, t)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    a = fixed_radius()
    inv = np.where(n > 0, -a * a / np.maximum(n * (n + 1.0), 1), 0.0)
    at = {(int(x), int(y)): i for i, (x, y) in enumerate(zip(n, m))}
    eps = lambda x, y: np.sqrt((x * x - y * y) / (4.0 * x * x - 1)) if x > y else 0.0
    for r in out.collect():
        psi, chi = inv * (data[r.f][0] + 1j * data[r.f][1]), inv * (data[r.f][2] + 1j * data[r.f][3])
        for i, (x, y) in enumerate(zip(n, m)):
            near = lambda z, k: z[at[k, y]] if (k, y) in at else 0.0
            u = (1j * y * chi[i] + (x - 1) * eps(x, y) * near(psi, x - 1) - (x + 2) * eps(x + 1, y) * near(psi, x + 1)) / a
            assert abs(complex(r.u_re[i], r.u_im[i]) - u) < 1e-6 * (1 + abs(u))
    again = {(r.f, r.n, r.m): r.u_re for r in spectral.vd2uv(df, ["f"]).collect()}
    flat = {(r.f, int(x), int(y)): v for r in out.collect() for x, y, v in zip(n, m, r.u_re)}
    assert again == flat


def fixed_radius():
    from gridloom.functions import fixed
    return float(fixed.EARTH_RADIUS)


def test_synthesis_on_arrays_of_any_latitudes(spark):
    rng = np.random.default_rng(3)
    t, lats, counts = 7, [80.0, 33.3, 0.0, -33.3, -10.0], [6, 20, 24, 18, 24]
    n, m = spectral._order(t)
    c = rng.normal(size=(2, len(n))) + 1j * rng.normal(size=(2, len(n)))
    df = spark.createDataFrame([(f, c[f].real.tolist(), c[f].imag.tolist()) for f in range(2)] + [(2, None, None)],
                               "f int, re array<double>, im array<double>")
    out = spectral.synthesise_fields(df, "re", "im", lats, counts, t, scale=[1, 2, 3, 4, 5])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        if r.f == 2:
            assert r["values"] is None
            continue
        want = []
        for lat, nl, s in zip(lats, counts, range(1, 6)):
            fm = np.array([c[r.f][m == k] @ spectral.legendre_matrix(t, k, np.array([np.sin(np.radians(lat))]))[:, 0] for k in range(t + 1)])
            for j in range(nl):
                lam = 2 * np.pi * j / nl
                want.append(s * sum((fm[k] * np.exp(1j * k * lam)).real * (2 if k else 1) for k in range(t + 1) if 2 * k < nl))
        np.testing.assert_allclose(r["values"], want, atol=1e-10)


def test_store_reads_after_chunk_writes_are_plain(spark, tmp_path):
    path = str(tmp_path / "s")
    C.build(long(spark, {"t": np.ones(BY.sizes)}), path, BY, ["variable", "level"])
    assert set(ST.read_store(spark, path).columns) == {"variable", "level", "values", "c_step", "c_y", "c_x"}
