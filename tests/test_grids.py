"""Reduced Gaussian grids with given points per latitude, regridding on arrays, dense chunks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import layout, regrid


def test_counts_are_an_input():
    lats, counts, first = regrid.reduced_gaussian_grid(2, [8, 12])
    assert counts.tolist() == [8, 12, 12, 8] and first.tolist() == [0, 8, 20, 32]
    assert lats[0] > lats[1] > 0 and np.allclose(lats, -lats[::-1])
    assert regrid.reduced_gaussian_grid(320)[1].sum() == 421_120
    with pytest.raises(ValueError):
        regrid.reduced_gaussian_grid(2, [8, 12, 12])


def test_a_grid_of_the_archive_size():
    # a list of 320 counts a hemisphere with 542,080 points in all
    half = np.linspace(18, 1280, 320).astype(int)
    half[-1] += 271_040 - half.sum()
    assert regrid.reduced_gaussian_grid(320, half.tolist())[1].sum() == 542_080


def test_arrays_and_rows_give_the_same_field(spark):
    counts = [6, 9, 9, 6]
    rng = np.random.default_rng(3)
    fields = {0: rng.normal(size=30), 1: rng.normal(size=30)}
    fields[1][4:9] = np.nan
    rows = [(f, [None if x != x else float(x) for x in v]) for f, v in fields.items()] + [(2, None), (3, [None] * 30)]
    df = spark.createDataFrame(rows, "f int, values array<double>")
    got = {r["f"]: r["values"] for r in regrid.gaussian_to_regular(df, "values", 2, 7, 11, counts=counts).collect()}
    cells = df.where("values IS NOT NULL").select("f", F.posexplode("values").alias("src_cell", "v"))
    w = regrid.gaussian_to_regular_weights(spark, 2, 7, 11, counts=counts)
    for r in regrid.apply_weights(cells, w, ["f"], "src_cell", "dst_cell", ["v"]).collect():
        a = got[r["f"]][r["dst_cell"]]
        assert (a is None) == (r["v"] is None) and (a is None or a == pytest.approx(r["v"], abs=1e-12))
    assert got[2] is None and set(got[3]) == {None} and len(got[0]) == 77


def test_blocks_of_destination_cells(spark, monkeypatch):
    monkeypatch.setattr(regrid, "DST_BLOCK", 10)
    df = spark.createDataFrame([(0, [1.0] * 30)], "f int, values array<double>")
    out = regrid.gaussian_to_regular(df, "values", 2, 7, 11, counts=[6, 9]).first()["values"]
    assert len(out) == 77 and all(x == pytest.approx(1.0) for x in out)


def test_chunk_pack_fills_and_refuses(spark):
    df = spark.createDataFrame([(0, 0, 1, 5.0), (0, 1, 0, None)], "f int, lat_idx int, lon_idx int, value double")
    assert layout.chunk_pack(df, ["f"], 2, 2).first()["values"] == [None, 5.0, None, None]
    with pytest.raises(Exception, match="twice"):
        layout.chunk_pack(df.union(df.limit(1)), ["f"], 2, 2).collect()


def test_no_input_stays_persisted(spark, sf_dir):
    from gridloom.plans import catalog  # noqa: F401  (registers every query)
    from gridloom.plans.registry import QUERIES
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("manifest_ar", "missing_files", "sample_line"):
        QUERIES[name](spark, sf_dir).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
