"""Axis and skeletons, one region rule for every write, digests, and promotion that resumes."""

import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.operators import release
from gridloom.plans import jobs
from gridloom.sinks import axis
from gridloom.sinks import store as ST
from gridloom.sinks.journal import Journal
from gridloom.streaming import ingest

DAY = datetime.date(2020, 1, 1)
SCHEMA = "variable string, date date, time timestamp_ntz, level int, cell int, value double"


def rows(level, value, cells=range(3), hour=0, date=DAY, variable="t"):
    t = datetime.datetime.combine(date, datetime.time(hour))
    return [(variable, date, t, level, c, value) for c in cells]


def stored(spark, path):
    spark.catalog.refreshByPath(path)
    return {(r.variable, r.level, r.time.hour, r.cell): r.value for r in ST.read_store(spark, path).collect()}


def store(spark, path, *parts):
    ST.write_store(spark.createDataFrame([r for p in parts for r in p], SCHEMA), path)


# ------------------------------------------------------------------ one region rule
def test_single_level_block_delivered_twice(spark, tmp_path):
    """A missing level is a level: beside multi-level rows it is replaced, not doubled."""
    landing, path, ck = (str(tmp_path / x) for x in ("landing", "store", "ck"))
    for value in (1.0, 2.0):
        spark.createDataFrame(rows(None, value) + rows(500, value, cells=[0]), SCHEMA).write.mode("append").parquet(landing)
        ingest.ingest_new_blocks(spark, landing, SCHEMA, path, ck)
    assert ST.read_store(spark, path).count() == 4
    assert set(stored(spark, path).values()) == {2.0}


def test_missing_partition_value_is_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    store(spark, path, rows(None, 1.0, variable=None), rows(None, 1.0))
    ST.replace_regions(spark, path, spark.createDataFrame(rows(None, 5.0, variable=None), SCHEMA), ["time", "level"])
    got = stored(spark, path)
    assert {v for k, v in got.items() if k[0] is None} == {5.0} and {v for k, v in got.items() if k[0] == "t"} == {1.0}
    assert len(got) == 6


def test_new_rows_are_computed_once(spark, tmp_path):
    path = str(tmp_path / "s")
    store(spark, path, rows(500, 1.0))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    new = spark.createDataFrame(rows(500, 2.0), SCHEMA).mapInArrow(count, SCHEMA)
    ST.replace_regions(spark, path, new, ["time", "level"])
    assert seen.value == 3 and set(stored(spark, path).values()) == {2.0}


def test_daily_update_keeps_hours_that_did_not_arrive(spark, tmp_path):
    path = str(tmp_path / "s")
    schema = "variable string, date date, time timestamp_ntz, cell int, value double"
    drop = lambda part: [r[:3] + r[4:] for r in part]
    ST.write_store(spark.createDataFrame(drop([r for h in (0, 6, 12, 18) for r in rows(None, 1.0, hour=h)]), schema), path)
    raw = spark.createDataFrame([(*r[:3], 5, *r[4:]) for h in (0, 6) for r in rows(None, 2.0, hour=h)],
                                "variable string, date date, time timestamp_ntz, expver int, cell int, value double").drop("date")
    jobs.update_daily(raw, path, "2020-01-01", "2020-01-01", keys=("time", "cell"))
    got = {(r.time.hour, r.cell): r.value for r in ST.read_store(spark, path).collect()}
    assert got == {(h, c): 2.0 if h < 12 else 1.0 for h in (0, 6, 12, 18) for c in range(3)}


def test_files_update_records_the_validity_end(spark, tmp_path):
    path, attrs = str(tmp_path / "s"), str(tmp_path / "attrs")
    name = "r/ERA5GRIB/HRES/Daily/2024/20240102_hres_tw.grb2"
    raw = spark.createDataFrame([(name, "t", "2024-01-02 00:00:00", 0, None, 1.0)],
                                "path string, short_name string, time string, cell int, level int, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    for _ in range(2):
        jobs.update_files(spark, raw.select("path"), raw, path, "2024-01-01", attrs_path=attrs, store_name="co", now="n")
    assert ST.read_store(spark, path).count() == 1
    assert spark.read.parquet(attrs).first()["attrs"]["valid_time_stop_era5t"] == "2024-01-02"


# ------------------------------------------------------------------ reconciliation
def test_staged_level_replaces_that_level_alone(spark, tmp_path):
    path, staged_path = str(tmp_path / "s"), str(tmp_path / "staged")
    store(spark, path, rows(500, 1.0), rows(850, 1.0), rows(None, 1.0))
    store(spark, staged_path, rows(500, 2.0), rows(None, 1.0))
    audit = jobs.reconcile_release(spark, ST.read_store(spark, path), ST.read_store(spark, staged_path), path,
                                   cell_keys=("time", "cell"), staged_path=staged_path)
    assert {(r.level, r.status) for r in audit.collect()} == {(500, "data_changed"), (850, "absent"), (None, "ratified")}
    got = stored(spark, path)
    assert {k[1]: v for k, v in got.items()} == {500: 2.0, 850: 1.0, None: 1.0} and len(got) == 9


def test_staged_rows_of_both_releases_are_combined(spark, tmp_path):
    path = str(tmp_path / "s")
    store(spark, path, rows(500, 1.0))
    staged = spark.createDataFrame([(*r, e) for e, v in ((5, 9.0), (1, 2.0)) for r in rows(500, v)], SCHEMA + ", expver int")
    jobs.reconcile_release(spark, ST.read_store(spark, path), staged, path, cell_keys=("time", "cell"))
    assert set(stored(spark, path).values()) == {2.0}


STEPS = [("replace_regions", "written"), ("audit", "audited"), ("drop_blocks", "dropped"), ("_record", "recorded")]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", [s for _, s in STEPS])
def test_promotion_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, step, after):
    """The job dies at each step, before or after its effect; a rerun ends as if nothing had failed."""
    path, staged_path, table, attrs = (str(tmp_path / x) for x in ("s", "staged", "audit", "attrs"))
    store(spark, path, rows(500, 1.0), rows(850, 1.0), rows(500, 1.0, variable="q"))
    store(spark, staged_path, rows(500, 2.0), rows(850, 1.0), rows(700, 3.0, variable="z"))

    def run():
        staged = spark.read.schema(SCHEMA).option("basePath", staged_path).parquet(staged_path)
        return jobs.reconcile_release(spark, ST.read_store(spark, path), staged, path, cell_keys=("time", "cell"), audit_table=table,
                                      staged_path=staged_path, attrs_path=attrs, time_end="2020-01-01", now="n")
    mark = Journal.mark

    def dies(self, name):
        if name == step and not after:
            raise OSError("lost")               # the step's effect is there, its entry is not
        mark(self, name)
        if name == step and after:
            raise OSError("lost")
    monkeypatch.setattr(Journal, "mark", dies)
    with pytest.raises(OSError):
        run()
    monkeypatch.setattr(Journal, "mark", mark)
    spark.catalog.refreshByPath(path)
    audit = {(r.variable, r.level, r.status) for r in run().collect()}
    want = {("t", 500, "data_changed"), ("t", 850, "ratified"), ("q", 500, "absent"), ("z", 700, "added")}
    assert audit == want
    kept = spark.read.parquet(table).collect()
    assert {(r.variable, r.level, r.status) for r in kept} == want and len(kept) == 4
    got = stored(spark, path)
    assert {k[:2]: v for k, v in got.items()} == {("t", 500): 2.0, ("t", 850): 1.0, ("q", 500): 1.0, ("z", 700): 3.0} and len(got) == 12
    assert spark.read.schema(SCHEMA).option("basePath", staged_path).parquet(staged_path).count() == 0
    assert spark.read.parquet(attrs).first()["attrs"]["valid_time_stop"] == "2020-01-01"
    assert not ST.store_exists(spark, f"{path}.journal")


def test_digests_tell_blocks_apart(spark):
    schema = "b string, c int, value double"
    a = spark.createDataFrame([("same", 0, 1.0), ("same", 1, -0.0), ("hole", 0, None), ("more", 0, 1.0), ("swap", 0, 1.0), ("swap", 1, 2.0),
                               (None, 0, 1.0), ("left", 0, 1.0), ("nan", None, 1.0)], schema)
    b = spark.createDataFrame([("same", 1, 0.0), ("same", 0, 1.0), ("hole", 1, None), ("more", 0, 1.0), ("more", 1, 1.0), ("swap", 0, 2.0),
                               ("swap", 1, 1.0), (None, 0, 1.0), ("right", 0, None), ("nan", 0, 1.0)], schema)
    got = {r.b: (r.in_a, r.in_b, r.equal) for r in release.compare_blocks(a, b, ["b"], ["c"]).collect()}
    assert got == {"same": (True, True, True), "hole": (True, True, True), "more": (True, True, False), "swap": (True, True, False),
                   None: (True, True, True), "left": (True, False, False), "right": (False, True, True), "nan": (True, True, False)}
    plan = release.blocks_equal(a, b, ["b"], ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


# ------------------------------------------------------------------ axis
def skeleton(spark, path, **more):
    names = spark.createDataFrame([("t", 500), ("t", 850), ("sst", None)], "variable string, level int")
    return axis.create_store(spark, path, "2020-01-01", "2020-01-02", names, {"cell": 3}, "double", step_hours=6, **more)


def test_skeleton_holds_no_cell_and_reads_full(spark, tmp_path):
    path = str(tmp_path / "s")
    skeleton(spark, path)
    assert ST.read_store(spark, path).count() == 0
    full = axis.read_filled(spark, path)
    assert full.count() == 4 * 3 * 3 and full.where("value IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="exists"):
        skeleton(spark, path)
    ST.replace_regions(spark, path, spark.createDataFrame(rows(None, 7.0, cells=[1], hour=6, variable="sst"), SCHEMA), ["time", "level"])
    got = axis.read_filled(spark, path, where=F.col("variable") == "sst").collect()
    assert len(got) == 12 and [(r.time.hour, r.cell, r.value) for r in got if r.value is not None] == [(6, 1, 7.0)]
    assert axis.read_filled(spark, path, start="2020-01-01 05:00:00", end="2020-01-01 12:00:00").count() == 9
    assert axis.read_filled(spark, path, start="2021-01-01").count() == 0


def test_axis_grows_once_and_takes_later_days(spark, tmp_path):
    path = str(tmp_path / "s")
    skeleton(spark, path)
    late = spark.createDataFrame(rows(500, 7.0, date=DAY + datetime.timedelta(1)), SCHEMA)
    with pytest.raises(ValueError, match="outside the store's axis"):
        ST.replace_regions(spark, path, late, ["time", "level"])
    assert ST.read_store(spark, path).count() == 0
    grown = [axis.extend_axis(spark, path, "2020-01-03") for _ in range(2)]
    assert grown[0] == grown[1] == axis.read_axis(spark, path) and grown[0].n_steps == 12 and grown[0].version == 1
    assert axis.extend_axis(spark, path, "2020-01-02").n_steps == 12           # an axis does not shrink
    ST.replace_regions(spark, path, late, ["time", "level"])
    got = axis.read_filled(spark, path, start="2020-01-02", where=F.col("level") == 500)
    assert got.count() == 8 * 3 and {(r.date.day, r.time.hour, r.value) for r in got.where("value IS NOT NULL").collect()} == {(2, 0, 7.0)}


@pytest.mark.parametrize("bad", [rows(500, 1.0, hour=1), rows(500, 1.0, cells=[3]), rows(500, 1.0, date=DAY - datetime.timedelta(1)),
                                 [("t", DAY, None, 500, 0, 1.0)], [("t", DAY, datetime.datetime(2020, 1, 1), 500, None, 1.0)]])
def test_writes_are_checked_against_the_axis(spark, tmp_path, bad):
    path = str(tmp_path / "s")
    skeleton(spark, path)
    with pytest.raises(ValueError, match="outside the store's axis"):
        ST.replace_regions(spark, path, spark.createDataFrame(bad, SCHEMA), ["time", "level"])


def test_forecast_axis_has_valid_times(spark, tmp_path):
    path = str(tmp_path / "s")
    axis.create_store(spark, path, "2020-01-01 06:00:00", "2020-01-02", spark.createDataFrame([("tp",)], "variable string"),
                      {"cell": 2}, "double", step_hours=12, forecast_steps=3)
    axis.extend_axis(spark, path, "2020-01-02")
    got = axis.read_filled(spark, path).where("cell = 0").collect()
    assert sorted((r.time.day, r.time.hour, r.step, r.valid_time.hour) for r in got) == [
        (d, h, s, (h + s) % 24) for d in (1, 2) for h in (6, 18) for s in range(3)]


def test_interrupted_creation_may_be_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    real = axis._write
    monkeypatch.setattr(axis, "_write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        skeleton(spark, path)
    monkeypatch.setattr(axis, "_write", real)
    assert skeleton(spark, path).n_steps == 4


def test_a_step_without_rows_is_a_gap(spark):
    t = [datetime.datetime(2020, 1, 1, h) for h in range(3)]
    df = spark.createDataFrame([("t", t[0], c, 1, 1.0) for c in range(2)], "variable string, time timestamp_ntz, cell int, expver int, value double")
    expected = spark.createDataFrame([("t", x) for x in t], "variable string, time timestamp_ntz")
    got = {r.time.hour: (r.gap_final, r.gap_prelim) for r in release.release_gaps(df, ["variable", "time"], 2, expected=expected).collect()}
    assert got == {0: (False, True), 1: (True, True), 2: (True, True)}


def test_month_files_follow_their_split_blocks(spark, tmp_path):
    old, new = tmp_path / "raw", tmp_path / "staged"
    folder = "ERA5GRIB/HRES/Month/2024"
    for root, text in ((old, "old"), (new, "new")):
        (root / folder).mkdir(parents=True)
        for name in ("202402_hres_soil.grb2", "202402_hres_pcp.grb2"):
            (root / folder / name).write_text(text)
    promoted = spark.createDataFrame([("single-level-reanalysis", c, datetime.date(2024, 2, d)) for c, d in (
        ("soil_depthBelowLandLayer_stl1", 1), ("soil_depthBelowLandLayer_stl2", 9), ("cape", 3), ("soil_surface_tsn", 1))],
        "store string, chunk string, date date")
    assert jobs.promote_parents(spark, promoted, str(new), str(old)) == 1
    assert jobs.promote_parents(spark, promoted, str(new), str(old)) == 0
    assert (old / folder / "202402_hres_soil.grb2").read_text() == "new" and not (new / folder / "202402_hres_soil.grb2").exists()
    assert (old / folder / "202402_hres_pcp.grb2").read_text() == "old"


@pytest.mark.parametrize("on_conflict", ["raise", "count"])
def test_merge_checks_while_it_merges(spark, on_conflict):
    a = spark.createDataFrame([(0, None, 1.0, 5.0), (1, 500, None, 5.0), (2, 500, 3.0, 5.0)], "cell int, level int, t double, w double")
    b = spark.createDataFrame([(0, None, 1.0), (1, 500, 2.0), (3, None, 4.0)], "cell int, level int, t double")
    same = release.merge_stores(a, b, ["cell", "level"], on_conflict)
    got = {(r.cell, r.level): (r.t, r.w) for r in same.collect()}
    assert got == {(0, None): (1.0, 5.0), (1, 500): (2.0, 5.0), (2, 500): (3.0, 5.0), (3, None): (4.0, None)}
    worse = release.merge_stores(a, b.unionByName(spark.createDataFrame([(2, 500, 9.0)], b.schema)), ["cell", "level"], on_conflict)
    if on_conflict == "raise":
        with pytest.raises(Exception, match="conflicting values of t at cell=2, level=500"):
            worse.collect()
    else:
        assert {r.cell: r.n_conflicts for r in worse.collect()} == {0: 0, 1: 0, 2: 1, 3: 0}


def test_nearest_on_rings_is_the_nearest_of_all():
    import numpy as np

    from gridloom.operators import regrid
    rng = np.random.default_rng(4)
    for n_half, counts in ((2, [8, 12, 12, 8]), (8, None), (3, [1, 7, 30]), (4, [4, 4, 50, 50])):
        grid = regrid.reduced_gaussian_grid(n_half, counts)
        lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, 400))), rng.uniform(0, 360, 400)
        lat[:4], lon[:4] = [90, -90, 89.9, 0], [0, 10, 359.9, 0]
        cell, dist = regrid._nearest_on_rings(grid, lat, lon)
        clat = np.repeat(grid[0], grid[1])
        clon = np.concatenate([360.0 * np.arange(n) / n for n in grid[1]])
        a, b = np.radians(clat)[None, :], np.radians(lat)[:, None]
        half = np.sin((a - b) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(clon[None, :] - lon[:, None]) / 2) ** 2
        every = np.degrees(2 * np.arcsin(np.sqrt(np.minimum(half, 1))))
        np.testing.assert_allclose(dist, every.min(axis=1), atol=1e-9)
        np.testing.assert_allclose(every[np.arange(400), cell], every.min(axis=1), atol=1e-9)
