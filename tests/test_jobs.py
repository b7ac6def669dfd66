"""Composed jobs end to end on the stand-in tables."""

from pyspark.sql import functions as F

from gridloom.plans import jobs
from gridloom.session import scratch_path
from gridloom.sinks import axis
from gridloom.sinks import store as ST
from gridloom.sources import standins as S


def _grid(spark, sf_dir):
    return S.v_grid(spark, sf_dir).select("time", "variable", "lat_idx", "lon_idx", "value") \
        .withColumn("date", F.col("time").cast("date"))


def test_reconcile_rewrites_only_changed_blocks_and_is_stable(spark, sf_dir):
    path = scratch_path(spark, "t-recon")
    cur = _grid(spark, sf_dir)
    ST.write_store(cur, path)
    staged = cur.withColumn("value", F.when(F.dayofmonth("time") == 4, F.col("value") + 1).otherwise(F.col("value"))) \
        .where(F.dayofmonth("time") != 9)
    audit = jobs.reconcile_release(spark, ST.read_store(spark, path), staged, path)
    counts = {r["status"]: r["count"] for r in audit.groupBy("status").count().collect()}
    assert counts.get("data_changed", 0) > 0 and counts.get("absent", 0) > 0 and counts.get("ratified", 0) > 0
    changed = ST.read_store(spark, path).where(F.dayofmonth("time") == 4)
    expected = staged.where(F.dayofmonth("time") == 4)
    assert sorted(map(tuple, changed.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    again = jobs.reconcile_release(spark, ST.read_store(spark, path), staged, path)
    assert again.where(F.col("status") == "data_changed").count() == 0


def test_update_daily_prefers_final(spark, sf_dir):
    path = scratch_path(spark, "t-daily")
    r = S.v_release(spark, sf_dir).select("time", "variable", F.col("cell").alias("lat_idx"),
                                          F.lit(0).alias("lon_idx"), "expver", "value")
    jobs.update_daily(r, path, "2024-01-03", "2024-01-04")
    got = ST.read_store(spark, path)
    assert got.select("date").distinct().count() == 2
    assert got.count() == r.where(F.col("time").cast("date").between("2024-01-03", "2024-01-04")) \
        .select("time", "variable", "lat_idx").distinct().count()


def test_check_availability_flags_missing(spark):
    listing = spark.createDataFrame([("/r/x",)], "path string")
    variables = spark.createDataFrame([("t", True), ("z", False)], "variable string, is_multilevel boolean")
    r = jobs.check_availability(spark, "2023-07-18", "daily", listing, "/r", variables).first()
    assert r["data_is_missing"] is True and r["n_missing"] == 4 + 37 + 1


def test_build_store_normalises_and_refuses_overwrite(spark, sf_dir):
    import pytest
    path = scratch_path(spark, "t-build")
    raw = S.v_grid(spark, sf_dir).select(
        F.concat_ws("/", F.date_format("time", "yyyy/MM/dd"), "variable").alias("path"), "variable",
        F.col("time").alias("valid_time"), "lat_idx", "lon_idx", F.lit(0).alias("number"),
        F.when(F.col("value") > 40, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    jobs.build_store(raw, path)
    got = ST.read_store(spark, path)
    assert got.count() == raw.count()
    assert got.where(F.isnan("value")).count() == 0 and got.where(F.col("value").isNull()).count() > 0
    with pytest.raises(Exception):
        jobs.build_store(raw, path)


def test_update_files_writes_only_chunk_variables_inside_region(spark):
    path = scratch_path(spark, "t-files")
    files = spark.createDataFrame([("r/ERA5GRIB/HRES/Daily/2024/20240102_hres_tw.grb2",)], "path string")
    rows = [("r/ERA5GRIB/HRES/Daily/2024/20240102_hres_tw.grb2", sn, f"2024-01-0{d} 0{h}:00:00", 0, 1.0)
            for sn in ("t", "w", "q") for d in (2, 3) for h in (0, 6)]
    raw = spark.createDataFrame(rows, "path string, short_name string, time string, cell int, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    jobs.update_files(spark, files, raw, path, "2024-01-01")
    got = ST.read_store(spark, path)
    assert sorted(r[0] for r in got.select("variable").distinct().collect()) == ["t", "w"]
    assert got.where(F.dayofmonth("time") != 2).count() == 0 and got.count() == 4


def test_consistency_and_find_missing(spark):
    years = spark.createDataFrame([(2001,)], "year int")
    listing = spark.createDataFrame([("raw/ERA5GRIB/HRES/Daily/2001/20010101_hres_dve.grb2",),
                                     ("raw/ERA5GRIB/HRES/Daily/2001/stray.tmp",)], "name string")
    extra = [r[0] for r in jobs.check_consistency(spark, years, listing).collect()]
    assert extra == ["raw/ERA5GRIB/HRES/Daily/2001/stray.tmp"]
    pattern = spark.createDataFrame([("a",), ("b",)], "path string")
    assert [r[0] for r in jobs.find_missing(pattern, spark.createDataFrame([("a",)], "path string")).collect()] == ["b"]


def test_derive_field_set(spark, sf_dir):
    from gridloom.operators import met
    lv = S.v_levels(spark, sf_dir)
    out = jobs.derive(spark, lv, S.v_surface(lv), met.hybrid_coefficients(spark, 7))
    assert {"temperature", "specific_humidity", "geopotential", "r", "td"} <= set(out.columns)
    # every level row stays; geopotential is there exactly where all levels below are
    columns = {}
    for r in lv.select("time", "cell", "k").collect():
        columns.setdefault((r["time"], r["cell"]), set()).add(r["k"])
    whole = {(*c, k) for c, ks in columns.items() for k in ks if ks >= set(range(k, 8))}
    rows = out.select("time", "cell", "k", "geopotential").collect()
    assert len(rows) == sum(map(len, columns.values()))
    assert {(r["time"], r["cell"], r["k"]) for r in rows if r["geopotential"] is not None} == whole


def test_native_init_and_hourly_update_with_skip(spark):
    import pytest
    from gridloom.operators import met
    path = scratch_path(spark, "t-native")
    names = ["temperature", "specific_humidity", "geopotential", "p", "r", "td"]
    jobs.init_native(spark, path, "2024-01-01", "2024-01-01", {"cell": 2}, 3, names)
    assert ST.read_store(spark, path).count() == 0 and axis.read_filled(spark, path).count() == 24 * 3 * 2 * len(names)
    rows = [(f"2024-01-01 0{h}:00:00", c, k, 250.0 + 10 * k, 0.001 * k) for h in (1, 2) for c in (0, 1) for k in (1, 2, 3)]
    rows = [r for r in rows if not (r[0].startswith("2024-01-01 02") and r[1] == 1 and r[2] == 2)]  # hour 2 incomplete
    lv = spark.createDataFrame(rows, "time string, cell int, k int, t double, q double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    sf = lv.select("time", "cell").distinct().select("time", "cell", F.lit(11.5).alias("lnsp"), F.lit(0.0).alias("zs"))
    coef = met.hybrid_coefficients(spark, 3)
    with pytest.raises(ValueError, match="absent"):
        jobs.update_native(spark, lv, sf, coef, path, "2024-01-01", "2024-01-01", 3)
    skipped = jobs.update_native(spark, lv, sf, coef, path, "2024-01-01", "2024-01-01", 3, on_error="skip")
    got = {r["time"].hour: r["reason"] for r in skipped.collect()}
    assert got == {h: "levels" if h == 2 else "absent" for h in range(24) if h != 1}
    st = axis.read_filled(spark, path)
    assert st.where((F.hour("time") == 1) & F.col("value").isNotNull()).count() == 2 * 3 * len(names)
    assert st.where((F.hour("time") == 2) & F.col("value").isNotNull()).count() == 0
    assert st.count() == 24 * 3 * 2 * len(names)


def test_store_attrs_table_upserts(spark, sf_dir):
    attrs = scratch_path(spark, "t-attrs")
    path = scratch_path(spark, "t-daily-attrs")
    r = S.v_release(spark, sf_dir).select("time", "variable", F.col("cell").alias("lat_idx"),
                                          F.lit(0).alias("lon_idx"), "expver", "value")
    jobs.update_daily(r, path, "2024-01-03", "2024-01-04", attrs_path=attrs, store_name="ar", now="t1")
    jobs.update_daily(r, path, "2024-01-05", "2024-01-05", attrs_path=attrs, store_name="ar", mode="era5", now="t2")
    ST.upsert_store_attrs_table(spark, attrs, "other", "2024-02-01", "monthly", "t3")
    rows = {x["store"]: x["attrs"] for x in spark.read.parquet(attrs).collect()}
    assert rows["ar"] == {"valid_time_start": "1940-01-01", "last_updated": "t2",
                          "valid_time_stop_era5t": "2024-01-04", "valid_time_stop": "2024-01-05"}
    assert rows["other"]["valid_time_stop_era5t"] == "2024-02-01"


def test_raw_paths_router(spark):
    from gridloom.operators import manifest
    w = spark.createDataFrame([("2024-01-30", "2024-02-02")], "start string, end string")
    wind = manifest.raw_paths(spark, w, "model-level-wind", "/r")
    assert wind.count() == 4 * 2                                   # 4 days x (dve, tw)
    surf = manifest.raw_paths(spark, w, "single-level-surface", "/r")
    assert sorted(r[0] for r in surf.collect()) == [
        "/r/ERA5GRIB/HRES/Month/2024/202402_hres_lnsp.grb2", "/r/ERA5GRIB/HRES/Month/2024/202402_hres_zs.grb2"]
    v = spark.createDataFrame([("t", True), ("geopotential_at_surface", False)], "variable string, is_multilevel boolean")
    ar = manifest.raw_paths(spark, w, "ar", "/r", v)
    assert ar.count() == 4 * (37 + 1)
    assert ar.where(F.col("path").endswith("/geopotential/surface.nc")).count() == 4
