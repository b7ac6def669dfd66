"""Store writes, releases and layouts: properties and failure cases."""

import pytest
from pyspark.sql import functions as F

from gridloom.operators import fields, layout, release
from gridloom.operators.aggregate import assert_level_count
from gridloom.session import scratch_path
from gridloom.sinks import store as ST
from gridloom.sources import standins as S


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_region_write_is_idempotent_and_only_touches_its_region(spark, sf_dir):
    path = scratch_path(spark, "t-idem")
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.write_store(g.withColumn("value", F.lit(0.0)), path)
    day = g.where(F.dayofmonth("time") == 3)
    ST.overwrite_regions(day, path)
    once = _sorted(ST.read_store(spark, path))
    ST.overwrite_regions(day, path)
    assert _sorted(ST.read_store(spark, path)) == once
    other = ST.read_store(spark, path).where(F.dayofmonth("time") != 3)
    assert other.where(F.col("value") != 0).count() == 0


def test_full_build_refuses_existing_store(spark, sf_dir):
    path = scratch_path(spark, "t-exists")
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.write_store(g, path)
    with pytest.raises(Exception):
        ST.write_store(g, path)


def test_partition_filters_prune(spark, sf_dir):
    path = scratch_path(spark, "t-prune")
    ST.write_store(S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date")), path)
    q = ST.read_store(spark, path).where((F.col("variable") == "click") & (F.col("date") == F.lit("2024-01-05").cast("date")))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "click" in plan


def test_pivot_unpivot_round_trip(spark, sf_dir):
    g = S.v_grid(spark, sf_dir).select("time", "lat_idx", "lon_idx", "variable", "value")
    names = [r[0] for r in g.select("variable").distinct().collect()]
    wide = layout.pivot_wide(g, ["time", "lat_idx", "lon_idx"], variables=names)
    back = layout.unpivot_long(wide, ["time", "lat_idx", "lon_idx"], names)
    assert _sorted(back) == _sorted(g)


def test_chunk_pack_explode_round_trip(spark, sf_dir):
    g = S.v_grid(spark, sf_dir).select("time", "variable", "lat_idx", "lon_idx", "value")
    packed = layout.chunk_pack(g, ["time", "variable"], 4, 6)
    back = layout.chunk_explode(packed, "values", 6, ["time", "variable"]).where(F.col("value").isNotNull())
    assert _sorted(back.select("time", "variable", "lat_idx", "lon_idx", "value")) == _sorted(g)


def test_reconcile_twice_changes_nothing(spark, sf_dir):
    comb = release.combine_releases(S.v_release(spark, sf_dir), ["time", "variable", "cell"]) \
        .withColumn("date", F.col("time").cast("date"))
    eq = release.blocks_equal(comb, comb, ["variable", "date"], ["time", "cell"])
    r = release.audit_counts(eq).first()
    assert r["n_different"] == 0 and r["n_equal"] > 0


def test_release_disjoint_and_overlapping(spark):
    rows = [("2024-01-01 00:00:00", 0, 1, 1.0), ("2024-01-01 00:00:00", 1, 1, 1.0),
            ("2024-01-01 01:00:00", 0, 5, 2.0), ("2024-01-01 01:00:00", 1, 5, 2.0)]
    df = spark.createDataFrame(rows, "time string, cell int, expver int, value double") \
        .withColumn("time", F.col("time").cast("timestamp_ntz")).withColumn("v", F.lit("a"))
    gaps = release.release_gaps(df, ["v", "time"], 2)
    assert release.release_disjoint(gaps, ["v"]).first()["disjoint"] is True
    over = df.where(~((F.col("cell") == 1) & (F.col("expver") == 1)))
    over = over.unionByName(df.where((F.col("cell") == 0) & (F.col("expver") == 1))
                            .withColumn("expver", F.lit(5)).withColumn("time", F.col("time")))
    gaps2 = release.release_gaps(over.where(F.col("cell") == 0), ["v", "time"], 2)
    assert release.release_disjoint(gaps2, ["v"]).first()["disjoint"] is False


def test_combine_prefers_final(spark):
    rows = [(0, 1, 10.0), (0, 5, 20.0), (1, 5, 30.0), (2, 1, None), (2, 5, 40.0)]
    df = spark.createDataFrame(rows, "cell int, expver int, value double")
    out = {r["cell"]: r["value"] for r in release.combine_releases(df, ["cell"]).collect()}
    assert out == {0: 10.0, 1: 30.0, 2: 40.0}


def test_one_variable_per_file(spark):
    df = spark.createDataFrame([("f1", "t", 1.0), ("f1", "q", 2.0)], "path string, variable string, value double")
    with pytest.raises(ValueError):
        fields.normalize_raw(df)


def test_wrong_level_count_raises(spark, sf_dir):
    with pytest.raises(ValueError):
        assert_level_count(S.v_levels(spark, sf_dir), ["time", "cell"], "k", 8)


def test_conflicting_merge_raises(spark):
    a = spark.createDataFrame([(0, 1.0)], "cell int, t double")
    b = spark.createDataFrame([(0, 2.0)], "cell int, t double")
    with pytest.raises(ValueError):
        release.assert_no_conflicts(release.merge_conflicts(a, b, ["cell"], ["t"]), ["t"])


def test_rechunk_size_must_divide_a_day(spark, sf_dir):
    with pytest.raises(ValueError):
        ST.rechunk_time(S.v_grid(spark, sf_dir), ["variable"], "lat_idx", 5)


def test_stream_equals_batch(spark, sf_dir):
    import __spark_entry__ as entry
    streamed = entry.queries()["stream_ingest"](spark, sf_dir)
    batch = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    assert _sorted(streamed.select(*batch.columns)) == _sorted(batch)


def test_hourly_grid_stream_equals_batch(spark, sf_dir):
    from gridloom.operators.aggregate import hourly_buckets
    from gridloom.streaming.windows import hourly_grid_stream
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = ev.select("ts", (F.col("user_id") % 24).cast("int").alias("cell"), "value")
    landing = scratch_path(spark, "t-ev")
    ev.write.parquet(landing)
    stream = spark.readStream.schema(ev.schema).parquet(landing) \
        .select("ts", (F.col("user_id") % 24).cast("int").alias("cell"), "value")
    q = hourly_grid_stream(stream, "ts", ["cell"], lateness="1000 days").writeStream.outputMode("update") \
        .format("memory").queryName("hourly_grid_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT * FROM hourly_grid_test")
    assert _sorted(got) == _sorted(hourly_buckets(rows, "ts", ["cell"]))


def test_complete_dates_stream(spark):
    """Repeated files count once, a date may fill over several drops, a back-filled one too."""
    from gridloom.streaming.windows import record_complete_dates
    landing, out, ckpt = (scratch_path(spark, n) for n in ("t-landed", "t-dates", "t-cd-ckpt"))
    expected = spark.createDataFrame([("2024-01-01", 2), ("2024-01-02", 3), ("2024-03-01", 1), ("2023-06-01", 1)],
                                     "date string, n_expected int").select(F.col("date").cast("date").alias("date"), "n_expected")
    drops = [[("a/1", "2024-01-01"), ("b/1", "2024-01-02")],
             [("a/1", "2024-01-01"), ("b/2", "2024-01-02")],
             [("a/2", "2024-01-01"), ("b/1", "2024-01-02"), ("c/1", "2024-03-01")],
             [("b/3", "2024-01-02"), ("c/1", "2024-03-01"), ("d/1", "2023-06-01")]]
    got = []
    for rows in drops:
        spark.createDataFrame(rows, "path string, date string").select("path", F.col("date").cast("date").alias("date")) \
            .write.mode("append").parquet(landing)
        record_complete_dates(spark, landing, "path string, date date", expected, out, ckpt)
        got.append(sorted((str(r["date"]), r["n_present"]) for r in spark.read.parquet(out).collect()))
    assert got == [[], [], [("2024-01-01", 2), ("2024-03-01", 1)],
                   [("2023-06-01", 1), ("2024-01-01", 2), ("2024-01-02", 3), ("2024-03-01", 1)]]


def test_expected_dates_are_stored_before_the_stream(spark, tmp_path, monkeypatch):
    """The product behind the expected counts is no part of the micro-batches' plans."""
    from gridloom.operators.dims import product
    from gridloom.streaming import windows
    day = lambda d: F.to_date(F.lit(f"2024-01-0{d}")).alias("date")
    expected = (product(spark.range(1).select(day(1)).union(spark.range(1).select(day(2))).distinct(),
                        spark.range(2).selectExpr("cast(id AS string) AS chunk").distinct())
                .groupBy("date").agg(F.count(F.lit(1)).alias("n_expected")))
    plans, stream = [], windows.complete_dates_stream

    def spy(landed, days, *a):
        plans.append(days._jdf.queryExecution().executedPlan().toString())
        return stream(landed, days, *a)

    monkeypatch.setattr(windows, "complete_dates_stream", spy)
    landing, out, ckpt = (str(tmp_path / n) for n in ("landing", "out", "ck"))
    (spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "path string, d int")
     .select("path", F.make_date(F.lit(2024), F.lit(1), "d").alias("date")).write.parquet(landing))
    windows.record_complete_dates(spark, landing, "path string, date date", expected, out, ckpt)
    assert [(str(r.date), r.n_present, r.n_expected) for r in spark.read.parquet(out).collect()] == [("2024-01-01", 2, 2)]
    assert len(plans) == 1 and "FileScan" in plans[0]
    assert not any(x in plans[0] for x in ("Cartesian", "NestedLoop", "Exchange"))


def test_late_rows_are_kept_aside_and_counted(spark, tmp_path):
    import datetime

    from gridloom.streaming.windows import hourly_grid_to_store
    landing, store, ckpt = (str(tmp_path / n) for n in ("landing", "store", "ck"))
    schema = "ts timestamp_ntz, cell int, value double"
    at = lambda day, hour, minute=0: datetime.datetime(2024, 1, day, hour, minute)
    drops = [[(at(1, 1), 0, 1.0), (at(3, 12), 0, 2.0)],
             [(at(3, 10, 30), 0, 5.0), (at(3, 9, 59), 0, 9.0), (at(1, 1, 30), 0, 7.0), (at(3, 12, 59), 0, 1.0), (at(4, 0), 1, 3.0)],
             [(at(3, 12), 0, 99.0), (at(4, 0, 5), 1, 4.0)]]
    late = []
    for rows in drops:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        late.append(hourly_grid_to_store(spark, landing, schema, store, ckpt, "ts", ["cell"], lateness="2 hours"))
    # closed before the second drop: hours that end by 10:00 of the 3rd; before the third: by 22:00 of it
    assert late == [0, 2, 3]
    assert sorted((r.ts, r.value) for r in spark.read.parquet(f"{store}.late").collect()) == [
        (at(1, 1, 30), 7.0), (at(3, 9, 59), 9.0), (at(3, 12), 99.0)]
    got = {(r.window_start, r.cell): (r.n, r.max_value) for r in ST.read_store(spark, store).collect()}
    assert got == {(at(1, 1), 0): (1, 1.0), (at(3, 10), 0): (1, 5.0), (at(3, 12), 0): (2, 2.0), (at(4, 0), 1): (2, 4.0)}
    assert hourly_grid_to_store(spark, landing, schema, store, ckpt, "ts", ["cell"], lateness="2 hours") == 3
    assert {r.date.day for r in spark.read.parquet(f"{store}.parts").select("date").collect()} == {3, 4}


def test_disjoint_region_writes_commute(spark, sf_dir):
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    base = g.withColumn("value", F.lit(0.0))
    a, b = g.where(F.dayofmonth("time") == 5), g.where(F.dayofmonth("time") == 6)
    p1, p2 = scratch_path(spark, "t-ab"), scratch_path(spark, "t-ba")
    for path, order in ((p1, (a, b)), (p2, (b, a))):
        ST.write_store(base, path)
        for region in order:
            ST.overwrite_regions(region, path)
    assert _sorted(ST.read_store(spark, p1)) == _sorted(ST.read_store(spark, p2))


def test_hot_region_is_split_across_tasks(spark):
    import glob
    path = scratch_path(spark, "t-hot")
    hot = spark.range(300_000).select(F.lit("hot").alias("variable"), F.lit("2024-01-01").cast("date").alias("date"),
                                      F.col("id").alias("cell"), (F.col("id") * 0.5).alias("value"))
    cold = spark.range(3_000).select(F.concat(F.lit("v"), (F.col("id") % 5).cast("string")).alias("variable"),
                                     F.lit("2024-01-02").cast("date").alias("date"), F.col("id").alias("cell"),
                                     F.col("id").cast("double").alias("value"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        ST.write_store(hot.unionByName(cold), path)
    finally:
        spark.conf.set(key, old)
    local = path.replace("file:", "")
    files = glob.glob(f"{local}/variable=hot/date=2024-01-01/*.parquet")
    assert len(files) > 1                                  # the hot region was written by several tasks
    assert ST.read_store(spark, path).count() == 303_000   # and nothing was dropped


def test_stream_ingest_resumes_from_checkpoint(spark, sf_dir):
    from gridloom.streaming import ingest
    landing, store, ckpt = (scratch_path(spark, n) for n in ("t-land", "t-store", "t-ckpt"))
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    schema = ("time timestamp_ntz, variable string, lat_idx int, lon_idx int, latitude float, longitude float, "
              "value double, date date")
    g.where(F.dayofmonth("time") <= 10).write.mode("append").parquet(landing)
    ingest.ingest_new_blocks(spark, landing, schema, store, ckpt)
    first = ST.read_store(spark, store).count()
    g.where(F.dayofmonth("time") > 10).write.mode("append").parquet(landing)
    ingest.ingest_new_blocks(spark, landing, schema, store, ckpt)      # same checkpoint: only the new files
    assert first == g.where(F.dayofmonth("time") <= 10).count()
    assert _sorted(ST.read_store(spark, store).select(*g.columns)) == _sorted(g)


def test_chunk_layout_store_round_trip(spark, sf_dir):
    path = scratch_path(spark, "t-chunkstore")
    g = S.v_grid(spark, sf_dir).select("time", "variable", "lat_idx", "lon_idx", "value")
    packed = layout.chunk_pack(g, ["time", "variable"], 4, 6).withColumn("date", F.col("time").cast("date"))
    ST.write_store(packed, path)
    back = layout.chunk_explode(ST.read_store(spark, path), "values", 6, ["time", "variable"]) \
        .where(F.col("value").isNotNull()).select("time", "variable", "lat_idx", "lon_idx", "value")
    assert _sorted(back) == _sorted(g)


def test_drop_blocks_removes_whole_partitions_once(spark, sf_dir):
    path = scratch_path(spark, "t-drop")
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.write_store(g, path)
    gone = g.where(F.dayofmonth("date") == 5).select("variable", "date").distinct()
    for _ in range(2):
        ST.drop_blocks(spark, path, gone)
        assert _sorted(ST.read_store(spark, path).select(*g.columns)) == _sorted(g.where(F.dayofmonth("date") != 5))


def test_listing_matches_the_file_system(spark, sf_dir):
    import glob
    import os
    from gridloom.plans.registry import QUERIES
    got = {r["path"].removeprefix("//"): (r["name"], r["length"]) for r in QUERIES["listing"](spark, sf_dir).collect()}
    assert got == {p: (os.path.basename(p), os.path.getsize(p)) for p in glob.glob(f"{sf_dir}/*.parquet")}
