"""Region writes replace exactly their region; releases keep missing cells."""

import datetime

import pytest

from gridloom.operators import fields, release
from gridloom.plans import jobs
from gridloom.sinks import store as ST
from gridloom.streaming import ingest

DAY = datetime.date(2020, 1, 1)
SCHEMA = "variable string, date date, time timestamp_ntz, level int, cell int, value double"


def rows(level, value, cells=range(3), hour=0, date=DAY):
    t = datetime.datetime.combine(date, datetime.time(hour))
    return [("t", date, t, level, c, value) for c in cells]


def test_level_files_land_one_after_the_other(spark, tmp_path):
    landing, store, ck = (str(tmp_path / x) for x in ("landing", "store", "ck"))
    for level in (500, 850):
        spark.createDataFrame(rows(level, float(level)), SCHEMA).write.mode("append").parquet(landing)
        ingest.ingest_new_blocks(spark, landing, SCHEMA, store, ck)
    got = {(r.level, r.cell): r.value for r in spark.read.parquet(store).collect()}
    assert got == {(lv, c): float(lv) for lv in (500, 850) for c in range(3)}


def test_step_replaced_by_fewer_cells(spark, tmp_path):
    path = str(tmp_path / "s")
    ST.write_store(spark.createDataFrame(rows(500, 1.0) + rows(500, 1.0, hour=6) + rows(500, 1.0, date=DAY + datetime.timedelta(1)),
                                         SCHEMA), path)
    ST.overwrite_steps(spark, path, spark.createDataFrame(rows(500, 2.0, cells=[0], hour=6), SCHEMA))
    got = sorted((r.date.day, r.time.hour, r.cell, r.value) for r in spark.read.parquet(path).collect())
    assert got == [(1, 0, 0, 1.0), (1, 0, 1, 1.0), (1, 0, 2, 1.0), (1, 6, 0, 2.0), (2, 0, 0, 1.0), (2, 0, 1, 1.0), (2, 0, 2, 1.0)]


def test_touched_partitions_are_literal_filters(spark, tmp_path):
    path = str(tmp_path / "s")
    ST.write_store(spark.createDataFrame(rows(500, 1.0), SCHEMA), path)
    plan = ST.read_touched(spark, path, spark.createDataFrame(rows(500, 2.0), SCHEMA), ("variable", "date"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "(variable#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_release_merge_into_a_plain_store(spark, tmp_path):
    """A store without release marks keeps its other rows."""
    landing, store, ck = (str(tmp_path / x) for x in ("landing", "store", "ck"))
    schema = "variable string, date date, cell int, value double, expver int"
    ST.write_store(spark.createDataFrame([("t", DAY, 0, 1.0), ("t", DAY, 1, 1.0)], "variable string, date date, cell int, value double"),
                   store)
    spark.createDataFrame([("t", DAY, 1, 9.0, 5)], schema).write.parquet(landing)
    ingest.ingest_releases(spark, landing, schema, store, ck, ["cell"])
    assert {r.cell: r.value for r in spark.read.parquet(store).collect()} == {0: 1.0, 1: 9.0}


def test_combine_keeps_missing_cells_and_later_deliveries(spark):
    df = spark.createDataFrame([(0, 1, None, 0), (0, 5, None, 0), (1, 1, 7.0, 0), (1, 1, 3.0, 1), (2, 5, 4.0, 9), (2, 1, 2.0, 0)],
                               "cell int, expver int, value double, arrival int")
    got = {r.cell: (r.value, r.expver_used) for r in release.combine_releases(df, ["cell"], arrival="arrival").collect()}
    assert got == {0: (None, None), 1: (3.0, 1), 2: (2.0, 1)}


def test_raw_keeps_its_type(spark):
    df = spark.createDataFrame([("f", "t", 1.5), ("f", "t", float("nan"))], "path string, variable string, value float")
    out = fields.normalize_raw(df)
    assert dict(out.dtypes)["value"] == "float" and sorted((r.value is None) for r in out.collect()) == [False, True]


def test_build_store_combines_releases(spark, tmp_path):
    t = datetime.datetime(2020, 1, 1)
    raw = spark.createDataFrame([("a", "t", t, 0, 0, 1, float("nan")), ("b", "t", t, 0, 0, 5, 2.0), ("a", "t", t, 0, 1, 1, 3.0)],
                                "path string, variable string, valid_time timestamp_ntz, lat_idx int, lon_idx int, expver int, value float")
    path = str(tmp_path / "s")
    jobs.build_store(raw, path)
    assert {r.lon_idx: r.value for r in spark.read.parquet(path).collect()} == {0: 2.0, 1: 3.0}


def test_staged_only_block_is_written_and_audited(spark, tmp_path):
    path = str(tmp_path / "s")
    schema = "variable string, date date, time timestamp_ntz, lat_idx int, lon_idx int, value double"
    t = datetime.datetime(2020, 1, 1)
    ST.write_store(spark.createDataFrame([("t", DAY, t, 0, 0, 1.0)], schema), path)
    current = ST.read_store(spark, path)
    staged = spark.createDataFrame([("q", DAY, t, 0, 0, 5.0)], schema)
    audit = {(r.variable, r.status) for r in jobs.reconcile_release(spark, current, staged, path).collect()}
    assert audit == {("t", "absent"), ("q", "added")}
    spark.catalog.refreshByPath(path)
    assert {(r.variable, r.value) for r in spark.read.parquet(path).collect()} == {("t", 1.0), ("q", 5.0)}


def test_missing_store_is_not_any_error(spark, tmp_path):
    bad = tmp_path / "attrs"
    bad.mkdir()
    (bad / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        ST.upsert_store_attrs_table(spark, str(bad), "s", "2020-01-01", "daily", "now")
    assert (bad / "part.parquet").exists()


def test_a_write_without_rows_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    none = spark.createDataFrame([], SCHEMA)
    ST.replace_regions(spark, path, none, ["time"])
    assert not ST.store_exists(spark, path)
    ST.write_store(spark.createDataFrame(rows(500, 1.0), SCHEMA), path)
    ST.replace_regions(spark, path, none, ["time"])
    assert spark.read.parquet(path).count() == 3
