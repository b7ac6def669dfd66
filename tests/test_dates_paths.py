"""Vectors from the archive's documented examples and calendar edge cases."""

from pyspark.sql import functions as F

from gridloom.functions import dates as D
from gridloom.functions import paths as P
from gridloom.sinks.store import file_region


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_month_range_before(spark):
    r = one(spark, D.processing_window(F.lit("2023-07-18"), F.lit("monthly")))
    assert (str(r["first_day"]), str(r["last_day"]), r["sl_year"], r["sl_month"]) == \
        ("2023-06-01", "2023-06-30", "2023", "06")


def test_final_and_daily_windows(spark):
    r = one(spark, D.processing_window(F.lit("2023-07-18"), F.lit("era5")))
    assert (str(r["first_day"]), str(r["last_day"])) == ("2023-04-01", "2023-04-30")
    r = one(spark, D.processing_window(F.lit("2023-07-18"), F.lit("daily")))
    assert str(r["first_day"]) == str(r["last_day"]) == "2023-07-12"


def test_daily_iterator_inclusive(spark):
    days = one(spark, D.date_axis(F.lit("2023-09-01"), F.lit("2023-09-05")))
    assert [str(d) for d in days] == [f"2023-09-0{i}" for i in range(1, 6)]


def test_month_start_axis(spark):
    ms = one(spark, D.date_axis(F.lit("2023-01-15"), F.lit("2023-04-01"), "MS"))
    assert [str(d) for d in ms] == ["2023-02-01", "2023-03-01", "2023-04-01"]


def test_hour_axis_covers_whole_end_day(spark):
    hrs = one(spark, D.hour_axis(F.lit("2023-09-01"), F.lit("2023-09-02")))
    assert len(hrs) == 48


def test_offset_ten_days_is_240(spark):
    assert one(spark, D.day_offset_hours(F.lit("1959-01-01"), F.lit("1959-01-11"))) == 240


def test_paths(spark):
    m = one(spark, P.grouped_file_path(F.lit("gs://b/raw"), F.lit("2023-09-11"), F.lit("dve"), F.lit(True)))
    d = one(spark, P.grouped_file_path(F.lit("gs://b/raw"), F.lit("2023-09-11"), F.lit("dve"), F.lit(False)))
    s = one(spark, P.grouped_file_path(F.lit("r"), F.lit("2023-09-11"), F.lit("soil_depthBelowLandLayer_istl1"),
                                       F.lit(True)))
    assert m == "gs://b/raw/ERA5GRIB/HRES/Month/2023/202309_hres_dve.grb2"
    assert d == "gs://b/raw/ERA5GRIB/HRES/Daily/2023/20230911_hres_dve.grb2"
    assert s == "r/ERA5GRIB/HRES/Month/2023/202309_hres_soil.grb2_depthBelowLandLayer_istl1.grib"


def test_surface_geopotential_alias_round_trip(spark):
    p = one(spark, P.ar_file_path(F.lit("r"), F.lit("2021-01-01"), F.lit("geopotential_at_surface")))
    assert p == "r/date-variable-single_level/2021/01/01/geopotential/surface.nc"
    parsed = one(spark, P.parse_ar_path(F.lit(p)))
    assert parsed["variable"] == "geopotential_at_surface" and parsed["level"] is None


def test_leap_february_region(spark):
    f = spark.createDataFrame([("r/ERA5GRIB/HRES/Month/2024/202402_hres_soil.grb2_surface_tsn.grib",)], "path string")
    r = file_region(f, "2024-01-01", 24).first()
    assert r["region_start"] == 31 * 24 and r["region_end"] - r["region_start"] == 29 * 24
    assert r["chunk"] == "soil_surface_tsn"


def test_slugify_and_url(spark):
    assert one(spark, P.slugify(F.lit("Job_Name 2024"))) == "-ob--ame-2024"
    assert one(spark, P.normalize_url(F.lit("https://example.com/data/file.txt"))) == "example.com/data/file.txt"
    assert one(spark, P.url_scheme(F.lit("gs://bucket/data/file.txt"))) == "gs"


def test_partial_labels(spark):
    from gridloom.operators.fields import time_label
    df = spark.createDataFrame([(f"2017-10-09 0{h}:30:00",) for h in range(5, 8)] + [("2017-11-01 00:00:00",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("time"))
    assert time_label(df, "2017-10-09T06").count() == 1
    assert time_label(df, "2017-10-09").count() == 3
    assert time_label(df, "2017-10").count() == 3
    assert time_label(df, "2017").count() == 4
