"""Calendar logic checked in bulk against pandas / the standard library on random inputs."""

import calendar
import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from gridloom.functions import dates as D
from gridloom.sinks.store import file_region

RNG = random.Random(11)


def _random_dates(n, lo=dt.date(1940, 1, 1), hi=dt.date(2030, 12, 31)):
    span = (hi - lo).days
    return [lo + dt.timedelta(days=RNG.randrange(span)) for _ in range(n)]


def test_month_start_axis_matches_pandas(spark):
    starts = _random_dates(300)
    pairs = [(s, s + dt.timedelta(days=RNG.randrange(0, 200))) for s in starts]
    df = spark.createDataFrame(pairs, "s date, e date").select("s", "e", D.date_axis("s", "e", "MS").alias("ms"),
                                                               D.date_axis("s", "e", "D").alias("d"))
    for r in df.collect():
        assert list(r["ms"]) == [x.date() for x in pd.date_range(r["s"], r["e"], freq="MS")]
        assert len(r["d"]) == (r["e"] - r["s"]).days + 1


def _prev_month(d):
    last = d.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def test_processing_window_matches_rule(spark):
    days = _random_dates(300)
    modes = ["daily", "monthly", "era5"]
    rows = [(d, m) for d in days for m in modes]
    df = spark.createDataFrame(rows, "today date, mode string").select(
        "today", "mode", D.processing_window("today", "mode").alias("w"))
    for r in df.collect():
        t, m = r["today"], r["mode"]
        if m == "daily":
            first = last = t - dt.timedelta(days=6)
        elif m == "monthly":
            first, last = _prev_month(t)
        else:
            first, last = _prev_month(t - dt.timedelta(days=2 * 366 / 12))
        assert (r["w"]["first_day"], r["w"]["last_day"]) == (first, last)
        assert (r["w"]["sl_year"], r["w"]["sl_month"]) == (f"{first.year:04d}", f"{first.month:02d}")


def test_month_file_regions_match_calendar(spark):
    init = dt.date(1940, 1, 1)
    months = sorted({d.replace(day=1) for d in _random_dates(200)})
    paths = [(f"r/ERA5GRIB/HRES/Month/{m:%Y}/{m:%Y%m}_hres_sfc.grb2",) for m in months]
    got = file_region(spark.createDataFrame(paths, "path string"), str(init), 24).collect()
    for r, m in zip(sorted(got, key=lambda x: x["path"]), months):
        start = (m - init).days * 24
        assert (r["region_start"], r["region_end"]) == (start, start + 24 * calendar.monthrange(m.year, m.month)[1])


def test_hour_offsets_round_trip(spark):
    ts = [dt.datetime(1940, 1, 1) + dt.timedelta(hours=RNG.randrange(800_000)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz").select(
        "t", D.time_offset_hours(F.lit("1940-01-01").cast("timestamp_ntz"), "t").alias("i"))
    df = df.select("t", "i", D.offset_to_time(F.lit("1940-01-01"), "i").alias("back"))
    for r in df.collect():
        assert r["i"] == int((r["t"] - dt.datetime(1940, 1, 1)).total_seconds() // 3600)
        assert r["back"] == r["t"]
