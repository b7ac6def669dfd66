"""Registered queries of the composed jobs: each runs the job on stores of its own
under the checkpoint folder and returns what the job leaves there."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.paths import ar_file_path, grouped_file_path
from ..operators import layout, met
from ..session import scratch_path
from ..sinks import axis, chunks
from ..sinks import store as ST
from ..sources import standins as S
from ..sources.tables import table
from . import jobs
from .q_manifest import ROOT, SQL_VAR_LEVELS, _grid_variables, _sql_year_manifest
from .q_met import (GEO, N_LEVELS, NAT_COUNTS, NAT_HALF, NAT_NLAT, NAT_NLON, TRUNC, _e, _es, _sql_assemble_native, _td, d,
                    native_inputs)
from .q_release import SQL_COMBINED, _combined_and_reissued
from .q_store import _events_window
from .registry import register, sql_ar_path, sql_grouped_path, sql_list, with_views

SQL_RELEASE_MERGED = """m AS (SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value
      FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell)"""


@register("job_build_store", with_views(f"""WITH {SQL_RELEASE_MERGED}
SELECT time, variable, cell, value, CAST(time AS DATE) AS date FROM m""", "v_release"))
def q_job_build_store(spark, sf_dir):
    """Job build_store on raw blocks of both releases, half of the preliminary ones with an
    explicit missing value: one row per cell."""
    path = scratch_path(spark, "job-build")
    r = S.v_release(spark, sf_dir)
    hole = r.where(F.col("expver") == 5).where(F.col("cell") % 2 == 0).select(
        "time", "variable", "cell", F.lit(1).alias("expver"), F.lit(float("nan")).alias("value"))
    raw = r.select("time", "variable", "cell", "expver", "value").unionByName(hole).withColumnRenamed("time", "valid_time")
    jobs.build_store(raw.withColumn("number", F.lit(0)), path, keys=("time", "cell"))
    return ST.read_store(spark, path).select("time", "variable", "cell", "value", "date")


def _both_groups(spark, sf_dir):
    """Raw blocks of both releases: single-level fields, and multi-level ones at one level."""
    r = S.v_release(spark, sf_dir).withColumnRenamed("time", "valid_time")
    multi = F.length("variable") <= 5
    return r.where(~multi), r.where(multi).withColumn("level", F.lit(500))


SQL_BOTH = f"""{SQL_RELEASE_MERGED}, w AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) + 1 AS e FROM events),
v AS (SELECT DISTINCT event_type AS variable, CASE WHEN length(event_type) <= 5 THEN 500 END AS level FROM events)"""


@register("job_build_filled", with_views(f"""WITH {SQL_BOTH},
hours AS (SELECT unnest(generate_series(CAST(s - 2 AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time FROM w)
SELECT hours.time, v.variable, v.level, CAST(c AS INT) AS cell, m.value, CAST(hours.time AS DATE) AS date
FROM hours CROSS JOIN v CROSS JOIN range(24) r(c) LEFT JOIN m ON m.time = hours.time AND m.variable = v.variable AND m.cell = c""",
                                        "v_release"))
def q_job_build_filled(spark, sf_dir):
    """Job build_store as a whole: both groups merged, releases combined, written on an axis that begins
    two days before the data; read with all its missing cells."""
    path = scratch_path(spark, "job-build-axis")
    single, multi = _both_groups(spark, sf_dir)
    first, end = _events_window(spark, sf_dir)
    start = str(datetime.date.fromisoformat(first) - datetime.timedelta(days=2))
    jobs.build_store(single, path, ("time", "cell"), levels=multi, start=start, end=end, dims={"cell": 24})
    return axis.read_filled(spark, path)


@register("job_build_chunks", with_views(f"""WITH {SQL_BOTH}
SELECT m.variable, v.level, CAST(date_diff('hour', CAST(s AS TIMESTAMP), m.time) AS INT) AS step, m.cell, m.value
FROM m JOIN v USING (variable), w""", "v_release"))
def q_job_build_chunks(spark, sf_dir):
    """Job build_store into chunks of 48 hours x 10 cells: the cells that the store holds."""
    path = scratch_path(spark, "job-build-chunks")
    single, multi = _both_groups(spark, sf_dir)
    first, end = _events_window(spark, sf_dir)
    n = 24 * (datetime.date.fromisoformat(end) - datetime.date.fromisoformat(first)).days
    by = chunks.Chunking(("step", "cell"), (n, 24), (48, 10))
    jobs.build_store(single, path, ("time", "cell"), levels=multi, start=first, end=end, chunking=by)
    return chunks.to_cells(chunks.read(spark, path, by), ["variable", "level"], by).where(F.col("value").isNotNull())


LISTED_LEVEL = fixed.PRESSURE_LEVEL_GROUPS["full_37"]


@register("job_check_availability", f"""
WITH {SQL_VAR_LEVELS},
day AS (SELECT CAST(max(ts) AS DATE) - 6 AS date FROM events),
ml AS (SELECT unnest({sql_list(fixed.MODEL_LEVEL_CHUNKS)}) AS chunk),
expected AS (SELECT {sql_grouped_path(ROOT, 'date', 'chunk', False)} AS path FROM day, ml
             UNION ALL SELECT {sql_ar_path(ROOT, 'date', 'variable', 'level')} AS path FROM day, vl),
here AS (SELECT DISTINCT CAST(ts AS DATE) AS date, event_type AS variable,
                CASE WHEN length(event_type) <= 5 THEN CAST({sql_list(LISTED_LEVEL)}[CAST(event_id % 37 AS INT) + 1] AS INT) END AS level FROM events),
listed AS (SELECT {sql_ar_path(ROOT, 'date', 'variable', 'level')} AS path FROM here)
SELECT count(*) AS n_missing, count(*) > 0 AS data_is_missing FROM expected WHERE path NOT IN (SELECT path FROM listed)""")
def q_job_check_availability(spark, sf_dir):
    """Job check_availability, daily mode: files of the refresh day that the listing (the fields and
    levels that have events) lacks."""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("variable"), "event_id")
    level = F.when(F.length("variable") <= 5, F.element_at(F.array(*[F.lit(x) for x in LISTED_LEVEL]), (F.col("event_id") % 37 + 1).cast("int")))
    listing = e.select("date", "variable", level.alias("level")).distinct().select(
        ar_file_path(F.lit(ROOT), "date", "variable", F.col("level")).alias("path"))
    today = e.agg(F.max("date").cast("string")).first()[0]
    return jobs.check_availability(spark, today, fixed.MODE_DAILY, listing, ROOT, _grid_variables(spark, sf_dir))


SQL_LISTED_NAMES = f"""SELECT DISTINCT 'raw/ERA5GRIB/HRES/Daily/' || strftime(o_orderdate, '%Y') || '/' || strftime(o_orderdate, '%Y%m%d') || '_hres_'
       || {sql_list([*fixed.CHECK_DAILY_CHUNKS, 'stray'])}[CAST(o_custkey % {len(fixed.CHECK_DAILY_CHUNKS) + 1} AS INT) + 1]
       || CASE WHEN o_orderkey % 11 = 0 THEN '.tmp' ELSE '.grb2' END AS name FROM orders"""


@register("job_check_consistency", f"""
SELECT name FROM ({SQL_LISTED_NAMES}) WHERE name NOT IN (SELECT name FROM ({_sql_year_manifest()}))""")
def q_job_check_consistency(spark, sf_dir):
    """Job check_consistency: names under the year prefixes (one a day and chunk with orders, some of
    them strays) that the archive does not expect."""
    o = table(spark, sf_dir, "orders")
    names = [*fixed.CHECK_DAILY_CHUNKS, "stray"]
    chunk = F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("o_custkey") % len(names) + 1).cast("int"))
    listing = o.select(F.concat(F.lit("raw/ERA5GRIB/HRES/Daily/"), F.date_format("o_orderdate", "yyyy"), F.lit("/"),
                                F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_hres_"), chunk,
                                F.when(F.col("o_orderkey") % 11 == 0, F.lit(".tmp")).otherwise(F.lit(".grb2"))).alias("name")).distinct()
    return jobs.check_consistency(spark, o.select(F.year("o_orderdate").alias("year")).distinct(), listing)


@register("job_derive", with_views(f"""WITH {GEO}
SELECT time, cell, k, round(p, 4) AS p, round(z, 3) AS geopotential, round({d(100.0)} * {_e('q', 'p')} / {_es('t')}, 4) AS r,
       round({_td('q', 'p')}, 4) AS td, round(sqrt(u * u + v * v), 6) AS ws, t AS temperature, q AS specific_humidity
FROM gz""", "v_levels", "v_surface"))
def q_job_derive(spark, sf_dir):
    """Job derive: pressure, geopotential, humidity, dewpoint and wind speed of every column, under long names."""
    lv = S.v_levels(spark, sf_dir)
    wind = lv.withColumn("u", F.col("x") / F.lit(1000.0) - F.lit(50.0)).withColumn("v", F.col("t") - F.lit(255.0))
    out = jobs.derive(spark, wind, S.v_surface(lv), met.hybrid_coefficients(spark, N_LEVELS))
    places = {"p": 4, "geopotential": 3, "r": 4, "td": 4, "ws": 6}
    return out.select("time", "cell", "k", *[F.round(c, n).alias(c) for c, n in places.items()], "temperature", "specific_humidity")


@register("job_update_daily", with_views(f"""
WITH w AS (SELECT CAST(min(ts) AS DATE) + 9 AS s, CAST(min(ts) AS DATE) + 11 AS e FROM events), {SQL_RELEASE_MERGED},
x AS (SELECT time, variable, cell, value FROM v_release, w WHERE expver = 5 AND NOT CAST(time AS DATE) BETWEEN s AND e
      UNION ALL SELECT time, variable, cell, value FROM m, w WHERE CAST(time AS DATE) BETWEEN s AND e)
SELECT time, variable, cell, CASE WHEN length(variable) <= 5 THEN 500 END AS level, value, CAST(time AS DATE) AS date FROM x""",
                                        "v_release"))
def q_job_update_daily(spark, sf_dir):
    """Job update_daily: a store of preliminary data gets three days of single and
    multi-level fields, merged, final over preliminary."""
    path = scratch_path(spark, "job-daily")
    r = S.v_release(spark, sf_dir).withColumn("level", F.when(F.length("variable") <= 5, F.lit(500)))
    ST.write_store(r.where(F.col("expver") == 5).drop("expver").withColumn("date", F.col("time").cast("date")), path)
    first = _events_window(spark, sf_dir)[0]
    start, end = spark.range(1).select(*[F.date_add(F.lit(first).cast("date"), n).cast("string") for n in (9, 11)]).first()
    jobs.update_daily(r.where("level IS NULL").drop("level"), path, start, end, keys=("time", "cell"),
                      levels=r.where("level IS NOT NULL"))
    return ST.read_store(spark, path).select("time", "variable", "cell", "level", "value", "date")


@register("job_update_files", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, CASE user_id % 3 WHEN 0 THEN 't' ELSE 'w' END AS variable,
       CAST(user_id % 24 AS INT) AS cell, CAST(event_id % 2 AS INT) AS level, max(value) AS value, CAST(ts AS DATE) AS date
FROM events WHERE user_id % 3 < 2 AND event_id % 7 <> 0 GROUP BY 1, 2, 3, 4, 6""")
def q_job_update_files(spark, sf_dir):
    """Job update_files: day files of one chunk; rows of other variables and rows outside a
    file's day stay out, levels are kept."""
    path = scratch_path(spark, "job-files")
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_id", "value")
    stray = (F.col("event_id") % 7 == 0).cast("int")          # found in the next day's file
    name = F.element_at(F.array(*[F.lit(x) for x in ("t", "w", "q")]), (F.col("user_id") % 3 + 1).cast("int"))
    raw = e.groupBy(F.date_add(F.col("ts").cast("date"), stray).alias("day"), name.alias("short_name"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
                    (F.col("user_id") % 24).cast("int").alias("cell"), (F.col("event_id") % 2).cast("int").alias("level")) \
        .agg(F.max("value").alias("value")) \
        .withColumn("path", grouped_file_path(F.lit("raw"), "day", F.lit("tw"), F.lit(False))).drop("day")
    jobs.update_files(spark, raw.select("path").distinct(), raw, path, _events_window(spark, sf_dir)[0])
    return ST.read_store(spark, path).select("time", "variable", "cell", "level", "value", "date")


@register("job_reconcile_release", with_views(f"""WITH {SQL_COMBINED},
cur AS (SELECT DISTINCT variable, date FROM o WHERE day(date) <> 22),
st AS (SELECT DISTINCT variable, date FROM n WHERE day(date) <> 20)
SELECT variable, date, CASE WHEN st.date IS NULL THEN 'absent' WHEN cur.date IS NULL THEN 'added'
                            WHEN eq.equal THEN 'ratified' ELSE 'data_changed' END AS status,
       CAST(CASE WHEN cur.date IS NULL OR (st.date IS NOT NULL AND NOT eq.equal) THEN nb.cells ELSE ob.cells END AS BIGINT) AS cells,
       false AS still_staged
FROM (SELECT * FROM cur UNION SELECT * FROM st) b
LEFT JOIN cur USING (variable, date) LEFT JOIN st USING (variable, date) LEFT JOIN eq USING (variable, date)
LEFT JOIN (SELECT variable, date, count(*) AS cells FROM n GROUP BY 1, 2) nb USING (variable, date)
LEFT JOIN (SELECT variable, date, count(*) AS cells FROM o GROUP BY 1, 2) ob USING (variable, date)""", "v_release"))
def q_job_reconcile_release(spark, sf_dir):
    """Job reconcile_release with promotion: audit, rows of each block afterwards, and
    whether its staged copy is still there."""
    cur_path, staged_path, audit = (scratch_path(spark, n) for n in ("job-cur", "job-staged", "job-audit"))
    old, new = _combined_and_reissued(spark, sf_dir)
    ST.write_store(old.where(F.dayofmonth("date") != 22).drop("expver_used"), cur_path)
    ST.write_store(new.where(F.dayofmonth("date") != 20), staged_path)
    jobs.reconcile_release(spark, ST.read_store(spark, cur_path), ST.read_store(spark, staged_path), cur_path,
                           cell_keys=("time", "cell"), audit_table=audit, staged_path=staged_path)
    block = ["variable", "date"]
    cells = ST.read_store(spark, cur_path).groupBy(*block).agg(F.count(F.lit(1)).alias("cells"))
    left = spark.read.schema("time timestamp_ntz, variable string, cell int, value double, date date").option(
        "basePath", staged_path).parquet(staged_path).select(*block).distinct().withColumn("still_staged", F.lit(True))
    return (spark.read.parquet(audit).join(cells, block, "left").join(left, block, "left")
            .select(*block, "status", "cells", F.coalesce("still_staged", F.lit(False)).alias("still_staged")))


FILE_SQL = "strftime(date, '%Y%m%d') || '/' || chunk"


@register("job_find_missing", with_views(f"""
SELECT {FILE_SQL} AS path FROM v_expected EXCEPT SELECT {FILE_SQL} FROM v_actual""", "v_expected", "v_actual"))
def q_job_find_missing(spark, sf_dir):
    """Job find_missing: paths of the pattern that are not in the listing."""
    path = F.concat_ws("/", F.date_format("date", "yyyyMMdd"), "chunk").alias("path")
    return jobs.find_missing(S.v_expected(spark, sf_dir).select(path), S.v_actual(spark, sf_dir).select(path))


SQL_NATIVE_LONG = f"""nat AS (SELECT time, cell, k, t, q, w, x, z, p, {d(100.0)} * {_e('q', 'p')} / {_es('t')} AS r, {_td('q', 'p')} AS td FROM gz),
long AS (SELECT time, cell, k, variable, round(value, 3) AS value FROM nat UNPIVOT INCLUDE NULLS (value FOR variable IN (t, q, w, x, z, p, r, td)))"""


@register("job_update_native", with_views(f"""WITH {GEO}, {SQL_NATIVE_LONG},
bad AS (SELECT time FROM v_levels GROUP BY time, cell HAVING count(DISTINCT k) <> {N_LEVELS})
SELECT time, cell, k, CASE variable WHEN 't' THEN '{fixed.SHORT_TO_LONG["t"]}' WHEN 'q' THEN '{fixed.SHORT_TO_LONG["q"]}'
       WHEN 'w' THEN '{fixed.SHORT_TO_LONG["w"]}' WHEN 'z' THEN '{fixed.SHORT_TO_LONG["z"]}' ELSE variable END AS variable,
       CASE WHEN time NOT IN (SELECT time FROM bad) THEN value END AS value, CAST(time AS DATE) AS date
FROM long""", "v_levels", "v_surface"))
def q_job_update_native(spark, sf_dir):
    """Job update_native over all hours of the data, into a store of missing values; hours with an
    incomplete column are skipped and stay as they were."""
    path = scratch_path(spark, "job-native")
    lv = S.v_levels(spark, sf_dir)
    names = [fixed.SHORT_TO_LONG.get(c, c) for c in ("t", "q", "w", "x", "z", "p", "r", "td")]
    ST.write_store(lv.select("time", "cell", "k", F.explode(F.array(*[F.lit(n) for n in names])).alias("variable"),
                             F.lit(None).cast("double").alias("value"), F.col("time").cast("date").alias("date")), path)
    w = lv.agg(F.min("time").cast("date").cast("string").alias("s"), F.max("time").cast("date").cast("string").alias("e")).first()
    jobs.update_native(spark, lv, S.v_surface(lv), met.hybrid_coefficients(spark, N_LEVELS), path, w["s"], w["e"],
                       N_LEVELS, on_error="skip")
    return ST.read_store(spark, path).select("time", "cell", "k", "variable", F.round("value", 3).alias("value"), "date")


@register("job_update_native_wind", f"""
WITH whole AS ({_sql_assemble_native()}),
hours AS (SELECT TIMESTAMP '2020-01-01 00:00:00' + to_hours(CAST(vec_id // 7 AS BIGINT)) AS time FROM embeddings
          GROUP BY vec_id // 7 HAVING count(DISTINCT vec_id % 7) = 7 AND (vec_id // 7) % 5 <> 3)
SELECT whole.*, (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT vec_id // 7 FROM embeddings)) AS n_hours,
       (SELECT CAST(max(time) AS DATE) FROM hours) AS last_day
FROM whole SEMI JOIN hours USING (time)""")
def q_job_update_native_wind(spark, sf_dir):
    """Job update_native as a whole: spectral wind and columns of every hour of the data -> fields on
    the regular grid -> hour regions of an array store that starts as a skeleton -> validity end.
    Hours that lack a level (every fifth, and a part hour at the end) are skipped."""
    path, attrs = scratch_path(spark, "job-native-wind"), scratch_path(spark, "job-native-attrs")
    wind, levels, surface = native_inputs(spark, sf_dir)
    hour = F.timestamp_diff("HOUR", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), F.col("time"))
    levels = levels.where((hour % 5 != 3) | (F.col("k") != 4))
    w = levels.agg(F.min("time").cast("date").cast("string"), F.max("time").cast("date").cast("string"),
                   F.count_distinct("time")).first()
    names = [fixed.SHORT_TO_LONG.get(c, c) for c in ("t", "q", "w", "z", "u", "v")]
    jobs.init_native(spark, path, w[0], w[1], {}, N_LEVELS, names, "array<double>")
    grid = jobs.NativeGrid(TRUNC, NAT_HALF, NAT_NLAT, NAT_NLON, NAT_COUNTS)
    jobs.update_native(spark, levels, surface, met.hybrid_coefficients(spark, N_LEVELS), path, w[0], w[1], N_LEVELS,
                       on_error="skip", wind=wind, grid=grid, attrs_path=attrs, store_name="native")
    z = F.col("variable") == fixed.SHORT_TO_LONG["z"]
    rows = layout.chunk_explode(ST.read_store(spark, path), "values", NAT_NLON, ["time", "k", "variable"])
    end = spark.read.parquet(attrs).select(F.col("attrs")["valid_time_stop_era5t"].cast("date").alias("last_day"))
    return rows.select("time", "k", "variable", "lat_idx", "lon_idx",
                       F.when(z, F.round("value", 2)).otherwise(F.round("value", 6)).alias("value"),
                       F.lit(w[2]).cast("long").alias("n_hours")).crossJoin(F.broadcast(end))
