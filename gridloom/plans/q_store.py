"""Registered queries: store templates, region writes, metadata, audit, selection
specs, listings and streaming ingest (SNK-*, SRC-6, SRC-13, SRC-14, STM-1/2).

Queries that write return the state of the store read back after the write;
every write goes to a fresh folder under the session's checkpoint directory.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.dates import time_offset_hours
from ..operators import layout, manifest, release
from ..session import scratch_path
from ..sinks import axis
from ..sinks import store as ST
from ..sources import standins as S
from ..sources.selection import expand_spec
from ..sources.tables import table
from ..streaming import ingest
from .registry import register, sql_list, with_views

WB13 = fixed.PRESSURE_LEVEL_GROUPS["weatherbench_13"]
GRID_KEYS = ["lat_idx", "lon_idx"]


def _events_window(spark, sf_dir):
    """(first day, day after the last day) of the event data, as ISO strings."""
    r = table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("s"),
                                           F.date_add(F.max("ts").cast("date"), 1).alias("e")).first()
    return str(r["s"]), str(r["e"])


def _cells(spark):
    return F.broadcast(spark.range(24).select((F.col("id") / 6).cast("int").alias("lat_idx"),
                                              (F.col("id") % 6).cast("int").alias("lon_idx")))


def _grid_variables(spark, sf_dir):
    return (table(spark, sf_dir, "events").select(F.col("event_type").alias("variable")).distinct()
            .select("variable", (F.length("variable") <= 5).alias("is_multilevel")))


SQL_WINDOW = "w AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) + 1 AS e FROM events)"
SQL_HOURS = ("hours AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 1 HOUR, "
             "INTERVAL 1 HOUR)) AS time FROM w)")
SQL_CELLS = "cells AS (SELECT CAST(i // 6 AS INT) AS lat_idx, CAST(i % 6 AS INT) AS lon_idx FROM range(24) r(i))"
SQL_VARS = "vars AS (SELECT DISTINCT event_type AS variable FROM events)"


# ------------------------------------------------------------------ templates
@register("template_ar", f"""
WITH {SQL_WINDOW}, {SQL_HOURS},
v AS (SELECT DISTINCT event_type AS variable, length(event_type) <= 5 AS is_multilevel FROM events),
lv AS (SELECT CAST(unnest({sql_list(WB13)}) AS INT) AS level),
vl AS (SELECT variable, level FROM v, lv WHERE is_multilevel
       UNION ALL SELECT variable, CAST(NULL AS INT) FROM v WHERE NOT is_multilevel)
SELECT time, variable, level, list_transform(range(24), lambda i: CAST(NULL AS FLOAT)) AS "values" FROM hours, vl""")
def q_template_ar(spark, sf_dir):
    """SNK-1: skeleton of the analysis-ready store (hourly, end exclusive), chunk layout."""
    s, e = _events_window(spark, sf_dir)
    vl = manifest.variable_levels(spark, _grid_variables(spark, sf_dir), "weatherbench_13")
    return ST.chunk_template(spark, s, e, vl, 24)


@register("template_native", with_views("""
WITH t AS (SELECT DISTINCT time FROM v_levels),
hy AS (SELECT CAST(h AS INT) AS hybrid FROM range(1, 8) r(h)),
cells AS (SELECT CAST(i // 6 AS INT) AS lat_idx, CAST(i % 6 AS INT) AS lon_idx FROM range(24) r(i))
SELECT time, hybrid, CAST((hybrid - 1) // 18 AS INT) AS hybrid_chunk, lat_idx, lon_idx,
       CAST(90.0 - 60.0 * lat_idx AS FLOAT) AS latitude, CAST(60.0 * lon_idx AS FLOAT) AS longitude,
       CAST(NULL AS FLOAT) AS value
FROM t, hy, cells""", "v_levels"))
def q_template_native(spark, sf_dir):
    """SNK-2: native-vertical skeleton: every time of the data x hybrid levels x generated lat/lon axes."""
    every = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b)))
    # the cells of a step are made where the step is: nothing is broadcast
    t = S.v_levels(spark, sf_dir).select("time").distinct().withColumn("hybrid", every(1, 7))
    t = t.withColumn("lat_idx", every(0, 3)).withColumn("lon_idx", every(0, 5))
    return t.select("time", "hybrid", ((F.col("hybrid") - 1) / 18).cast("int").alias("hybrid_chunk"), "lat_idx", "lon_idx",
                    (F.lit(90.0) - F.lit(60.0) * F.col("lat_idx")).cast("float").alias("latitude"),
                    (F.lit(60.0) * F.col("lon_idx")).cast("float").alias("longitude"), F.lit(None).cast("float").alias("value"))


# ------------------------------------------------------------------ build / region writes
@register("build_store", with_views("SELECT *, CAST(time AS DATE) AS date FROM v_grid", "v_grid"))
def q_build_store(spark, sf_dir):
    """SNK-3 / SNK-15: bulk write partitioned by (variable, date); refuses an existing store."""
    path = scratch_path(spark, "build")
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.write_store(g, path)
    return ST.read_store(spark, path)


def _skeleton(spark, sf_dir, path, start, end, value_type="float"):
    """A store of the grid's variables on hours [start, end): axis and arrays, no rows."""
    return axis.create_store(spark, path, start, end, S.v_grid(spark, sf_dir).select("variable").distinct(),
                             {"lat_idx": 4, "lon_idx": 6}, value_type)


@register("init_store", f"""
WITH w0 AS (SELECT CAST(min(ts) AS DATE) - 5 AS s, CAST(max(ts) AS DATE) + 1 AS e FROM events),
w AS (SELECT * FROM w0), {SQL_HOURS}, {SQL_CELLS}, {SQL_VARS}
SELECT time, variable, lat_idx, lon_idx, CAST(NULL AS FLOAT) AS value, CAST(time AS DATE) AS date
FROM hours, vars, cells""")
def q_init_store(spark, sf_dir):
    """SNK-4: create the store skeleton only (no cell is stored), its axis starting 5 days before
    the data; the reader makes its missing cells."""
    s, e = _events_window(spark, sf_dir)
    init = str(datetime.date.fromisoformat(s) - datetime.timedelta(days=5))
    path = scratch_path(spark, "init")
    _skeleton(spark, sf_dir, path, init, e)
    return axis.read_filled(spark, path)


@register("region_write_day", with_views(f"""
WITH {SQL_WINDOW}, {SQL_HOURS}, {SQL_CELLS}, {SQL_VARS}
SELECT h.time, v.variable, c.lat_idx, c.lon_idx,
       CAST(CASE WHEN day(h.time) % 2 = 1 THEN g.value END AS FLOAT) AS value, CAST(h.time AS DATE) AS date
FROM hours h CROSS JOIN vars v CROSS JOIN cells c
LEFT JOIN v_grid g ON g.time = h.time AND g.variable = v.variable AND g.lat_idx = c.lat_idx AND g.lon_idx = c.lon_idx""",
                                         "v_grid"))
def q_region_write_day(spark, sf_dir):
    """SNK-5: day regions (odd days) written into a skeleton; other days and cells stay missing."""
    s, e = _events_window(spark, sf_dir)
    path = scratch_path(spark, "day")
    _skeleton(spark, sf_dir, path, s, e)
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.replace_regions(spark, path, g.where(F.dayofmonth("time") % 2 == 1).drop("latitude", "longitude"), ["time"])
    return axis.read_filled(spark, path)


def _levels_long(spark, sf_dir):
    lv = S.v_levels(spark, sf_dir)
    return layout.unpivot_long(lv, ["time", "cell", "k"], ["t", "q", "w", "x"]).withColumn(
        "date", F.col("time").cast("date"))


@register("region_write_file", with_views("""
SELECT time, cell, k, variable, CASE WHEN variable IN ('t', 'w') AND month(time) <= 6 THEN value ELSE value * 0.0 END AS value,
       CAST(time AS DATE) AS date
FROM v_levels UNPIVOT (value FOR variable IN (t, q, w, x))""", "v_levels"))
def q_region_write_file(spark, sf_dir):
    """SNK-6: a month file of chunk 'tw' overwrites its month for that chunk's variables only."""
    path = scratch_path(spark, "file")
    long = _levels_long(spark, sf_dir)
    ST.write_store(long.withColumn("value", F.col("value") * F.lit(0.0)), path)
    tw = set(fixed.CHUNK_VARIABLES["tw"])
    new = long.where(F.col("variable").isin(*tw) & (F.month("time") <= 6))
    ST.replace_regions(spark, path, new, ["time"])
    return ST.read_store(spark, path)


@register("region_write_hour", with_views("""
SELECT time, variable, lat_idx, lon_idx, latitude, longitude,
       CASE WHEN hour(time) = 12 THEN value ELSE value * 0.0 END AS value, CAST(time AS DATE) AS date
FROM v_grid""", "v_grid"))
def q_region_write_hour(spark, sf_dir):
    """SNK-7: one time step (12 UTC of every day) replaced inside its day partitions, staged."""
    path = scratch_path(spark, "hour")
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    ST.write_store(g.withColumn("value", F.col("value") * F.lit(0.0)), path)
    ST.overwrite_steps(spark, path, g.where(F.hour("time") == 12))
    return ST.read_store(spark, path)


PLEVEL_SQL = f"{sql_list(fixed.PRESSURE_LEVEL_GROUPS['full_37'])}[CAST((cell + k * 5) % 37 AS INT) + 1]"


@register("region_write_level", with_views(f"""
SELECT time, cell, variable, CASE WHEN level IN (500, 850) THEN value ELSE value * 0.0 END AS value,
       CAST(time AS DATE) AS date, level
FROM (SELECT time, cell, CAST({PLEVEL_SQL} AS INT) AS level, variable, value
      FROM v_levels UNPIVOT (value FOR variable IN (t, q, w, x)))""", "v_levels"))
def q_region_write_level(spark, sf_dir):
    """SNK-8: a pressure-level file overwrites its (time, level) region only."""
    from .q_fields import _plevels
    path = scratch_path(spark, "level")
    p = layout.unpivot_long(_plevels(spark, sf_dir), ["time", "cell", "level"], ["t", "q", "w", "x"]).withColumn(
        "date", F.col("time").cast("date"))
    ST.write_store(p.withColumn("value", F.col("value") * F.lit(0.0)), path)
    # (time, level) regions merged into their (variable, date) partitions, staged
    ST.overwrite_steps(spark, path, p.where(F.col("level").isin(500, 850)), ["level"])
    return ST.read_store(spark, path).select("time", "cell", "variable", "value", "date", "level")


@register("extend_axis", with_views("""
WITH w AS (SELECT CAST(max(time) AS DATE) AS s FROM v_grid),
axis AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(s AS TIMESTAMP) + INTERVAL 71 HOUR, INTERVAL 1 HOUR)) AS time FROM w),
k AS (SELECT variable, CAST(i // 6 AS INT) AS lat_idx, CAST(i % 6 AS INT) AS lon_idx FROM (SELECT DISTINCT variable FROM v_grid), range(24) r(i)),
g AS (SELECT time, variable, lat_idx, lon_idx, value FROM v_grid
      UNION ALL SELECT time + INTERVAL 24 HOUR, variable, lat_idx, lon_idx, value FROM v_grid, w WHERE CAST(time AS DATE) = s)
SELECT axis.time, k.variable, k.lat_idx, k.lon_idx, g.value, CAST(axis.time AS DATE) AS date
FROM axis CROSS JOIN k LEFT JOIN g ON g.time = axis.time AND g.variable = k.variable AND g.lat_idx = k.lat_idx AND g.lon_idx = k.lon_idx""",
                                   "v_grid"))
def q_extend_axis(spark, sf_dir):
    """SNK-9: a store whose axis ends with its data grows by two days (twice: the second run
    changes nothing), gets a day beyond its old end, and is read from its old last day on."""
    path = scratch_path(spark, "axis")
    first, end = _events_window(spark, sf_dir)
    _skeleton(spark, sf_dir, path, first, end, "double")
    g = S.v_grid(spark, sf_dir).drop("latitude", "longitude").withColumn("date", F.col("time").cast("date"))
    ST.replace_regions(spark, path, g, ["time"])
    last = datetime.date.fromisoformat(end) - datetime.timedelta(days=1)
    for _ in range(2):
        axis.extend_axis(spark, path, last + datetime.timedelta(days=2))
    later = F.timestamp_add("HOUR", F.lit(24), "time")
    ST.replace_regions(spark, path, g.where(F.col("date") == F.lit(last)).withColumn("time", later)
                       .withColumn("date", F.col("time").cast("date")), ["time"])
    return axis.read_filled(spark, path, start=last)


SQL_FC = f"""fc AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CASE WHEN hour(ts) < 12 THEN 6 ELSE 18 END) AS time,
             CAST(event_id % {fixed.FORECAST_STEPS} AS INT) AS step, CAST(user_id % 24 AS INT) AS cell, max(value) AS value
       FROM events GROUP BY 1, 2, 3)"""


@register("extend_axis_forecast", f"""
WITH {SQL_FC},
w AS (SELECT CAST(max(time) AS DATE) AS s FROM fc),
axis AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP) + INTERVAL 6 HOUR, CAST(s AS TIMESTAMP) + INTERVAL 90 HOUR,
                                       INTERVAL 12 HOUR)) AS time FROM w),
g AS (SELECT * FROM fc UNION ALL SELECT time + INTERVAL 24 HOUR, step, cell, value FROM fc, w WHERE CAST(time AS DATE) = s)
SELECT axis.time, CAST(i AS INT) AS step, CAST(c AS INT) AS cell, axis.time + to_hours(CAST(i AS BIGINT)) AS valid_time, 'tp' AS variable,
       g.value, CAST(axis.time AS DATE) AS date
FROM axis CROSS JOIN range({fixed.FORECAST_STEPS}) i(i) CROSS JOIN range(24) c(c)
LEFT JOIN g ON g.time = axis.time AND g.step = i AND g.cell = c""")
def q_extend_axis_forecast(spark, sf_dir):
    """SNK-9 (forecast form): bases 06 and 18 UTC, 19 steps each; the store grows by three days
    (twice), gets the bases of one day beyond its old end, and is read from its old last day on,
    each base with its valid times."""
    path = scratch_path(spark, "axis-fc")
    e = table(spark, sf_dir, "events")
    base = F.timestamp_add("HOUR", F.when(F.hour("ts") < 12, F.lit(6)).otherwise(F.lit(18)),
                           F.col("ts").cast("date").cast("timestamp_ntz"))
    fc = (e.groupBy(base.alias("time"), (F.col("event_id") % fixed.FORECAST_STEPS).cast("int").alias("step"),
                    (F.col("user_id") % 24).cast("int").alias("cell")).agg(F.max("value").alias("value"))
          .withColumn("variable", F.lit("tp")).withColumn("date", F.col("time").cast("date")))
    first, end = _events_window(spark, sf_dir)
    axis.create_store(spark, path, f"{first} 06:00:00", end, spark.createDataFrame([("tp",)], "variable string"), {"cell": 24},
                      "double", step_hours=12, forecast_steps=fixed.FORECAST_STEPS)
    ST.replace_regions(spark, path, fc, ["time", "step"])
    last = datetime.date.fromisoformat(end) - datetime.timedelta(days=1)
    for _ in range(2):
        axis.extend_axis(spark, path, last + datetime.timedelta(days=3))
    later = F.timestamp_add("HOUR", F.lit(24), "time")
    ST.replace_regions(spark, path, fc.where(F.col("date") == F.lit(last)).withColumn("time", later)
                       .withColumn("date", F.col("time").cast("date")), ["time", "step"])
    return axis.read_filled(spark, path, start=last)


@register("store_attrs_upsert", """
WITH a AS (SELECT event_type AS store, CAST(max(CAST(json_extract_string(props, '$.k') AS INT)) AS VARCHAR) AS k_max,
                  CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS time_end FROM events GROUP BY event_type)
SELECT store, CASE WHEN store < 'p' THEN ['k_max', 'last_updated', 'units', 'valid_time_start', 'valid_time_stop']
                   ELSE ['k_max', 'last_updated', 'units', 'valid_time_start', 'valid_time_stop', 'valid_time_stop_era5t']
              END AS attr_keys,
       '1940-01-01' AS valid_time_start, '2026-01-01 00:00:00' AS last_updated, time_end AS stop_value, k_max
FROM a""")
def q_store_attrs_upsert(spark, sf_dir):
    """SNK-10 / MAP-1: upsert validity keys in each store's attribute map by mode."""
    e = table(spark, sf_dir, "events")
    a = e.groupBy(F.col("event_type").alias("store")).agg(
        F.max(F.get_json_object("props", "$.k").cast("int")).cast("string").alias("k_max"),
        F.max("ts").cast("date").cast("string").alias("time_end"))
    a = a.withColumn("attrs", F.create_map(F.lit("k_max"), F.col("k_max"), F.lit("units"), F.lit("1"),
                                           F.lit("valid_time_stop"), F.lit("old"),
                                           F.lit("last_updated"), F.lit("old")))
    mode = F.when(F.col("store") < "p", F.lit(fixed.MODE_FINAL)).otherwise(F.lit(fixed.MODE_DAILY))
    up = ST.upsert_attrs(a, F.col("time_end"), mode, "2026-01-01 00:00:00")
    stop = F.coalesce(F.element_at("attrs", F.lit("valid_time_stop_era5t")),
                      F.when(F.col("store") < "p", F.element_at("attrs", F.lit("valid_time_stop"))))
    return up.select("store", F.array_sort(F.map_keys("attrs")).alias("attr_keys"),
                     F.element_at("attrs", F.lit("valid_time_start")).alias("valid_time_start"),
                     F.element_at("attrs", F.lit("last_updated")).alias("last_updated"),
                     stop.alias("stop_value"), F.element_at("attrs", F.lit("k_max")).alias("k_max"))


@register("metadata_resize", with_views("""
WITH n AS (SELECT variable, count(DISTINCT time) AS n FROM v_grid GROUP BY variable)
SELECT variable, n + 24 AS shape0, CASE WHEN variable < 'm' THEN n ELSE n + 24 END AS chunk0,
       CAST(6 AS BIGINT) AS shape1, '{"id":"zlib","level":4}' AS compressor, '<f4' AS dtype FROM n""", "v_grid"))
def q_metadata_resize(spark, sf_dir):
    """SNK-11: set the time length in each array's metadata document (optionally keep the chunk)."""
    n = S.v_grid(spark, sf_dir).groupBy("variable").agg(F.count_distinct("time").alias("n"))
    six = F.lit(6).cast("long")
    doc = n.select("variable", "n", F.to_json(F.struct(
        F.array("n", six).alias("shape"), F.array("n", six).alias("chunks"), F.lit("<f4").alias("dtype"),
        F.struct(F.lit("zlib").alias("id"), F.lit(4).alias("level")).alias("compressor"))).alias("doc"))
    out = doc.select("variable", ST.resize_metadata(F.col("doc"), F.col("n") + 24, F.col("variable") < "m").alias("doc"))
    return out.select("variable", F.get_json_object("doc", "$.shape[0]").cast("long").alias("shape0"),
                      F.get_json_object("doc", "$.chunks[0]").cast("long").alias("chunk0"),
                      F.get_json_object("doc", "$.shape[1]").cast("long").alias("shape1"),
                      F.get_json_object("doc", "$.compressor").alias("compressor"),
                      F.get_json_object("doc", "$.dtype").alias("dtype"))


@register("split_mixed", with_views("""
SELECT CASE WHEN k = 7 THEN 'surface' ELSE 'depthBelowLandLayer' END AS type_of_level, short_name, time, cell, k, value,
       strftime(time, '%Y%m') || '_hres_soil.grb2_' || CASE WHEN k = 7 THEN 'surface' ELSE 'depthBelowLandLayer' END
       || '_' || short_name || '.grib' AS file_name
FROM v_levels UNPIVOT (value FOR short_name IN (t, q, w, x))""", "v_levels"))
def q_split_mixed(spark, sf_dir):
    """SNK-12: a mixed-level file split into one output per (level type, short name)."""
    path = scratch_path(spark, "split")
    long = layout.unpivot_long(S.v_levels(spark, sf_dir), ["time", "cell", "k"], ["t", "q", "w", "x"],
                               "short_name", "value")
    tol = F.when(F.col("k") == 7, F.lit("surface")).otherwise(F.lit("depthBelowLandLayer"))
    ST.write_store(long.withColumn("type_of_level", tol), path, ("type_of_level", "short_name"))
    r = ST.read_store(spark, path)
    return r.select("type_of_level", "short_name", "time", "cell", "k", "value",
                    F.concat(F.date_format("time", "yyyyMM"), F.lit("_hres_soil.grb2_"), F.col("type_of_level"),
                             F.lit("_"), F.col("short_name"), F.lit(".grib")).alias("file_name"))


@register("promote_audit", with_views("""
WITH c AS (SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value
           FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell),
o AS (SELECT *, CAST(time AS DATE) AS date FROM c),
n AS (SELECT time, variable, cell, CASE WHEN day(time) % 7 = 0 AND cell = 3 THEN value + 1.0 ELSE value END AS value,
             CAST(time AS DATE) AS date FROM c WHERE day(time) <> 20),
ob AS (SELECT DISTINCT variable, date FROM o),
nb AS (SELECT DISTINCT variable, date FROM n),
eq AS (SELECT coalesce(o.variable, n.variable) AS variable, coalesce(o.date, n.date) AS date,
              bool_and(o.value IS NOT DISTINCT FROM n.value) AS equal
       FROM (SELECT * FROM o WHERE (variable, date) IN (SELECT variable, date FROM nb)) o
       FULL OUTER JOIN n ON o.variable = n.variable AND o.date = n.date AND o.time = n.time AND o.cell = n.cell
       GROUP BY 1, 2)
SELECT ob.variable, ob.date, '/archive/raw/' || strftime(ob.date, '%Y/%m/%d') || '/' || ob.variable || '/surface.nc' AS path,
       CASE WHEN eq.equal IS NULL THEN 'absent' WHEN eq.equal THEN 'ratified' ELSE 'data_changed' END AS status
FROM ob LEFT JOIN eq ON ob.variable = eq.variable AND ob.date = eq.date""", "v_release"))
def q_promote_audit(spark, sf_dir):
    """SNK-13: audit status per block — ratified, data_changed (promoted) or absent (no staged copy)."""
    comb = release.combine_releases(S.v_release(spark, sf_dir), ["time", "variable", "cell"]).drop("expver_used")
    old = comb.withColumn("date", F.col("time").cast("date"))
    bump = (F.dayofmonth("time") % 7 == 0) & (F.col("cell") == 3)
    new = (comb.where(F.dayofmonth("time") != 20)
           .withColumn("value", F.when(bump, F.col("value") + F.lit(1.0)).otherwise(F.col("value")))
           .withColumn("date", F.col("time").cast("date")))
    audit = release.block_audit(old, new, ["variable", "date"], ["time", "cell"]).where(F.col("status") != "added")
    path = F.concat(F.lit("/archive/raw/"), F.date_format("date", "yyyy/MM/dd"), F.lit("/"), F.col("variable"),
                    F.lit("/surface.nc"))
    return audit.select("variable", "date", path.alias("path"), "status")


@register("rechunk", with_views("""
WITH g AS (SELECT *, CAST(date_diff('hour', (SELECT min(time) FROM v_grid), time) AS BIGINT) AS ti FROM v_grid),
k AS (SELECT DISTINCT variable, lat_idx, lon_idx, CAST(floor(ti / 6) AS BIGINT) AS chunk FROM g),
slots AS (SELECT k.*, CAST(i AS INT) AS pos FROM k, range(6) r(i))
SELECT s.variable, s.lat_idx, s.lon_idx, s.chunk, list(g.value ORDER BY s.pos) AS "values"
FROM slots s LEFT JOIN g ON g.variable = s.variable AND g.lat_idx = s.lat_idx AND g.lon_idx = s.lon_idx
  AND g.ti = s.chunk * 6 + s.pos
GROUP BY 1, 2, 3, 4""", "v_grid"))
def q_rechunk(spark, sf_dir):
    """SNK-14: re-block each cell's series into 6-hour time chunks (dense arrays)."""
    g = S.v_grid(spark, sf_dir)
    t0 = g.agg(F.min("time").alias("t0"))
    gi = g.crossJoin(F.broadcast(t0)).withColumn("ti", time_offset_hours(F.col("t0"), "time"))
    return ST.rechunk_time(gi, ["variable", *GRID_KEYS], "ti", 6)


@register("scan_store", with_views("""
SELECT *, CAST(time AS DATE) AS date FROM v_grid
WHERE variable IN ('click', 'view') AND CAST(time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""", "v_grid"))
def q_scan_store(spark, sf_dir):
    """SRC-14: lazy store scan; the selection prunes partition directories before any read."""
    path = scratch_path(spark, "scan")
    ST.write_store(S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date")), path)
    r = ST.read_store(spark, path)
    return r.where(F.col("variable").isin("click", "view")
                   & F.col("date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))


# ------------------------------------------------------------------ specs / listings
@register("expand_selection", """
WITH s AS (SELECT o_orderkey AS spec_id, CAST(o_orderdate AS DATE) AS d0 FROM orders),
sp AS (SELECT spec_id, strftime(d0, '%Y-%m-%d') || '/to/' || strftime(d0 + 9, '%Y-%m-%d') AS date,
              '00/to/23/by/6' AS time, '1/to/10' AS levelist, 'd/vo' AS param FROM s)
SELECT spec_id, strftime(unnest(generate_series(CAST(split_part(date, '/', 1) AS DATE), CAST(split_part(date, '/', 3) AS DATE), INTERVAL 1 DAY)), '%Y-%m-%d') AS date,
       ['00', '06', '12', '18'] AS time, [CAST(i AS VARCHAR) FOR i IN range(1, 11)] AS levelist, pr.param
FROM sp, (SELECT unnest(['d', 'vo']) AS param) pr""")
def q_expand_selection(spark, sf_dir):
    """SRC-13: retrieval spec rows -> one task row per (date, param); time / levels stay lists."""
    o = table(spark, sf_dir, "orders")
    s = o.select(F.col("o_orderkey").alias("spec_id"), F.col("o_orderdate").cast("date").alias("d0"))
    sp = s.select("spec_id", F.concat(F.date_format("d0", "yyyy-MM-dd"), F.lit("/to/"),
                                      F.date_format(F.date_add("d0", 9), "yyyy-MM-dd")).alias("date"),
                  F.lit("00/to/23/by/6").alias("time"), F.lit("1/to/10").alias("levelist"), F.lit("d/vo").alias("param"))
    return expand_spec(sp, ["date", "time", "levelist", "param"], ["date", "param"])


@register("listing", None)
def q_listing(spark, sf_dir):
    """SRC-6: files under a prefix with size and time, content not read (binaryFile, pruned)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(sf_dir)
    return files.select(F.regexp_replace("path", r"^file:", "").alias("path"),
                        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")


# ------------------------------------------------------------------ streaming
GRID_SCHEMA = ("time timestamp_ntz, variable string, lat_idx int, lon_idx int, latitude float, longitude float, "
               "value double, date date")


@register("stream_ingest", with_views("SELECT *, CAST(time AS DATE) AS date FROM v_grid", "v_grid"))
def q_stream_ingest(spark, sf_dir):
    """STM-1: raw blocks landing in three drops, by date, are ingested incrementally into the store."""
    landing, store, ckpt = (scratch_path(spark, n) for n in ("landing", "store", "ckpt"))
    g = S.v_grid(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    first, end = _events_window(spark, sf_dir)
    third = F.floor(3 * F.datediff("date", F.lit(first).cast("date"))
                    / F.datediff(F.lit(end).cast("date"), F.lit(first).cast("date")))
    for drop in range(3):
        g.where(third == drop).write.mode("append").parquet(landing)
        ingest.ingest_new_blocks(spark, landing, GRID_SCHEMA, store, ckpt)
    return ST.read_store(spark, store)


@register("stream_replace", with_views("""
SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value,
       arg_max(expver, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS expver_used, CAST(time AS DATE) AS date
FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell""", "v_release"))
def q_stream_replace(spark, sf_dir):
    """STM-2: the preliminary release lands first, the final one later; the store keeps final over preliminary."""
    landing, store, ckpt = (scratch_path(spark, n) for n in ("rel-landing", "rel-store", "rel-ckpt"))
    r = S.v_release(spark, sf_dir).withColumn("date", F.col("time").cast("date"))
    schema = "time timestamp_ntz, variable string, cell int, expver int, value double, date date"
    r.where(F.col("expver") == fixed.RELEASE_PRELIMINARY).write.mode("append").parquet(landing)
    ingest.ingest_releases(spark, landing, schema, store, ckpt, ["time", "cell"])
    r.where(F.col("expver") == fixed.RELEASE_FINAL).write.mode("append").parquet(landing)
    ingest.ingest_releases(spark, landing, schema, store, ckpt, ["time", "cell"])
    return ST.read_store(spark, store).select("time", "variable", "cell", "value", "expver_used", "date")


@register("hourly_grid_stream", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('hour', ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end,
       CAST(user_id % 24 AS INT) AS cell, count(*) AS n, max(value) AS max_value,
       CAST(date_trunc('hour', ts) AS DATE) AS date
FROM events GROUP BY 1, 2, 3, 6""")
def q_hourly_grid_stream(spark, sf_dir):
    """STM-4 (streaming form): event files landing in two drops are bucketed on
    the hourly axis; each micro-batch's hours are merged into a date-partitioned store, some of
    them up to two days late.  Equal to the batch form."""
    from ..streaming.windows import hourly_grid_to_store
    landing, store, ckpt = (scratch_path(spark, n) for n in ("hg-landing", "hg-store", "hg-ckpt"))
    ev = table(spark, sf_dir, "events").select("ts", (F.col("user_id") % 24).cast("int").alias("cell"), "value")
    # the first half lands first, but for a fifth of its last two days, which comes late
    # with the second half; state older than three days has gone by then
    first, end = (F.lit(x).cast("date") for x in _events_window(spark, sf_dir))
    middle = F.date_add(first, (F.datediff(end, first) / 2).cast("int"))
    late = (F.col("cell") % 5 == 0) & (F.col("ts").cast("date") >= F.date_sub(middle, 2))
    drop = (F.col("ts").cast("date") < middle) & ~late
    schema = "ts timestamp_ntz, cell int, value double"
    for rows in (ev.where(drop), ev.where(~drop)):
        rows.write.mode("append").parquet(landing)
        hourly_grid_to_store(spark, landing, schema, store, ckpt, "ts", ["cell"], lateness="3 days")
    return ST.read_store(spark, store).select("window_start", "window_end", "cell", "n", "max_value", "date")


@register("complete_dates_stream", with_views("""
SELECT CAST(e.date AS DATE) AS date, count(*) AS n_expected, count(a.chunk) AS n_present
FROM v_expected e LEFT JOIN v_actual a ON e.date = a.date AND e.chunk = a.chunk
GROUP BY e.date HAVING count(*) = count(a.chunk)""", "v_expected", "v_actual"))
def q_complete_dates_stream(spark, sf_dir):
    """STM-3 (streaming form): files land in two drops; a month of dates gets its files partly
    in the first and partly in the second, ten days land twice, and the first twenty days of the
    archive are filled in years later.  Equal to the batch form."""
    from ..streaming.windows import record_complete_dates
    landing, out, ckpt = (scratch_path(spark, n) for n in ("cd-landing", "cd-dates", "cd-ckpt"))
    file = F.concat_ws("/", F.date_format("date", "yyyyMMdd"), "chunk").alias("path")
    landed = S.v_actual(spark, sf_dir).select(file, F.col("date").cast("date").alias("date"), "chunk")
    expected = S.v_expected(spark, sf_dir).groupBy(F.col("date").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_expected"))
    w = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("s"),
                                           F.max("o_orderdate").cast("date").alias("e")).first()
    middle = w["s"] + (w["e"] - w["s"]) / 2
    days = F.datediff("date", F.lit(middle))
    early = (days < 0) | ((days < 30) & (F.col("chunk") < "3"))
    again = (days < 0) & (days >= -10)
    filled_in = (F.datediff("date", F.lit(w["s"])) < 20) & (F.col("chunk") >= "3")       # years late, with the second drop
    early = early & ~filled_in
    for drop in (landed.where(early), landed.where(~early | again)):
        drop.select("path", "date").write.mode("append").parquet(landing)
        record_complete_dates(spark, landing, "path string, date date", expected, out, ckpt)
    return spark.read.parquet(out)
