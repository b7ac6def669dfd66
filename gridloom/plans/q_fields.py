"""Registered queries: flagship, layouts, projections, scans (PRJ-*, ARR-*, SO-*,
SET-2, SRC-7..12, JSN-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed
from ..operators import dims, fields, layout
from ..sources import standins as S
from ..sources.tables import table
from .registry import register, sql_list, with_views

GRID_VARS = ["click", "error", "purchase", "signup", "view"]
WIDE_SQL = ", ".join(f"max(value) FILTER (WHERE variable = '{v}') AS {v}" for v in GRID_VARS)
SLICE = ("2024-01-02 00:00:00", "2024-01-29 23:00:00")
N_LAT, N_LON = 4, 6


def grid_template(spark, grid):
    """Hourly template of the stand-in grid: every hour of every day with data x every cell."""
    w = grid.agg(F.min("time").alias("s"), F.max("time").alias("e"))
    hours = w.select(F.explode(D.hour_axis("s", "e")).alias("time"))
    cells = (spark.range(N_LAT * N_LON)
             .select((F.col("id") / N_LON).cast("int").alias("lat_idx"),
                     (F.col("id") % N_LON).cast("int").alias("lon_idx"))
             .select("lat_idx", "lon_idx",
                     (F.lit(90) - F.lit(60) * F.col("lat_idx")).cast("float").alias("latitude"),
                     (F.lit(60) * F.col("lon_idx")).cast("float").alias("longitude")))
    return hours.crossJoin(F.broadcast(cells))


@register("grid_flagship", with_views(f"""
WITH w AS (SELECT CAST(min(time) AS DATE) AS s, CAST(max(time) AS DATE) AS e FROM v_grid),
hours AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM w),
cells AS (SELECT CAST(i // 6 AS INT) AS lat_idx, CAST(i % 6 AS INT) AS lon_idx FROM range(24) r(i)),
wide AS (SELECT time, lat_idx, lon_idx, {WIDE_SQL} FROM v_grid GROUP BY 1, 2, 3)
SELECT h.time, c.lat_idx, c.lon_idx, CAST(90 - 60 * c.lat_idx AS FLOAT) AS latitude,
       CAST(60 * c.lon_idx AS FLOAT) AS longitude, {", ".join(GRID_VARS)},
       sqrt(click * click + view * view) AS wind_speed
FROM hours h CROSS JOIN cells c
LEFT JOIN wide ON wide.time = h.time AND wide.lat_idx = c.lat_idx AND wide.lon_idx = c.lon_idx
WHERE h.time BETWEEN TIMESTAMP '{SLICE[0]}' AND TIMESTAMP '{SLICE[1]}'
  AND CAST(90 - 60 * c.lat_idx AS FLOAT) BETWEEN -30 AND 90 AND CAST(60 * c.lon_idx AS FLOAT) BETWEEN 0 AND 240""",
                                         "v_grid"))
def q_grid_flagship(spark, sf_dir):
    """Hourly grid -> template left join -> wide pivot -> time slice + area -> wind speed."""
    from ..operators import met
    g = S.v_grid(spark, sf_dir)
    wide = layout.pivot_wide(g, ["time", "lat_idx", "lon_idx"], variables=GRID_VARS)
    tmpl = fields.area_subset(fields.time_slice(grid_template(spark, g), *SLICE), 90, 0, -30, 240)
    out = tmpl.join(wide, ["time", "lat_idx", "lon_idx"], "left")
    return out.select("time", "lat_idx", "lon_idx", "latitude", "longitude", *GRID_VARS,
                      met.wind_speed("click", "view").alias("wind_speed"))


@register("pivot_vars", with_views(f"SELECT time, lat_idx, lon_idx, {WIDE_SQL} FROM v_grid GROUP BY 1, 2, 3",
                                   "v_grid"))
def q_pivot_vars(spark, sf_dir):
    """PRJ-12: long -> wide."""
    return layout.pivot_wide(S.v_grid(spark, sf_dir), ["time", "lat_idx", "lon_idx"], variables=GRID_VARS)


@register("unpivot_vars", with_views(f"""
WITH wide AS (SELECT time, lat_idx, lon_idx, {WIDE_SQL} FROM v_grid GROUP BY 1, 2, 3)
SELECT time, lat_idx, lon_idx, variable, value FROM wide
UNPIVOT (value FOR variable IN ({", ".join(GRID_VARS)}))""", "v_grid"))
def q_unpivot_vars(spark, sf_dir):
    """PRJ-12: wide -> long (round trip of pivot_vars; missing cells dropped)."""
    wide = layout.pivot_wide(S.v_grid(spark, sf_dir), ["time", "lat_idx", "lon_idx"], variables=GRID_VARS)
    return layout.unpivot_long(wide, ["time", "lat_idx", "lon_idx"], GRID_VARS)


@register("chunk_explode", """
SELECT vec_id AS time_index, label AS variable, CAST(i AS INT) AS pos, CAST(i // 8 AS INT) AS lat_idx,
       CAST(i % 8 AS INT) AS lon_idx, embedding[i + 1] AS value
FROM embeddings, range(64) r(i) WHERE i < len(embedding)""")
def q_chunk_explode(spark, sf_dir):
    """ARR-2: 8 x 8 chunk arrays -> long cells."""
    c = S.v_chunks(spark, sf_dir).select(F.col("vec_id").alias("time_index"), F.col("label").alias("variable"),
                                         "embedding")
    return layout.chunk_explode(c, "embedding", 8, ["time_index", "variable"])


@register("chunk_pack", with_views(f"""
WITH k AS (SELECT DISTINCT time, variable FROM v_grid),
slots AS (SELECT k.time, k.variable, CAST(i AS INT) AS pos FROM k, range({N_LAT * N_LON}) r(i))
SELECT s.time, s.variable, list(g.value ORDER BY s.pos) AS "values"
FROM slots s LEFT JOIN v_grid g ON g.time = s.time AND g.variable = s.variable AND g.lat_idx * {N_LON} + g.lon_idx = s.pos
GROUP BY s.time, s.variable""", "v_grid"))
def q_chunk_pack(spark, sf_dir):
    """ARR-2: long grid -> one dense row-major chunk per (time, variable); gaps NULL."""
    return layout.chunk_pack(S.v_grid(spark, sf_dir), ["time", "variable"], N_LAT, N_LON)


@register("array_region", """
SELECT vec_id, embedding[CAST(vec_id % 8 AS INT) * 8 + 1 : CAST(vec_id % 8 AS INT) * 8 + 8] AS region,
       list_concat(embedding[1 : CAST(vec_id % 8 AS INT) * 8],
                   list_transform(embedding[CAST(vec_id % 8 AS INT) * 8 + 1 : CAST(vec_id % 8 AS INT) * 8 + 8], lambda x: -x),
                   embedding[CAST(vec_id % 8 AS INT) * 8 + 9 : 64]) AS patched
FROM embeddings""")
def q_array_region(spark, sf_dir):
    """ARR-1: get and set one 8-cell row region of each chunk array."""
    c = S.v_chunks(spark, sf_dir)
    off = ((F.col("vec_id") % 8) * 8).cast("int")
    region = layout.array_region_get("embedding", off, 8)
    return c.select("vec_id", region.alias("region"),
                    layout.array_region_set("embedding", off, F.transform(region, lambda x: -x)).alias("patched"))


@register("select_vars", with_views("SELECT * FROM v_grid WHERE variable IN ('click', 'view')", "v_grid"))
def q_select_vars(spark, sf_dir):
    """PRJ-1: the variables of one chunk."""
    return fields.select_vars(S.v_grid(spark, sf_dir), ["click", "view"])


@register("rename_vars", with_views("""
SELECT time, cell, k, t AS temperature, q AS specific_humidity, w AS vertical_velocity, x FROM v_levels""",
                                    "v_levels"))
def q_rename_vars(spark, sf_dir):
    """PRJ-2: short names -> long names (unknown names kept)."""
    return fields.rename_columns(S.v_levels(spark, sf_dir), fixed.SHORT_TO_LONG)


@register("align_coords", with_views("""
SELECT time, lat_idx, lon_idx, CAST(90.0 - 60.0 * lat_idx AS FLOAT) AS latitude,
       CAST(60.0 * lon_idx AS FLOAT) AS longitude, variable, value FROM v_grid""", "v_grid"))
def q_align_coords(spark, sf_dir):
    """PRJ-3: keep index coords and variables; lat/lon downcast to FLOAT."""
    g = S.v_grid(spark, sf_dir).select(
        "time", "lat_idx", "lon_idx", "variable", "value",
        (F.lit(90.0) - F.lit(60.0) * F.col("lat_idx")).alias("latitude"),
        (F.lit(60.0) * F.col("lon_idx")).alias("longitude"), F.lit("extra").alias("number"))
    return fields.align_coords(g, ["time", "lat_idx", "lon_idx", "latitude", "longitude"], ["variable", "value"])


@register("attr_fix", """
SELECT event_id, ['k', 'long_name', 'units'] AS attr_keys, json_extract_string(props, '$.k') AS k FROM events""")
def q_attr_fix(spark, sf_dir):
    """PRJ-4: decoder keys removed from each variable's attribute map."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    parsed = F.from_json("props", "map<string,string>")
    attrs = F.map_concat(parsed, F.create_map(
        F.lit("GRIB_cfName"), F.col("event_type"), F.lit("GRIB_shortName"), F.substring("event_type", 1, 1),
        F.lit("GRIB_cfVarName"), F.col("event_type"), F.lit("long_name"), F.col("event_type"),
        F.lit("units"), F.lit("1")))
    fixed_attrs = fields.attr_fix(attrs)
    return e.select("event_id", F.array_sort(F.map_keys(fixed_attrs)).alias("attr_keys"),
                    F.element_at(fixed_attrs, F.lit("k")).alias("k"))


@register("time_slice", with_views(
    f"SELECT * FROM v_grid WHERE time BETWEEN TIMESTAMP '{SLICE[0]}' AND TIMESTAMP '{SLICE[1]}'", "v_grid"))
def q_time_slice(spark, sf_dir):
    """PRJ-5: inclusive label slice."""
    return fields.time_slice(S.v_grid(spark, sf_dir), *SLICE)


@register("time_label", with_views("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-03-01 00:00:00' AND l_shipdate < TIMESTAMP '1996-03-01 00:00:00' + INTERVAL 1 MONTH"""))
def q_time_label(spark, sf_dir):
    """PRJ-6: partial label -> every step inside it, as a half-open range that
    reaches the Parquet scan as a pushed filter."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return fields.time_label(li, "1996-03", "l_shipdate")


PLEVEL = f"element_at(array({', '.join(map(str, fixed.PRESSURE_LEVEL_GROUPS['full_37']))}), CAST((cell + k * 5) % 37 AS INT) + 1)"
PLEVEL_SQL = f"{sql_list(fixed.PRESSURE_LEVEL_GROUPS['full_37'])}[CAST((cell + k * 5) % 37 AS INT) + 1]"


def _plevels(spark, sf_dir):
    return S.v_levels(spark, sf_dir).withColumn("level", F.expr(PLEVEL).cast("int"))


@register("level_group", with_views(f"""
SELECT time, cell, k, level, t FROM (SELECT *, CAST({PLEVEL_SQL} AS INT) AS level FROM v_levels)
WHERE level IN ({", ".join(map(str, fixed.PRESSURE_LEVEL_GROUPS['weatherbench_13']))})""", "v_levels"))
def q_level_group(spark, sf_dir):
    """PRJ-7: rows on the 13 WeatherBench levels."""
    return fields.level_subset(_plevels(spark, sf_dir), "weatherbench_13").select("time", "cell", "k", "level", "t")


@register("level_index", with_views(f"""
SELECT time, cell, k, level, CAST(list_position({sql_list(fixed.PRESSURE_LEVEL_GROUPS['full_37'])}, level) - 1 AS INT) AS level_index,
       CAST(list_position({sql_list(fixed.PRESSURE_LEVEL_GROUPS['weatherbench_13'])}, level) - 1 AS INT) AS wb_index
FROM (SELECT *, CAST({PLEVEL_SQL} AS INT) AS level FROM v_levels)""", "v_levels"))
def q_level_index(spark, sf_dir):
    """PRJ-15: label -> position in the 37- and 13-level groups (NULL when absent)."""
    p = _plevels(spark, sf_dir)
    return p.select("time", "cell", "k", "level", fields.level_index("level", "full_37").alias("level_index"),
                    fields.level_index("level", "weatherbench_13").alias("wb_index"))


@register("field_select", with_views("""
SELECT time, cell, k, short_name, value FROM v_levels
UNPIVOT (value FOR short_name IN (t, q, w, x))
WHERE short_name IN ('t', 'q') AND k IN (1, 4, 7)""", "v_levels"))
def q_field_select(spark, sf_dir):
    """PRJ-8: fields by short name and level from a field set."""
    fs = layout.unpivot_long(S.v_levels(spark, sf_dir), ["time", "cell", "k"], ["t", "q", "w", "x"],
                             "short_name", "value")
    return fs.where(F.col("short_name").isin("t", "q") & F.col("k").isin(1, 4, 7))


@register("area_subset", with_views(
    "SELECT * FROM v_grid WHERE latitude BETWEEN -30 AND 90 AND longitude BETWEEN 60 AND 240", "v_grid"))
def q_area_subset(spark, sf_dir):
    """PRJ-9: [north, west, south, east] box."""
    return fields.area_subset(S.v_grid(spark, sf_dir), 90, 60, -30, 240)


@register("area_subset_wrapped", with_views(
    "SELECT * FROM v_grid WHERE latitude BETWEEN -30 AND 90 AND (longitude >= 240 OR longitude <= 60)", "v_grid"))
def q_area_subset_wrapped(spark, sf_dir):
    """PRJ-9: a box across the meridian where longitudes begin."""
    return fields.area_subset(S.v_grid(spark, sf_dir), 90, 240, -30, 60)


@register("thin_grid", with_views("SELECT * FROM v_grid WHERE lat_idx % 2 = 0 AND lon_idx % 2 = 0", "v_grid"))
def q_thin_grid(spark, sf_dir):
    """PRJ-10: every 2nd latitude and longitude."""
    return fields.thin(S.v_grid(spark, sf_dir), 2)


@register("lon_wrap", with_views("""
SELECT time, variable, lat_idx, lon_idx, CAST(((longitude + 180.0) % 360.0 + 360.0) % 360.0 - 180.0 AS DOUBLE) AS lon180, value
FROM v_grid""", "v_grid"))
def q_lon_wrap(spark, sf_dir):
    """PRJ-11: 0..360 longitudes -> -180..180."""
    g = S.v_grid(spark, sf_dir)
    return g.select("time", "variable", "lat_idx", "lon_idx",
                    fields.wrap_longitude(F.col("longitude").cast("double")).alias("lon180"), "value")


@register("scale_bias", with_views("""
SELECT time, cell, k, t - 273.15 AS t_c, x / 100.0 AS x_hpa, w * 1000.0 / 980.625 AS w_dam, q * 1000.0 + 0.5 AS q_scaled
FROM v_levels""", "v_levels"))
def q_scale_bias(spark, sf_dir):
    """PRJ-11: unit conversions and scale + bias."""
    lv = S.v_levels(spark, sf_dir)
    return lv.select("time", "cell", "k", fields.kelvin_to_celsius("t").alias("t_c"),
                     fields.pa_to_hpa("x").alias("x_hpa"),
                     fields.geopotential_to_dam(F.col("w") * 1000.0).alias("w_dam"),
                     fields.scale_bias("q", 1000.0, 0.5).alias("q_scaled"))


@register("expand_level", with_views("SELECT *, CAST(1000 AS INT) AS level FROM v_grid", "v_grid"))
def q_expand_level(spark, sf_dir):
    """PRJ-13: a single-level field gets a constant level dimension."""
    return fields.expand_dim(S.v_grid(spark, sf_dir), "level", 1000)


@register("drop_dims", with_views("""
SELECT DISTINCT l.time, l.cell, ln(98000.0 + s.x * 0.04) AS lnsp, s.w * 10000.0 AS zs
FROM v_levels l LEFT JOIN (SELECT * FROM v_levels WHERE k = 7) s ON l.time = s.time AND l.cell = s.cell""",
                                  "v_levels"))
def q_drop_dims(spark, sf_dir):
    """PRJ-14: drop every variable with a level dimension -> the surface fields of all columns."""
    lv = S.v_levels(spark, sf_dir)
    return fields.drop_dim_of_tables([(lv, ["time", "cell", "k"]), (S.v_surface(lv), ["time", "cell"])], "k")


@register("data_vars", with_views(f"""
WITH s AS (SELECT DISTINCT variable AS name, ['time', 'latitude', 'longitude'] AS dims FROM v_grid
           UNION ALL SELECT unnest(['time', 'latitude', 'longitude']) AS name, NULL AS dims),
s2 AS (SELECT name, coalesce(dims, [name]) AS dims FROM s),
d AS (SELECT DISTINCT unnest(dims) AS name FROM s2)
SELECT name, list_contains(dims, 'time') AS has_time FROM s2 WHERE name NOT IN (SELECT name FROM d)""",
                                  "v_grid"))
def q_data_vars(spark, sf_dir):
    """PRJ-16 / AG-9: data variables = array names minus dimension names."""
    g = S.v_grid(spark, sf_dir)
    var_rows = g.select(F.col("variable").alias("name")).distinct().select(
        "name", F.array(*[F.lit(x) for x in ("time", "latitude", "longitude")]).alias("dims"))
    coords = spark.createDataFrame([(c, [c]) for c in ("time", "latitude", "longitude")],
                                   "name string, dims array<string>")
    return fields.data_vars(var_rows.unionByName(coords))


@register("field_meta", with_views("""
SELECT DISTINCT variable, CAST(strftime(time, '%Y%m%d') AS INT) AS data_date,
       CAST(strftime(time, '%H%M') AS INT) AS data_time, 0 AS step FROM v_grid""", "v_grid"))
def q_field_meta(spark, sf_dir):
    """PRJ-17: date / time / step keys of each field."""
    g = S.v_grid(spark, sf_dir)
    return g.select("variable", F.date_format("time", "yyyyMMdd").cast("int").alias("data_date"),
                    F.date_format("time", "HHmm").cast("int").alias("data_time"),
                    F.lit(0).alias("step")).distinct()


@register("stack_levels", with_views("""
SELECT time, cell, list(k ORDER BY k) AS ks, list(t ORDER BY k) AS t, list(q ORDER BY k) AS q,
       list(w ORDER BY k) AS w, list(x ORDER BY k) AS x
FROM v_levels GROUP BY time, cell""", "v_levels"))
def q_stack_levels(spark, sf_dir):
    """SO-1: stack level fields on a level axis, in level order."""
    return layout.stack_levels(S.v_levels(spark, sf_dir), ["time", "cell"], "k", ["t", "q", "w", "x"])


@register("sample_var", with_views("""
SELECT * FROM v_grid WHERE variable = (SELECT min(variable) FROM v_grid)""", "v_grid"))
def q_sample_var(spark, sf_dir):
    """SO-2: all rows of the first variable (a template sample)."""
    g = S.v_grid(spark, sf_dir)
    first = g.agg(F.min("variable").alias("variable"))
    return g.join(F.broadcast(first), "variable", "left_semi")


@register("fields_union", with_views("""
SELECT time, cell, k, t FROM v_levels WHERE k <= 4
UNION ALL BY NAME
SELECT time, cell, k, q, w FROM v_levels WHERE k > 2""", "v_levels"))
def q_fields_union(spark, sf_dir):
    """SET-2: append two field sets with different variables."""
    lv = S.v_levels(spark, sf_dir)
    return layout.union_fields(lv.where(F.col("k") <= 4).select("time", "cell", "k", "t"),
                               lv.where(F.col("k") > 2).select("time", "cell", "k", "q", "w"))


@register("json_attrs", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
       json_object('k', json_extract(props, '$.k'), 'k2', CAST(json_extract_string(props, '$.k') AS INT) * 2)::VARCHAR AS edited
FROM events""")
def q_json_attrs(spark, sf_dir):
    """JSN-1: read a metadata field and edit the document (add k2 = 2k)."""
    e = table(spark, sf_dir, "events").select("event_id", "props")
    k = fields.json_field("props", "$.k").cast("int")
    return e.select("event_id", k.alias("k"), fields.json_set_fields("props", {"k2": k * 2}).alias("edited"))


@register("var_attrs", """
SELECT CASE event_type WHEN 'click' THEN 'click_rate' WHEN 'view' THEN 'view_rate' ELSE event_type END AS variable,
       ['k', 'short_name'] AS attr_names, [json_extract_string(arg_min(props, ts), '$.k'), event_type] AS attr_values
FROM events GROUP BY event_type""")
def q_var_attrs(spark, sf_dir):
    """SRC-12: attribute map of each variable from its first sample, with short_name, under the
    variable's long name where it has one."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("variable"), "props", "ts")
    a = fields.long_named(fields.attribute_maps(e, "variable", "props", F.col("ts")), "variable",
                          {"click": "click_rate", "view": "view_rate"})
    names = F.array_sort(F.map_keys("attrs"))
    return a.select("variable", names.alias("attr_names"), F.transform(names, lambda n: F.element_at("attrs", n)).alias("attr_values"))


def _raw_blocks(spark, sf_dir):
    """Raw blocks as decoded: one file per (day, variable), extra length-1 dims."""
    g = S.v_grid(spark, sf_dir)
    return g.select(F.concat_ws("/", F.date_format("time", "yyyy/MM/dd"), "variable", F.lit("surface.nc")).alias("path"),
                    "variable", F.col("time").alias("valid_time"), "lat_idx", "lon_idx",
                    F.lit(0).alias("number"), F.lit(0).alias("step"), F.lit(0.0).alias("surface"),
                    F.when(F.col("value") > 999, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))


@register("raw_normalize", with_views("""
SELECT strftime(time, '%Y/%m/%d') || '/' || variable || '/surface.nc' AS path, variable, time, lat_idx, lon_idx,
       CASE WHEN value > 999 THEN NULL ELSE value END AS value FROM v_grid""", "v_grid"))
def q_raw_normalize(spark, sf_dir):
    """SRC-7: normalising scan (drop length-1 dims, rename valid_time, NaN -> NULL, one variable per file)."""
    return fields.normalize_raw(_raw_blocks(spark, sf_dir))


@register("scan_single_level", with_views(f"""
SELECT CAST(time AS DATE) AS date, time, lat_idx, lon_idx, {WIDE_SQL.replace("'view'", "'view'")}
FROM v_grid WHERE variable IN ('click', 'purchase', 'view') GROUP BY 1, 2, 3, 4""".replace(
    ", max(value) FILTER (WHERE variable = 'error') AS error", "").replace(
    ", max(value) FILTER (WHERE variable = 'signup') AS signup", ""), "v_grid"))
def q_scan_single_level(spark, sf_dir):
    """SRC-8: per day, many surface variables -> one wide table on (time, lat, lon)."""
    g = fields.select_vars(S.v_grid(spark, sf_dir), ["click", "purchase", "view"])
    g = g.withColumn("date", F.col("time").cast("date"))
    return layout.pivot_wide(g, ["date", "time", "lat_idx", "lon_idx"], variables=["click", "purchase", "view"])


@register("scan_multilevel", with_views(f"""
SELECT time, cell, level, max(value) FILTER (WHERE variable = 't') AS t, max(value) FILTER (WHERE variable = 'q') AS q
FROM (SELECT time, cell, CAST({PLEVEL_SQL} AS INT) AS level, variable, value
      FROM v_levels UNPIVOT (value FOR variable IN (t, q, w)))
WHERE level IN ({", ".join(map(str, fixed.PRESSURE_LEVEL_GROUPS['weatherbench_13']))}) AND variable IN ('t', 'q')
GROUP BY 1, 2, 3""", "v_levels"))
def q_scan_multilevel(spark, sf_dir):
    """SRC-9: per-variable level files -> stacked on level, filtered to a group, variables pivoted."""
    raw = layout.unpivot_long(_plevels(spark, sf_dir), ["time", "cell", "level"], ["t", "q", "w"])
    raw = fields.level_subset(fields.select_vars(raw, ["t", "q"]), "weatherbench_13")
    return layout.pivot_wide(raw, ["time", "cell", "level"], variables=["t", "q"])


@register("scan_chunk", with_views(f"""
WITH cv AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{v}')" for c, vs in fixed.CHUNK_VARIABLES.items() for v in vs)}) t(chunk, short_name))
SELECT cv.chunk, l.time, l.cell, l.k, l.short_name, l.value
FROM (SELECT time, cell, k, short_name, value FROM v_levels UNPIVOT (value FOR short_name IN (t, q, w, x))) l
JOIN cv ON cv.short_name = l.short_name""", "v_levels"))
def q_scan_chunk(spark, sf_dir):
    """SRC-10: read grouped files, emit only the variables each chunk holds."""
    long = layout.unpivot_long(S.v_levels(spark, sf_dir), ["time", "cell", "k"], ["t", "q", "w", "x"],
                               "short_name", "value")
    return long.join(dims.chunk_variables(spark), "short_name").select(
        "chunk", "time", "cell", "k", "short_name", "value")


@register("assemble", with_views("""
SELECT coalesce(a.time, b.time) AS time, coalesce(a.cell, b.cell) AS cell, coalesce(a.k, b.k) AS k, a.t, a.w, b.q
FROM (SELECT time, cell, k, t, w FROM v_levels WHERE year(time) % 2 = 0
      UNION ALL SELECT time, cell, k, t, w FROM v_levels WHERE year(time) % 2 = 1) a
FULL OUTER JOIN (SELECT time, cell, k, q FROM v_levels WHERE k > 1) b
  ON a.time = b.time AND a.cell = b.cell AND a.k = b.k""", "v_levels"))
def q_assemble(spark, sf_dir):
    """SRC-11: concat files along time, then merge chunk groups on coordinates."""
    lv = S.v_levels(spark, sf_dir)
    tw = lv.where(F.year("time") % 2 == 0).select("time", "cell", "k", "t", "w").unionByName(
        lv.where(F.year("time") % 2 == 1).select("time", "cell", "k", "t", "w"))
    o3q = lv.where(F.col("k") > 1).select("time", "cell", "k", "q")
    return tw.join(o3q, ["time", "cell", "k"], "full_outer")
