"""Registered queries: manifests, date axes, paths and URLs (SRC-1..5, JN-5/6,
SET-1/3, AG-7, STM-3, DT-1..8, STR-1..3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import dates as D
from ..functions import paths as P
from ..operators import dims, manifest
from ..sources import standins as S
from ..sources.tables import table
from .registry import register, sql_ar_path, sql_grouped_path, sql_list, with_views

ROOT = "/archive/raw"
FULL_37 = fixed.PRESSURE_LEVEL_GROUPS["full_37"]
INIT = "1990-01-01"


def _grid_variables(spark, sf_dir):
    """Variables of the stand-in field: short names are multilevel."""
    return (table(spark, sf_dir, "events").select(F.col("event_type").alias("variable")).distinct()
            .select("variable", (F.length("variable") <= 5).alias("is_multilevel")))


SQL_VARS = "SELECT DISTINCT event_type AS variable, length(event_type) <= 5 AS is_multilevel FROM events"
SQL_VAR_LEVELS = f"""vars AS ({SQL_VARS}),
lv AS (SELECT CAST(unnest({sql_list(FULL_37)}) AS INT) AS level),
vl AS (SELECT variable, level FROM vars, lv WHERE is_multilevel
       UNION ALL SELECT variable, CAST(NULL AS INT) AS level FROM vars WHERE NOT is_multilevel)"""


@register("manifest_ar", f"""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
{SQL_VAR_LEVELS}
SELECT date, variable, level, {sql_ar_path(ROOT, 'date', 'variable', 'level')} AS path FROM d, vl""")
def q_manifest_ar(spark, sf_dir):
    """SRC-1: expected analysis-ready raw files for every order date (variables x levels)."""
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return manifest.ar_manifest(spark, dates, _grid_variables(spark, sf_dir), ROOT)


def _window(df, col):
    return df.agg(F.min(col).cast("date").alias("start"), F.max(col).cast("date").alias("end"))


SQL_MONTH_STARTS = ("CASE WHEN day(s) = 1 THEN s ELSE CAST(date_trunc('month', s) + INTERVAL 1 MONTH AS DATE) END")


@register("manifest_co", f"""
WITH w AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM w),
months AS (SELECT CAST(unnest(generate_series({SQL_MONTH_STARTS}, e, INTERVAL 1 MONTH)) AS DATE) AS date FROM w),
ml AS (SELECT unnest({sql_list(fixed.MODEL_LEVEL_CHUNKS)}) AS chunk),
sl AS (SELECT unnest({sql_list(fixed.SINGLE_LEVEL_CHUNKS)}) AS chunk)
SELECT date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', False)} AS path FROM days, ml
UNION ALL
SELECT date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', True)} AS path FROM months, sl""")
def q_manifest_co(spark, sf_dir):
    """SRC-2: expected grouped files over the order-date window (daily model-level, monthly single-level)."""
    w = _window(table(spark, sf_dir, "orders"), "o_orderdate")
    ml = manifest.grouped_manifest(w, dims.chunk_list(spark, fixed.MODEL_LEVEL_CHUNKS), ROOT, False)
    sl = manifest.grouped_manifest(w, dims.chunk_list(spark, fixed.SINGLE_LEVEL_CHUNKS), ROOT, True)
    return ml.unionByName(sl)


@register("manifest_pattern", f"""
WITH t AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS time FROM lineitem),
c AS (SELECT unnest({sql_list(fixed.all_chunks())}) AS chunk)
SELECT time, chunk, {sql_grouped_path(ROOT, 'time', 'chunk', True)} AS path FROM t, c""")
def q_manifest_pattern(spark, sf_dir):
    """SRC-3: (time x chunk) -> month-file path for every month present in the data."""
    t = (table(spark, sf_dir, "lineitem")
         .select(F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("time")).distinct())
    c = dims.chunk_list(spark, fixed.all_chunks())
    return t.crossJoin(c).select("time", "chunk",
                                 P.grouped_file_path(F.lit(ROOT), "time", "chunk", F.lit(True)).alias("path"))


def _sql_year_manifest():
    monthly = ([(c, f"{c}.grb2") for c in fixed.CHECK_MONTHLY_CHUNKS]
               + [(c, f"pcp.grb2_surface_{c}.grib") for c in fixed.CHECK_MONTHLY_PCP]
               + [(c, f"soil.grb2_depthBelowLandLayer_{c}.grib") for c in fixed.CHECK_MONTHLY_SOIL]
               + [("tsn", fixed.CHECK_SOIL_SURFACE)])
    suffixes = sql_list([s for _, s in monthly])
    return f"""
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders),
days AS (SELECT year, CAST(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM y),
dc AS (SELECT unnest({sql_list(fixed.CHECK_DAILY_CHUNKS)}) AS chunk),
m AS (SELECT year, unnest(range(1, 13)) AS month FROM y),
sfx AS (SELECT unnest({suffixes}) AS suffix)
SELECT year, 'raw/ERA5GRIB/HRES/Daily/' || CAST(year AS VARCHAR) || '/' || strftime(date, '%Y%m%d') || '_hres_' || chunk || '.grb2' AS name
FROM days, dc
UNION ALL
SELECT year, 'raw/ERA5GRIB/HRES/Month/' || CAST(year AS VARCHAR) || '/' || CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') || '_hres_' || suffix AS name
FROM m, sfx"""


@register("manifest_year", _sql_year_manifest())
def q_manifest_year(spark, sf_dir):
    """SRC-4: names the consistency check expects for every year with orders."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return manifest.year_manifest(spark, years, "raw")


def _sql_store_manifest():
    rows = [(s, c, s.startswith("single-level")) for s, cs in fixed.STORE_CHUNKS.items() for c in cs]
    values = ", ".join(f"('{s}', '{c}', {str(b).upper()})" for s, c, b in rows)
    return f"""
WITH w AS (SELECT CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM w),
months AS (SELECT CAST(unnest(generate_series({SQL_MONTH_STARTS}, e, INTERVAL 1 MONTH)) AS DATE) AS date FROM w),
sc AS (SELECT * FROM (VALUES {values}) t(store, chunk, single))
SELECT store, date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', False)} AS path FROM days, sc WHERE NOT single
UNION ALL
SELECT store, date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', True)} AS path FROM months, sc WHERE single"""


@register("manifest_store", _sql_store_manifest())
def q_manifest_store(spark, sf_dir):
    """SRC-5: expected raw files of every grouped store over the ship-date window."""
    w = _window(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return manifest.store_manifest(spark, w, ROOT)


@register("missing_files", with_views(
    "SELECT date, chunk FROM v_expected EXCEPT ALL SELECT date, chunk FROM v_actual", "v_expected", "v_actual"))
def q_missing_files(spark, sf_dir):
    """JN-5: expected (date, chunk) files with no actual file."""
    return manifest.missing(S.v_expected(spark, sf_dir), S.v_actual(spark, sf_dir), ["date", "chunk"])


@register("extra_files", """
WITH e AS (SELECT DISTINCT o_orderdate AS date, o_orderpriority AS chunk FROM orders WHERE o_orderstatus = 'O'),
a AS (SELECT DISTINCT o_orderdate AS date, o_orderpriority AS chunk FROM orders)
SELECT a.date, a.chunk FROM a WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.date = a.date AND e.chunk = a.chunk)""")
def q_extra_files(spark, sf_dir):
    """JN-6: files listed (any order) that the manifest (open orders) does not expect."""
    o = table(spark, sf_dir, "orders")
    listed = o.select(F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("chunk")).distinct()
    expected = (o.where(F.col("o_orderstatus") == "O")
                .select(F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("chunk")).distinct())
    return manifest.extra(listed, expected, ["date", "chunk"])


SPLIT = [(s, c) for s, cs in fixed.STORE_CHUNKS.items() for c in cs]
SQL_PARENT = ("'{root}/ERA5GRIB/HRES/Month/' || strftime(date, '%Y') || '/' || strftime(date, '%Y%m') || '_hres_' || "
              "split_part(chunk, '_', 1) || '.grb2'")


@register("split_parents", f"""
WITH c AS (SELECT {sql_list([s for s, _ in SPLIT])}[i + 1] AS store, {sql_list([c for _, c in SPLIT])}[i + 1] AS chunk, i FROM range({len(SPLIT)}) r(i)),
p AS (SELECT DISTINCT store, chunk, CAST(o_orderdate AS DATE) AS date FROM orders JOIN c ON o_custkey % {len(SPLIT)} = i WHERE o_orderstatus = 'F')
SELECT DISTINCT store, CAST(date_trunc('month', date) AS DATE) AS month, {SQL_PARENT.format(root='/archive/staging')} AS staged_path,
       {SQL_PARENT.format(root=ROOT)} AS path FROM p WHERE contains(chunk, '_')""")
def q_split_parents(spark, sf_dir):
    """SNK-13: month files of soil and precipitation to promote with the split blocks (one a filled order)."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    at = (F.col("o_custkey") % len(SPLIT) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in SPLIT]), at)
    promoted = o.select(pick(0).alias("store"), pick(1).alias("chunk"), F.col("o_orderdate").cast("date").alias("date")).distinct()
    return manifest.split_parents(spark, promoted, "/archive/staging", ROOT)


@register("missing_flag", with_views("""
SELECT count(*) AS n_missing, count(*) > 0 AS data_is_missing
FROM (SELECT date, chunk FROM v_expected EXCEPT ALL SELECT date, chunk FROM v_actual) m""", "v_expected", "v_actual"))
def q_missing_flag(spark, sf_dir):
    """AG-7: number of missing files and the any-missing flag."""
    return manifest.missing_flag(S.v_expected(spark, sf_dir), S.v_actual(spark, sf_dir), ["date", "chunk"])


@register("manifest_mode", f"""
WITH w AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM w),
months AS (SELECT CAST(unnest(generate_series({SQL_MONTH_STARTS}, e, INTERVAL 1 MONTH)) AS DATE) AS date FROM w),
ml AS (SELECT unnest({sql_list(fixed.MODEL_LEVEL_CHUNKS)}) AS chunk),
sl AS (SELECT unnest({sql_list(fixed.SINGLE_LEVEL_CHUNKS)}) AS chunk),
{SQL_VAR_LEVELS}
SELECT {sql_grouped_path(ROOT, 'date', 'chunk', False)} AS path FROM days, ml
UNION ALL SELECT {sql_ar_path(ROOT, 'date', 'variable', 'level')} AS path FROM days, vl
UNION ALL SELECT {sql_grouped_path(ROOT, 'date', 'chunk', True)} AS path FROM months, sl""")
def q_manifest_mode(spark, sf_dir):
    """SET-3: the final-release mode's manifest (union of three manifests)."""
    w = _window(table(spark, sf_dir, "events"), "ts")
    return manifest.availability_manifest(spark, w, fixed.MODE_FINAL, ROOT, _grid_variables(spark, sf_dir))


@register("set_difference", """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem
EXCEPT SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders""")
def q_set_difference(spark, sf_dir):
    """SET-1: ship dates that are not order dates (set semantics)."""
    a = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    b = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return manifest.set_difference(a, b)


@register("complete_dates", with_views("""
SELECT e.date, count(*) AS n_expected, count(a.chunk) AS n_present
FROM v_expected e LEFT JOIN v_actual a ON e.date = a.date AND e.chunk = a.chunk
GROUP BY e.date HAVING count(*) = count(a.chunk)""", "v_expected", "v_actual"))
def q_complete_dates(spark, sf_dir):
    """STM-3 (batch form): dates whose every expected file is present."""
    return manifest.complete_dates(S.v_expected(spark, sf_dir), S.v_actual(spark, sf_dir))


# ------------------------------------------------------------------ dates
@register("date_axis", f"""
SELECT o_orderkey, 'D' AS freq, CAST(unnest(generate_series(CAST(o_orderdate AS DATE),
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT), INTERVAL 1 DAY)) AS DATE) AS date FROM orders
UNION ALL
SELECT o_orderkey, 'MS' AS freq, date FROM (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 70 AS INT) AS e FROM orders) w,
  LATERAL (SELECT CAST(unnest(generate_series({SQL_MONTH_STARTS}, e, INTERVAL 1 MONTH)) AS DATE) AS date
           WHERE {SQL_MONTH_STARTS} <= e) x""")
def q_date_axis(spark, sf_dir):
    """DT-1: inclusive daily axis and month-start axis per order window."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("s"))
    daily = o.select("o_orderkey", F.lit("D").alias("freq"),
                     F.explode(D.date_axis("s", F.date_add("s", (F.col("o_orderkey") % 5).cast("int")), "D"))
                     .alias("date"))
    ms = o.select("o_orderkey", F.lit("MS").alias("freq"),
                  F.explode(D.date_axis("s", F.date_add("s", (F.col("o_orderkey") % 70).cast("int")), "MS"))
                  .alias("date"))
    return daily.unionByName(ms)


@register("hour_axis", """
WITH w AS (SELECT event_type AS variable, CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events GROUP BY 1)
SELECT variable, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS TIMESTAMP) AS time FROM w""")
def q_hour_axis(spark, sf_dir):
    """DT-2: every hour of every day a variable has data for, end day included."""
    w = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("variable")).agg(
        F.min("ts").alias("s"), F.max("ts").alias("e"))
    return w.select("variable", F.explode(D.hour_axis("s", "e")).alias("time"))


@register("time_offset", with_views(f"""
SELECT time, variable, lat_idx, lon_idx,
       CAST(date_diff('hour', TIMESTAMP '{INIT}', time) AS BIGINT) AS time_index,
       CAST(date_diff('day', DATE '{INIT}', CAST(time AS DATE)) * 24 AS INT) AS day_offset
FROM v_grid""", "v_grid"))
def q_time_offset(spark, sf_dir):
    """DT-3: hourly index of each grid row and the offset of its day's first step."""
    g = S.v_grid(spark, sf_dir)
    return g.select("time", "variable", "lat_idx", "lon_idx",
                    D.time_offset_hours(F.lit(INIT).cast("timestamp_ntz"), "time").alias("time_index"),
                    D.day_offset_hours(F.lit(INIT), "time").alias("day_offset"))


@register("offset_to_time", with_views(f"""
SELECT DISTINCT CAST(date_diff('hour', TIMESTAMP '{INIT}', time) AS BIGINT) AS time_index,
       TIMESTAMP '{INIT}' + to_hours(CAST(date_diff('hour', TIMESTAMP '{INIT}', time) AS BIGINT)) AS time
FROM v_grid""", "v_grid"))
def q_offset_to_time(spark, sf_dir):
    """DT-5: offset -> time for every offset the grid uses (round trip of DT-3)."""
    g = S.v_grid(spark, sf_dir)
    idx = g.select(D.time_offset_hours(F.lit(INIT).cast("timestamp_ntz"), "time").alias("time_index")).distinct()
    return idx.select("time_index", D.offset_to_time(F.lit(INIT), "time_index").alias("time"))


@register("file_region", f"""
WITH w AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM w),
months AS (SELECT CAST(unnest(generate_series({SQL_MONTH_STARTS}, e, INTERVAL 1 MONTH)) AS DATE) AS date FROM w),
ml AS (SELECT unnest({sql_list(fixed.MODEL_LEVEL_CHUNKS)}) AS chunk),
sl AS (SELECT unnest({sql_list(fixed.SINGLE_LEVEL_CHUNKS)}) AS chunk),
f AS (SELECT date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', False)} AS path, FALSE AS single FROM days, ml
      UNION ALL SELECT date, chunk, {sql_grouped_path(ROOT, 'date', 'chunk', True)} AS path, TRUE AS single FROM months, sl)
SELECT path, chunk,
       CAST(date_diff('day', DATE '{INIT}', date) * 24 AS INT) AS region_start,
       CAST(date_diff('day', DATE '{INIT}', date) * 24
            + 24 * CASE WHEN single THEN day(last_day(date)) ELSE 1 END AS INT) AS region_end
FROM f""")
def q_file_region(spark, sf_dir):
    """DT-4: (start, end) offsets of the region each grouped file overwrites."""
    from ..sinks.store import file_region
    files = q_manifest_co(spark, sf_dir).select("path")
    return file_region(files, INIT, 24).select("path", "chunk", "region_start", "region_end")


@register("processing_window", """
WITH t AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS today FROM orders),
m AS (SELECT unnest(['daily', 'monthly', 'era5']) AS mode),
x AS (SELECT today, mode,
        CASE mode WHEN 'daily' THEN today - 6
                  WHEN 'monthly' THEN CAST(date_trunc('month', CAST(date_trunc('month', today) AS DATE) - 1) AS DATE)
                  ELSE CAST(date_trunc('month', CAST(date_trunc('month', today - 61) AS DATE) - 1) AS DATE) END AS first_day,
        CASE mode WHEN 'daily' THEN today - 6
                  WHEN 'monthly' THEN CAST(date_trunc('month', today) AS DATE) - 1
                  ELSE CAST(date_trunc('month', today - 61) AS DATE) - 1 END AS last_day
      FROM t, m)
SELECT today, mode, first_day, last_day, strftime(first_day, '%Y') AS sl_year, strftime(first_day, '%m') AS sl_month FROM x""")
def q_processing_window(spark, sf_dir):
    """DT-6: the refresh window of each mode, for every order date taken as 'today'."""
    t = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("today")).distinct()
    m = dims.chunk_list(spark, [fixed.MODE_DAILY, fixed.MODE_MONTHLY, fixed.MODE_FINAL], "mode")
    w = t.crossJoin(m).select("today", "mode", D.processing_window("today", "mode").alias("w"))
    return w.select("today", "mode", "w.first_day", "w.last_day", "w.sl_year", "w.sl_month")


@register("valid_time", f"""
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
b AS (SELECT date, CAST(date AS TIMESTAMP) + to_hours(h) AS time FROM d, (SELECT unnest([6, 18]) AS h)),
s AS (SELECT CAST(unnest(range(0, {fixed.FORECAST_STEPS})) AS INT) AS step)
SELECT time, step, time + to_hours(step) AS valid_time FROM b, s""")
def q_valid_time(spark, sf_dir):
    """DT-7: forecast bases (06, 18 UTC) of every day with data x 19 steps."""
    d = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("date")).distinct()
    b = d.select(F.explode(F.array(*[F.timestamp_add("HOUR", F.lit(h), F.col("date").cast("timestamp_ntz"))
                                     for h in fixed.FORECAST_BASE_HOURS])).alias("time"))
    s = b.select("time", F.explode(F.sequence(F.lit(0), F.lit(fixed.FORECAST_STEPS - 1))).alias("step"))
    return s.select("time", "step", D.valid_time("time", "step").alias("valid_time"))


@register("parse_date", """
SELECT o_orderkey,
       CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS d_iso,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS d_compact,
       CAST(try_strptime(o_orderpriority, '%Y%m%d') AS DATE) AS d_bad
FROM orders""")
def q_parse_date(spark, sf_dir):
    """DT-8: ISO and compact date text; text that is not a date gives NULL."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    D.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd", strict=True).alias("d_iso"),
                    D.parse_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd", strict=True).alias("d_compact"),
                    D.parse_date("o_orderpriority", "yyyyMMdd").alias("d_bad"))


# ------------------------------------------------------------------ strings
@register("parse_path", f"""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
{SQL_VAR_LEVELS},
lvi AS (SELECT CAST(unnest({sql_list(FULL_37)}) AS INT) AS level, CAST(unnest(range(0, 37)) AS INT) AS level_index),
p AS (SELECT {sql_ar_path(ROOT, 'date', 'variable', 'level')} AS path, date, variable, level FROM d, vl)
SELECT p.path, p.date, p.variable, p.level,
       CAST(date_diff('day', DATE '{INIT}', p.date) * 24 AS INT) AS region_start,
       CAST(date_diff('day', DATE '{INIT}', p.date) * 24 + 24 AS INT) AS region_end,
       lvi.level_index
FROM p LEFT JOIN lvi ON p.level = lvi.level""")
def q_parse_path(spark, sf_dir):
    """STR-1 / SNK-8 region: parse analysis-ready paths back to (date, variable, level) and offsets."""
    from ..sinks.store import ar_path_region
    paths = q_manifest_ar(spark, sf_dir).select("path")
    return ar_path_region(spark, paths, INIT)


@register("url_normalize", r"""
SELECT page_id,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS normalized,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) = 'gs' AS is_gs
FROM pages""")
def q_url_normalize(spark, sf_dir):
    """STR-2: host + path of each page URL, its scheme, and the cloud-bucket test."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    scheme = P.url_scheme("url")
    return p.select("page_id", P.normalize_url("url").alias("normalized"), scheme.alias("scheme"),
                    (scheme == "gs").alias("is_gs"))


@register("slugify", "SELECT p_partkey, regexp_replace(p_name, '[^a-z0-9-]', '-', 'g') AS slug FROM part")
def q_slugify(spark, sf_dir):
    """STR-3: job-name safe text."""
    return table(spark, sf_dir, "part").select("p_partkey", P.slugify("p_name").alias("slug"))
