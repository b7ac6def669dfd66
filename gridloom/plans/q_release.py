"""Registered queries: release logic, joins and aggregates (JN-*, AG-*, STM-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import aggregate, dims, layout, release
from ..sinks.store import hourly_template
from ..sources import standins as S
from ..sources.tables import table
from .registry import register, with_views

N_CELLS = 24
GRID_VARS = ["click", "error", "purchase", "signup", "view"]


@register("expver_combine", with_views("""
SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value,
       arg_max(expver, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS expver_used
FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell""", "v_release"))
def q_expver_combine(spark, sf_dir):
    """JN-4: combine_first over releases: final value, else preliminary."""
    return release.combine_releases(S.v_release(spark, sf_dir), ["time", "variable", "cell"])


SQL_GAPS = f"""SELECT variable, time, coalesce(f, 0) < {N_CELLS} AS gap_final, coalesce(p, 0) < {N_CELLS} AS gap_prelim
FROM (SELECT DISTINCT event_type AS variable FROM events)
CROSS JOIN (SELECT unnest(generate_series(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP), CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 23 HOUR,
                                          INTERVAL 1 HOUR)) AS time FROM events)
LEFT JOIN (SELECT variable, time, count(DISTINCT CASE WHEN value IS NOT NULL AND expver = 1 THEN cell END) AS f,
                  count(DISTINCT CASE WHEN value IS NOT NULL AND expver = 5 THEN cell END) AS p
           FROM v_release WHERE day(time) <> 17 GROUP BY variable, time) USING (variable, time)"""


def _gaps(spark, sf_dir):
    """Gaps against the hourly axis of the data's days; one day of each month has lost all its rows."""
    from .q_store import _events_window
    r = S.v_release(spark, sf_dir)
    variables = table(spark, sf_dir, "events").select(F.col("event_type").alias("variable")).distinct()
    expected = hourly_template(spark, *_events_window(spark, sf_dir), variables).drop("value")
    return release.release_gaps(r.where(F.dayofmonth("time") != 17), ["variable", "time"], N_CELLS, expected=expected)


@register("release_gaps", with_views(SQL_GAPS, "v_release"))
def q_release_gaps(spark, sf_dir):
    """AG-1: per step of the axis, is any cell missing in the final / preliminary release?"""
    return _gaps(spark, sf_dir)


@register("release_disjoint", with_views(f"""
WITH g AS ({SQL_GAPS})
SELECT variable, bool_and(gap_final <> gap_prelim) AS disjoint,
       count(*) FILTER (WHERE gap_final AND gap_prelim) AS n_both_gappy, count(*) AS n_times
FROM g GROUP BY variable""", "v_release"))
def q_release_disjoint(spark, sf_dir):
    """AG-2: are the two releases' gaps disjoint at every step of the axis?"""
    return release.release_disjoint(_gaps(spark, sf_dir), ["variable"])


REL_SQL = "strftime(date, '%Y/%m/%d') || '/' || chunk || '.grib'"


@register("pair_releases", with_views(f"""
SELECT e.relpath, '/archive/raw/' || e.relpath AS old_path, '/archive/staging/' || a.relpath AS new_path
FROM (SELECT {REL_SQL} AS relpath FROM v_expected) e JOIN (SELECT {REL_SQL} AS relpath FROM v_actual) a
  ON e.relpath = a.relpath""", "v_expected", "v_actual"))
def q_pair_releases(spark, sf_dir):
    """JN-7: current file <-> staged replacement, only where the staged file exists."""
    rel = F.concat(F.date_format("date", "yyyy/MM/dd"), F.lit("/"), F.col("chunk"), F.lit(".grib"))
    old = S.v_expected(spark, sf_dir).select(rel.alias("relpath")).select(
        "relpath", F.concat(F.lit("/archive/raw/"), "relpath").alias("old_path"))
    new = S.v_actual(spark, sf_dir).select(rel.alias("relpath")).select(
        "relpath", F.concat(F.lit("/archive/staging/"), "relpath").alias("new_path"))
    return release.pair_releases(old, new)


def _combined_and_reissued(spark, sf_dir):
    comb = release.combine_releases(S.v_release(spark, sf_dir), ["time", "variable", "cell"])
    bump = (F.dayofmonth("time") % 7 == 0) & (F.col("cell") == 3)
    reissued = comb.select("time", "variable", "cell",
                           F.when(bump, F.col("value") + F.lit(1.0)).otherwise(F.col("value")).alias("value"))
    gone = (F.dayofmonth("time") == 13) & (F.col("cell") == 5)
    reissued = reissued.where(~gone)
    old = comb.withColumn("date", F.col("time").cast("date"))
    new = reissued.withColumn("date", F.col("time").cast("date"))
    return old, new


SQL_COMBINED = """c AS (SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value
      FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell),
o AS (SELECT *, CAST(time AS DATE) AS date FROM c),
n AS (SELECT time, variable, cell, CASE WHEN day(time) % 7 = 0 AND cell = 3 THEN value + 1.0 ELSE value END AS value,
             CAST(time AS DATE) AS date FROM c WHERE NOT (day(time) = 13 AND cell = 5)),
eq AS (SELECT coalesce(o.variable, n.variable) AS variable, coalesce(o.date, n.date) AS date,
              bool_and(o.value IS NOT DISTINCT FROM n.value) AS equal
       FROM o FULL OUTER JOIN n ON o.variable = n.variable AND o.date = n.date AND o.time = n.time AND o.cell = n.cell
       GROUP BY 1, 2)"""


@register("blocks_equal", with_views(f"WITH {SQL_COMBINED}\nSELECT variable, date, equal FROM eq", "v_release"))
def q_blocks_equal(spark, sf_dir):
    """JN-8: per (variable, day) block: is the re-issued block identical to the stored one?"""
    old, new = _combined_and_reissued(spark, sf_dir)
    return release.blocks_equal(old, new, ["variable", "date"], ["time", "cell"])


@register("audit_counts", with_views(f"""WITH {SQL_COMBINED}
SELECT count(*) FILTER (WHERE equal) AS n_equal, count(*) FILTER (WHERE NOT equal) AS n_different FROM eq""",
                                     "v_release"))
def q_audit_counts(spark, sf_dir):
    """AG-6: counters of unchanged and changed blocks."""
    old, new = _combined_and_reissued(spark, sf_dir)
    return release.audit_counts(release.blocks_equal(old, new, ["variable", "date"], ["time", "cell"]))


KINDS = ("click", "error", "purchase", "signup", "view")      # the variables of v_release
_KIND_COLUMNS = ", ".join(f"max(value) FILTER (WHERE variable = '{v}') AS {v}" for v in KINDS)


@register("merge_conflicts", with_views(f"""
WITH a AS (SELECT time, cell, {_KIND_COLUMNS} FROM v_release WHERE expver = 1 GROUP BY 1, 2),
b AS (SELECT time, cell, {_KIND_COLUMNS} FROM v_release WHERE expver = 5 GROUP BY 1, 2)
SELECT {", ".join(f"count(*) FILTER (WHERE a.{v} IS NOT NULL AND b.{v} IS NOT NULL) AS {v}_both, "
                  f"count(*) FILTER (WHERE a.{v} IS NOT NULL AND b.{v} IS NOT NULL AND a.{v} <> b.{v}) AS {v}_conflicts"
                  for v in KINDS)}
FROM a JOIN b ON a.time = b.time AND a.cell = b.cell""", "v_release"))
def q_merge_conflicts(spark, sf_dir):
    """JN-9: where both sources hold a same-named variable, do they agree?"""
    r = S.v_release(spark, sf_dir)
    a = layout.pivot_wide(r.where(F.col("expver") == 1), ["time", "cell"], variables=list(KINDS))
    b = layout.pivot_wide(r.where(F.col("expver") == 5), ["time", "cell"], variables=list(KINDS))
    return release.merge_conflicts(a, b, ["time", "cell"], list(KINDS))


@register("merge_groups", with_views("""
SELECT coalesce(l.time, s.time) AS time, coalesce(l.cell, s.cell) AS cell, l.k, l.t, l.q, l.w, l.x, s.lnsp, s.zs
FROM v_levels l FULL OUTER JOIN v_surface s ON l.time = s.time AND l.cell = s.cell""", "v_levels", "v_surface"))
def q_merge_groups(spark, sf_dir):
    """JN-1: merge the level group with the surface group on shared coords."""
    lv = S.v_levels(spark, sf_dir)
    return release.merge_stores(lv, S.v_surface(lv), ["time", "cell"])


@register("merge_stores", with_views("""
WITH sp AS (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time, CAST(l_partkey % 24 AS INT) AS cell,
                   CAST(max(l_quantity) AS DOUBLE) AS sp
            FROM lineitem GROUP BY 1, 2)
SELECT coalesce(l.time, sp.time) AS time, coalesce(l.cell, sp.cell) AS cell, l.k, l.t, l.q, l.w, l.x, sp.sp
FROM v_levels l FULL OUTER JOIN sp ON l.time = sp.time AND l.cell = sp.cell""", "v_levels"))
def q_merge_stores(spark, sf_dir):
    """JN-2: native-vertical store merged with another store's surface part; a conflict would fail it."""
    li = table(spark, sf_dir, "lineitem")
    from ..functions.dates import trunc_ntz
    sp = li.groupBy(trunc_ntz("month", "l_shipdate").alias("time"),
                    (F.col("l_partkey") % 24).cast("int").alias("cell")).agg(
        F.max("l_quantity").cast("double").alias("sp"))
    return release.merge_stores(S.v_levels(spark, sf_dir), sp, ["time", "cell"])


@register("merge_stores_conflicts", with_views("""
WITH b AS (SELECT time, cell, k, CASE WHEN cell % 5 = 3 THEN t + 1 WHEN cell % 5 <> 1 THEN t END AS t, q, w * 2 AS w2 FROM v_levels WHERE k <> 2)
SELECT coalesce(a.time, b.time) AS time, coalesce(a.cell, b.cell) AS cell, coalesce(a.k, b.k) AS k, coalesce(a.t, b.t) AS t,
       coalesce(a.q, b.q) AS q, a.w, b.w2, CAST(coalesce(a.t <> b.t, false) AS INT) + CAST(coalesce(a.q <> b.q, false) AS INT) AS n_conflicts
FROM (SELECT time, cell, k, t, q, w FROM v_levels WHERE k <> 5) a
FULL OUTER JOIN b ON a.time = b.time AND a.cell = b.cell AND a.k = b.k""", "v_levels"))
def q_merge_stores_conflicts(spark, sf_dir):
    """JN-2 with JN-9 in one plan: two stores that share t and q; t disagrees on some cells and is
    missing on others; each lacks a level that the other has."""
    lv = S.v_levels(spark, sf_dir)
    c = F.col("cell") % 5
    b = lv.where(F.col("k") != 2).select("time", "cell", "k", F.when(c == 3, F.col("t") + 1).when(c != 1, F.col("t")).alias("t"),
                                         "q", (F.col("w") * 2).alias("w2"))
    return release.merge_stores(lv.where(F.col("k") != 5).drop("x"), b, ["time", "cell", "k"], on_conflict="count")


@register("align_outer", with_views(f"""
SELECT expver, time, cell, {_KIND_COLUMNS} FROM v_release GROUP BY expver, time, cell""", "v_release"))
def q_align_outer(spark, sf_dir):
    """JN-3: outer-align per-variable arrays of both releases on their coords (as one pivot)."""
    return layout.pivot_wide(S.v_release(spark, sf_dir), ["expver", "time", "cell"], variables=list(KINDS))


def _chunk_rows():
    return ", ".join(f"('{c}', '{v}')" for c, vs in fixed.CHUNK_VARIABLES.items() for v in vs)


def _store_rows():
    return ", ".join(f"('{s}', '{c}')" for s, cs in fixed.STORE_CHUNKS.items() for c in cs)


@register("chunk_lookup", with_views(f"""
WITH cv AS (SELECT * FROM (VALUES {_chunk_rows()}) t(chunk, short_name)),
sc AS (SELECT * FROM (VALUES {_store_rows()}) t(store, chunk)),
l AS (SELECT short_name, value FROM v_levels UNPIVOT (value FOR short_name IN (t, q, w, x)))
SELECT sc.store, cv.chunk, l.short_name, count(*) AS n_values
FROM l JOIN cv ON cv.short_name = l.short_name JOIN sc ON sc.chunk = cv.chunk
GROUP BY 1, 2, 3""", "v_levels"))
def q_chunk_lookup(spark, sf_dir):
    """JN-10: data rows routed to chunk and store through the broadcast lookup tables."""
    long = layout.unpivot_long(S.v_levels(spark, sf_dir), ["time", "cell", "k"], ["t", "q", "w", "x"],
                               "short_name", "value")
    j = long.join(dims.chunk_variables(spark), "short_name").join(
        dims.store_chunks(spark).select("store", "chunk"), "chunk")
    return j.groupBy("store", "chunk", "short_name").agg(F.count(F.lit(1)).alias("n_values"))


@register("field_extremes", with_views("""
SELECT variable, min(value * 0.5 + 1.0) AS min_value, max(value * 0.5 + 1.0) AS max_value FROM v_grid GROUP BY variable""",
                                       "v_grid"))
def q_field_extremes(spark, sf_dir):
    """AG-3: extremes per field after scale + bias."""
    return aggregate.field_extremes(S.v_grid(spark, sf_dir), ["variable"], scale=0.5, bias=1.0)


@register("describe_fields", with_views("""
SELECT short_name, count(*) AS n_values, list_sort(list(DISTINCT k)) AS levels, min(time) AS time_min, max(time) AS time_max
FROM (SELECT time, k, short_name, value FROM v_levels UNPIVOT (value FOR short_name IN (t, q, w, x)))
GROUP BY short_name""", "v_levels"))
def q_describe_fields(spark, sf_dir):
    """AG-4: per field: count, level list, time range."""
    long = layout.unpivot_long(S.v_levels(spark, sf_dir), ["time", "cell", "k"], ["t", "q", "w", "x"],
                               "short_name", "value")
    return aggregate.describe_fields(long, "short_name", "k")


@register("store_size", with_views("""
SELECT variable, count(*) AS n_values, count(*) * 4 AS nbytes FROM v_grid GROUP BY ROLLUP (variable)""", "v_grid"))
def q_store_size(spark, sf_dir):
    """AG-5: bytes per variable and for the whole store."""
    return aggregate.store_size(S.v_grid(spark, sf_dir), "variable")


@register("assert_levels", with_views("""
SELECT time, cell, count(DISTINCT k) AS n_levels, count(DISTINCT k) = 7 AS complete FROM v_levels GROUP BY time, cell""",
                                      "v_levels"))
def q_assert_levels(spark, sf_dir):
    """AG-8: level count per column against the group size."""
    return aggregate.level_counts(S.v_levels(spark, sf_dir), ["time", "cell"], "k", 7)


@register("climatology", with_views("""
SELECT CAST(month(time) AS INT) AS month, CAST(hour(time) AS INT) AS hour, lat_idx, lon_idx, variable, round(avg(value), 6) AS mean_value,
       count(value) AS n
FROM v_grid GROUP BY 1, 2, 3, 4, 5""", "v_grid"))
def q_climatology(spark, sf_dir):
    """AG-10: mean per month-of-year, hour-of-day and cell."""
    c = aggregate.climatology(S.v_grid(spark, sf_dir), ["lat_idx", "lon_idx", "variable"])
    return c.withColumn("mean_value", F.round("mean_value", 6))


@register("diurnal_range", with_views("""
SELECT CAST(time AS DATE) AS date, lat_idx, lon_idx, variable, max(value) - min(value) AS diurnal_range
FROM v_grid GROUP BY 1, 2, 3, 4""", "v_grid"))
def q_diurnal_range(spark, sf_dir):
    """AG-11: daily max - min per cell."""
    return aggregate.diurnal_range(S.v_grid(spark, sf_dir), ["lat_idx", "lon_idx", "variable"])


@register("hourly_grid", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('hour', ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end,
       CAST(user_id % 24 AS INT) AS cell, count(*) AS n, max(value) AS max_value
FROM events GROUP BY 1, 2, 3""")
def q_hourly_grid(spark, sf_dir):
    """STM-4 (batch form): raw rows bucketed on the hourly grid axis."""
    e = table(spark, sf_dir, "events").select("ts", (F.col("user_id") % 24).cast("int").alias("cell"), "value")
    return aggregate.hourly_buckets(e, "ts", ["cell"])
