"""Registered queries: derived fields, vertical and horizontal interpolation,
spectral wind (MET-1 .. MET-19, WN-1 .. WN-5, JN-12, JN-13)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.numeric import round_scaled
from ..operators import layout, met, parcel, regrid, release, spectral, vertical
from ..sources import standins as S
from ..sources.tables import table
from .registry import register, sql_list, with_views

N_LEVELS = 7
LINE = (75.0, 10.0, -80.0, 250.0, 25)           # lat1, lon1, lat2, lon2, points
GRID = dict(n_lat=4, n_lon=6, lat0=90.0, dlat=60.0, lon0=0.0, dlon=60.0)
P_TARGETS = [lv * 100.0 for lv in fixed.PRESSURE_LEVEL_GROUPS["full_37"] if lv >= 50]
H_TARGETS = [float(h) for h in range(0, 20001, 1000)]
THETA = math.atan2(LINE[2] - LINE[0], LINE[3] - LINE[1])
TRUNC = 6


def d(x: float) -> str:
    """A DOUBLE literal in DuckDB that parses to exactly the Python value."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


# ------------------------------------------------------------ Spark helpers
def levels_with_pressure(spark, sf_dir):
    lv = S.v_levels(spark, sf_dir)
    sf = S.v_surface(lv)
    out = met.full_level_pressure(lv, sf, met.hybrid_coefficients(spark, N_LEVELS))
    return out.withColumn("u", F.col("x") / F.lit(1000.0) - F.lit(50.0)) \
        .withColumn("v", F.col("t") - F.lit(255.0))


def levels_with_geopotential(spark, sf_dir):
    return met.geopotential_on_levels(levels_with_pressure(spark, sf_dir))


def _cell_xy(df):
    return df.withColumn("lat_idx", (F.col("cell") / 6).cast("int")).withColumn("lon_idx", (F.col("cell") % 6).cast("int"))


def _line_neighbours(spark):
    pts = regrid.line_points(spark, *LINE)
    return regrid.bilinear_neighbours(pts, ["point_id"], **GRID)


# ------------------------------------------------------------- SQL helpers
COEF = (f"coef AS (SELECT CAST(h AS INT) AS half_level, "
        f"{d(20000.0)} * (CAST(h AS DOUBLE) / {d(N_LEVELS)}) * ({d(1.0)} - CAST(h AS DOUBLE) / {d(N_LEVELS)}) AS a, "
        f"(CAST(h AS DOUBLE) / {d(N_LEVELS)}) * (CAST(h AS DOUBLE) / {d(N_LEVELS)}) AS b FROM range({N_LEVELS + 1}) r(h))")
PRES = f"""{COEF},
pl AS (SELECT l.time, l.cell, l.k, l.t, l.q, l.w, l.x, s.lnsp, s.zs,
              cu.a + cu.b * exp(s.lnsp) AS p_above, cd.a + cd.b * exp(s.lnsp) AS p_below
       FROM v_levels l LEFT JOIN v_surface s ON l.time = s.time AND l.cell = s.cell
       JOIN coef cu ON cu.half_level = l.k - 1 JOIN coef cd ON cd.half_level = l.k),
pf AS (SELECT *, (p_above + p_below) / {d(2.0)} AS p, x / {d(1000.0)} - {d(50.0)} AS u, t - {d(255.0)} AS v FROM pl)"""
TV = f"({d(1.0)} + {d(fixed.R_VAP / fixed.R_DRY - 1.0)} * q) * t"
GEO = f"""{PRES},
g AS (SELECT *, {TV} AS tv, CASE WHEN p_above <= {d(0.0)} THEN NULL ELSE ln(p_below / p_above) END AS dlogp FROM pf),
g2 AS (SELECT *, CASE WHEN count(tv * dlogp) OVER below = {N_LEVELS} - k
                 THEN zs + coalesce(sum({d(fixed.R_DRY)} * tv * dlogp) OVER below, {d(0.0)}) END AS z_half
       FROM g WINDOW below AS (PARTITION BY time, cell ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
gz AS (SELECT *, z_half + CASE WHEN p_above <= {d(0.0)} THEN {d(0.6931471805599453)}
                  ELSE {d(1.0)} - p_above / (p_below - p_above) * dlogp END * {d(fixed.R_DRY)} * tv AS z FROM g2)"""


def _es(t: str) -> str:
    water = f"{d(fixed.ES_A1)} * exp({d(fixed.ES_A3_WATER)} * ({t} - {d(fixed.T_ZERO)}) / ({t} - {d(fixed.ES_A4_WATER)}))"
    ice = f"{d(fixed.ES_A1)} * exp({d(fixed.ES_A3_ICE)} * ({t} - {d(fixed.T_ZERO)}) / ({t} - {d(fixed.ES_A4_ICE)}))"
    frac = f"(({t} - {d(fixed.T_ICE)}) / {d(fixed.T_ZERO - fixed.T_ICE)})"
    alpha = (f"(CASE WHEN {t} >= {d(fixed.T_ZERO)} THEN {d(1.0)} WHEN {t} <= {d(fixed.T_ICE)} THEN {d(0.0)} "
             f"ELSE {frac} * {frac} END)")
    return f"({alpha} * {water} + ({d(1.0)} - {alpha}) * {ice})"


def _e(q: str, p: str) -> str:
    eps = fixed.EPSILON
    return f"({q} * {p} / ({d(eps)} + {d(1.0 - eps)} * {q}))"


def _td(q: str, p: str) -> str:
    ln = f"ln({_e(q, p)} / {d(fixed.ES_A1)})"
    td = f"(({d(fixed.ES_A3_WATER * fixed.T_ZERO)} - {d(fixed.ES_A4_WATER)} * {ln}) / ({d(fixed.ES_A3_WATER)} - {ln}))"
    return f"(CASE WHEN {_e(q, p)} > {d(0.0)} THEN {td} END)"


def _sql_line_neighbours() -> str:
    lat1, lon1, lat2, lon2, n = LINE
    g = GRID
    pts = (f"pts AS (SELECT CAST(i AS INT) AS point_id, {d(lat1)} + {d(lat2 - lat1)} * (CAST(i AS DOUBLE) / {d(n - 1)}) AS lat, "
           f"{d(lon1)} + {d(lon2 - lon1)} * (CAST(i AS DOUBLE) / {d(n - 1)}) AS lon FROM range({n}) r(i))")
    fi = f"(({d(g['lat0'])} - lat) / {d(g['dlat'])})"
    fj = f"(((((lon - {d(g['lon0'])}) % {d(360.0)}) + {d(360.0)}) % {d(360.0)}) / {d(g['dlon'])})"
    frac = (f"fr AS (SELECT point_id, CAST(least(greatest(floor({fi}), 0), {g['n_lat'] - 2}) AS INT) AS i0, "
            f"CAST(floor({fj}) AS INT) AS j0, {fi} AS fi, {fj} AS fj FROM pts)")
    wts = (f"fw AS (SELECT point_id, i0, j0, least(greatest(fi - i0, {d(0.0)}), {d(1.0)}) AS wi, fj - j0 AS wj FROM fr)")
    parts = []
    for di in (0, 1):
        for dj in (0, 1):
            wi = "wi" if di else f"({d(1.0)} - wi)"
            wj = "wj" if dj else f"({d(1.0)} - wj)"
            parts.append(f"SELECT point_id, i0 + {di} AS lat_idx, CAST((((j0 + {dj}) % {g['n_lon']}) + {g['n_lon']}) % {g['n_lon']} AS INT) AS lon_idx, "
                         f"{wi} * {wj} AS w FROM fw")
    nb = f"nb AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE w > {d(0.0)})"
    return f"{pts},\n{frac},\n{wts},\n{nb}"


def _sql_sample(field: str, keys: list[str], values: list[str]) -> str:
    ks = ", ".join(f"f.{k}" for k in keys)
    aggs = ", ".join(
        f"CASE WHEN sum(CASE WHEN f.{v} IS NOT NULL THEN nb.w END) > 0 THEN "
        f"sum(CASE WHEN f.{v} IS NOT NULL THEN nb.w * f.{v} END) / sum(CASE WHEN f.{v} IS NOT NULL THEN nb.w END) END AS {v}"
        for v in values)
    return (f"SELECT nb.point_id, {ks}, {aggs} FROM {field} f JOIN nb ON f.lat_idx = nb.lat_idx AND f.lon_idx = nb.lon_idx "
            f"GROUP BY nb.point_id, {ks}")


def _sql_interp(src: str, keys: list[str], coord: str, values: list[str], targets: list[float], log: bool,
                extrapolate: tuple = ()) -> str:
    ks = ", ".join(keys)
    f = (lambda x: f"ln({x})") if log else (lambda x: x)
    leads = ", ".join(f"lead({v}) OVER w AS {v}_1" for v in values)
    b = (f"SELECT {ks}, {coord} AS c0, {', '.join(values)}, lead({coord}) OVER w AS c1, {leads}, "
         f"lead({coord}, 2) OVER w IS NULL AS is_last, lag({coord}) OVER w IS NULL AS is_first "
         f"FROM {src} WHERE {coord} IS NOT NULL WINDOW w AS (PARTITION BY {ks} ORDER BY {coord})")
    tg = f"(SELECT unnest({sql_list([float(x) for x in sorted(targets)])}) AS target)"
    frac = f"(({f('target')} - {f('c0')}) / ({f('c1')} - {f('c0')}))"
    vals = ", ".join(f"{v} + ({v}_1 - {v}) * {frac} AS {v}" for v in values)
    inside = (f"SELECT {ks}, target, {vals} FROM ({b}) bb, {tg} tg WHERE c1 IS NOT NULL AND target >= c0 "
              f"AND (target < c1 OR (target = c1 AND is_last))")
    if not extrapolate:
        return inside
    ev = ", ".join((f"{v}" if v in extrapolate else f"CAST(NULL AS DOUBLE)") + f" AS {v}" for v in values)
    ext = (f"SELECT {ks}, target, {ev} FROM ({b}) bb, {tg} tg WHERE (is_first AND target < c0) "
           f"OR (c1 IS NULL AND target > c0)")
    return f"{inside} UNION ALL {ext}"


# ------------------------------------------------------------------ point formulas
@register("wind_speed", with_views(f"""
SELECT time, cell, k, sqrt((x / {d(1000.0)} - {d(50.0)}) * (x / {d(1000.0)} - {d(50.0)}) + (t - {d(255.0)}) * (t - {d(255.0)})) AS wind_speed
FROM v_levels""", "v_levels"))
def q_wind_speed(spark, sf_dir):
    """MET-1: wind speed from u, v."""
    lv = S.v_levels(spark, sf_dir)
    return lv.select("time", "cell", "k", met.wind_speed(F.col("x") / F.lit(1000.0) - F.lit(50.0),
                                                         F.col("t") - F.lit(255.0)).alias("wind_speed"))


@register("pressure_ml", with_views(f"""WITH {PRES}
SELECT time, cell, k, round(p_above, 4) AS p_above, round(p_below, 4) AS p_below, round(p, 4) AS p FROM pf""",
                                    "v_levels", "v_surface"))
def q_pressure_ml(spark, sf_dir):
    """MET-2 / WN-2: half- and full-level pressure from lnsp and hybrid coefficients."""
    p = levels_with_pressure(spark, sf_dir)
    return p.select("time", "cell", "k", *[F.round(c, 4).alias(c) for c in ("p_above", "p_below", "p")])


@register("virtual_temp", with_views(f"SELECT time, cell, k, round({TV}, 8) AS tv FROM v_levels", "v_levels"))
def q_virtual_temp(spark, sf_dir):
    """MET-3: virtual temperature."""
    lv = S.v_levels(spark, sf_dir)
    return lv.select("time", "cell", "k", F.round(met.virtual_temperature("t", "q"), 8).alias("tv"))


@register("rel_humidity", with_views(f"""WITH {PRES}
SELECT time, cell, k, round({d(100.0)} * {_e('q', 'p')} / {_es('t')}, 6) AS rh FROM pf""", "v_levels", "v_surface"))
def q_rel_humidity(spark, sf_dir):
    """MET-4: relative humidity (mixed-phase saturation)."""
    p = levels_with_pressure(spark, sf_dir)
    return p.select("time", "cell", "k", F.round(met.relative_humidity("t", "q", "p"), 6).alias("rh"))


@register("dewpoint", with_views(f"""WITH {PRES}
SELECT time, cell, k, round({_td('q', 'p')}, 6) AS td FROM pf""", "v_levels", "v_surface"))
def q_dewpoint(spark, sf_dir):
    """MET-5: dewpoint from specific humidity and pressure."""
    p = levels_with_pressure(spark, sf_dir)
    return p.select("time", "cell", "k", F.round(met.dewpoint("q", "p"), 6).alias("td"))


@register("geopotential", with_views(f"""WITH {GEO}
SELECT time, cell, k, round(z_half, 3) AS z_half, round(z, 3) AS z FROM gz""", "v_levels", "v_surface"))
def q_geopotential(spark, sf_dir):
    """MET-6 / WN-1: hydrostatic geopotential on model levels."""
    g = levels_with_geopotential(spark, sf_dir)
    return g.select("time", "cell", "k", F.round("z_half", 3).alias("z_half"), F.round("z", 3).alias("z"))


@register("geo_height", with_views(f"""WITH {GEO}
SELECT time, cell, k, round(z / {d(fixed.G_HEIGHT)}, 3) AS height FROM gz""", "v_levels", "v_surface"))
def q_geo_height(spark, sf_dir):
    """MET-7: geopotential height."""
    g = levels_with_geopotential(spark, sf_dir)
    return g.select("time", "cell", "k", F.round(met.geopotential_height("z"), 3).alias("height"))


@register("w_from_omega", with_views(f"""WITH {PRES}
SELECT time, cell, k, round(-w * {d(fixed.R_DRY)} * t / (p * {d(fixed.G0)}), 8) AS w_ms FROM pf""",
                                     "v_levels", "v_surface"))
def q_w_from_omega(spark, sf_dir):
    """MET-8: vertical velocity in m/s from omega (Pa/s)."""
    p = levels_with_pressure(spark, sf_dir)
    return p.select("time", "cell", "k", F.round(met.w_from_omega("w", "t", "p"), 8).alias("w_ms"))


@register("lcl", with_views(f"""WITH {PRES},
s AS (SELECT time, cell, t, least({_td('q', 'p')}, t) AS td, p FROM pf WHERE k = {N_LEVELS}),
l AS (SELECT time, cell, t, p, {d(1.0)} / ({d(1.0)} / (td - {d(56.0)}) + ln(t / td) / {d(800.0)}) + {d(56.0)} AS lcl_t FROM s)
SELECT time, cell, round(lcl_t, 4) AS lcl_t, round(p * pow(lcl_t / t, {d(fixed.CP_DRY / fixed.R_DRY)}) / {d(100.0)}, 3) AS lcl_hpa FROM l""",
                            "v_levels", "v_surface"))
def q_lcl(spark, sf_dir):
    """MET-13 (LCL part): lifting condensation level of the lowest-level parcel of every column."""
    p = levels_with_pressure(spark, sf_dir).where(F.col("k") == N_LEVELS)
    td = F.least(met.dewpoint("q", "p"), F.col("t"))
    t_lcl, p_lcl = vertical.lcl(F.col("t"), td, F.col("p"))
    return p.select("time", "cell", F.round(t_lcl, 4).alias("lcl_t"), F.round(p_lcl / F.lit(100.0), 3).alias("lcl_hpa"))


def _sql_parcel(mode: str) -> str:
    """The ascent in SQL: eight steps a layer by recursion, from the LCL up; then buoyancy, layers
    and crossings with windows."""
    kappa, rd, cp, lv = d(fixed.R_DRY / fixed.CP_DRY), d(fixed.R_DRY), d(fixed.CP_DRY), d(parcel.LV)
    es = lambda t: f"({d(fixed.ES_A1)} * exp({d(fixed.ES_A3_WATER)} * ({t} - {d(fixed.T_ZERO)}) / ({t} - {d(fixed.ES_A4_WATER)})))"
    rs = lambda t, p: f"({d(fixed.EPSILON)} * {es(t)} / greatest({p} - {es(t)}, 1.0))"
    ln = f"ln(greatest({_e('q', 'p')}, 1e-10) / {d(fixed.ES_A1)})"
    td = f"(({d(fixed.ES_A3_WATER * fixed.T_ZERO)} - {d(fixed.ES_A4_WATER)} * {ln}) / ({d(fixed.ES_A3_WATER)} - {ln}))"
    best = "0" if mode == "surface" else "arg_max(i, theta_e) FILTER (WHERE p >= p_low - 30000.0)"
    zero = lambda p0, b0, p1, b1: f"exp(ln({p0}) + {b0} / ({b0} - {b1}) * (ln({p1}) - ln({p0})))"
    return f"""WITH RECURSIVE {PRES},
lev AS (SELECT time, cell, p, t, q, {td} AS td, row_number() OVER (PARTITION BY time, cell ORDER BY p DESC, t DESC, q DESC) - 1 AS i
        FROM pf WHERE p IS NOT NULL AND t IS NOT NULL AND q IS NOT NULL),
warm AS (SELECT *, max(p) OVER (PARTITION BY time, cell) AS p_low, t * pow(100000.0 / p, {kappa}) * exp({lv} * {rs('td', 'p')} / ({cp} * t)) AS theta_e
         FROM lev),
st AS (SELECT time, cell, {best} AS s, count(*) AS n FROM warm GROUP BY 1, 2),
par AS (SELECT time, cell, s, n, p AS p0, t AS t0, least(td, t) AS td0 FROM st JOIN lev USING (time, cell) WHERE i = s),
lcl AS (SELECT *, 1.0 / (1.0 / (td0 - 56.0) + ln(t0 / td0) / 800.0) + 56.0 AS t_lcl FROM par),
lc AS (SELECT *, p0 * pow(t_lcl / t0, {d(fixed.CP_DRY / fixed.R_DRY)}) AS p_lcl FROM lcl),
lay AS (SELECT l.time, l.cell, l.i, ln(l.p) AS l1,
               ln(CASE WHEN lag(l.p) OVER w IS NULL THEN c.p_lcl ELSE lag(l.p) OVER w END) AS l0, lag(l.p) OVER w IS NULL AS lowest
        FROM lev l JOIN lc c USING (time, cell) WHERE l.i >= c.s AND l.p < c.p_lcl WINDOW w AS (PARTITION BY l.time, l.cell ORDER BY l.i)),
up(time, cell, i, step, lp, t) AS (
  SELECT lay.time, lay.cell, lay.i, 0, lay.l0, lc.t_lcl FROM lay JOIN lc USING (time, cell) WHERE lowest
  UNION ALL
  SELECT time, cell, i, step, lp + (l1 - l0) / 8, t + (l1 - l0) / 8 * ({rd} * t + {lv} * r)
         / ({cp} + {lv} * {lv} * r * {d(fixed.EPSILON)} / ({rd} * t * t))
  FROM (SELECT x.time, x.cell, x.i, x.step, x.t, y.l0, y.l1, CASE WHEN x.step = 1 THEN y.l0 ELSE x.lp END AS lp,
               {rs('x.t', 'exp(CASE WHEN x.step = 1 THEN y.l0 ELSE x.lp END)')} AS r
        FROM (SELECT time, cell, lp, t, CASE WHEN step = 8 THEN i + 1 ELSE i END AS i, CASE WHEN step = 8 THEN 1 ELSE step + 1 END AS step FROM up) x
        JOIN lay y ON y.time = x.time AND y.cell = x.cell AND y.i = x.i)),
b AS (SELECT l.time, l.cell, l.i, l.p, c.p_lcl, c.s, c.n,
             CASE WHEN l.p >= c.p_lcl THEN c.t0 * pow(l.p / c.p0, {kappa}) ELSE u.t END - l.t AS b
      FROM lev l JOIN lc c USING (time, cell) LEFT JOIN up u ON u.time = l.time AND u.cell = l.cell AND u.i = l.i AND u.step = 8
      WHERE l.i >= c.s),
e AS (SELECT *, lag(p) OVER w AS pd, lag(b) OVER w AS bd, lead(p) OVER w AS pu, lead(b) OVER w AS bu FROM b
      WINDOW w AS (PARTITION BY time, cell ORDER BY i)),
f AS (SELECT *, i > s AND p <= p_lcl AND b > 0 AS pos, CASE WHEN i > s THEN {rd} * 0.5 * (b + bd) * (ln(pd) - ln(p)) END AS layer FROM e),
g AS (SELECT time, cell, min(i) FILTER (WHERE pos) AS lo, max(i) FILTER (WHERE pos) AS hi FROM f GROUP BY 1, 2),
h AS (SELECT f.time, f.cell,
             max(CASE WHEN i = lo THEN CASE WHEN bd <= 0 THEN least({zero('pd', 'bd', 'p', 'b')}, p_lcl) ELSE p_lcl END END) AS lfc_p,
             max(CASE WHEN i = hi THEN CASE WHEN pu IS NULL THEN p ELSE {zero('p', 'b', 'pu', 'bu')} END END) AS el_p,
             coalesce(sum(CASE WHEN layer > 0 AND i >= lo THEN layer END), 0) AS cape,
             coalesce(sum(CASE WHEN layer < 0 AND (lo IS NULL OR i < lo) THEN layer END), 0) AS cin
      FROM f JOIN g USING (time, cell) GROUP BY 1, 2)
SELECT k.time, k.cell, CASE WHEN n >= 2 THEN round(p_lcl, 3) END AS lcl_p, CASE WHEN n >= 2 THEN round(t_lcl, 4) END AS lcl_t,
       CASE WHEN n >= 2 THEN round(lfc_p, 3) END AS lfc_p, CASE WHEN n >= 2 THEN round(el_p, 3) END AS el_p,
       CASE WHEN n >= 2 THEN round(cape, 3) ELSE 0 END AS cape, CASE WHEN n >= 2 THEN round(cin, 3) ELSE 0 END AS cin
FROM (SELECT DISTINCT time, cell FROM v_levels) k LEFT JOIN lc USING (time, cell) LEFT JOIN h USING (time, cell)"""


def _parcel(spark, sf_dir, mode):
    r = parcel.parcel_indices(levels_with_pressure(spark, sf_dir), ["time", "cell"], mode=mode)
    places = {"lcl_p": 3, "lcl_t": 4, "lfc_p": 3, "el_p": 3, "cape": 3, "cin": 3}
    return r.select("time", "cell", *[(F.round(c, n) + F.lit(0.0)).alias(c) for c, n in places.items()])


@register("parcel_indices", with_views(_sql_parcel("surface"), "v_levels", "v_surface"))
def q_parcel_indices(spark, sf_dir):
    """MET-13: LCL, LFC, EL, CAPE, CIN per column (grouped pandas ascent)."""
    return _parcel(spark, sf_dir, "surface")


@register("parcel_most_unstable", with_views(_sql_parcel("most_unstable"), "v_levels", "v_surface"))
def q_parcel_most_unstable(spark, sf_dir):
    """MET-13, the most unstable parcel of the lowest 300 hPa."""
    return _parcel(spark, sf_dir, "most_unstable")


# ------------------------------------------------------------------ sampling / sections
@register("point_profile", with_views(f"""WITH {PRES},
pts AS (SELECT n_nationkey, CAST(n_nationkey AS DOUBLE) * {d(7.3)} - {d(80.1)} AS lat,
               CAST(n_regionkey AS DOUBLE) * {d(70.0)} + {d(5.0)} AS lon FROM nation),
nc AS (SELECT n_nationkey, CAST(least(greatest(round(({d(90.0)} - lat) / {d(60.0)}), 0), 3) AS INT) AS lat_idx,
              CAST(((CAST(round((((lon % {d(360.0)}) + {d(360.0)}) % {d(360.0)}) / {d(60.0)}) AS INT) % 6) + 6) % 6 AS INT) AS lon_idx
       FROM pts)
SELECT nc.n_nationkey, pf.time, pf.k, pf.t, pf.q, pf.u, pf.v, pf.lnsp, round(pf.p, 4) AS p
FROM pf JOIN nc ON pf.cell // 6 = nc.lat_idx AND pf.cell % 6 = nc.lon_idx""",
                                      "v_levels", "v_surface"))
def q_point_profile(spark, sf_dir):
    """MET-12 / JN-12: vertical profile at the grid column nearest to each point."""
    pts = table(spark, sf_dir, "nation").select(
        "n_nationkey", (F.col("n_nationkey").cast("double") * F.lit(7.3) - F.lit(80.1)).alias("lat"),
        (F.col("n_regionkey").cast("double") * F.lit(70.0) + F.lit(5.0)).alias("lon"))
    nc = regrid.nearest_cell(pts, ["n_nationkey"], **GRID)
    p = _cell_xy(levels_with_pressure(spark, sf_dir))
    return p.join(nc, ["lat_idx", "lon_idx"]).select(
        "n_nationkey", "time", "k", "t", "q", "u", "v", "lnsp", F.round("p", 4).alias("p"))


@register("sample_line", with_views(f"""WITH {_sql_line_neighbours()}
SELECT point_id, time, variable, round(value, 4) AS value FROM ({_sql_sample('v_grid', ['time', 'variable'], ['value'])})""",
                                    "v_grid"))
def q_sample_line(spark, sf_dir):
    """JN-12: bilinear sampling of the grid along a line (NULL-aware weights)."""
    s = regrid.sample_points(S.v_grid(spark, sf_dir), _line_neighbours(spark), ["point_id"], ["time", "variable"],
                             ["value"])
    return s.select("point_id", "time", "variable", round_scaled("value", 4).alias("value"))


SQL_CELL_XY = "CAST(cell // 6 AS INT) AS lat_idx, CAST(cell % 6 AS INT) AS lon_idx"


@register("xsec_pressure", with_views(f"""WITH {PRES},
{_sql_line_neighbours()},
fx AS (SELECT time, k, t, p, {SQL_CELL_XY} FROM pf),
s AS ({_sql_sample('fx', ['time', 'k'], ['t', 'p'])}),
x AS ({_sql_interp('s', ['point_id', 'time'], 'p', ['t'], P_TARGETS, True)})
SELECT point_id, time, target, round(t, 4) AS t FROM x""", "v_levels", "v_surface"))
def q_xsec_pressure(spark, sf_dir):
    """MET-14: temperature along a line, interpolated in log pressure to fixed levels (top 50 hPa)."""
    f = _cell_xy(levels_with_pressure(spark, sf_dir)).select("time", "k", "t", "p", "lat_idx", "lon_idx")
    s = regrid.sample_points(f, _line_neighbours(spark), ["point_id"], ["time", "k"], ["t", "p"])
    x = vertical.interpolate_to_targets(s, ["point_id", "time"], "p", P_TARGETS, ["t"], log=True)
    return x.select("point_id", "time", "target", F.round("t", 4).alias("t"))


@register("ml_to_pl", with_views(f"""WITH {PRES},
x AS ({_sql_interp('pf', ['time', 'cell'], 'p', ['t', 'q'], P_TARGETS, True)})
SELECT time, cell, target, round(t, 4) AS t, round(q, 8) AS q FROM x""", "v_levels", "v_surface"))
def q_ml_to_pl(spark, sf_dir):
    """MET-18: model levels -> fixed pressure levels for every column (log-p interpolation)."""
    p = levels_with_pressure(spark, sf_dir)
    x = vertical.interpolate_to_targets(p, ["time", "cell"], "p", P_TARGETS, ["t", "q"], log=True)
    return x.select("time", "cell", "target", F.round("t", 4).alias("t"), F.round("q", 8).alias("q"))


BINS = [float(b) for b in fixed.HODOGRAPH_BINS]


@register("hodograph_bins", with_views(f"""WITH {PRES},
h AS (SELECT time, cell, k, p / {d(100.0)} AS ph, u, v,
             lead(struct_pack(k := k, u := u, v := v, p := p / {d(100.0)})) OVER (PARTITION BY time, cell ORDER BY k) AS nx
      FROM pf),
ib AS (SELECT *, unnest(list_filter({sql_list(list(range(len(BINS) - 1)))},
                  lambda i: ph <= {sql_list(BINS[:-1])}[i + 1] AND ph >= {sql_list(BINS[1:])}[i + 1])) AS bin
       FROM h WHERE ph IS NOT NULL AND u IS NOT NULL AND v IS NOT NULL AND ph >= {d(BINS[-1])}),
ibm AS (SELECT *, max(k) OVER (PARTITION BY time, cell, bin) AS kmax FROM ib),
pts AS (SELECT time, cell, bin, k, u, v, ph AS p, FALSE AS is_edge FROM ibm
        UNION ALL SELECT time, cell, bin, nx.k, nx.u, nx.v, nx.p, TRUE FROM ibm WHERE k = kmax AND nx IS NOT NULL)
SELECT time, cell, {sql_list(BINS[:-1])}[bin + 1] AS bin_bottom, {sql_list(BINS[1:])}[bin + 1] AS bin_top,
       k, u, v, round(p, 6) AS p, is_edge FROM pts""", "v_levels", "v_surface"))
def q_hodograph_bins(spark, sf_dir):
    """MET-15 / WN-3: wind points per pressure bin with the connecting edge point, every column."""
    p = levels_with_pressure(spark, sf_dir).withColumn("p_hpa", F.col("p") / F.lit(100.0))
    h = vertical.hodograph_bins(p, ["time", "cell"], "k", "p_hpa", "u", "v", BINS)
    return h.withColumn("p", F.round("p", 6))


COS_T, SIN_T = math.cos(THETA), math.sin(THETA)


@register("xsec_height", with_views(f"""WITH {GEO},
{_sql_line_neighbours()},
fx AS (SELECT time, k, t - {d(273.15)} AS t, u * {d(COS_T)} + v * {d(SIN_T)} AS wind_par,
              -w * {d(fixed.R_DRY)} * t / (p * {d(fixed.G0)}) * {d(100.0)} AS w_scaled,
              z / {d(fixed.G_HEIGHT)} AS h, {SQL_CELL_XY} FROM gz),
s AS ({_sql_sample('fx', ['time', 'k'], ['t', 'wind_par', 'w_scaled', 'h'])}),
x AS ({_sql_interp('s', ['point_id', 'time'], 'h', ['t', 'wind_par', 'w_scaled'], H_TARGETS, False, ('t',))})
SELECT point_id, time, target, round(t, 4) AS t, round(wind_par, 4) AS wind_par, round(w_scaled, 6) AS w_scaled FROM x""",
                                   "v_levels", "v_surface"))
def q_xsec_height(spark, sf_dir):
    """MET-16: section in height above sea level: T (constant extrapolation), along-line wind, scaled w."""
    g = _cell_xy(levels_with_geopotential(spark, sf_dir))
    f = g.select("time", "k", "lat_idx", "lon_idx", (F.col("t") - F.lit(273.15)).alias("t"),
                 (F.col("u") * F.lit(COS_T) + F.col("v") * F.lit(SIN_T)).alias("wind_par"),
                 (met.w_from_omega("w", "t", "p") * F.lit(100.0)).alias("w_scaled"),
                 met.geopotential_height("z").alias("h"))
    s = regrid.sample_points(f, _line_neighbours(spark), ["point_id"], ["time", "k"], ["t", "wind_par", "w_scaled", "h"])
    x = vertical.interpolate_to_targets(s, ["point_id", "time"], "h", H_TARGETS, ["t", "wind_par", "w_scaled"],
                                        extrapolate=("t",))
    return x.select("point_id", "time", "target", F.round("t", 4).alias("t"), F.round("wind_par", 4).alias("wind_par"),
                    F.round("w_scaled", 6).alias("w_scaled"))


@register("orography_line", with_views(f"""WITH {_sql_line_neighbours()},
fx AS (SELECT time, zs / {d(fixed.G_HEIGHT)} AS orog, {SQL_CELL_XY} FROM v_surface),
s AS ({_sql_sample('fx', ['time'], ['orog'])})
SELECT point_id, time, round(orog, 4) AS orog FROM s""", "v_levels", "v_surface"))
def q_orography_line(spark, sf_dir):
    """MET-17: surface height along the section line."""
    sf = _cell_xy(S.v_surface(S.v_levels(spark, sf_dir))).select(
        "time", "lat_idx", "lon_idx", met.geopotential_height("zs").alias("orog"))
    s = regrid.sample_points(sf, _line_neighbours(spark), ["point_id"], ["time"], ["orog"])
    return s.select("point_id", "time", F.round("orog", 4).alias("orog"))


# ------------------------------------------------------------------ spectral / regrid
def spectral_fields(spark, sf_dir):
    """Stand-in spectral fields (T6, 28 coefficients in m-major order) from the 64-float chunks."""
    x = S.v_chunks(spark, sf_dir).select("vec_id", F.col("label").alias("level"), F.col("embedding").cast("array<double>").alias("x"))
    back = F.reverse("x")
    return x.select("vec_id", "level", F.slice("x", 1, 28).alias("vo_re"), F.slice("x", 29, 28).alias("vo_im"),
                    F.slice(back, 1, 28).alias("d_re"), F.slice(back, 29, 28).alias("d_im"))


def _sql_vd2uv() -> str:
    a = fixed.EARTH_RADIUS
    t = TRUNC

    def eps(n):
        return (f"(CASE WHEN {n} > abs(mm) THEN sqrt(({n} * {n} - mm * mm) / ({d(4.0)} * {n} * {n} - {d(1.0)})) "
                f"ELSE {d(0.0)} END)")
    return f"""WITH idx AS (SELECT CAST(m AS INT) AS m, CAST(n AS INT) AS n, CAST(m * {t + 1} - (m * (m - 1)) // 2 + n - m AS INT) AS idx
             FROM range({t + 1}) r1(m), range({t + 1}) r2(n) WHERE n >= m),
co AS (SELECT e.vec_id, e.label AS level, idx.n, idx.m, CAST(e.embedding[idx.idx + 1] AS DOUBLE) AS vo_re,
              CAST(e.embedding[idx.idx + 29] AS DOUBLE) AS vo_im, CAST(e.embedding[64 - idx.idx] AS DOUBLE) AS d_re,
              CAST(e.embedding[36 - idx.idx] AS DOUBLE) AS d_im FROM embeddings e, idx),
c2 AS (SELECT *, CAST(n AS DOUBLE) AS nn, CAST(m AS DOUBLE) AS mm,
              CASE WHEN n > 0 THEN {d(-a * a)} / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) + {d(1.0)})) ELSE {d(0.0)} END AS inv FROM co),
b AS (SELECT vec_id, level, n, m, nn, mm, inv * vo_re AS psi_re, inv * vo_im AS psi_im, inv * d_re AS chi_re, inv * d_im AS chi_im FROM c2),
nb AS (SELECT *, coalesce(lag(psi_re) OVER w, {d(0.0)}) AS psi_re_dn, coalesce(lead(psi_re) OVER w, {d(0.0)}) AS psi_re_up,
              coalesce(lag(psi_im) OVER w, {d(0.0)}) AS psi_im_dn, coalesce(lead(psi_im) OVER w, {d(0.0)}) AS psi_im_up,
              coalesce(lag(chi_re) OVER w, {d(0.0)}) AS chi_re_dn, coalesce(lead(chi_re) OVER w, {d(0.0)}) AS chi_re_up,
              coalesce(lag(chi_im) OVER w, {d(0.0)}) AS chi_im_dn, coalesce(lead(chi_im) OVER w, {d(0.0)}) AS chi_im_up
       FROM b WINDOW w AS (PARTITION BY vec_id, level, m ORDER BY n)),
cc AS (SELECT *, (nn - {d(1.0)}) * {eps('nn')} AS c_dn, (nn + {d(2.0)}) * {eps(f'(nn + {d(1.0)})')} AS c_up FROM nb)
SELECT vec_id, level, n, m,
       round({d(1.0 / a)} * (-mm * chi_im + c_dn * psi_re_dn - c_up * psi_re_up), 3) AS u_re,
       round({d(1.0 / a)} * (mm * chi_re + c_dn * psi_im_dn - c_up * psi_im_up), 3) AS u_im,
       round({d(1.0 / a)} * (-mm * psi_im - c_dn * chi_re_dn + c_up * chi_re_up), 3) AS v_re,
       round({d(1.0 / a)} * (mm * psi_re - c_dn * chi_im_dn + c_up * chi_im_up), 3) AS v_im
FROM cc"""


@register("vd2uv", _sql_vd2uv())
def q_vd2uv(spark, sf_dir):
    """MET-9 / WN-4: spectral vorticity + divergence -> spectral wind (U, V)."""
    out = ["u_re", "u_im", "v_re", "v_im"]
    uv = spectral.unpack(spectral.vd2uv_fields(spectral_fields(spark, sf_dir), TRUNC), ["vec_id", "level"], out, TRUNC)
    return uv.select("vec_id", "level", "n", "m", *[F.round(c, 3).alias(c) for c in ("u_re", "u_im", "v_re", "v_im")])


SYN_LATS = [67.5, 22.5, -22.5, -67.5]
SYN_NLON = 16


def _sql_legendre(truncation: int, rings: str) -> str:
    """CTE ``leg`` (n, m, lat_idx, p): Legendre values at the ``rings`` (lat_idx, lat) by their
    closed sum over factorials (the operator uses recurrences)."""
    return f"""leg AS (
  SELECT n, m, lat_idx, sqrt(CAST((2 * n + 1) * factorial(n - m) AS DOUBLE) / CAST(factorial(n + m) AS DOUBLE))
         * pow(1.0 - mu * mu, m / 2.0) / pow(2.0, n)
         * sum((CASE WHEN i % 2 = 0 THEN 1.0 ELSE -1.0 END) * CAST(factorial(2 * n - 2 * i) AS DOUBLE)
               / CAST(factorial(i) * factorial(n - i) * factorial(n - m - 2 * i) AS DOUBLE) * pow(mu, n - m - 2 * i)) AS p
  FROM (SELECT CAST(n AS INT) AS n, CAST(m AS INT) AS m, CAST(i AS INT) AS i
        FROM range({truncation + 1}) r1(n), range({truncation + 1}) r2(m), range({truncation // 2 + 1}) r3(i)
        WHERE m <= n AND 2 * i <= n - m) nmi,
       (SELECT lat_idx, sin(radians(lat)) AS mu FROM {rings}) la
  GROUP BY n, m, lat_idx, mu)"""


def _sql_synthesis() -> str:
    """Oracle: the same field by a direct Legendre and Fourier sum."""
    lats = ", ".join(f"({j}, {d(x)})" for j, x in enumerate(SYN_LATS))
    co = _sql_vd2uv().split("c2 AS")[0].rstrip().rstrip(",")
    return f"""{co},
lats AS (SELECT * FROM (VALUES {lats}) t(lat_idx, lat)),
{_sql_legendre(TRUNC, "lats")},
fm AS (SELECT co.vec_id, co.level, leg.lat_idx, co.m, sum(co.vo_re * leg.p) AS a, sum(co.vo_im * leg.p) AS b
       FROM co JOIN leg ON co.n = leg.n AND co.m = leg.m GROUP BY 1, 2, 3, 4),
lon AS (SELECT CAST(j AS INT) AS lon_idx FROM range({SYN_NLON}) r(j))
SELECT vec_id, level, CAST(lat_idx AS INT) AS lat_idx, lon_idx,
       round(sum(CASE WHEN m = 0 THEN a ELSE 2.0 * (a * cos(2 * pi() * m * lon_idx / {SYN_NLON})
                                                     - b * sin(2 * pi() * m * lon_idx / {SYN_NLON})) END), 6) AS value
FROM fm, lon GROUP BY 1, 2, 3, 4"""


@register("spectral_synthesis", _sql_synthesis())
def q_spectral_synthesis(spark, sf_dir):
    """MET-10: spectral vorticity -> values on a 4 x 16 latitude/longitude grid."""
    g = spectral.synthesise_fields(spectral_fields(spark, sf_dir), "vo_re", "vo_im", SYN_LATS, SYN_NLON, TRUNC)
    return layout.chunk_explode(g, "values", SYN_NLON, ["vec_id", "level"]).select(
        "vec_id", "level", "lat_idx", "lon_idx", F.round("value", 6).alias("value"))


@register("regrid_linear", with_views("""
WITH c AS (SELECT time, variable, cell, arg_max(value, CASE WHEN expver = 1 THEN 2 ELSE 1 END) AS value
           FROM v_release WHERE value IS NOT NULL GROUP BY time, variable, cell),
wt AS (SELECT * FROM (
         SELECT CAST(d // 2 AS INT) AS src_cell, CAST(d AS INT) AS dst_cell, 1.0 - CAST(d % 2 AS DOUBLE) / 2.0 AS w FROM range(48) r(d)
         UNION ALL
         SELECT CAST((d // 2 + 1) % 24 AS INT) AS src_cell, CAST(d AS INT) AS dst_cell, CAST(d % 2 AS DOUBLE) / 2.0 AS w FROM range(48) r(d))
       WHERE w > 0)
SELECT c.time, c.variable, wt.dst_cell,
       round(CASE WHEN sum(wt.w) > 0 THEN sum(wt.w * c.value) / sum(wt.w) END, 6) AS value
FROM c JOIN wt ON c.cell = wt.src_cell GROUP BY 1, 2, 3""", "v_release"))
def q_regrid_linear(spark, sf_dir):
    """MET-11: sparse linear interpolation onto a twice finer grid (weights join + grouped sum)."""
    comb = release.combine_releases(S.v_release(spark, sf_dir), ["time", "variable", "cell"])
    wts = regrid.ring_weights(spark, 24, 2)
    out = regrid.apply_weights(comb.withColumnRenamed("cell", "src_cell"), wts, ["time", "variable"],
                               "src_cell", "dst_cell", ["value"])
    return out.select("time", "variable", "dst_cell", F.round("value", 6).alias("value"))


@register("assemble_hour", with_views(f"""WITH {GEO}
SELECT time, cell, k, t AS temperature, q AS specific_humidity, w AS vertical_velocity,
       u AS u_component_of_wind, v AS v_component_of_wind, round(z, 3) AS geopotential, round(p, 4) AS p,
       round({d(100.0)} * {_e('q', 'p')} / {_es('t')}, 6) AS r, round({_td('q', 'p')}, 6) AS td,
       sqrt(u * u + v * v) AS ws
FROM gz""", "v_levels", "v_surface"))
def q_assemble_hour(spark, sf_dir):
    """MET-19: the derived field set of every time step — pressure, geopotential,
    humidity, dewpoint, wind — merged and renamed to long names."""
    g = levels_with_geopotential(spark, sf_dir)
    out = g.select("time", "cell", "k", "t", "q", "w", "u", "v", F.round("z", 3).alias("z"),
                   F.round("p", 4).alias("p"),
                   F.round(met.relative_humidity("t", "q", "p"), 6).alias("r"),
                   F.round(met.dewpoint("q", "p"), 6).alias("td"),
                   met.wind_speed("u", "v").alias("ws"))
    from ..operators.fields import rename_columns
    return rename_columns(out, fixed.SHORT_TO_LONG)


GG_HALF, GG_NLAT, GG_NLON = 4, 5, 8          # N4 octahedral grid (208 cells) -> 5 x 8 regular grid


def _sql_ring(n_half: int, counts) -> str:
    """CTE ``ring`` (lat_idx, lat, n_lon, first): the Gaussian latitudes and their points."""
    import numpy as np
    x, _ = np.polynomial.legendre.leggauss(2 * n_half)
    lats, first, rows = sorted(np.degrees(np.arcsin(x)), reverse=True), 0, []
    for j, (lat, n) in enumerate(zip(lats, counts)):
        rows.append(f"({j}, {d(lat)}, {n}, {first})")
        first += n
    return f"ring AS (SELECT * FROM (VALUES {', '.join(rows)}) t(lat_idx, lat, n_lon, first))"


def _sql_gaussian_weights(n_lat: int, n_lon: int) -> str:
    """CTE ``wt`` (src_cell, dst_cell, w): bilinear between the bracketing rings and points."""
    return f"""dst AS (SELECT CAST(i AS INT) AS dst_cell, 90.0 - {d(180.0 / (n_lat - 1))} * (i // {n_lon}) AS lat,
               {d(360.0)} * (i % {n_lon}) / {n_lon} AS lon FROM range({n_lat * n_lon}) r(i)),
near AS (SELECT d.dst_cell, d.lat, d.lon, max(CASE WHEN r.lat >= d.lat THEN r.lat_idx END) AS up,
                min(CASE WHEN r.lat < d.lat THEN r.lat_idx END) AS down FROM dst d, ring r GROUP BY 1, 2, 3),
two AS (SELECT n.dst_cell, n.lon, n.up AS lat_idx, CASE WHEN b.lat IS NULL THEN 1.0 ELSE (n.lat - b.lat) / (a.lat - b.lat) END AS wy
        FROM near n JOIN ring a ON a.lat_idx = n.up LEFT JOIN ring b ON b.lat_idx = n.down
        UNION ALL
        SELECT n.dst_cell, n.lon, n.down, CASE WHEN a.lat IS NULL THEN 1.0 ELSE (a.lat - n.lat) / (a.lat - b.lat) END
        FROM near n JOIN ring b ON b.lat_idx = n.down LEFT JOIN ring a ON a.lat_idx = n.up),
px AS (SELECT t.dst_cell, t.wy, r.n_lon, r.first, t.lon / 360.0 * r.n_lon AS x FROM two t JOIN ring r USING (lat_idx)),
wt AS (SELECT * FROM (
         SELECT CAST(first + CAST(floor(x) AS INT) % n_lon AS BIGINT) AS src_cell, dst_cell, wy * (1.0 - (x - floor(x))) AS w FROM px
         UNION ALL
         SELECT CAST(first + (CAST(floor(x) AS INT) + 1) % n_lon AS BIGINT), dst_cell, wy * (x - floor(x)) FROM px) WHERE w > 0)"""


def _sql_regrid_gaussian() -> str:
    counts = [20, 24, 28, 32, 32, 28, 24, 20]
    return f"""
WITH f AS (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time, CAST(l_partkey % {sum(counts)} AS BIGINT) AS src_cell,
                  max(l_extendedprice) / 1000.0 AS value FROM lineitem GROUP BY 1, 2),
{_sql_ring(GG_HALF, counts)},
{_sql_gaussian_weights(GG_NLAT, GG_NLON)}
SELECT f.time, CAST(wt.dst_cell AS BIGINT) AS dst_cell,
       round(CASE WHEN sum(wt.w) > 0 THEN sum(wt.w * f.value) / sum(wt.w) END, 6) AS value
FROM f JOIN wt ON f.src_cell = wt.src_cell GROUP BY 1, 2"""


@register("regrid_gaussian", _sql_regrid_gaussian())
def q_regrid_gaussian(spark, sf_dir):
    """MET-11 at true geometry: a field on an octahedral reduced Gaussian grid
    regridded to a regular lat/lon grid (weights generated by Spark)."""
    from ..functions.dates import trunc_ntz
    n_src = int(regrid.reduced_gaussian_grid(GG_HALF)[1].sum())
    li = table(spark, sf_dir, "lineitem")
    f = li.groupBy(trunc_ntz("month", "l_shipdate").alias("time"),
                   (F.col("l_partkey") % n_src).cast("long").alias("src_cell")).agg(
        (F.max("l_extendedprice") / F.lit(1000.0)).alias("value"))
    w = regrid.gaussian_to_regular_weights(spark, GG_HALF, GG_NLAT, GG_NLON)
    out = regrid.apply_weights(f, w, ["time"], "src_cell", "dst_cell", ["value"])
    return out.select("time", "dst_cell", F.round("value", 6).alias("value"))


# ------------------------------------------------------------ the native-level job
NAT_HALF, NAT_COUNTS, NAT_NLAT, NAT_NLON = 2, [8, 12, 12, 8], 5, 8        # 40 cells -> 5 x 8


def native_inputs(spark, sf_dir):
    """Stand-in inputs of the native-level job: seven vectors make an hour, one a level; its
    64 numbers give the spectral fields, the 40 cells' t, q, w and (lowest level) surface."""
    e = S.v_chunks(spark, sf_dir)
    hour = F.timestamp_add("HOUR", F.floor(F.col("vec_id") / 7), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    at = e.select("vec_id", hour.alias("time"), (F.col("vec_id") % 7 + 1).cast("int").alias("k"), "embedding")
    wind = spectral_fields(spark, sf_dir).select(
        hour.alias("time"), (F.col("vec_id") % 7 + 1).cast("int").alias("k"),
        *[F.transform(c, lambda x: x * F.lit(1e-5)).alias(c) for c in ("vo_re", "vo_im", "d_re", "d_im")])
    el = lambda off: F.element_at("embedding", off.cast("int")).cast("double")
    c = F.col("cell")
    cells = at.select("time", "k", "embedding", F.explode(F.sequence(F.lit(0), F.lit(sum(NAT_COUNTS) - 1))).alias("cell"))
    levels = cells.select("time", "k", "cell", (F.lit(250.0) + F.lit(10.0) * el(c + 1)).alias("t"),
                          (F.abs(el(F.lit(64) - c)) / F.lit(100.0)).alias("q"), el(c + 20).alias("w"))
    surface = cells.where(F.col("k") == 7).select(
        "time", "cell", F.log(F.lit(100000.0) + F.lit(1000.0) * el(c + 1)).alias("lnsp"), (F.lit(100.0) * el(c + 11)).alias("zs"))
    return wind, levels, surface


def _sql_native_points() -> str:
    """CTEs ``ring``, ``pts`` (point_id, lat, lon) and ``f`` (the columns of the native grid)."""
    lat1, lon1, lat2, lon2, n = LINE
    return f"""{_sql_ring(NAT_HALF, NAT_COUNTS)},
pts AS (SELECT CAST(i AS INT) AS point_id, {d(lat1)} + {d(lat2 - lat1)} * (i / {d(n - 1)}) AS lat, {d(lon1)} + {d(lon2 - lon1)} * (i / {d(n - 1)}) AS lon
        FROM range({n}) r(i)),
f AS (SELECT TIMESTAMP '2020-01-01 00:00:00' + to_hours(CAST(vec_id // 7 AS BIGINT)) AS time, CAST(vec_id % 7 + 1 AS INT) AS k, c AS cell,
             250.0 + 10.0 * CAST(embedding[c + 1] AS DOUBLE) AS t, abs(CAST(embedding[64 - c] AS DOUBLE)) / 100.0 AS q,
             CAST(embedding[c + 20] AS DOUBLE) AS w FROM embeddings, range({sum(NAT_COUNTS)}) r(c))"""


@register("profile_gaussian", f"""
WITH {_sql_native_points()},
cell AS (SELECT ring.first + i AS cell, ring.lat AS clat, 360.0 * i / n_lon AS clon FROM ring, range({max(NAT_COUNTS)}) r(i) WHERE i < n_lon),
near AS (SELECT point_id, arg_min(cell, 2 * asin(sqrt(least(1.0, pow(sin(radians(clat - lat) / 2), 2)
                + cos(radians(clat)) * cos(radians(lat)) * pow(sin(radians(clon - lon) / 2), 2))))) AS cell FROM pts, cell GROUP BY point_id)
SELECT point_id, time, k, CAST(cell AS INT) AS cell, round(t, 6) AS t, round(q, 9) AS q, round(w, 6) AS w FROM f JOIN near USING (cell)""")
def q_profile_gaussian(spark, sf_dir):
    """MET-12 / JN-12 on a reduced Gaussian grid: the profile of the column nearest on the sphere to
    each point of a line."""
    _, levels, _ = native_inputs(spark, sf_dir)
    pts = regrid.line_points(spark, *LINE)
    near = regrid.gaussian_point_cells(pts, ["point_id"], NAT_HALF, NAT_COUNTS, nearest=True)
    return levels.join(near.drop("w"), "cell").select(
        "point_id", "time", "k", F.col("cell").cast("int").alias("cell"), F.round("t", 6).alias("t"), F.round("q", 9).alias("q"),
        F.round("w", 6).alias("w"))


@register("sample_gaussian", f"""
WITH {_sql_native_points()},
{_sql_gaussian_weights(2, 2).replace(_sql_gaussian_weights(2, 2).split("near AS")[0], "dst AS (SELECT point_id AS dst_cell, lat, lon FROM pts)," + chr(10))}
SELECT dst_cell AS point_id, time, k, round(sum(wt.w * t) / sum(wt.w), 6) AS t, round(sum(wt.w * f.w) / sum(wt.w), 6) AS w
FROM f JOIN wt ON f.cell = wt.src_cell GROUP BY 1, 2, 3""")
def q_sample_gaussian(spark, sf_dir):
    """JN-12 on a reduced Gaussian grid: fields along a line, bilinear between rings."""
    _, levels, _ = native_inputs(spark, sf_dir)
    cells = regrid.gaussian_point_cells(regrid.line_points(spark, *LINE), ["point_id"], NAT_HALF, NAT_COUNTS)
    out = regrid.sample_cells(levels.withColumnRenamed("w", "omega"), cells, ["point_id"], ["time", "k"], ["t", "omega"])
    return out.select("point_id", "time", "k", F.round("t", 6).alias("t"), F.round("omega", 6).alias("w"))


def _sql_assemble_native() -> str:
    uv = _sql_vd2uv().rsplit("SELECT vec_id, level, n, m,", 1)[0].rstrip()
    a = fixed.EARTH_RADIUS
    n_cells = sum(NAT_COUNTS)
    geo = with_views(f"WITH {GEO}").removeprefix("WITH ")
    names = fixed.SHORT_TO_LONG
    fields_sql = " UNION ALL ".join(f"SELECT time, k, cell, '{names[c]}' AS variable, {c} AS value FROM {src}"
                                    for c, src in (("t", "gz"), ("q", "gz"), ("w", "gz"), ("z", "gz"), ("u", "wind"), ("v", "wind")))
    wave = lambda c: (f"sum(CASE WHEN m = 0 THEN {c}a ELSE 2.0 * ({c}a * cos(2 * pi() * m * i / n_lon) "  # noqa: E731
                      f"- {c}b * sin(2 * pi() * m * i / n_lon)) END) / cos(radians(lat))")
    return f"""{uv},
uv AS (SELECT vec_id, n, m, {d(1e-5 / a)} * (-mm * chi_im + c_dn * psi_re_dn - c_up * psi_re_up) AS u_re,
              {d(1e-5 / a)} * (mm * chi_re + c_dn * psi_im_dn - c_up * psi_im_up) AS u_im,
              {d(1e-5 / a)} * (-mm * psi_im - c_dn * chi_re_dn + c_up * chi_re_up) AS v_re,
              {d(1e-5 / a)} * (mm * psi_re - c_dn * chi_im_dn + c_up * chi_im_up) AS v_im FROM cc),
{_sql_ring(NAT_HALF, NAT_COUNTS)},
{_sql_legendre(TRUNC, "ring")},
{_sql_gaussian_weights(NAT_NLAT, NAT_NLON)},
e0 AS (SELECT vec_id, TIMESTAMP '2020-01-01 00:00:00' + to_hours(CAST(vec_id // 7 AS BIGINT)) AS time,
              CAST(vec_id % 7 + 1 AS INT) AS k, embedding AS x FROM embeddings),
fm AS (SELECT vec_id, lat_idx, m, sum(u_re * p) AS ua, sum(u_im * p) AS ub, sum(v_re * p) AS va, sum(v_im * p) AS vb
       FROM uv JOIN leg USING (n, m) GROUP BY 1, 2, 3),
wind AS (SELECT e0.time, e0.k, ring.first + i AS cell, {wave('u')} AS u, {wave('v')} AS v
         FROM fm JOIN ring USING (lat_idx) JOIN e0 USING (vec_id), range({max(NAT_COUNTS)}) r(i)
         WHERE i < n_lon AND 2 * m < n_lon GROUP BY e0.time, e0.k, ring.first, i, n_lon, lat),
th AS (SELECT time, k, c AS cell, 250.0 + 10.0 * CAST(x[c + 1] AS DOUBLE) AS t, abs(CAST(x[64 - c] AS DOUBLE)) / 100.0 AS q,
              CAST(x[c + 20] AS DOUBLE) AS w, ln(100000.0 + 1000.0 * CAST(x[c + 1] AS DOUBLE)) AS lnsp,
              100.0 * CAST(x[c + 11] AS DOUBLE) AS zs FROM e0, range({n_cells}) r(c)),
v_levels AS (SELECT time, cell, k, t, q, w, {d(0.0)} AS x FROM th),
v_surface AS (SELECT time, cell, lnsp, zs FROM th WHERE k = 7),
{geo},
f AS ({fields_sql})
SELECT f.time, f.k, f.variable, CAST(wt.dst_cell // {NAT_NLON} AS INT) AS lat_idx, CAST(wt.dst_cell % {NAT_NLON} AS INT) AS lon_idx,
       round(sum(wt.w * f.value) / sum(CASE WHEN f.value IS NOT NULL THEN wt.w END),
             CASE WHEN f.variable = '{names["z"]}' THEN 2 ELSE 6 END) AS value
FROM f JOIN wt ON f.cell = wt.src_cell GROUP BY f.time, f.k, f.variable, wt.dst_cell"""


@register("assemble_native", _sql_assemble_native())
def q_assemble_native(spark, sf_dir):
    """MET-19 whole: spectral wind -> reduced Gaussian grid -> geopotential -> regular grid ->
    merged under long names, every hour and level of the data."""
    from . import jobs
    out = jobs.assemble_native(*native_inputs(spark, sf_dir), met.hybrid_coefficients(spark, N_LEVELS), TRUNC,
                               NAT_HALF, NAT_NLAT, NAT_NLON, counts=NAT_COUNTS)
    z = F.col("variable") == fixed.SHORT_TO_LONG["z"]
    return layout.chunk_explode(out, "values", NAT_NLON, ["time", "k", "variable"]).select(
        "time", "k", "variable", "lat_idx", "lon_idx",
        F.when(z, F.round("value", 2)).otherwise(F.round("value", 6)).alias("value"))
