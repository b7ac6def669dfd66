"""Query registry: Spark query functions and their DuckDB oracle SQL.

``register(name, sql)`` records a function ``(spark, sf_dir) -> DataFrame``;
``sql`` is the equivalent DuckDB text over the driver tables, or ``None``
for operators with no SQL form (the driver then checks rows only).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------ SQL fragments
def sql_list(values) -> str:
    items = []
    for v in values:
        if isinstance(v, str):
            items.append(f"'{v}'")
        elif isinstance(v, float):
            items.append(f"CAST('{v!r}' AS DOUBLE)")   # DOUBLE, not DECIMAL
        else:
            items.append(str(v))
    return "[" + ", ".join(items) + "]"


V_GRID = """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, event_type AS variable,
       CAST(floor((user_id % 24) / 6) AS INT) AS lat_idx, CAST(user_id % 6 AS INT) AS lon_idx,
       CAST(90 - 60 * floor((user_id % 24) / 6) AS FLOAT) AS latitude,
       CAST(60 * (user_id % 6) AS FLOAT) AS longitude, max(value) AS value
FROM events GROUP BY 1,2,3,4,5,6"""

V_RELEASE = """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, event_type AS variable,
       CAST(user_id % 24 AS INT) AS cell, CASE WHEN event_id % 3 = 0 THEN 5 ELSE 1 END AS expver,
       max(value) AS value
FROM events GROUP BY 1,2,3,4"""

V_LEVELS = """SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time, CAST(l_suppkey % 24 AS INT) AS cell,
       CAST(l_linenumber AS INT) AS k, CAST(230 + max(l_quantity) AS DOUBLE) AS t,
       CAST(max(l_discount) / 10 AS DOUBLE) AS q, CAST(max(l_tax) AS DOUBLE) AS w,
       CAST(min(l_extendedprice) AS DOUBLE) AS x
FROM lineitem GROUP BY 1,2,3"""

V_EXPECTED = """SELECT d.o_orderdate AS date, p.o_orderpriority AS chunk
FROM (SELECT DISTINCT o_orderdate FROM orders) d CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p"""

V_ACTUAL = """SELECT DISTINCT o_orderdate AS date, o_orderpriority AS chunk FROM orders WHERE o_orderstatus <> 'F'"""

V_SURFACE = """SELECT time, cell, ln(98000.0 + x * 0.04) AS lnsp, w * 10000.0 AS zs FROM v_levels WHERE k = 7"""


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the named stand-in views as CTEs."""
    defs = {"v_grid": V_GRID, "v_release": V_RELEASE, "v_levels": V_LEVELS,
            "v_expected": V_EXPECTED, "v_actual": V_ACTUAL, "v_surface": V_SURFACE}
    needed = list(views)
    if not needed:
        return body.strip()
    if "v_surface" in needed and "v_levels" not in needed:
        needed.insert(needed.index("v_surface"), "v_levels")
    ctes = ",\n".join(f"{v} AS ({defs[v]})" for v in needed)
    body = body.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(head):
            return f"{head}{ctes},\n{body[len(head):]}"
    return f"WITH {ctes}\n{body}"


def sql_grouped_path(root: str, date: str, chunk: str, monthly: bool) -> str:
    if monthly:
        prefix = f"'{root}/ERA5GRIB/HRES/Month/' || strftime({date}, '%Y') || '/' || strftime({date}, '%Y%m')"
    else:
        prefix = f"'{root}/ERA5GRIB/HRES/Daily/' || strftime({date}, '%Y') || '/' || strftime({date}, '%Y%m%d')"
    tail = (f"CASE WHEN contains({chunk}, '_') THEN split_part({chunk}, '_', 1) || '.grb2_' || "
            f"split_part({chunk}, '_', 2) || '_' || split_part({chunk}, '_', 3) || '.grib' "
            f"ELSE {chunk} || '.grb2' END")
    return f"{prefix} || '_hres_' || {tail}"


def sql_ar_path(root: str, date: str, variable: str, level: str) -> str:
    ymd = f"strftime({date}, '%Y/%m/%d')"
    fv = f"CASE WHEN {variable} = 'geopotential_at_surface' THEN 'geopotential' ELSE {variable} END"
    return (f"CASE WHEN {level} IS NULL THEN '{root}/date-variable-single_level/' || {ymd} || '/' || {fv} "
            f"|| '/surface.nc' ELSE '{root}/date-variable-pressure_level/' || {ymd} || '/' || {variable} "
            f"|| '/' || CAST({level} AS VARCHAR) || '.nc' END")
