"""Registered queries of stores in the chunk layout (SRC-14, SNK-3, SNK-5, SNK-14)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions.dates import time_offset_hours
from ..session import scratch_path
from ..sinks import chunks as C
from ..sources import standins as S
from .q_store import _events_window
from .registry import register, with_views

DIMS = ("step", "lat_idx", "lon_idx")

SQL_CELLS = """g AS (SELECT variable, CAST(date_diff('hour', (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) FROM events), time) AS INT) AS step,
             lat_idx, lon_idx, value FROM v_grid),
w AS (SELECT 24 * CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 AS INT) AS n FROM events),
cells AS (SELECT variable, CAST(step AS INT) AS step, CAST(i // 6 AS INT) AS lat_idx, CAST(i % 6 AS INT) AS lon_idx
          FROM (SELECT DISTINCT variable FROM v_grid), (SELECT unnest(range(n)) AS step FROM w), range(24) r(i))"""


def _store(spark, sf_dir, name, factor=1.0):
    """The grid on chunks of 24 steps x 2 x 4 cells (the last on each row is part-filled)."""
    path = scratch_path(spark, name)
    first, end = _events_window(spark, sf_dir)
    days = (datetime.date.fromisoformat(end) - datetime.date.fromisoformat(first)).days
    by = C.Chunking(DIMS, (24 * days, 4, 6), (24, 2, 4))
    g = S.v_grid(spark, sf_dir).select("variable", time_offset_hours(F.lit(first).cast("timestamp_ntz"), "time").cast("int").alias("step"),
                                       "lat_idx", "lon_idx", "value")
    C.build(g.withColumn("value", F.col("value") * F.lit(factor)), path, by)
    return path, by, g


@register("chunk_scan", with_views(f"""WITH {SQL_CELLS}
SELECT cells.*, g.value FROM cells LEFT JOIN g USING (variable, step, lat_idx, lon_idx)
WHERE variable IN ('click', 'view') AND step BETWEEN 30 AND 99 AND lat_idx = 1 AND lon_idx BETWEEN 1 AND 4
  AND (variable, step // 24, lon_idx // 4) IN (SELECT (variable, step // 24, lon_idx // 4) FROM g WHERE lat_idx < 2)""", "v_grid"))
def q_chunk_scan(spark, sf_dir):
    """SRC-14 / SNK-3 on chunks: a slice of steps and a box of cells, read from the chunks that hold them."""
    path, by, _ = _store(spark, sf_dir, "chunk-scan")
    box = {"step": (30, 100), "lat_idx": (1, 2), "lon_idx": (1, 5)}
    return C.to_cells(C.read(spark, path, by, box, F.col("variable").isin("click", "view")), ["variable"], by, box)


@register("chunk_region_write", with_views(f"""WITH {SQL_CELLS},
x AS (SELECT cells.*, g.value, step >= 30 AND step < n - 10 AND lat_idx >= 1 AND lon_idx BETWEEN 1 AND 4 AND variable IN ('click', 'view') AS new,
             (step * 7 + lon_idx) % 5 = 0 AS hole
      FROM cells LEFT JOIN g USING (variable, step, lat_idx, lon_idx), w)
SELECT variable, step, lat_idx, lon_idx, CASE WHEN NOT new THEN value * 0.0 WHEN NOT hole THEN value END AS value FROM x""",
                                          "v_grid"))
def q_chunk_region_write(spark, sf_dir):
    """SNK-5 on chunks: a region that begins and ends inside a day and cuts chunks on each side gets
    new cells (some missing) for two variables; all other cells stay."""
    path, by, g = _store(spark, sf_dir, "chunk-write", 0.0)
    box = {"step": (30, by.sizes[0] - 10), "lat_idx": (1, 4), "lon_idx": (1, 5)}
    new = g.where(F.col("variable").isin("click", "view"))
    for name, (lo, hi) in box.items():
        new = new.where(F.col(name).between(lo, hi - 1))
    C.write_region(spark, path, by, new.where((F.col("step") * 7 + F.col("lon_idx")) % 5 != 0), box)
    return _filled(spark, sf_dir, path, by)


def _filled(spark, sf_dir, path, by):
    """Every cell of the store; a chunk without a row is missing."""
    every = S.v_grid(spark, sf_dir).select("variable").distinct()
    for n, size in zip(by.names, by.sizes):
        every = every.withColumn(n, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    return every.join(C.to_cells(C.read(spark, path, by), ["variable"], by), ["variable", *by.names], "left")


@register("chunk_rechunk", with_views(f"""WITH {SQL_CELLS},
k AS (SELECT DISTINCT variable, step // 24 AS day, lat_idx // 2 AS cy, lon_idx // 4 AS cx FROM g)
SELECT steps, variable, CAST(step // steps AS INT) AS c_step, CAST(lat_idx // 2 AS INT) AS c_lat_idx, CAST(lon_idx // 4 AS INT) AS c_lon_idx,
       count(value) AS n, max(value) AS top, CAST(steps * 8 AS INT) AS cells
FROM cells LEFT JOIN g USING (variable, step, lat_idx, lon_idx), (VALUES (6), (72)) t(steps)
WHERE (variable, step // 24, lat_idx // 2, lon_idx // 4) IN (SELECT (variable, day, cy, cx) FROM k)
GROUP BY 1, 2, 3, 4, 5""", "v_grid"))
def q_chunk_rechunk(spark, sf_dir):
    """SNK-14 on chunks: chunks of a day become chunks of 6 hours (slices) and of three days (joined slices)."""
    path, by, _ = _store(spark, sf_dir, "chunk-rechunk")
    out = None
    for steps in (6, 72):
        rows, to = C.rechunk_first(C.read(spark, path, by), ["variable"], by, steps)
        has = F.filter("values", lambda v: v.isNotNull())
        part = rows.select(F.lit(steps).alias("steps"), "variable", *to.indices, F.size(has).cast("long").alias("n"),
                           F.array_max("values").alias("top"), F.size("values").alias("cells"))
        out = part if out is None else out.unionByName(part)
    return out
