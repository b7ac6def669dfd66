"""Layout conversions: long <-> wide <-> chunk (PRJ-12, ARR-1, ARR-2, SO-1, SET-2).

* long  — one row per (keys, variable) with ``value``
* wide  — one column per variable
* chunk — one row per (keys, variable) holding an ARRAY of the grid, row-major

Pivot takes an explicit variable list when the caller knows it (no extra
job to discover the distinct values).  Packing a chunk collects at most one
chunk's cells into one row: the group size is bounded by the chunk shape,
never by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_wide(df: DataFrame, keys: Sequence[str], variable: str = "variable", value: str = "value",
               variables: Sequence[str] | None = None) -> DataFrame:
    """long -> wide: one column per variable (missing cells are NULL).

    With a known variable list this is one conditional aggregation (partial
    aggregation map-side, a single shuffle on ``keys``); Spark's ``pivot``
    would plan two aggregations.  Without the list, ``pivot`` discovers the
    values first.
    """
    if variables is None:
        return df.groupBy(*keys).pivot(variable).agg(F.max(value))
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(variable) == F.lit(v), F.col(value))).alias(v)
                                   for v in variables])


def unpivot_long(df: DataFrame, keys: Sequence[str], variables: Sequence[str],
                 variable: str = "variable", value: str = "value", drop_missing: bool = True) -> DataFrame:
    """wide -> long; by default missing values are not materialised."""
    out = df.unpivot(list(keys), list(variables), variable, value)
    return out.where(F.col(value).isNotNull()) if drop_missing else out


def chunk_explode(df: DataFrame, array_col: str, n_lon: int, keep: Sequence[str]) -> DataFrame:
    """chunk -> long: position, row-major (lat_idx, lon_idx) and value."""
    return df.select(*keep, F.posexplode(array_col).alias("pos", "value")).select(
        *keep, "pos", (F.col("pos") / n_lon).cast("int").alias("lat_idx"),
        (F.col("pos") % n_lon).cast("int").alias("lon_idx"), "value")


def dense_entries(entries: str, n: int, nothing: Column, what: str = "chunk") -> Column:
    """The (k, v) entries of positions 0..n-1, in order, from an array that has some of them;
    ``nothing`` where there is none.  n log n steps.  Two entries for a position, or one outside,
    raise."""
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.lit(n - 1)), F.transform(entries, lambda e: e["k"])),
                       lambda k: F.struct(k.alias("k"), nothing.alias("v")))
    whole = F.sort_array(F.concat(entries, rest))
    return F.when(F.size(whole) == n, whole).otherwise(
        F.raise_error(F.lit(f"a {what} of {n} cells holds a cell twice or one outside it")))


def chunk_pack(df: DataFrame, keys: Sequence[str], n_lat: int, n_lon: int,
               lat: str = "lat_idx", lon: str = "lon_idx", value: str = "value") -> DataFrame:
    """long -> chunk: a dense row-major array per key; cells without a value are NULL.

    Cells are collected as (pos, value) entries of one chunk, the positions without one are
    added as missing, and the entries sorted by position: n log n steps for a chunk of n
    cells.  Two values for one cell, or a cell outside the grid, raise.
    """
    pos = (F.col(lat) * n_lon + F.col(lon)).cast("int")
    packed = df.groupBy(*keys).agg(F.collect_list(F.struct(pos.alias("k"), F.col(value).alias("v"))).alias("_e"))
    nothing = F.lit(None).cast(df.schema[value].dataType)
    cells = packed.select(*keys, dense_entries("_e", n_lat * n_lon, nothing).alias("_e"))
    return cells.select(*keys, F.transform("_e", lambda e: e["v"]).alias("values"))


def array_region_get(arr, offset, length) -> Column:
    """ARR-1 get: ``arr[offset : offset + length]`` (0-based offset)."""
    a = arr if isinstance(arr, Column) else F.col(arr)
    off = offset if isinstance(offset, Column) else F.lit(offset)
    ln = length if isinstance(length, Column) else F.lit(length)
    return F.slice(a, off + 1, ln)


def array_region_set(arr, offset, new) -> Column:
    """ARR-1 set: replace ``arr[offset : offset + len(new)]`` with ``new``."""
    a = arr if isinstance(arr, Column) else F.col(arr)
    off = offset if isinstance(offset, Column) else F.lit(offset)
    nw = new if isinstance(new, Column) else F.col(new)
    head = F.slice(a, F.lit(1), F.greatest(off, F.lit(0)))
    tail_start = off + F.size(nw) + 1
    tail = F.slice(a, tail_start, F.greatest(F.size(a) - tail_start + 1, F.lit(0)))
    return F.concat(head, nw, tail)


def stack_levels(df: DataFrame, keys: Sequence[str], level: str, values: Sequence[str]) -> DataFrame:
    """SO-1: per key, the level axis and each variable as arrays ordered by level.

    Rows carry no order in Spark, so order comes from sorting (level, value)
    structs inside each (bounded) column.
    """
    s = F.array_sort(F.collect_list(F.struct(F.col(level).alias("_lv"), *[F.col(v) for v in values])))
    g = df.groupBy(*keys).agg(s.alias("_s"))
    def field(name):
        return lambda x: x[name]
    return g.select(*keys, F.transform("_s", field("_lv")).alias(f"{level}s"),
                    *[F.transform("_s", field(v)).alias(v) for v in values])


def union_fields(*dfs: DataFrame) -> DataFrame:
    """SET-2: append field sets; columns missing in one side are NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
