"""Projections and predicates on fields (PRJ-1 .. PRJ-17, SRC-7, SRC-12, JSN-1).

Predicates are written on plain columns (ranges, IN lists) so that they reach
the Parquet scan as pushed filters or partition pruning.  Hour labels are
rewritten as half-open ranges for the same reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def select_vars(df: DataFrame, variables: Sequence[str], column: str = "variable") -> DataFrame:
    """PRJ-1: rows of the given variables (partition pruning on a long store)."""
    return df.where(F.col(column).isin(list(variables)))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-2 (wide): rename the columns that appear in ``mapping``."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def rename_values(col, mapping: Mapping[str, str]) -> Column:
    """PRJ-2 (long): map a name column through ``mapping``; unknown names kept."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(col)), _c(col))


def align_coords(df: DataFrame, keys: Sequence[str], variables: Sequence[str],
                 float_coords: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """PRJ-3: keep index keys and variables only; lat/lon as FLOAT so equal
    coordinates compare equal across sources."""
    cols = []
    for k in keys:
        cols.append(F.col(k).cast("float").alias(k) if k in float_coords else F.col(k))
    return df.select(*cols, *[F.col(v) for v in variables])


def attr_fix(attrs, removed: Sequence[str] = fixed.REMOVED_ATTRS) -> Column:
    """PRJ-4: drop the decoder's bookkeeping keys from an attribute map."""
    rm = list(removed)
    return F.map_filter(_c(attrs), lambda k, v: ~k.isin(rm))


def time_slice(df: DataFrame, start, stop, column: str = "time") -> DataFrame:
    """PRJ-5: label slice, both ends inclusive."""
    t = F.col(column)
    return df.where((t >= _lit_ts(start)) & (t <= _lit_ts(stop)))


def _lit_ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp_ntz")


def time_label(df: DataFrame, label: str, column: str = "time") -> DataFrame:
    """PRJ-6: partial label -> every step inside it.

    ``'2017'``, ``'2017-10'``, ``'2017-10-09'`` and ``'2017-10-09T06'`` select a
    year, month, day or hour.  The label becomes a half-open range
    ``[start, start + 1 unit)`` on the raw column, so the predicate reaches
    the Parquet scan (pushed filter / row-group pruning) instead of a
    ``date_trunc`` that would not prune.
    """
    text = label.replace("T", " ")
    unit = {4: "YEAR", 7: "MONTH", 10: "DAY", 13: "HOUR"}.get(len(text))
    if unit is None:
        raise ValueError(f"unsupported partial label {label!r}")
    full = {4: "-01-01 00:00:00", 7: "-01 00:00:00", 10: " 00:00:00", 13: ":00:00"}[len(text)]
    start = F.lit(text + full).cast("timestamp_ntz")
    end = F.timestamp_add(unit, F.lit(1), start)
    t = F.col(column)
    return df.where((t >= start) & (t < end))


def level_subset(df: DataFrame, group: str = "weatherbench_13", column: str = "level") -> DataFrame:
    """PRJ-7: rows on the levels of a pressure-level group."""
    return df.where(F.col(column).isin(list(fixed.PRESSURE_LEVEL_GROUPS[group])))


def level_index(level, group: str = "full_37") -> Column:
    """PRJ-15: 0-based position of a level in a group, NULL when absent."""
    arr = F.array(*[F.lit(x) for x in fixed.PRESSURE_LEVEL_GROUPS[group]])
    pos = F.array_position(arr, _c(level))
    return F.when(pos > 0, (pos - 1).cast("int"))


def area_subset(df: DataFrame, north: float, west: float, south: float, east: float,
                lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """PRJ-9: [lat1, lon1, lat2, lon2] box, edges included; one whose west is greater than its
    east crosses the meridian where longitudes begin."""
    across = (F.col(lon) >= west) | (F.col(lon) <= east) if west > east else F.col(lon).between(west, east)
    return df.where(F.col(lat).between(min(north, south), max(north, south)) & across)


def thin(df: DataFrame, every: int, lat: str = "lat_idx", lon: str = "lon_idx") -> DataFrame:
    """PRJ-10: every n-th latitude and longitude."""
    return df.where((F.col(lat) % every == 0) & (F.col(lon) % every == 0))


def wrap_longitude(lon) -> Column:
    """PRJ-11: 0..360 -> -180..180."""
    return F.pmod(_c(lon) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def scale_bias(x, scale: float, bias: float = 0.0) -> Column:
    return _c(x) * F.lit(scale) + F.lit(bias)


def kelvin_to_celsius(x) -> Column:
    return _c(x) - F.lit(273.15)


def pa_to_hpa(x) -> Column:
    return _c(x) / F.lit(100.0)


def geopotential_to_dam(z) -> Column:
    return _c(z) / F.lit(100.0 * fixed.G_HEIGHT)


def expand_dim(df: DataFrame, name: str, value, dtype: str = "int") -> DataFrame:
    """PRJ-13: add a constant dimension (level, time)."""
    return df.withColumn(name, F.lit(value).cast(dtype))


def with_dims(col: str, dims: Sequence[str]) -> Column:
    """Attach the dimension names of a variable as column metadata."""
    return F.col(col).alias(col, metadata={"dims": list(dims)})


def column_dims(df: DataFrame) -> dict[str, list[str]]:
    return {f.name: list(f.metadata.get("dims", [])) for f in df.schema.fields}


def drop_dims(df: DataFrame, dim: str) -> DataFrame:
    """PRJ-14: drop every variable whose dimensions include ``dim`` (and ``dim`` itself)."""
    dims = column_dims(df)
    gone = [c for c, ds in dims.items() if dim in ds or c == dim]
    return df.drop(*gone)


def drop_dim_of_tables(tables: Sequence[tuple[DataFrame, Sequence[str]]], dim: str) -> DataFrame:
    """PRJ-14 on tables not merged yet, each with the dimensions of its rows: what is left of their
    merge once every variable with ``dim`` is dropped.

    A table with ``dim`` gives only its other coordinates (distinct, partial sums before the
    exchange); its variables are never joined.  Tables without it are merged on the dimensions they share."""
    out: DataFrame | None = None
    have: list[str] = []
    for df, dims in tables:
        rest = [x for x in dims if x != dim]
        part = df.select(*rest).distinct() if dim in dims else df
        on = [x for x in rest if x in have]
        out, have = (part if out is None else out.join(part, on, "full_outer")), list(dict.fromkeys([*have, *rest]))
    return out


def data_vars(schema: DataFrame) -> DataFrame:
    """PRJ-16 / AG-9: array names that are not dimension names, and whether they
    have a time axis.  ``schema`` is (name, dims)."""
    dim_names = schema.select(F.explode("dims").alias("name")).distinct()
    return (schema.join(dim_names, "name", "left_anti")
            .select("name", F.array_contains("dims", "time").alias("has_time")))


def normalize_raw(df: DataFrame, time_col: str = "valid_time", variable: str = "variable",
                  file_col: str = "path", check: bool = True) -> DataFrame:
    """SRC-7: normalising scan of raw blocks.

    Drops the length-1 bookkeeping dimensions, renames the time axis and turns
    NaN into NULL (missing).  With ``check`` the job fails if a file holds
    more than one variable; the check is a map-side-combined distinct count
    per file whose first offending row (if any) is fetched — nothing of the
    data itself goes to the driver.
    """
    if check:
        assert_one_variable_per_file(df, file_col, variable)
    out = df.drop(*[c for c in fixed.DROPPED_RAW_DIMS if c in df.columns])
    if time_col in out.columns:
        out = out.withColumnRenamed(time_col, "time")
    if "value" in out.columns:
        out = out.withColumn("value", nan_to_null("value"))
    return out


def assert_one_variable_per_file(df: DataFrame, file_col: str = "path", variable: str = "variable") -> None:
    """AG-8: raise if any file holds more than one variable."""
    bad = (df.select(file_col, variable).distinct().groupBy(file_col).count()
           .where(F.col("count") > 1).limit(1).collect())
    if bad:
        raise ValueError(f"more than one variable in {bad[0][0]}")


def nan_to_null(x) -> Column:
    """D1: NaN is missing; inside the engine missing is NULL."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def attribute_maps(samples: DataFrame, variable: str, doc: str, order) -> DataFrame:
    """SRC-12: (variable, attrs), the attributes of each variable's first sample by ``order``
    (a JSON document of scalars), with ``short_name`` set to the variable."""
    first = samples.groupBy(variable).agg(F.min_by(F.col(doc), order).alias("_doc"))
    held = F.coalesce(F.from_json("_doc", "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    kept = F.map_filter(held, lambda k, v: k != "short_name")
    return first.select(variable, F.map_concat(kept, F.create_map(F.lit("short_name"), F.col(variable))).alias("attrs"))


def long_named(attrs: DataFrame, variable: str, names: Mapping[str, str] = fixed.SHORT_TO_LONG) -> DataFrame:
    """SRC-12, native-vertical form: the map of each variable under its long name; the short one
    stays in ``short_name``.  A variable without a long name keeps its own."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return attrs.withColumn(variable, F.coalesce(F.try_element_at(known, F.col(variable)), F.col(variable)))


def json_field(doc, path: str) -> Column:
    """JSN-1 read: one field of a JSON document."""
    return F.get_json_object(_c(doc), path)


def json_set_fields(doc, updates: Mapping[str, Column]) -> Column:
    """JSN-1 edit: set top-level keys; every value keeps its JSON type and nesting."""
    m = F.from_json(_c(doc), "map<string,variant>")
    kept = F.map_filter(m, lambda k, v: ~k.isin(list(updates)))
    whole = F.create_map(*[x for k, v in updates.items() for x in (F.lit(k), F.parse_json(F.to_json(F.struct(v.alias("v")))))])
    new = F.transform_values(whole, lambda k, v: F.variant_get(v, "$.v", "variant"))
    return F.to_json(F.map_concat(kept, new))
