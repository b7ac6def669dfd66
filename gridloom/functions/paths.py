"""Raw-file path formatting / parsing and URL helpers (SRC-1..4, STR-1..3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def file_variable(variable) -> Column:
    """Variable name as used in file names (surface geopotential alias)."""
    v = _c(variable)
    expr = v
    for store_name, file_name in fixed.VARIABLE_TO_FILE_NAME.items():
        expr = F.when(v == store_name, F.lit(file_name)).otherwise(expr)
    return expr


def ar_file_path(root, date, variable, level=None) -> Column:
    """Path of one analysis-ready raw file: a surface file when ``level`` is NULL."""
    d = _c(date).cast("date")
    ymd = F.concat_ws("/", F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd"))
    surface = F.concat_ws("/", _lit(root), F.lit("date-variable-single_level"), ymd,
                          file_variable(variable), F.lit("surface.nc"))
    if level is None:
        return surface
    lv = _c(level)
    multi = F.concat_ws("/", _lit(root), F.lit("date-variable-pressure_level"), ymd, _c(variable),
                        F.concat(lv.cast("string"), F.lit(".nc")))
    return F.when(lv.isNull(), surface).otherwise(multi)


def grouped_file_path(root, date, chunk, monthly) -> Column:
    """Path of one grouped raw file; split chunks ``a_b_c`` get ``a.grb2_b_c.grib``."""
    d = _c(date).cast("date")
    ch = _c(chunk)
    parts = F.split(ch, "_")
    is_split = ch.contains("_")
    head = F.when(is_split, parts.getItem(0)).otherwise(ch)
    tail = F.when(is_split, F.concat(F.lit("_"), parts.getItem(1), F.lit("_"), parts.getItem(2),
                                     F.lit(fixed.SPLIT_SUFFIX))).otherwise(F.lit(""))
    month_part = F.concat(F.lit("ERA5GRIB/HRES/Month/"), F.date_format(d, "yyyy"), F.lit("/"),
                          F.date_format(d, "yyyyMM"))
    day_part = F.concat(F.lit("ERA5GRIB/HRES/Daily/"), F.date_format(d, "yyyy"), F.lit("/"),
                        F.date_format(d, "yyyyMMdd"))
    prefix = F.when(_lit(monthly), month_part).otherwise(day_part)
    return F.concat(_lit(root), F.lit("/"), prefix, F.lit("_hres_"), head, F.lit(".grb2"), tail)


def parse_ar_path(url) -> Column:
    """(date, variable, level) of an analysis-ready raw path; level NULL for surface."""
    u = _c(url)
    rx = r"(\d{4})/(\d{2})/(\d{2})/([^/]+)/([^/]+)\.nc$"
    y, m, d = (F.regexp_extract(u, rx, i) for i in (1, 2, 3))
    var = F.regexp_extract(u, rx, 4)
    fname = F.regexp_extract(u, rx, 5)
    surface = fname == "surface"
    variable = var
    for store_name, file_name in fixed.VARIABLE_TO_FILE_NAME.items():
        variable = F.when(surface & (var == file_name), F.lit(store_name)).otherwise(variable)
    return F.struct(
        F.make_date(y.cast("int"), m.cast("int"), d.cast("int")).alias("date"),
        variable.alias("variable"),
        F.when(surface, F.lit(None).cast("int")).otherwise(fname.cast("int")).alias("level"),
    )


def parse_grouped_path(url) -> Column:
    """(file_date, chunk, monthly) of a grouped raw path."""
    u = _c(url)
    base = F.regexp_extract(u, r"([^/]+)$", 1)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")          # drop the last extension
    date_txt = F.regexp_extract(stem, r"^(\d+)_hres_", 1)
    chunk = F.regexp_replace(F.regexp_extract(stem, r"_hres_(.*)$", 1), r"\.grb2_", "_")
    monthly = F.length(date_txt) == 6
    d = F.when(monthly, F.to_date(F.concat(date_txt, F.lit("01")), "yyyyMMdd")) \
        .otherwise(F.to_date(date_txt, "yyyyMMdd"))
    return F.struct(d.alias("file_date"), chunk.alias("chunk"), monthly.alias("monthly"))


def normalize_url(url) -> Column:
    """host + path of a URL (scheme, query and fragment dropped)."""
    u = _c(url)
    return F.concat(F.coalesce(F.try_parse_url(u, F.lit("HOST")), F.lit("")),
                    F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit("")))


def url_scheme(url) -> Column:
    return F.try_parse_url(_c(url), F.lit("PROTOCOL"))


def slugify(s) -> Column:
    """Replace every character outside ``[a-z0-9-]`` with a hyphen."""
    return F.regexp_replace(_c(s), "[^a-z0-9-]", "-")
