"""Expected-file manifests and their reconciliation with listings.

SRC-1..5 (expected paths), JN-5 / JN-6 (missing / extra), SET-1 / SET-3,
AG-7 (any-missing flag), STM-3 (complete dates).

Manifests are products of a date axis with small dimensions (chunks,
variables x levels).  The date axis is generated with ``sequence`` +
``explode`` from a window row; the dimensions are broadcast because their
size is fixed (chunk lists, level groups) or checked (variables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.dates import date_axis
from ..functions.paths import ar_file_path, grouped_file_path
from . import dims


def variable_levels(spark: SparkSession, variables: DataFrame, group: str = "full_37") -> DataFrame:
    """(variable, level): every level of a multilevel variable, NULL level for surface ones.

    ``variables`` has (variable STRING, is_multilevel BOOLEAN); it is a parameter
    because the archive's full variable list is long.
    """
    levels = dims.level_group(spark, group).select("level")
    multi = variables.where(F.col("is_multilevel")).select("variable").crossJoin(levels)
    surface = variables.where(~F.col("is_multilevel")).select(
        "variable", F.lit(None).cast("int").alias("level"))
    return multi.unionByName(surface)


def ar_manifest(spark: SparkSession, dates: DataFrame, variables: DataFrame, root: str,
                group: str = "full_37") -> DataFrame:
    """SRC-1: expected analysis-ready raw files for each date (column ``date``)."""
    vl = variable_levels(spark, variables, group)
    return (dims.product(dates.select(F.col("date").cast("date").alias("date")), vl)
            .select("date", "variable", "level",
                    ar_file_path(F.lit(root), "date", "variable", "level").alias("path")))


def grouped_manifest(window: DataFrame, chunks: DataFrame, root: str, is_single_level: bool) -> DataFrame:
    """SRC-2 / SRC-3: expected grouped files for each window row (``start``, ``end``).

    Daily step for model-level chunks; month starts (the first on or after
    ``start``) for single-level chunks.
    """
    freq = "MS" if is_single_level else "D"
    axis = window.select(F.explode(date_axis("start", "end", freq)).alias("date"))
    return (axis.crossJoin(F.broadcast(chunks.select("chunk")))
            .select("date", "chunk",
                    grouped_file_path(F.lit(root), "date", "chunk", F.lit(is_single_level)).alias("path")))


def year_manifest(spark: SparkSession, years: DataFrame, root: str = "raw") -> DataFrame:
    """SRC-4: names the raw-archive consistency check expects per year.

    Daily: every date of the year x daily chunks.  Monthly: every month x
    (grouped chunks, split precipitation, split soil layers, soil surface).
    """
    y = years.select(F.col("year").cast("int").alias("year")).distinct()
    days = y.select("year", F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)),
                                                  F.make_date("year", F.lit(12), F.lit(31)))).alias("date"))
    daily = (days.crossJoin(dims.chunk_list(spark, fixed.CHECK_DAILY_CHUNKS, "chunk"))
             .select("year", F.concat(F.lit(f"{root}/ERA5GRIB/HRES/Daily/"), F.col("year").cast("string"),
                                      F.lit("/"), F.date_format("date", "yyyyMMdd"), F.lit("_hres_"),
                                      F.col("chunk"), F.lit(".grb2")).alias("name")))
    months = y.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    monthly_names = (
        [(c, f"{c}.grb2") for c in fixed.CHECK_MONTHLY_CHUNKS]
        + [(c, f"pcp.grb2_surface_{c}.grib") for c in fixed.CHECK_MONTHLY_PCP]
        + [(c, f"soil.grb2_depthBelowLandLayer_{c}.grib") for c in fixed.CHECK_MONTHLY_SOIL]
        + [("tsn", fixed.CHECK_SOIL_SURFACE)])
    suffixes = F.broadcast(spark.createDataFrame(monthly_names, "chunk string, suffix string"))
    monthly = (months.crossJoin(suffixes)
               .select("year", F.concat(F.lit(f"{root}/ERA5GRIB/HRES/Month/"), F.col("year").cast("string"),
                                        F.lit("/"), F.col("year").cast("string"),
                                        F.lpad(F.col("month").cast("string"), 2, "0"),
                                        F.lit("_hres_"), F.col("suffix")).alias("name")))
    return daily.unionByName(monthly)


def store_manifest(spark: SparkSession, window: DataFrame, root: str, stores=None) -> DataFrame:
    """SRC-5: expected raw files of each grouped store over the window."""
    sc = dims.store_chunks(spark)
    if stores is not None:
        sc = sc.where(F.col("store").isin(list(stores)))
    out = None
    for single in (False, True):
        ch = sc.where(F.col("is_single_level") == F.lit(single))
        m = grouped_manifest(window, ch.select("chunk"), root, single)
        m = m.join(F.broadcast(ch.select("store", "chunk")), "chunk")
        out = m if out is None else out.unionByName(m)
    return out.select("store", "date", "chunk", "path")


def raw_paths(spark: SparkSession, window: DataFrame, store: str, root: str,
              variables: DataFrame | None = None) -> DataFrame:
    """SRC-5 router: expected raw files of one store over the window — the
    per-variable files for the analysis-ready store (``"ar"``), the grouped
    chunk files (daily or monthly by store) otherwise."""
    if store == "ar":
        if variables is None:
            raise ValueError("the analysis-ready manifest needs the variable list")
        dates = window.select(F.explode(date_axis("start", "end", "D")).alias("date"))
        return ar_manifest(spark, dates, variables, root).select("path")
    if store not in fixed.STORE_CHUNKS:
        raise ValueError(f"unknown store {store!r}")
    return store_manifest(spark, window, root, [store]).select("path")


def availability_manifest(spark: SparkSession, window: DataFrame, mode: str, root: str,
                          variables: DataFrame) -> DataFrame:
    """SET-3: union of the manifests one processing mode depends on.

    daily / final: model-level chunks (daily) + analysis-ready files;
    monthly / final: single-level chunks (monthly).
    """
    parts = []
    if mode in (fixed.MODE_DAILY, fixed.MODE_FINAL):
        parts.append(grouped_manifest(window, dims.chunk_list(spark, fixed.MODEL_LEVEL_CHUNKS), root, False)
                     .select("path"))
        dates = window.select(F.explode(date_axis("start", "end", "D")).alias("date"))
        parts.append(ar_manifest(spark, dates, variables, root).select("path"))
    if mode in (fixed.MODE_MONTHLY, fixed.MODE_FINAL):
        parts.append(grouped_manifest(window, dims.chunk_list(spark, fixed.SINGLE_LEVEL_CHUNKS), root, True)
                     .select("path"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def split_parents(spark: SparkSession, promoted: DataFrame, staged_root: str, root: str) -> DataFrame:
    """SNK-13: the month files behind promoted blocks of split variables.

    Some chunks (soil, precipitation) are split, from one month file, into a file a variable;
    when such a block (``store``, ``chunk``, ``date``) is promoted, so is the month file it came from.
    Returns one row a file: store, month, staged_path, path."""
    sc = dims.store_chunks(spark).where(F.col("chunk").contains("_")).select("store", "chunk")
    parent = F.split_part("chunk", F.lit("_"), F.lit(1))
    month = F.trunc("date", "MM")
    name = lambda r: grouped_file_path(F.lit(r), month, parent, F.lit(True))
    return (promoted.join(sc, ["store", "chunk"]).select("store", month.alias("month"), name(staged_root).alias("staged_path"),
                                                         name(root).alias("path")).distinct())


def missing(expected: DataFrame, actual: DataFrame, on) -> DataFrame:
    """JN-5: expected rows with no actual counterpart (left anti join)."""
    return expected.join(actual, on, "left_anti")


def extra(actual: DataFrame, expected: DataFrame, on) -> DataFrame:
    """JN-6: rows present but not expected; every one is reported."""
    return actual.join(expected, on, "left_anti")


def missing_flag(expected: DataFrame, actual: DataFrame, on) -> DataFrame:
    """AG-7: one row — how many expected rows are missing and whether any is."""
    return (missing(expected, actual, on)
            .agg(F.count(F.lit(1)).alias("n_missing"))
            .select("n_missing", (F.col("n_missing") > 0).alias("data_is_missing")))


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-1: distinct rows of ``a`` not in ``b`` (set semantics)."""
    return a.subtract(b)


def complete_dates(expected: DataFrame, actual: DataFrame, key: str = "date") -> DataFrame:
    """STM-3: dates whose every expected file is present.

    One pass: count expected and matched files per date (semi-join flag),
    emit a date when the two counts agree.
    """
    matched = expected.join(actual.withColumn("_present", F.lit(1)), [c for c in expected.columns], "left")
    return (matched.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_expected"), F.count("_present").alias("n_present"))
            .where(F.col("n_expected") == F.col("n_present")))
