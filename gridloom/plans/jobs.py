"""Composed jobs — the user-facing API.

Each job wires operators into one Spark plan per step; all inputs are
DataFrames or store paths, so the same code runs on a laptop or a cluster.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import dates as D
from ..operators import dims, fields, layout, manifest, met, regrid, release, spectral
from ..sinks import axis, chunks
from ..sinks import store as ST
from ..sinks.journal import Journal


def build_store(raw: DataFrame, path: str, keys: Sequence[str] = ("time", "lat_idx", "lon_idx"),
                partition_by=("variable", "date"), levels: DataFrame | None = None, start: str | None = None,
                end: str | None = None, dims: Mapping[str, int] | None = None, chunking: chunks.Chunking | None = None) -> None:
    """Bulk build: normalise raw blocks, combine releases where they are marked (one row per cell),
    merge the level fields in, and write the store (refuses an existing one).

    ``levels`` (with a ``level`` column) are the multi-level fields, ``raw`` then the single-level ones
    (JN-1); level is missing for the latter.  Three layouts: rows as they are; with ``start``, ``end``
    (exclusive) and ``dims``, rows on an axis (SNK-1, SNK-4) whose other cells are missing; with
    ``chunking`` as well, arrays re-blocked into chunks (SNK-14), the first dimension, ``step``, counting hours
    from ``start``."""
    own = list(keys)
    if levels is not None:
        raw, own = raw.unionByName(levels, allowMissingColumns=True), [*own, "level"]
    if "path" in raw.columns:
        fields.assert_one_variable_per_file(raw)
    if "expver" in raw.columns:
        time_col = "time" if "time" in raw.columns else "valid_time"
        cell = [time_col if k == "time" else k for k in own]
        raw = release.combine_releases(raw.withColumn("value", fields.nan_to_null("value")), [*cell, "variable"])
        raw = raw.drop("expver_used")
    n = fields.normalize_raw(raw, check=False).select(*own, "variable", "value")
    arrays = ["variable", *(["level"] if "level" in own else [])]
    if chunking is not None:
        if start is None:
            raise ValueError("chunks count steps from a start")
        step = D.time_offset_hours(F.lit(str(start)).cast("timestamp_ntz"), "time").cast("int")
        chunks.build(n.withColumn(chunking.names[0], step), path, chunking, arrays)
        return
    rows = n.withColumn("date", F.col("time").cast("date"))
    if start is None:
        ST.write_store(rows, path, partition_by)
        return
    spark = raw.sparkSession
    axis.create_store(spark, path, start, end, n.select(*arrays).distinct(), dims or {}, n.schema["value"].dataType.simpleString())
    ST.replace_regions(spark, path, rows, [c for c in ("time", "level") if c in own], partition_by)


def _record(spark: SparkSession, attrs_path: str | None, store_name: str, time_end: str | None, mode: str,
            now: str | None) -> None:
    """SNK-10 after a write, where the job was given an attributes table."""
    if attrs_path and time_end:
        stamp = now or str(datetime.datetime.now(datetime.timezone.utc))
        ST.upsert_store_attrs_table(spark, attrs_path, store_name, time_end, mode, stamp)


def update_daily(raw_releases: DataFrame, path: str, start: str, end: str,
                 keys: Sequence[str] = ("time", "lat_idx", "lon_idx"), attrs_path: str | None = None,
                 store_name: str = "store", mode: str = fixed.MODE_DAILY, now: str | None = None,
                 levels: DataFrame | None = None) -> None:
    """Days [start, end]: combine releases (final over preliminary), overwrite the steps that
    arrived, then record the new validity end in the store's attributes.

    ``raw_releases`` are the single-level fields, ``levels`` (with a ``level`` column) the
    multi-level ones; both are merged (JN-1) into one set of rows, coordinates aligned (PRJ-3),
    level NULL for single-level fields, and written together.  A region is one step of one
    variable and level: hours of a day that did not arrive stay as they are.
    """
    raw, own = raw_releases, list(keys)
    if levels is not None:
        raw, own = raw.unionByName(levels, allowMissingColumns=True), [*own, "level"]
    coords = [c for c in ("latitude", "longitude") if c in raw.columns]
    raw = fields.align_coords(raw, [*own, *coords], [c for c in raw.columns if c not in (*own, *coords)])
    window = raw.where(F.col("time").cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    comb = release.combine_releases(window, [*own, *coords, "variable"]).drop("expver_used")
    spark = raw_releases.sparkSession
    ST.replace_regions(spark, path, comb.withColumn("date", F.col("time").cast("date")),
                       [c for c in ("time", "level") if c in own])
    _record(spark, attrs_path, store_name, end, mode, now)


def update_files(spark: SparkSession, files: DataFrame, raw: DataFrame, path: str, init: str,
                 steps_per_day: int = 24, attrs_path: str | None = None, store_name: str = "store",
                 mode: str = fixed.MODE_DAILY, now: str | None = None) -> None:
    """Grouped files -> their regions and chunk variables -> region overwrite -> validity end.

    ``raw`` is long (path, short_name, time, cell, value); only the variables
    the file's chunk holds are written, only inside the file's region.  The end recorded in
    ``attrs_path`` is the last day that a file covers.
    """
    regions = ST.file_region(files, init, steps_per_day)
    reg = regions.select("path", "chunk", "region_start", "region_end")
    rows = raw.join(reg, "path").join(dims.chunk_variables(spark), ["chunk", "short_name"])
    # the file's region counts steps of the axis, not hours
    idx = F.floor(D.time_offset_hours(F.lit(init).cast("timestamp_ntz"), "time") / (24 // steps_per_day))
    rows = rows.where((idx >= F.col("region_start")) & (idx < F.col("region_end")))
    inner = [c for c in ("level", "step") if c in raw.columns]
    out = rows.select(F.col("short_name").alias("variable"), "time", *inner, "cell", "value",
                      F.col("time").cast("date").alias("date"))
    ST.replace_regions(spark, path, out, ["time", *inner])
    if attrs_path:
        last = F.date_add(F.lit(init).cast("date"), (F.max("region_end") / steps_per_day).cast("int") - 1)
        _record(spark, attrs_path, store_name, regions.agg(last.cast("string")).first()[0], mode, now)


def reconcile_release(spark: SparkSession, current: DataFrame, staged: DataFrame, path: str,
                      block: Sequence[str] | None = None,
                      cell_keys: Sequence[str] = ("time", "lat_idx", "lon_idx"), audit_table: str | None = None,
                      staged_path: str | None = None, attrs_path: str | None = None, store_name: str = "store",
                      time_end: str | None = None, now: str | None = None, journal_path: str | None = None) -> DataFrame:
    """Compare every current block with its staged final-release copy, rewrite the
    changed blocks only, and return the audit (block, status).

    A block is a variable, date and, where the rows have one, level: a staged level
    replaces that level and no other.  Blocks are compared by digests (``release.block_audit``);
    cells move only where a block is rewritten.  Staged rows that still hold both releases
    (``expver``) are combined first, final over preliminary (JN-4).

    Promotion (SNK-13) is complete with ``audit_table`` (the audit is added to it, marked with
    the ``run``), ``staged_path`` (the staged store: its partitions now ratified, replaced or
    added are removed) and ``attrs_path`` with ``time_end`` (the store's final validity end).

    Every step is entered in a journal beside the store (``journal_path``) once it is done; every
    step may be repeated without harm.  After a failure the next call goes on with the audit
    that was planned then, so store, audit and staging end as if nothing had failed.
    """
    from ..session import scratch_path
    if block is None:
        block = ["variable", "date", *(["level"] if "level" in current.columns and "level" in staged.columns else [])]
    block = list(block)
    within = [c for c in block if c not in ("variable", "date")]
    if "expver" in staged.columns:
        staged = release.combine_releases(staged, list(dict.fromkeys([*block, *cell_keys]))).drop("expver_used")
    log = Journal(spark, journal_path or f"{path.rstrip('/')}.journal")
    if not log.done("planned"):
        log.clear()
        plan = release.block_audit(current, staged, block, cell_keys)
        plan.withColumn("run", F.lit(uuid.uuid4().hex)).write.parquet(log.at("plan"))
        log.mark("planned")
    audit = spark.read.parquet(log.at("plan"))
    if not log.done("written"):
        changed = audit.where(F.col("status").isin("data_changed", "added")).select(*block)
        rows = staged.join(changed, ST.same(staged, changed, block), "left_semi")
        ST.replace_regions(spark, path, rows.select(*current.columns), within)
        log.mark("written")
    if audit_table and not log.done("audited"):
        # its own partition: a repeated step replaces what an interrupted one left
        audit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(audit_table)
        log.mark("audited")
    if staged_path and not log.done("dropped"):
        parts = audit.where(F.col("status") != "absent").select("variable", "date").distinct()
        ST.drop_blocks(spark, staged_path, parts)
        log.mark("dropped")
    if not log.done("recorded"):
        _record(spark, attrs_path, store_name, time_end, fixed.MODE_FINAL, now)
        log.mark("recorded")
    audit_path = scratch_path(spark, "audit")
    audit.drop("run").write.parquet(audit_path)
    log.clear()
    return spark.read.parquet(audit_path)


def promote_parents(spark: SparkSession, promoted: DataFrame, staged_root: str, root: str) -> int:
    """SNK-13: replace the month files behind promoted blocks of split variables by their staged
    copies, which are then removed.  One that is not staged (any more) is left alone, so a rerun is
    harmless.  Returns the number of files replaced; there is one a month and family."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for r in manifest.split_parents(spark, promoted, staged_root, root).collect():
        source, target = hadoop.Path(r["staged_path"]), hadoop.Path(r["path"])
        files, there = source.getFileSystem(conf), target.getFileSystem(conf)
        if files.exists(source):
            # the staged copy goes only once the new file is whole
            hadoop.FileUtil.copy(files, source, there, target, False, True, conf)
            files.delete(source, False)
            n += 1
    return n


def check_availability(spark: SparkSession, today: str, mode: str, listing: DataFrame, root: str,
                       variables: DataFrame) -> DataFrame:
    """Refresh window of the mode -> expected files -> missing ones (path) with a flag."""
    w = spark.range(1).select(D.processing_window(F.lit(today), F.lit(mode)).alias("w")).select(
        F.col("w.first_day").alias("start"), F.col("w.last_day").alias("end"))
    expected = manifest.availability_manifest(spark, w, mode, root, variables)
    return manifest.missing_flag(expected, listing.select("path"), ["path"])


def check_consistency(spark: SparkSession, years: DataFrame, listing: DataFrame, root: str = "raw") -> DataFrame:
    """Names present under the year prefixes that the archive does not expect."""
    desired = manifest.year_manifest(spark, years, root).select("name")
    return manifest.extra(listing.select("name"), desired, ["name"])


def find_missing(pattern: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths of a file pattern (time x chunk) that are not present."""
    return manifest.missing(pattern.select("path"), listing.select("path"), ["path"])


def derive(spark: SparkSession, levels: DataFrame, surface: DataFrame, coef: DataFrame,
           keys: Sequence[str] = ("time", "cell")) -> DataFrame:
    """Derived model-level fields: pressure, geopotential, RH, dewpoint, wind speed."""
    p = met.full_level_pressure(levels, surface, coef, keys)
    g = met.geopotential_on_levels(p, keys)
    out = g.withColumn("r", met.relative_humidity("t", "q", "p")).withColumn("td", met.dewpoint("q", "p"))
    if "u" in levels.columns and "v" in levels.columns:
        out = out.withColumn("ws", met.wind_speed("u", "v"))
    return fields.rename_columns(out, fixed.SHORT_TO_LONG)


def assemble_native(wind: DataFrame, levels: DataFrame, surface: DataFrame, coef: DataFrame, truncation: int,
                    n_half: int, n_lat: int, n_lon: int, counts: Sequence[int] | None = None,
                    keys: Sequence[str] = ("time",), k: str = "k") -> DataFrame:
    """MET-19: the native-level fields of every time step in the data, on a regular grid.

    Spectral vorticity and divergence (``wind``: keys, k, vo_re, vo_im, d_re, d_im as arrays in
    m-major order; or as rows with n, m) -> spectral (U, V) -> values on the reduced Gaussian grid (``n_half``, ``counts``: its
    points per latitude) -> divided by cos(latitude); geopotential from the grid's columns
    (``levels``: keys, k, cell, t, q and any further field; ``surface``: keys, cell, lnsp,
    zs); all fields -> regular grid -> long names.  Returns chunk rows (keys, k,
    variable, values), north to south.  A field that lacks levels or surface keeps its
    row, with missing values; wind and levels need not cover the same steps.
    """
    row = [*keys, k]
    parts = ["vo_re", "vo_im", "d_re", "d_im"]
    if "n" in wind.columns:                  # coefficients as rows
        wind = spectral.pack(wind, row, parts, truncation)
    uv = spectral.vd2uv_fields(wind.select(*row, *parts), truncation)
    uv = uv.select(*row, F.inline(F.array(*[F.struct(F.lit(x).alias("variable"), F.col(f"{x}_re").alias("re"),
                                                     F.col(f"{x}_im").alias("im")) for x in ("u", "v")])))
    lats, per_lat, _ = regrid.reduced_gaussian_grid(n_half, counts)
    fields_uv = spectral.synthesise_fields(uv, "re", "im", lats, per_lat, truncation, 1.0 / np.cos(np.radians(lats)))
    column = [*keys, "cell"]
    z = met.geopotential_on_levels(met.full_level_pressure(levels, surface, coef, column, k), column, k)
    names = [c for c in (*levels.columns, "z") if c not in (*column, k)]
    fields_z = z.select(*row, "cell", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        [*row, "cell"], names, "variable", "value").select(*row, "variable", "cell", "value")
    # wind comes as arrays; only the column fields, computed cell by cell, are packed
    packed = layout.chunk_pack(fields_z.withColumn("_ring", F.lit(0)), [*row, "variable"], 1, int(per_lat.sum()), "_ring", "cell")
    packed = packed.select(*row, "variable", "values").unionByName(fields_uv.select(*row, "variable", "values"))
    out = regrid.gaussian_to_regular(packed, "values", n_half, n_lat, n_lon, counts=counts)
    long_name = F.coalesce(*[F.when(F.col("variable") == s, F.lit(n)) for s, n in fixed.SHORT_TO_LONG.items()],
                           F.col("variable"))
    return out.withColumn("variable", long_name)


def init_native(spark: SparkSession, path: str, start: str, end: str, dims: Mapping[str, int], n_levels: int,
                variables: Sequence[str], value_type: str = "double") -> None:
    """Native-vertical store skeleton: every hour of [start, end] (whole end day) x
    hybrid levels x cells x variables, missing.  Axis and arrays only; without ``dims`` a row of
    the store holds a whole array."""
    hy = spark.range(1, n_levels + 1).select(F.col("id").cast("int").alias("k"))
    var = spark.createDataFrame([(v,) for v in variables], "variable string")
    day_after = datetime.date.fromisoformat(str(end)) + datetime.timedelta(days=1)
    axis.create_store(spark, path, start, day_after, var.crossJoin(hy), dims, value_type)


class NativeGrid(NamedTuple):
    """Grids of the native-level job: spectral truncation, reduced Gaussian grid (latitudes per
    hemisphere and, unless octahedral, points per latitude), regular grid."""
    truncation: int
    n_half: int
    n_lat: int
    n_lon: int
    counts: Sequence[int] | None = None


def incomplete_hours(hours: DataFrame, levels: DataFrame, surface: DataFrame, n_levels: int,
                     keys: Sequence[str] = ("time", "cell"), wind: DataFrame | None = None) -> DataFrame:
    """(time, reason) of the hours asked for that cannot be derived: no input at all, a column without
    all its levels or without surface, spectral wind without all levels."""
    per_col = levels.groupBy(*keys).agg(F.count_distinct("k").alias("n")).join(
        surface.select(*keys, F.lit(True).alias("_sf")).distinct(), list(keys), "full_outer")
    found = per_col.groupBy("time").agg(F.count_if(F.col("n").isNull() | (F.col("n") != n_levels)).alias("short"),
                                        F.count_if(F.col("_sf").isNull()).alias("bare"))
    out = hours.join(found, "time", "left")
    reason = (F.when(F.col("short").isNull(), F.lit("absent")).when(F.col("short") > 0, F.lit("levels"))
              .when(F.col("bare") > 0, F.lit("surface")))
    if wind is not None:
        have = wind.groupBy("time").agg(F.count_distinct("k").alias("w"))
        out = out.join(have, "time", "left")
        reason = F.coalesce(reason, F.when(F.coalesce("w", F.lit(0)) != n_levels, F.lit("wind")))
    return out.select("time", reason.alias("reason")).where(F.col("reason").isNotNull())


def update_native(spark: SparkSession, levels: DataFrame, surface: DataFrame, coef: DataFrame, path: str,
                  start: str, end: str, n_levels: int, on_error: str = "fail",
                  keys: Sequence[str] = ("time", "cell"), wind: DataFrame | None = None, grid: NativeGrid | None = None,
                  attrs_path: str | None = None, store_name: str = "store", mode: str = fixed.MODE_DAILY,
                  now: str | None = None) -> DataFrame:
    """Derive the native-vertical fields for every hour of [start, end], overwrite those hours in
    the store, and record the new validity end.

    With ``wind`` (spectral vorticity and divergence) and ``grid`` the hours are assembled as MET-19
    does (wind, geopotential and column fields on the regular grid) and written as arrays; without, the column
    fields are derived and written cell by cell.

    An hour is incomplete when it has no input, when a column lacks a level or its surface
    fields, or when the wind lacks a level.  ``on_error="fail"`` (default) raises before anything is
    written; ``"skip"`` leaves those hours untouched.  The returned DataFrame lists them (time, reason).
    """
    from ..session import scratch_path
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    t0, t1 = (datetime.datetime.fromisoformat(str(x)) for x in (start, end))
    n_hours = ((t1 - t0).days + 1) * 24          # whole end day
    hours = spark.range(n_hours).select(F.timestamp_add("HOUR", F.col("id"), F.lit(t0)).alias("time"))
    asked = F.col("time").between(F.lit(t0), F.lit(t0 + datetime.timedelta(hours=n_hours - 1)))
    lv, sf = levels.where(asked), surface.where(asked)
    spectral_wind = None if wind is None else wind.where(asked)
    report = scratch_path(spark, "incomplete")
    incomplete_hours(hours, lv, sf, n_levels, keys, spectral_wind).write.parquet(report)
    bad = spark.read.parquet(report)             # few rows, computed once, read before the write and after
    if on_error == "fail":
        first_bad = bad.orderBy("time").limit(1).collect()
        if first_bad:
            raise ValueError(f"incomplete input for hour {first_bad[0]['time']}: {first_bad[0]['reason']}")
    good = lambda df: df.join(bad.select("time"), "time", "left_anti")
    if wind is not None:
        if grid is None:
            raise ValueError("spectral wind needs a grid")
        rows = assemble_native(good(spectral_wind), good(lv), good(sf), coef, grid.truncation, grid.n_half, grid.n_lat,
                               grid.n_lon, grid.counts, [c for c in keys if c != "cell"])
    else:
        derived = derive(spark, good(lv), sf, coef, keys)
        names = [c for c in derived.columns if c not in (*keys, "k") and c not in ("p_above", "p_below", "z_half", "lnsp", "zs")]
        rows = derived.unpivot([*keys, "k"], names, "variable", "value")
    ST.overwrite_steps(spark, path, rows.withColumn("date", F.col("time").cast("date")))
    _record(spark, attrs_path, store_name, str(t1.date()), mode, now)
    return bad
