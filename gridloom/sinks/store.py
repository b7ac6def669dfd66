"""Stores on Parquet: regions, templates, region writes, axis extension, metadata.

Layout (long): ``(variable, date, time, [level], lat_idx, lon_idx, value)``
written with ``partitionBy("variable", "date")``.  Every archive write
replaces one variable over one period, which is exactly a dynamic partition
overwrite: idempotent, and disjoint regions can be written in parallel
without locks.  At full scale the partition key is (variable, month) and
``time`` is pruned through row-group statistics.
"""

from __future__ import annotations

import functools
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import dates as D
from ..functions.paths import parse_ar_path, parse_grouped_path
from ..operators import dims
from ..operators.fields import json_set_fields


# ------------------------------------------------------------------ regions
def file_region(files: DataFrame, init: str, steps_per_day: int = 24) -> DataFrame:
    """DT-4: region (start, end) of the time axis that each grouped file covers.

    Daily files cover one day; month files cover every day of their month.
    """
    p = files.withColumn("_p", parse_grouped_path("path"))
    start = F.datediff(F.col("_p.file_date"), F.lit(init).cast("date")) * F.lit(steps_per_day)
    days = F.when(F.col("_p.monthly"), F.dayofmonth(F.last_day("_p.file_date"))).otherwise(F.lit(1))
    return p.select("*", F.col("_p.chunk").alias("chunk"), F.col("_p.file_date").alias("file_date"),
                    start.alias("region_start"),
                    (start + F.lit(steps_per_day) * days).alias("region_end")).drop("_p")


def ar_path_region(spark: SparkSession, paths: DataFrame, init: str) -> DataFrame:
    """SNK-8 / STR-1: (time slice, level slice) a raw analysis-ready file overwrites."""
    p = paths.withColumn("_p", parse_ar_path("path"))
    start = D.day_offset_hours(F.lit(init), F.col("_p.date"))
    out = p.select("path", F.col("_p.date").alias("date"), F.col("_p.variable").alias("variable"),
                   F.col("_p.level").alias("level"), start.alias("region_start"),
                   (start + F.lit(24)).alias("region_end"))
    return out.join(dims.level_group(spark, "full_37"), "level", "left") \
        .select("path", "date", "variable", "level", "region_start", "region_end", "level_index")


# ------------------------------------------------------------------ templates
def hourly_template(spark: SparkSession, start: str, end: str, keys: DataFrame,
                    end_inclusive: bool = False, dtype: str = "float") -> DataFrame:
    """SNK-1: every hour of [start, end) (or through ``end`` inclusive) x every
    row of ``keys`` (variables, levels, cells), value NULL.

    Time is a distributed ``range`` of hours, so the skeleton is made by as many tasks as
    the session runs; ``keys`` is a dimension whose size is fixed by the store layout.
    """
    hours = (datetime.fromisoformat(str(end)) - datetime.fromisoformat(str(start))) // timedelta(hours=1)
    axis = spark.range(hours + 1 if end_inclusive else hours).select(
        F.timestamp_add("HOUR", F.col("id"), F.lit(str(start)).cast("timestamp_ntz")).alias("time"))
    return dims.product(axis, keys).withColumn("value", F.lit(None).cast(dtype))


def chunk_template(spark: SparkSession, start: str, end: str, var_levels: DataFrame, n_cells: int,
                   end_inclusive: bool = False) -> DataFrame:
    """SNK-1 in chunk layout: one row per (time, variable, level) holding an
    array of ``n_cells`` missing values — a store skeleton without any data."""
    t = hourly_template(spark, start, end, var_levels, end_inclusive).drop("value")
    return t.withColumn("values", F.array_repeat(F.lit(None).cast("float"), n_cells))


# ------------------------------------------------------------------ writes
MAX_RECORDS_PER_FILE = 20_000_000


def write_store(df: DataFrame, path: str, partition_by=("variable", "date"), mode: str = "errorifexists") -> None:
    """SNK-3 / SNK-15: bulk write, partitioned like the archive's regions.

    ``errorifexists`` refuses to overwrite an existing store on a full build.
    Rows are shuffled with the ``rebalance`` hint on the partition columns:
    each region lands in one task (one file) when it is small, AQE coalesces
    small regions together and splits a hot region over several tasks
    (advisory partition size), so neither small files nor one oversized
    task appear.  The shuffle is by hash, so a retried task sees the same rows.
    """
    cols = list(partition_by)
    (df.hint("rebalance", *cols).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*cols).parquet(path))


def overwrite_regions(df: DataFrame, path: str, partition_by=("variable", "date")) -> None:
    """SNK-5 / SNK-6 / SNK-8: replace exactly the partitions present in ``df``.

    Dynamic partition overwrite: idempotent (rewriting the same region gives
    the same store) and order-independent for disjoint regions.
    """
    write_store(df, path, partition_by, mode="overwrite")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14: lazy store scan; filters on partition columns prune directories.  A store that
    has an axis but no rows yet is empty, not an error."""
    from . import axis
    reader, schema = spark.read.option("basePath", path), axis.row_schema(spark, path)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_staged(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A staged copy of ``like``; without rows (nothing was staged) it is empty, not an error."""
    return spark.read.schema(like.schema).option("basePath", path).parquet(path)


MAX_TOUCHED_PARTITIONS = 50_000


def store_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store's folder is there, asked of its file system: other errors of a
    read (a missing column, a refused access) are not taken for a missing store."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def same(left: DataFrame, right: DataFrame, keys) -> "F.Column":
    """Join condition on ``keys`` in which a missing value (the level of a single-level field)
    equals a missing value."""
    return functools.reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[k]) for k in keys])


def read_touched(spark: SparkSession, path: str, new: DataFrame, partition_by) -> DataFrame:
    """Rows of the store in the partitions that ``new`` has rows in.

    The partition values come to the driver (one row per touched partition, checked
    against a bound) and are stated as literal filters, so only those
    directories are scanned, however large the store."""
    cols = list(partition_by)
    touched = new.select(*cols).distinct().limit(MAX_TOUCHED_PARTITIONS + 1).collect()
    if len(touched) > MAX_TOUCHED_PARTITIONS:
        raise ValueError(f"one write touches over {MAX_TOUCHED_PARTITIONS} partitions; write it in parts")
    store = read_store(spark, path)
    for c in cols:
        values = sorted({r[c] for r in touched if r[c] is not None}, key=str)
        match = F.col(c).isin(values) if values else F.lit(False)
        store = store.where(match | F.col(c).isNull() if any(r[c] is None for r in touched) else match)
    if len(cols) > 1:        # the filters allow every combination of values
        pairs = F.broadcast(spark.createDataFrame(touched, new.select(*cols).schema))
        store = store.join(pairs, same(store, pairs, cols), "left_semi")
    return store


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds; one that is not there is no error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_blocks(spark: SparkSession, path: str, blocks: DataFrame) -> None:
    """Remove whole partitions of a store: ``blocks`` has its partition columns, one row a
    partition.  Their folders (checked against the same bound) are found from the store's own
    file names, so a block that is not there is no error and a second run changes nothing."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    # nothing but partition columns is read, so a store without any file left is no error either
    rows = read_staged(spark, path, blocks).withColumn("_folder", folder)
    found = (rows.join(blocks, same(rows, blocks, blocks.columns), "left_semi").select("_folder").distinct().limit(MAX_TOUCHED_PARTITIONS + 1).collect())
    if len(found) > MAX_TOUCHED_PARTITIONS:
        raise ValueError(f"one call drops over {MAX_TOUCHED_PARTITIONS} partitions; drop them in parts")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for r in found:
        target = hadoop.Path(spark.sparkContext._jvm.java.net.URI.create(r["_folder"]))
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace_regions(spark: SparkSession, path: str, new: DataFrame, region=(),
                    partition_by=("variable", "date"), staging: str | None = None) -> None:
    """Replace exactly the regions that ``new`` has rows in: a region is one value of the
    partition columns and of ``region`` (``time``, ``level``, ``step``); a missing value
    (the level of a single-level field) is a value like any other.  All stored rows of those
    regions go, also cells that ``new`` lacks; all others stay.

    Every write to a store takes this way.  ``new`` is computed once, into a staging folder;
    touched partitions and regions are taken from there.  Rows of the touched
    partitions outside the regions are staged too, then the partitions are overwritten from
    the staged rows: a job never reads and writes one path.  Rows outside the store's axis
    (``axis.py``) are an error before anything is written.  Without a store it is created.
    """
    from ..session import scratch_path
    from . import axis
    cols = list(partition_by)
    stage = staging or scratch_path(spark, "stage")
    new.write.parquet(f"{stage}/new")
    staged = spark.read.schema(new.schema).parquet(f"{stage}/new")
    if staged.isEmpty():                     # no rows: nothing changes, no store either
        delete(spark, stage)
        return
    axis.check_rows(axis.read_axis(spark, path), staged)
    if store_exists(spark, path):
        current = read_touched(spark, path, staged, cols)
        # rows take the store's types (partition columns may have been read back in another one)
        staged = staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in current.schema])
        if region:
            key = [*cols, *region]
            regions = staged.select(*key).distinct()
            kept = current.join(regions, same(current, regions, key), "left_anti")
            kept.write.parquet(f"{stage}/kept")
            staged = spark.read.schema(current.schema).parquet(f"{stage}/kept").unionByName(staged)
    overwrite_regions(staged, path, partition_by)
    delete(spark, stage)


def overwrite_steps(spark: SparkSession, path: str, new: DataFrame, region=(), step_col: str = "time",
                    partition_by=("variable", "date"), staging: str | None = None) -> None:
    """SNK-7 / SNK-8: overwrite single time steps (with ``region`` also single levels)
    inside day partitions."""
    replace_regions(spark, path, new, [*region, step_col], partition_by, staging)


def valid_times(base, steps: int = fixed.FORECAST_STEPS) -> "F.Column":
    """SNK-9 / DT-7: the forecast valid-time row of a base time (base + 0..steps-1 hours)."""
    b = base if not isinstance(base, str) else F.col(base)
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda s: F.timestamp_add("HOUR", s, b))


def upsert_attrs(attrs: DataFrame, time_end, mode, last_updated, attrs_col: str = "attrs") -> DataFrame:
    """SNK-10 / MAP-1: set valid_time_start, last_updated and the stop key of the
    mode (final -> valid_time_stop, else valid_time_stop_era5t), keeping every
    other key.  Old values of these keys are filtered out first because
    ``map_concat`` refuses duplicate keys."""
    stop_key = F.when(F.col("_mode") == fixed.MODE_FINAL, F.lit("valid_time_stop")) \
        .otherwise(F.lit("valid_time_stop_era5t"))
    a = attrs.withColumn("_mode", mode if not isinstance(mode, str) else F.lit(mode))
    new = F.map_from_arrays(
        F.array(F.lit("valid_time_start"), F.lit("last_updated"), stop_key),
        F.array(F.lit(fixed.VALID_TIME_START), (last_updated if not isinstance(last_updated, str)
                                                else F.lit(last_updated)),
                (time_end if not isinstance(time_end, str) else F.lit(time_end)).cast("string")))
    kept = F.map_filter(F.col(attrs_col), lambda k, v: ~k.isin("valid_time_start", "last_updated") & (k != stop_key))
    return a.withColumn(attrs_col, F.map_concat(kept, new)).drop("_mode")


def resize_metadata(doc, total, keep_chunk) -> "F.Column":
    """SNK-11: set the time array's shape (and chunk unless kept) in a metadata
    document; every other field keeps its value, type and nesting."""
    source = doc if not isinstance(doc, str) else F.col(doc)
    z = F.from_json(source, "struct<shape: array<bigint>, chunks: array<bigint>>")
    tot = total if not isinstance(total, (int, str)) else (F.lit(total) if isinstance(total, int) else F.col(total))
    keep = keep_chunk if not isinstance(keep_chunk, bool) else F.lit(keep_chunk)
    shape = F.concat(F.array(tot.cast("bigint")), F.slice(z["shape"], F.lit(2), F.greatest(F.size(z["shape"]) - 1, F.lit(0))))
    chunks = F.when(keep, z["chunks"]).otherwise(F.concat(F.array(tot.cast("bigint")), F.slice(z["chunks"], F.lit(2), F.greatest(F.size(z["chunks"]) - 1, F.lit(0)))))
    return json_set_fields(source, {"shape": shape, "chunks": chunks})


def rechunk_time(df: DataFrame, keys, time_index: str, steps: int, value: str = "value") -> DataFrame:
    """SNK-14: re-block along time into chunks of ``steps`` (must divide 24);
    one row per (keys, chunk) with a dense array ordered by time."""
    if 24 % steps:
        raise ValueError(f"time chunk size {steps} must divide 24")
    c = (F.floor(F.col(time_index) / steps)).cast("long")
    pos = (F.col(time_index) - c * steps).cast("int")
    g = df.groupBy(*keys, c.alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(pos.alias("k"), F.col(value).alias("v")))).alias("_m"))
    return g.select(*keys, "chunk", F.transform(F.sequence(F.lit(0), F.lit(steps - 1)),
                                                lambda i: F.try_element_at(F.col("_m"), i)).alias("values"))


def upsert_store_attrs_table(spark: SparkSession, attrs_path: str, store: str, time_end: str, mode: str,
                             last_updated: str) -> None:
    """SNK-10 on the ``store_attrs`` table (store STRING, attrs MAP<STRING,STRING>):
    upsert the validity keys of one store after a write, keeping its other keys.

    The current row (if any) is read, merged and staged; the table is then
    rewritten from the staged copy (Parquet has no MERGE; the table holds one
    row per store, so the rewrite is small).
    """
    from ..session import scratch_path
    new = spark.createDataFrame([(store, {})], "store string, attrs map<string,string>")
    if store_exists(spark, attrs_path):
        cur = spark.read.parquet(attrs_path)
        mine = cur.where(F.col("store") == store)
        others = cur.where(F.col("store") != store)
        base = mine.unionByName(new.join(mine.select("store"), "store", "left_anti"))
    else:
        others, base = None, new
    row = upsert_attrs(base, time_end, mode, last_updated)
    out = row if others is None else others.unionByName(row)
    stage = scratch_path(spark, "attrs-stage")
    out.write.parquet(stage)
    spark.read.parquet(stage).coalesce(1).write.mode("overwrite").parquet(attrs_path)
