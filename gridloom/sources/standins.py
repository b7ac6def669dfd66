"""Gridded stand-in views over the driver tables.

The driver tables are not weather; these views give them the shape of the
archive's tables so that every operator runs over data whose size grows with
the input.  Each view is one aggregation (partial aggregate map-side, one
shuffle on the grid key).  The same definitions exist as DuckDB SQL in
``__spark_entry__`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import trunc_ntz
from ..operators.dims import product
from .tables import table


def v_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly field, long layout: (time, variable, lat_idx, lon_idx, latitude, longitude, value).

    5 variables on a 4 x 6 grid, sparse so that missing cells occur.
    """
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "user_id", "value")
    row = F.floor((F.col("user_id") % 24) / 6)
    col = F.col("user_id") % 6
    return (ev.groupBy(
        trunc_ntz("hour", "ts").alias("time"),
        F.col("event_type").alias("variable"),
        row.cast("int").alias("lat_idx"),
        col.cast("int").alias("lon_idx"),
        (F.lit(90) - F.lit(60) * row).cast("float").alias("latitude"),
        (F.lit(60) * col).cast("float").alias("longitude"))
        .agg(F.max("value").alias("value")))


def v_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same field in two releases: expver 1 (final) and 5 (preliminary)."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "user_id", "event_id", "value")
    return (ev.groupBy(
        trunc_ntz("hour", "ts").alias("time"),
        F.col("event_type").alias("variable"),
        (F.col("user_id") % 24).cast("int").alias("cell"),
        F.when(F.col("event_id") % 3 == 0, F.lit(5)).otherwise(F.lit(1)).alias("expver"))
        .agg(F.max("value").alias("value")))


def v_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-complete 7-level columns on 24 cells, monthly: (time, cell, k, t, q, w, x)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_extendedprice")
    return (li.groupBy(
        trunc_ntz("month", "l_shipdate").alias("time"),
        (F.col("l_suppkey") % 24).cast("int").alias("cell"),
        F.col("l_linenumber").cast("int").alias("k"))
        .agg((F.lit(230) + F.max("l_quantity")).cast("double").alias("t"),
             (F.max("l_discount") / 10).cast("double").alias("q"),
             F.max("l_tax").cast("double").alias("w"),
             F.min("l_extendedprice").cast("double").alias("x")))


def v_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected manifest: every order date x every priority (a checked small product)."""
    o = table(spark, sf_dir, "orders")
    dates = o.select(F.col("o_orderdate").alias("date")).distinct()
    chunks = o.select(F.col("o_orderpriority").alias("chunk")).distinct()
    return product(dates, chunks)


def v_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present: (date, chunk) of orders not yet fulfilled."""
    o = table(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderstatus") != "F")
            .select(F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("chunk"))
            .distinct())


def v_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 array chunks: (vec_id = time_index, label = variable, embedding ARRAY<FLOAT>[64])."""
    return table(spark, sf_dir, "embeddings")


def v_surface(levels: DataFrame) -> DataFrame:
    """Surface fields per column derived from the levels view.

    lnsp from the lowest level's ``x`` (98 000 .. 102 000 Pa) and surface
    geopotential from its ``w``; (time, cell, lnsp, zs).
    """
    return (levels.where(F.col("k") == 7)
            .select("time", "cell",
                    F.log(F.lit(98000.0) + F.col("x") * F.lit(0.04)).alias("lnsp"),
                    (F.col("w") * F.lit(10000.0)).alias("zs")))
