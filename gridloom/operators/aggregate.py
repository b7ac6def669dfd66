"""Field aggregates (AG-3, AG-4, AG-5, AG-8, AG-10, AG-11, STM-4 batch form).

All are grouped aggregations with map-side partial aggregation.  Per-group
collections (``collect_set`` of levels) are bounded by the level axis.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fields import nan_to_null


def field_extremes(df: DataFrame, keys: Sequence[str], value: str = "value",
                   scale: float = 1.0, bias: float = 0.0) -> DataFrame:
    """AG-3: min / max after scaling; NaN is missing (Spark orders NaN highest)."""
    v = nan_to_null(F.col(value)) * F.lit(scale) + F.lit(bias)
    return df.groupBy(*keys).agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def describe_fields(df: DataFrame, name: str, level: str, time: str = "time") -> DataFrame:
    """AG-4: inventory per field: value count, levels, time range."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n_values"),
                                F.sort_array(F.collect_set(level)).alias("levels"),
                                F.min(time).alias("time_min"), F.max(time).alias("time_max"))


def store_size(df: DataFrame, name: str, bytes_per_value: int = 4) -> DataFrame:
    """AG-5: bytes per variable and in total (rollup row has name NULL)."""
    return df.rollup(name).agg(F.count(F.lit(1)).alias("n_values"),
                               (F.count(F.lit(1)) * F.lit(bytes_per_value)).alias("nbytes"))


def level_counts(df: DataFrame, keys: Sequence[str], level: str, expected: int) -> DataFrame:
    """AG-8: number of levels per column and whether it matches the group."""
    return df.groupBy(*keys).agg(F.count_distinct(level).alias("n_levels")) \
        .withColumn("complete", F.col("n_levels") == F.lit(expected))


def assert_level_count(df: DataFrame, keys: Sequence[str], level: str, expected: int) -> None:
    bad = level_counts(df, keys, level, expected).where(~F.col("complete")).limit(1).collect()
    if bad:
        raise ValueError(f"level count {bad[0]['n_levels']} != {expected} at {bad[0].asDict()}")


def climatology(df: DataFrame, cell_keys: Sequence[str], time: str = "time", value: str = "value") -> DataFrame:
    """AG-10: mean per (month of year, hour of day, cell)."""
    return df.groupBy(F.month(time).alias("month"), F.hour(time).alias("hour"), *cell_keys).agg(
        F.avg(value).alias("mean_value"), F.count(value).alias("n"))


def diurnal_range(df: DataFrame, cell_keys: Sequence[str], time: str = "time", value: str = "value") -> DataFrame:
    """AG-11: daily max - min per cell."""
    return df.groupBy(F.col(time).cast("date").alias("date"), *cell_keys).agg(
        (F.max(value) - F.min(value)).alias("diurnal_range"))


def hourly_buckets(df: DataFrame, ts: str, cell_keys: Sequence[str], value: str = "value") -> DataFrame:
    """STM-4: bucket raw rows onto the fixed hourly axis of the grid."""
    return df.groupBy(F.window(ts, "1 hour").alias("w"), *cell_keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(value).alias("max_value")) \
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                F.col("w.end").cast("timestamp_ntz").alias("window_end"), *cell_keys, "n", "max_value")
