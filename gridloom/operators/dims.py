"""Small dimension tables and size-checked products (JN-10, JN-11).

Dimension tables built from the fixed values have a size known when the plan
is built, so broadcasting them is always safe.  Dimensions derived from data carry
no hint: Spark broadcasts them only when their size in bytes is below its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed

def chunk_variables(spark: SparkSession) -> DataFrame:
    """(chunk, short_name): 40 chunks, 73 rows."""
    rows = [(c, v) for c, vs in fixed.CHUNK_VARIABLES.items() for v in vs]
    return F.broadcast(spark.createDataFrame(rows, "chunk string, short_name string"))


def store_chunks(spark: SparkSession) -> DataFrame:
    """(store, chunk, is_single_level) for the grouped stores."""
    rows = [(s, c, s.startswith("single-level")) for s, cs in fixed.STORE_CHUNKS.items() for c in cs]
    return F.broadcast(spark.createDataFrame(rows, "store string, chunk string, is_single_level boolean"))


def chunk_list(spark: SparkSession, chunks, name: str = "chunk") -> DataFrame:
    return F.broadcast(spark.createDataFrame([(c,) for c in chunks], f"{name} string"))


def level_group(spark: SparkSession, group: str = "full_37") -> DataFrame:
    """(level, level_index) of a pressure-level group."""
    levels = fixed.PRESSURE_LEVEL_GROUPS[group]
    return F.broadcast(spark.createDataFrame(list(zip(levels, range(len(levels)))),
                                             "level int, level_index int"))


def product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` (a manifest or template product).

    No hint and no count: Spark broadcasts a side whose size it knows to be below
    ``spark.sql.autoBroadcastJoinThreshold`` (for a side behind a shuffle, AQE knows it
    when that stage has run) and else plans the distributed product.
    """
    return left.crossJoin(right)
