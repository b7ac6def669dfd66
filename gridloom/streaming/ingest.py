"""Incremental ingest with Structured Streaming (STM-1, STM-2).

New raw blocks land as Parquet files in a landing folder.  A file-source
stream picks up what is new since the last run (``trigger(availableNow=True)``
= a scheduled refresh that processes the backlog and stops; the checkpoint
remembers what was ingested, so a lost executor or a rerun never ingests a
file twice).  Each micro-batch is written with ``foreachBatch`` as a dynamic
partition overwrite of exactly the regions it covers.

Lateness here is months (the preliminary release is replaced by the final
one), so there is no watermark: replacement is a keyed merge per region that
keeps the final value where both releases are present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.release import combine_releases
from ..session import scratch_path
from ..sinks.store import overwrite_regions, read_staged, read_touched, replace_regions, store_exists


def _run(stream_df: DataFrame, batch_fn, checkpoint: str) -> None:
    q = (stream_df.writeStream.foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_new_blocks(spark: SparkSession, landing: str, schema, store: str, checkpoint: str,
                      transform=None, partition_by=("variable", "date"), region=None) -> None:
    """STM-1: ingest every new landing file into the store (region overwrite).

    A region is a partition and, where the rows have them, a level and a forecast step
    (``region`` names other columns): a file of one level leaves the other levels alone."""
    src = spark.readStream.schema(schema).parquet(landing)

    def batch(df: DataFrame, epoch_id: int) -> None:
        out = transform(df) if transform else df
        if out.isEmpty():
            return
        within = [c for c in ("level", "step") if c in out.columns] if region is None else list(region)
        replace_regions(out.sparkSession, store, out, within, partition_by)

    _run(src, batch, checkpoint)


def ingest_releases(spark: SparkSession, landing: str, schema, store: str, checkpoint: str,
                    keys: Sequence[str], partition_by=("variable", "date")) -> None:
    """STM-2: merge arriving releases into the store, final over preliminary.

    Per batch: the touched regions of the store are read, unioned with the new
    rows, reduced with ``combine_releases`` and staged, then the regions are
    overwritten from the staged copy.
    """
    src = spark.readStream.schema(schema).parquet(landing)
    cols = list(partition_by)

    def batch(df: DataFrame, epoch_id: int) -> None:
        sp = df.sparkSession
        incoming = df.select(*keys, *cols, "value", "expver")
        if incoming.isEmpty():
            return
        rows = incoming.withColumn("arrival", F.lit(1))
        if store_exists(sp, store):
            current = read_touched(sp, store, incoming, cols)
            # a store written without release marks gives way to whatever arrives later
            held = F.col("expver_used") if "expver_used" in current.columns else F.lit(fixed.RELEASE_PRELIMINARY)
            rows = rows.unionByName(current.select(*keys, *cols, "value", held.cast(incoming.schema["expver"].dataType)
                                                   .alias("expver"), F.lit(0).alias("arrival")))
        merged = combine_releases(rows, list(keys) + cols, arrival="arrival")
        stage = scratch_path(sp, "release-stage")
        merged.write.mode("errorifexists").partitionBy(*cols).parquet(stage)
        overwrite_regions(read_staged(sp, stage, merged), store, partition_by)

    _run(src, batch, checkpoint)
