"""Event rows bucketed onto the hourly grid axis as a stream (STM-4, STM-3).

Rows arriving from a file or message source are aggregated per
(hour window, cell) with a watermark: once the watermark passes the end of an
hour, that hour is final and emitted once (append mode), and its state is
dropped — state stays bounded by the allowed lateness, not by history.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _as_event_time(df: DataFrame, ts: str) -> DataFrame:
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def hourly_grid_stream(rows: DataFrame, ts: str, cell_keys: Sequence[str], value: str = "value",
                       lateness: str = "2 hours") -> DataFrame:
    """Streaming form of :func:`gridloom.operators.aggregate.hourly_buckets`.

    Event time must be TIMESTAMP for a watermark; NTZ wall time is read as UTC.
    """
    agg = (_as_event_time(rows, ts).withWatermark(ts, lateness)
           .groupBy(F.window(ts, "1 hour").alias("w"), *cell_keys)
           .agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("max_value")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *cell_keys, "n", "max_value")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Gate(StatefulProcessor):
    """State of one date: its files until it is complete, then no more than that it is.  So a
    date's state expires by itself, however late its files come."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("date", "files array<string>, complete boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.state.get() if self.state.exists() else None
        files, needed = set(held[0] or []) if held else set(), 0
        for part in rows:                            # repeated files count once
            files.update(part["file"])
            needed = int(part["n_expected"].iloc[0])
        if held and held[1]:
            return
        done = len(files) >= needed
        self.state.update(([] if done else sorted(files), done))
        if done:
            yield pd.DataFrame({self.key: [key[0]], "n_present": [len(files)], "n_expected": [needed]})

    def close(self) -> None:
        pass


def complete_dates_stream(landed: DataFrame, expected_per_date: DataFrame, key: str = "date",
                          file_col: str = "path") -> DataFrame:
    """STM-3 streaming gate: a date, once, as soon as its landed files reach the expected count.

    ``landed`` is a stream of (path, date); ``expected_per_date`` a static
    (date, n_expected) table (a manifest aggregate), which every micro-batch reads anew: best stored,
    as the plans of micro-batches do not adapt to the sizes that they meet.  State is kept by date
    (``transformWithState``), so a date's files may arrive in any number of drops and more than
    once.  There is no watermark: late and back-filled dates are decided like all others.  The
    state of a date holds its paths until it is complete and then one flag.  For update mode; the
    query needs the RocksDB state store (``record_complete_dates`` sets it)."""
    from ..session import ensure_session_defaults
    ensure_session_defaults(landed.sparkSession)
    day = expected_per_date.select(F.col(key).cast("date").alias(key), F.col("n_expected").cast("long").alias("n_expected"))
    rows = landed.select(F.col(key).cast("date").alias(key), F.col(file_col).alias("file")).join(day, key)
    return rows.groupBy(key).transformWithStateInPandas(
        _Gate(key), f"{key} date, n_present long, n_expected long", "Update", "None")


def record_complete_dates(spark, landing: str, schema, expected_per_date: DataFrame, out: str, checkpoint: str,
                          key: str = "date", file_col: str = "path") -> None:
    """Run :func:`complete_dates_stream` over new landing files and append each date to the
    table ``out`` once; a replayed batch finds its dates there and adds nothing.

    ``expected_per_date`` is worked out once, as a batch job, and stored for the run: within a micro-batch
    its product of dates and chunks would be a task for every pair of shuffle partitions."""
    from ..session import scratch_path
    from ..sinks.store import store_exists

    days = scratch_path(spark, "expected-dates")
    expected_per_date.select(key, "n_expected").write.parquet(days)
    dates = complete_dates_stream(spark.readStream.schema(schema).parquet(landing), spark.read.parquet(days), key, file_col)

    def batch(df: DataFrame, epoch_id: int) -> None:
        sp = df.sparkSession
        new = df.join(sp.read.parquet(out).select(key), key, "left_anti") if store_exists(sp, out) else df
        new.write.mode("append").parquet(out)

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)                    # a query takes its settings when it starts
    try:
        q = (dates.writeStream.outputMode("update").foreachBatch(batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def hourly_grid_to_store(spark, landing: str, schema, store: str, checkpoint: str, ts: str,
                         cell_keys: Sequence[str], value: str = "value", lateness: str = "2 hours",
                         late: str | None = None) -> int:
    """Bucket new landing rows on the hourly axis and keep the result in a store partitioned by
    date.  Returns the number of rows that came too late, over all runs.

    Beside the store stand ``<store>.parts`` (what each micro-batch adds to an hour and cell, by
    date and batch), ``<store>.seen`` (the newest time of each batch) and, at ``late`` or else
    ``<store>.late``, the rows that came too late.  A batch writes its parts, the dates it
    touches are summed anew from all parts and overwritten: a replayed batch overwrites its own
    parts, so nothing counts twice.  An hour is closed once the newest time of earlier
    batches, less ``lateness``, has passed its end (the watermark rule): rows for closed
    hours change nothing and go, whole, to the late table; parts of closed dates are removed, so what is
    kept beside the store is bounded by the lateness.
    """
    from ..sinks import store as ST

    parts, seen, aside = f"{store}.parts", f"{store}.seen", late or f"{store}.late"
    keys, n_max = list(cell_keys), ["n", "max_value"]

    def write(df: DataFrame, path: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def batch(df: DataFrame, epoch_id: int) -> None:
        sp = df.sparkSession
        rows = df.withColumn("_ts", F.col(ts).cast("timestamp_ntz")).withColumn("epoch", F.lit(epoch_id))
        newest = rows.agg(F.max("_ts")).first()[0]
        if newest is None:
            return
        horizon = None
        if ST.store_exists(sp, seen):
            edge = F.max("newest") - F.expr(f"INTERVAL {lateness}")
            horizon = sp.read.parquet(seen).where(F.col("epoch") < epoch_id).agg(edge.cast("timestamp_ntz")).first()[0]
        start = F.date_trunc("hour", "_ts").cast("timestamp_ntz")
        end = F.timestamp_add("HOUR", F.lit(1), start)
        closed = F.lit(False) if horizon is None else end <= F.lit(horizon)
        write(rows.where(closed).drop("_ts"), aside, "epoch")
        added = (rows.where(~closed).groupBy("epoch", start.alias("window_start"), end.alias("window_end"), *keys)
                 .agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("max_value"))
                 .withColumn("date", F.col("window_start").cast("date")))
        write(added, parts, "date", "epoch")
        mine = sp.read.parquet(parts)
        dates = [r[0] for r in mine.where(F.col("epoch") == epoch_id).select("date").distinct()
                 .limit(ST.MAX_TOUCHED_PARTITIONS).collect()]
        if dates:
            whole = (mine.where(F.col("date").isin(dates)).groupBy("date", "window_start", "window_end", *keys)
                     .agg(F.sum("n").alias("n"), F.max("max_value").alias("max_value")))
            ST.overwrite_regions(whole.select("window_start", "window_end", *keys, *n_max, "date"), store, ("date",))
        write(sp.createDataFrame([(newest, epoch_id)], "newest timestamp_ntz, epoch int"), seen, "epoch")
        if horizon is not None:
            gone = mine.where(F.col("date") < F.lit(horizon.date())).select("date").distinct()
            ST.drop_blocks(sp, parts, gone)

    q = (spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema("epoch int").parquet(aside).count() if ST.store_exists(spark, aside) else 0
