"""Tables, checkpoints and small shared summaries used by the operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.session import checkpoint_root

PART_ROWS = 10_000            # rows from which a partition is worth a task of its own
HOLD_WORDS = 1 << 16          # longs in a hashed set: 4 Mi bits, 512 KB whatever the data
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder: cuts the lineage, fixes rows
    and their partitions, and survives the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def cut_close(df: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """``cut``, read again in as many tasks as the rows are worth: one for ``rows`` of them, two a
    core at least, never more than were written.  For steps that leave few rows of many, where each
    later stage would else run a task for every all but empty partition."""
    checkpoint_root(df.sparkSession)
    seen = Observation()
    kept = df.observe(seen, F.count(F.lit(1)).alias("n")).checkpoint()
    n = seen.get["n"]
    return kept.coalesce(max(-(-n // rows), min(n, 2 * df.sparkSession.sparkContext.defaultParallelism), 1))


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Frames planned herein give up their shuffle files as soon as an execution of theirs ends.
    Else those of every step stay on disk until the driver happens to collect its garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def hashed_set(df: DataFrame, key: str, words: int = HOLD_WORDS) -> np.ndarray:
    """Bit array of ``words`` longs with the bit of every key (a long) set.

    Its size is fixed by the parameter, not by the data, so it may be sent to every
    task.  A key not in the column may find its bit set; one in it always does."""
    bit = F.col(key).bitwiseAND(F.lit(words * 64 - 1))
    rows = df.select(bit.alias("b")).select(F.shiftright("b", 6).alias("w"),
                                            F.expr("shiftleft(1L, cast(b & 63 AS int))").alias("m"))
    out = np.zeros(words, dtype=np.uint64)
    for w, m in rows.groupBy("w").agg(F.bit_or("m").alias("m")).collect():   # at most ``words`` rows
        out[w] = np.uint64(m & 0xFFFFFFFFFFFFFFFF)
    return out


def rows_in_set(df: DataFrame, key: str, bits: np.ndarray, inside: bool) -> DataFrame:
    """Rows of ``df`` whose key's bit is set (``inside``) or is not; a null key has none."""
    def run(batches):
        for b in batches:
            col = b.column(key)
            hit = in_set(bits, col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            hit &= ~col.is_null().to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(hit if inside else ~hit))
    return df.mapInArrow(run, df.schema)


def in_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key (uint64) is set."""
    b = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) == 1


def sample_texts(documents: DataFrame, pattern: str, rows: int, most_chars: int, spare: int = 4) -> list[str]:
    """At most ``rows`` texts that hold ``pattern`` and have at most ``most_chars`` code points:
    what a tagger learns from, bounded whatever the corpus.  About ``spare * rows`` rows, picked
    by hash, are looked at; all rows where there are no more."""
    n = documents.count()
    text = F.col("text").cast("string")
    pick = F.xxhash64("doc_id", "text")
    share = min(1.0, spare * rows / max(1, n))
    few = (documents.select(pick.alias("h"), text.alias("text"))
           .where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)))
           .where((F.length("text") <= most_chars) & F.col("text").rlike(pattern)).orderBy("h", "text").limit(rows))
    return [r["text"] for r in few.collect()]
