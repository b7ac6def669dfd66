"""Stores in the chunk layout: one row a chunk, holding its cells as an array (SRC-14, SNK-3, SNK-5, SNK-14).

This is the layout for production sizes: a chunk of 24 hours x 103 x 240 cells is one row instead
of 593,000.  All that moves between tasks is chunks.  Which chunks a selection needs follows
from index arithmetic, so reads state chunk ranges as literal filters: on the first dimension
they prune folders (the partition is variable x first chunk index), on the others Parquet row groups.
A write edits the chunks that its region only touches and replaces those it covers.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import dense_entries
from . import store as ST

Ranges = Mapping[str, tuple[int, int]]


@dataclass(frozen=True)
class Chunking:
    """Dimensions (slowest first) with their sizes and chunk sizes.  Chunks at the end of a
    dimension keep the full size; their cells beyond it are missing and never read."""
    names: tuple[str, ...]
    sizes: tuple[int, ...]
    chunks: tuple[int, ...]

    @property
    def cells(self) -> int:
        return math.prod(self.chunks)

    @property
    def indices(self) -> list[str]:
        return [f"c_{n}" for n in self.names]

    @property
    def partition(self) -> tuple[str, str]:
        return ("variable", self.indices[0])

    def whole(self, ranges: Ranges | None) -> dict[str, tuple[int, int]]:
        """[lo, hi) of every dimension, cut to its size."""
        out = {}
        for name, size in zip(self.names, self.sizes):
            lo, hi = (ranges or {}).get(name, (0, size))
            out[name] = (max(0, lo), min(size, hi))
        unknown = set(ranges or {}) - set(self.names)
        if unknown:
            raise ValueError(f"no such dimension: {sorted(unknown)}")
        return out

    def position(self) -> Column:
        """Row-major place of a cell in its chunk."""
        return functools.reduce(lambda p, x: p * x[1] + F.col(x[0]) % x[1], zip(self.names, self.chunks), F.lit(0)).cast("int")

    def index_at(self, position: Column) -> dict[str, Column]:
        """Index on every dimension of the cell at a place in the chunk at hand."""
        out, below = {}, self.cells
        for name, size in zip(self.names, self.chunks):
            below //= size
            inside = F.floor(position / below) % size
            out[name] = (F.col(f"c_{name}") * size + inside).cast("int")
        return out

    def inside(self, position: Column, ranges: Ranges) -> Column:
        at = self.index_at(position)
        return functools.reduce(lambda a, b: a & b, [(at[n] >= lo) & (at[n] < hi) for n, (lo, hi) in ranges.items()])


def to_chunks(rows: DataFrame, keys: Sequence[str], by: Chunking, value: str = "value") -> DataFrame:
    """long (keys, index columns, value) -> one row a chunk (keys, chunk indices, values).  A group is
    one chunk."""
    index = [F.floor(F.col(n) / c).cast("int").alias(f"c_{n}") for n, c in zip(by.names, by.chunks)]
    g = rows.groupBy(*keys, *index).agg(
        F.collect_list(F.struct(by.position().alias("k"), F.col(value).alias("v"))).alias("_e"))
    nothing = F.lit(None).cast(rows.schema[value].dataType)
    return g.select(*keys, *by.indices, dense_entries("_e", by.cells, nothing).alias("_e")).select(
        *keys, *by.indices, F.transform("_e", lambda e: e["v"]).alias("values"))


def to_cells(chunks: DataFrame, keys: Sequence[str], by: Chunking, ranges: Ranges | None = None) -> DataFrame:
    """One row a chunk -> long, the cells in ``ranges`` only (also missing ones)."""
    box = by.whole(ranges)
    at = by.index_at(F.col("_p"))
    flat = chunks.select(*keys, *by.indices, F.posexplode("values").alias("_p", "value")).where(by.inside(F.col("_p"), box))
    return flat.select(*keys, *[at[n].alias(n) for n in by.names], "value")


def build(rows: DataFrame, path: str, by: Chunking, keys: Sequence[str] = ("variable",), value: str = "value") -> None:
    """SNK-3 in chunk layout: bulk write of long rows; refuses an existing store."""
    ST.write_store(to_chunks(rows, keys, by, value), path, by.partition)


def read(spark: SparkSession, path: str, by: Chunking, ranges: Ranges | None = None, where: Column | None = None) -> DataFrame:
    """SRC-14: the chunks that hold cells of ``ranges``, by literal filters on chunk indices; ``where`` selects
    arrays (a condition on variable and further keys)."""
    out = ST.read_store(spark, path)
    box = by.whole(ranges)
    for (lo, hi), size, c in zip(box.values(), by.chunks, by.indices):
        out = out.where(F.col(c).between(lo // size, (hi - 1) // size) if hi > lo else F.lit(False))
    return out if where is None else out.where(where)


def write_region(spark: SparkSession, path: str, by: Chunking, rows: DataFrame, ranges: Ranges,
                 keys: Sequence[str] = ("variable",), value: str = "value") -> None:
    """SNK-5 in chunk layout: replace the cells of ``ranges``, of every array that ``rows`` has, by
    ``rows``; cells of the region without a row become missing, all other cells stay.

    Every chunk that the region overlaps is written, also those without a row.  Chunks that it covers are not
    read for their cells; chunks on its border are edited as arrays, place by place, joined
    one row a chunk.  Rows outside the region raise."""
    from ..session import scratch_path
    box = by.whole(ranges)
    if any(hi <= lo for lo, hi in box.values()):
        return
    stage = scratch_path(spark, "chunks")
    outside = ~functools.reduce(lambda a, b: a & b, [F.col(n).between(lo, hi - 1) for n, (lo, hi) in box.items()])
    checked = rows.select(*keys, *by.names, F.when(F.coalesce(outside, F.lit(True)), F.raise_error(F.lit("a row outside the region")))
                          .otherwise(F.col(value)).alias(value))
    to_chunks(checked, keys, by, value).write.parquet(stage)
    new = spark.read.parquet(stage)
    # every chunk of the region, for each array at hand
    every = new.select(*keys).distinct()
    for (lo, hi), size, c in zip(box.values(), by.chunks, by.indices):
        every = every.withColumn(c, F.explode(F.sequence(F.lit(lo // size), F.lit((hi - 1) // size))))
    chunk = [*keys, *by.indices]
    here = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in chunk])
    side = lambda df, name: df.select(*[F.col(c).alias(f"_{c}") for c in chunk], F.col("values").alias(name))
    both = every.join(side(new, "_new"), here, "left").select(*chunk, "_new")
    if ST.store_exists(spark, path):
        # a chunk is on the border where it reaches beyond the region on some dimension
        border = functools.reduce(lambda a, b: a | b, [
            (F.col(c) * size < lo) | (F.least((F.col(c) + 1) * size, F.lit(n)) > hi)
            for (lo, hi), size, n, c in zip(box.values(), by.chunks, by.sizes, by.indices)])
        old = read(spark, path, by, ranges).where(border)
        both = both.join(side(old, "_old"), here, "left").select(*chunk, "_new", "_old")
    else:
        both = both.withColumn("_old", F.lit(None).cast(new.schema["values"].dataType))
    edited = F.transform(F.sequence(F.lit(0), F.lit(by.cells - 1)),
                         lambda i: F.when(by.inside(i, box), F.get("_new", i)).otherwise(F.get("_old", i)))
    ST.replace_regions(spark, path, both.select(*chunk, edited.alias("values")),
                       [c for c in chunk if c not in by.partition], by.partition)
    ST.delete(spark, stage)


def rechunk_first(chunks: DataFrame, keys: Sequence[str], by: Chunking, steps: int) -> tuple[DataFrame, Chunking]:
    """SNK-14 in chunk layout: chunks of ``steps`` on the first dimension.

    The first dimension is the slowest, so shorter chunks are slices of the arrays at hand: nothing is
    exchanged.  Longer ones are slices put one after the other: one row a chunk is exchanged.
    One of the two sizes must divide the other."""
    own = by.chunks[0]
    to = Chunking(by.names, by.sizes, (steps, *by.chunks[1:]))
    layer, first = by.cells // own, by.indices[0]
    if own % steps == 0:
        part = F.explode(F.sequence(F.lit(0), F.lit(own // steps - 1))).alias("_i")
        cut = chunks.select(*keys, *by.indices, "values", part)
        n = -(-by.sizes[0] // steps)
        return cut.select(*keys, (F.col(first) * (own // steps) + F.col("_i")).cast("int").alias(first), *by.indices[1:],
                          F.slice("values", F.col("_i") * (steps * layer) + 1, steps * layer).alias("values")
                          ).where(F.col(first) < n), to
    if steps % own:
        raise ValueError(f"chunks of {own} steps can not become chunks of {steps}")
    times = steps // own
    nothing = F.array_repeat(F.lit(None).cast(chunks.schema["values"].dataType.elementType), own * layer)
    g = chunks.groupBy(*keys, F.floor(F.col(first) / times).cast("int").alias("_c"), *by.indices[1:]).agg(
        F.collect_list(F.struct((F.col(first) % times).cast("int").alias("k"), F.col("values").alias("v"))).alias("_e"))
    return g.select(*keys, F.col("_c").alias(first), *by.indices[1:],
                    F.flatten(F.transform(dense_entries("_e", times, nothing), lambda e: e["v"])).alias("values")), to
