"""Histogram-sort sharding (operator 10), law ``bytes``.

Rows are ordered by (h, doc_id), h being the first 60 bits of the MD5 of the text, so equal
texts stand together.  A row belongs to shard k when the middle of its bytes, in that
order, lies in the k-th equal part of all bytes: shard sizes differ by less than the largest row.

The splitters are found by histogram: rounds of exact byte and row counts below candidate
boundaries (the next bits of the key), each refining only the bins that hold an open
splitter, until a bin holds a single row.  A round returns at most ``BINS`` counts.  Each
shard has several cells with splitters of their own, so that no task handles a whole
shard; then rows are exchanged once, by cell, and numbered within it.

Edge cases: a null text counts as no bytes (size 1, CRC of nothing); a null ``doc_id`` sorts
first; rows equal in text and doc_id share a shard; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.io import cut

SHARDS = 16
CELL_ROWS = 200_000           # rows a cell should have
MAX_CELLS = 1024              # per shard; bounds the splitters
BINS = 1 << 18                # counts that one round may bring to the driver
H_BITS, ID_BITS = 60, 64


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    data = F.encode(text, "UTF-8")
    h = F.conv(F.substring(F.md5(data), 1, 15), 16, 10).cast("long")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), h.alias("h"),
        # unsigned order of the id with its sign bit turned
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63)).bitwiseXOR(F.lit(-2 ** 63)).alias("u"))


def _splitters(spark: SparkSession, rows: DataFrame, total: int, targets: list[int]) -> list[tuple[int, int]]:
    """(key, rows before it) of each target: the first key the middle of whose bytes is at or
    beyond target / len(targets + 1) of all bytes.  Keys are 124-bit integers (h, then u)."""
    parts = len(targets) + 1
    goal = {t: t * total for t in targets}                 # in units of 1 / parts byte
    out: dict[int, tuple[int, int]] = {}
    # an open bin: its prefix -> (bytes before, rows before, targets inside)
    open_ = {0: (0, 0, list(targets))}
    done = 0                                               # leading key bits already fixed
    while open_:
        bits = max(1, min(14, (BINS // len(open_)).bit_length() - 1, (H_BITS if done < H_BITS else H_BITS + ID_BITS) - done))
        if done < H_BITS:
            prefix = F.shiftright("h", H_BITS - done).alias("p") if done else F.lit(0).cast("long").alias("p")
            second = F.lit(0).cast("long").alias("q")
            digit = F.shiftright("h", H_BITS - done - bits).bitwiseAND(F.lit((1 << bits) - 1))
        else:
            d = done - H_BITS
            prefix = F.col("h").alias("p")
            second = (F.shiftrightunsigned("u", ID_BITS - d) if d else F.lit(0).cast("long")).alias("q")
            digit = F.shiftrightunsigned("u", ID_BITS - d - bits).bitwiseAND(F.lit((1 << bits) - 1))
        view = rows.select(prefix, second, digit.alias("g"), "size")
        if done:
            split = (lambda k: (k, 0)) if done <= H_BITS else (lambda k: (k >> (done - H_BITS), k & ((1 << (done - H_BITS)) - 1)))
            names = [split(k) for k in open_]
            # at most one bin per splitter, so this table is bounded
            view = view.join(F.broadcast(spark.createDataFrame(names, "p long, q long")), ["p", "q"])
        counts: dict[int, list[tuple[int, int, int]]] = {}
        for r in view.groupBy("p", "q", "g").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
            key = (r.p << max(0, done - H_BITS)) | r.q
            counts.setdefault(key, []).append((r.g, r.b, r.n))
        done += bits
        rest = H_BITS + ID_BITS - done
        nxt: dict[int, tuple[int, int, list[int]]] = {}
        for key, (size, n, inside) in open_.items():
            todo = sorted(inside)
            for g, b, k in sorted(counts[key]):
                child = (key << bits) | g
                held = []
                while todo and goal[todo[0]] <= parts * (size + b):
                    t = todo.pop(0)
                    if k > 1 and rest:
                        held.append(t)
                    elif 2 * goal[t] <= parts * (2 * size + b):
                        out[t] = (child << rest, n)
                    else:
                        out[t] = ((child + 1) << rest, n + k)
                if held:
                    nxt[child] = (size, n, held)
                size, n = size + b, n + k
            for t in todo:
                out[t] = ((key + 1) << (rest + bits), n)
        open_ = nxt
    return [out[t] for t in targets]


def _cells(keys: list[int]):
    h = np.array([k >> ID_BITS for k in keys], dtype=np.int64)
    u = np.array([k & (2 ** 64 - 1) for k in keys], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, own_u = b.column("h").to_numpy(), b.column("u").to_numpy().view(np.uint64)
            cell = np.searchsorted(h, own, side="left")
            upto = np.searchsorted(h, own, side="right")
            for i in np.flatnonzero(upto > cell):
                cell[i] += np.searchsorted(u[cell[i]:upto[i]], own_u[i], side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], names=[*b.schema.names, "cell"])
    return run


def shard(documents: DataFrame, shards: int = SHARDS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = documents.sparkSession
    rows = cut(_keyed(documents))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    per = max(2, min(MAX_CELLS, -(-n // (shards * cell_rows))))
    found = _splitters(spark, rows, total, list(range(1, shards * per))) if n else []
    starts = [0, *(r for _, r in found)]
    base = [starts[i] - starts[i // per * per] if n else 0 for i in range(shards * per)]
    named = rows.mapInArrow(_cells([k for k, _ in found]),
                            "doc_id long, size long, text_crc32 long, h long, u long, cell int")
    places = spark.createDataFrame([(i, i // per, b) for i, b in enumerate(base)], "cell int, shard int, base long")
    order = Window.partitionBy("cell").orderBy("h", "u", "doc_id", "text_crc32")
    return (named.withColumn("nth", F.row_number().over(order)).join(F.broadcast(places), "cell")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("nth") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
