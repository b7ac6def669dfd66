"""Numpy helpers that read the words of many texts at once, inside a Spark task.

A batch of texts is laid out as one array of UTF-8 bytes with a line feed after
each text, so one vector operation serves the whole batch and no word crosses
into the next text.  Words are the maximal runs of anything but 0x20 and
0x09-0x0D.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SHINGLE_WORDS = 5
CHUNK_CHARS = 800_000        # code points handled at once; bounds a task's memory
BATCH_ROWS = 2_000           # rows of a batch between Spark and its Python workers
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_MIX_K = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.arange(1, 257, dtype=np.uint64)
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] += np.uint64(32)
_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64; kept per process and made longer on demand."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        out = np.full(1 << max(20, (n - 1).bit_length()), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        have = _tables[base] = np.multiply.accumulate(out)
    return have[:n]


def utf8(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a line feed after each, and where each text starts
    (one entry more than texts)."""
    each = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((len(t) + 1 for t in each), dtype=np.int64, count=len(each)), out=starts[1:])
    return np.frombuffer(b"\n".join([*each, b""]), dtype=np.uint8), starts


def word_spans(data: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in bytes that end with a line feed; ``apart``: which
    bytes stand between words."""
    space = apart[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, lower: bool = True, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word; ``lower`` folds A-Z only.

    A word's hash is its polynomial value modulo 2^64, taken from the running sum over
    the whole batch and divided by the power at its start, then finalised."""
    starts, ends = word_spans(data, apart)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts, ends
    return span_hashes(data, starts, ends, lower), starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hash of each (not empty) span; the same bytes give the same hash wherever they stand."""
    run = (_FOLDED if lower else _PLAIN)[data]
    run *= powers(_BASE, len(data))
    np.cumsum(run, out=run)
    before = np.where(starts > 0, run[starts - 1], np.uint64(0))
    sums = (run[ends - 1] - before) * powers(_INVERSE, len(data))[starts]
    return mix64(sums + (ends - starts).astype(np.uint64) * _M1)


def text_of(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text that each position lies in."""
    return np.searchsorted(starts, positions, side="right") - 1


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in runs of about ``limit`` code points; null is empty.
    A text is never cut."""
    begin, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1]) + 1
        if size >= limit:
            yield begin, held
            begin, held, size = i + 1, [], 0
    if held:
        yield begin, held


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches (views, no copies): bounds what is held as objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """One hash of a short word sequence (fewer than five words)."""
    acc = (words * _MIX_K[:len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
    return mix64(np.array([acc ^ np.uint64(0x5851F42D4C957F2D)], dtype=np.uint64))[0]


def shingles(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of each run of ``k`` words; the whole sequence where there are fewer; none
    without words.  Not made distinct."""
    if len(words) == 0:
        return np.empty(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([sequence_hash(words)], dtype=np.uint64)
    n = len(words) - k + 1
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        acc += words[j:j + n] * _MIX_K[j]
    return mix64(acc)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def text_shingles(texts: list[str]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    data, starts = utf8(texts)
    hashes, begin, _ = word_hashes(data)
    first = np.searchsorted(begin, starts)
    n = max(0, len(hashes) - SHINGLE_WORDS + 1)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(SHINGLE_WORDS if n else 0):
        acc += hashes[j:j + n] * _MIX_K[j]
    every = mix64(acc)
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= SHINGLE_WORDS:
            yield distinct(every[a:b - SHINGLE_WORDS + 1])
        else:
            yield shingles(hashes[a:b])


def give_back() -> None:
    """Returns free memory to the system.  Spark reuses its Python workers, and what one
    stage freed would else stay with the process while later stages take more."""
    _tables.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def bounded(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` for ``mapInArrow``: texts come in batches of at most ``BATCH_ROWS`` rows, and
    memory is given back when the task ends."""
    SparkSession.active().conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


def map_batches(df: DataFrame, columns: list[str], schema: StructType | str,
                fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over just the named columns."""
    return df.select(*columns).mapInArrow(bounded(fn), schema)


def as_signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def as_unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).astype(np.int64, copy=False).view(np.uint64)
