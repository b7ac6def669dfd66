"""Benchmark decontamination by SimHash windows (operator 9).

A document is compared, window by window, with every benchmark item; a window has as many
words as the item (the whole document where that is shorter).  Each window's SimHash is
looked up in a multi-index of the items of that size: fingerprints are cut into blocks, and two
fingerprints within ``RADIUS`` bits agree in at least one block up to RADIUS // BLOCKS bits,
so the index misses none.  Candidates are then verified exactly: weighted Jaccard
similarity of the five-word shingles, each weighing ln(1 + items / items that hold it), at
least 0.75.  Only windows that share a shingle with some item of their size can pass that,
so the others get no fingerprint; the rolling sums behind the fingerprints make a window
cost the same whatever its size.

The benchmark is small beside the corpus; still its size is counted first, and beyond
``ITEM_WORDS`` words it is taken in blocks of that size, one pass each.  Weights always come
from the whole benchmark: Spark counts the items of each shingle, and every block gets the
counts of those held by two items or more, 16 bytes each; a shingle of one item, of this
block or another, weighs as much as one of none.  So the blocks do not change the result.

Edge cases: null, empty and blank documents and items match nothing; a text of fewer than
five words is one shingle; repeated rows are answered as often as they come; of equally
similar windows the first counts; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import textkit as T

LEAST = 0.75
RADIUS, BLOCKS = 20, 8
ITEM_WORDS = 2_000_000        # words of items that a task holds at once


class Weights:
    """Weight of a shingle: ln(1 + items / items that hold it)."""

    def __init__(self, items: int, several: np.ndarray, held: np.ndarray):
        """``several``: shingles that two items or more hold, sorted, and how many hold each."""
        n = max(1, items)
        self.several = several
        kinds, at = np.unique(held, return_inverse=True)
        self.weight = np.array([math.log(1 + n / k) for k in kinds.tolist()], dtype=np.float64)[at]
        self.other = math.log(1 + n)           # held by one, or by none

    def __call__(self, s: np.ndarray) -> np.ndarray:
        out = np.full(len(s), self.other)
        if len(self.several):
            at = np.minimum(np.searchsorted(self.several, s), len(self.several) - 1)
            same = self.several[at] == s
            out[same] = self.weight[at[same]]
        return out


class Items:
    """Benchmark items by size, with the index of their fingerprints."""

    def __init__(self, rows: list[tuple[int, str]], radius: int = RADIUS, weights: Weights | None = None):
        self.radius = radius
        self.ids, self.bags, sizes = [], [], []
        words = [T.word_hashes(T.utf8([text or ""])[0])[0] for _, text in rows]
        if weights is None:
            df: Counter = Counter()
            for w in words:
                df.update(set(T.shingles(w).tolist()))
            several = sorted(s for s, k in df.items() if k > 1)
            weights = Weights(len(rows), np.array(several, dtype=np.uint64),
                              np.array([df[s] for s in several], dtype=np.int64))
        self.weights = weights
        prints = []
        for (item_id, _), w in zip(rows, words):
            if not len(w):
                continue
            s = T.shingles(w)
            self.ids.append(item_id)
            self.bags.append(Counter(s.tolist()))
            sizes.append(len(w))
            prints.append(_fingerprints(s, weights(s), np.array([0]), np.array([len(s)]))[0])
        self.sizes = np.array(sizes, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint64)
        self.by_size: dict[int, dict] = {}
        for size in np.unique(self.sizes).tolist():
            at = np.flatnonzero(self.sizes == size)
            every = np.unique(np.concatenate([np.fromiter(self.bags[i], dtype=np.uint64) for i in at]))
            self.by_size[size] = {"at": at, "shingles": every, "index": _index(self.prints[at], radius)}
        held = [np.fromiter(b, dtype=np.uint64) for b in self.bags]
        self.shingles = np.unique(np.concatenate(held)) if held else np.empty(0, dtype=np.uint64)
        # a first, rough sieve: low bits of every shingle of the items
        self.sieve = np.zeros(1 << 22, dtype=bool)
        self.sieve[(self.shingles & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and a window's shingles, with multiplicity."""
        a, b = self.bags[item], Counter(window.tolist())
        wa, wb = (self.weights(np.fromiter(x, dtype=np.uint64, count=len(x))).tolist() for x in (a, b))
        both = sum(min(k, b[s]) * w for (s, k), w in zip(a.items(), wa) if s in b)
        every = sum(k * w for k, w in zip(a.values(), wa)) + sum(k * w for k, w in zip(b.values(), wb)) - both
        return both / every if every else 0.0


_SHIFT = np.arange(64, dtype=np.uint64)


def _fingerprints(s: np.ndarray, weight: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the shingles begin:end for each pair, from running sums."""
    signs = ((s[:, None] >> _SHIFT) & np.uint64(1)).astype(np.float64) * 2 - 1
    weight = np.round(weight * (1 << 20)) / (1 << 20)         # sums are exact wherever they start
    run = np.concatenate((np.zeros((1, 64)), np.cumsum(signs * weight[:, None], axis=0)))
    bits = (run[end] - run[begin]) > 0
    return (bits.astype(np.uint64) << _SHIFT).sum(axis=1, dtype=np.uint64)


def _index(prints: np.ndarray, radius: int) -> list[dict[int, np.ndarray]]:
    """Per block: items whose block lies within radius // BLOCKS bits of a value."""
    near, width = radius // BLOCKS, 64 // BLOCKS
    values = np.arange(1 << width, dtype=np.uint64)
    out = []
    for b in range(BLOCKS):
        own = (prints >> np.uint64(b * width)) & np.uint64((1 << width) - 1)
        close = np.bitwise_count(values[:, None] ^ own[None, :]) <= near
        out.append({int(v): np.flatnonzero(close[v]) for v in range(1 << width) if close[v].any()})
    return out


def matches(items: Items, words: np.ndarray, least: float = LEAST) -> list[tuple[int, float, int, int]]:
    """(item id, similarity, first word, words) of the best window of each item that one
    document holds; ``words`` are its word hashes."""
    out: dict[int, tuple[float, int, int]] = {}
    n = len(words)
    if not n or not items.ids:
        return []
    runs: dict[int, np.ndarray] = {}
    for size, group in items.by_size.items():
        k = min(size, T.SHINGLE_WORDS)                     # words of a shingle in such an item
        if n < k:
            continue
        if k not in runs:
            s = _runs(words, k)
            rough = np.flatnonzero(items.sieve[(s & np.uint64((1 << 22) - 1)).astype(np.int64)])
            runs[k] = (s, rough[np.isin(s[rough], items.shingles)] if len(rough) else rough)
        s, hits = runs[k]
        if not len(hits):
            continue
        hits = hits[np.isin(s[hits], group["shingles"])]
        if not len(hits):
            continue
        wide = min(size, n) - k + 1                        # shingles of a window
        mark = np.zeros(len(s) + 1, dtype=np.int32)
        np.add.at(mark, np.maximum(0, hits - wide + 1), 1)
        np.add.at(mark, hits + 1, -1)
        begin = np.flatnonzero(np.cumsum(mark[:-1])[:len(s) - wide + 1])
        for piece in np.split(begin, np.flatnonzero(np.diff(begin) > wide) + 1):
            a, b = int(piece[0]), int(piece[-1]) + wide
            part = s[a:b]
            prints = _fingerprints(part, items.weights(part), piece - a, piece - a + wide)
            for at, fp in zip(piece.tolist(), prints):
                cand: set[int] = set()
                for j in range(BLOCKS):
                    cand.update(group["index"][j].get(int(fp >> np.uint64(j * 8)) & 0xFF, _NONE).tolist())
                for c in sorted(cand):
                    item = int(group["at"][c])
                    if int(fp ^ items.prints[item]).bit_count() <= items.radius:
                        sim = items.similarity(item, s[at:at + wide])
                        old = out.get(item)
                        if sim >= least - 1e-12 and (old is None or sim > old[0] + 1e-12):
                            out[item] = (sim, at, min(size, n))
    return [(items.ids[i], sim, at, w) for i, (sim, at, w) in sorted(out.items())]


_NONE = np.empty(0, dtype=np.int64)


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words: of five, or, for shorter items, of their whole length."""
    if k == T.SHINGLE_WORDS:
        return T.shingles(words)
    return np.array([T.sequence_hash(words[i:i + k]) for i in range(len(words) - k + 1)], dtype=np.uint64)


def item_blocks(benchmark: DataFrame, most_words: int = ITEM_WORDS) -> Iterator[Items]:
    """The benchmark in blocks of bounded size; weights come from all of it."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (2 * most_words)))          # a word has two characters or more, with its space
    weights = benchmark_weights(rows)
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], weights=weights)


def benchmark_weights(rows: DataFrame) -> Weights:
    """Weights from all ``rows`` (text): the driver gets the shingles of two items or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches):
            for text in b.column("text").to_pylist():
                s = T.distinct(T.shingles(T.word_hashes(T.utf8([text or ""])[0])[0]))
                yield pa.RecordBatch.from_arrays([pa.array(T.as_signed(s))], names=["s"])

    several = (T.map_batches(rows, ["text"], "s long", run).groupBy("s").agg(F.count("s").alias("k"))
               .where("k > 1").toArrow())
    s, k = T.as_unsigned(several["s"].to_numpy()), several["k"].to_numpy()
    order = np.argsort(s)
    return Weights(rows.count(), s[order], k[order])


def _held(items: Items, texts: list[str | None], least: float):
    for first, held in T.chunks(texts):
        data, starts = T.utf8(held)
        hashes, begin, _ = T.word_hashes(data)
        cuts = np.searchsorted(begin, starts)
        for i in range(len(held)):
            got = matches(items, hashes[cuts[i]:cuts[i + 1]], least)
            if got:
                yield first + i, got


def contaminated(documents: DataFrame, benchmark: DataFrame, least: float = LEAST, most_words: int = ITEM_WORDS) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, similarity, first_word, n_words."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in item_blocks(benchmark, most_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)       # bounded, see item_blocks

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in T.slices(batches):
                ids = b.column("doc_id").to_pylist()
                rows = [(ids[i], *g) for i, got in _held(shared.value, b.column("text").to_pylist(), least) for g in got]
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["doc_id", "item_id", "similarity", "first_word", "n_words"])
        got = docs.mapInArrow(T.bounded(run), "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = got if out is None else out.union(got)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``documents``, all columns, without the rows that hold an item."""
    for items in item_blocks(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in T.slices(batches):
                keep = np.ones(b.num_rows, dtype=bool)
                for i, _ in _held(shared.value, b.column("text").cast(pa.string()).to_pylist(), least):
                    keep[i] = False
                yield b.filter(pa.array(keep))
        documents = documents.mapInArrow(T.bounded(run), documents.schema)
    return documents
