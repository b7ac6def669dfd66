"""Exact top-k search by ball trees, one per shard (operator 8).

Vectors become integers floor(1024 * x).  Rows are dealt to shards by hash of their id; each
shard builds a ball tree.  A query meets a node only if its upper bound
``q . centre + |q| * radius`` reaches the k-th score known so far; leaves are
taken by descending bound.  Queries go to every shard, shards in
waves: what a wave finds for a query gives the k-th score that the next wave starts from.

The scores are exact integers; ties go to the smaller vec_id.  Edge cases: vectors that are
null or hold a null or non-finite component take no part, nor do rows with a null vec_id or
an empty vector; a query meets vectors of its own dimension; fewer than k candidates
give as many rows; a repeated vec_id is a candidate as often as it comes but never
for its own id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.io import cut

K = 10
SCALE = 1024
SHARD_ROWS = 8192             # vectors in a shard, about
LEAF = 48
EVERY = 100                   # queries: vec_id divisible by this
_EXACT = 2.0 ** 52            # sums below this are exact in doubles


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(F.coalesce(ok, F.lit(False)))
            .select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v")))


def build_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list]:
    """Row order, and nodes (begin, end, centre, radius, left, right); -1: a leaf."""
    order = np.arange(len(x))
    nodes: list = []
    todo = [(0, len(x), None, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        rows = order[a:b]
        part = x[rows]
        centre = part.mean(axis=0)
        radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-6
        me = len(nodes)
        nodes.append([a, b, centre, radius, -1, -1])
        if parent is not None:
            nodes[parent][4 + side] = me
        if b - a > leaf:
            # split across the two rows that lie farthest apart, roughly
            p = part[((part - part[0]) ** 2).sum(axis=1).argmax()]
            q = part[((part - p) ** 2).sum(axis=1).argmax()]
            place = np.argsort(part @ (q - p), kind="stable")
            order[a:b] = rows[place]
            mid = (a + b) // 2
            todo += [(mid, b, me, 1), (a, mid, me, 0)]
    return order, nodes


def dot(x: np.ndarray, q: np.ndarray) -> list[int] | np.ndarray:
    """Exact integer products; in doubles where those are exact, else in whole numbers of
    any size held to the range of a long."""
    if len(x) and float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1] < _EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    top = 2 ** 63 - 1
    return np.array([max(-top - 1, min(top, sum(int(a) * int(b) for a, b in zip(r, q)))) for r in x], dtype=object)


class Shard:
    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order, self.nodes = build_tree(x.astype(np.float64))
        self.ids, self.x = ids[order], x[order]
        self.centres = np.stack([n[2] for n in self.nodes])
        self.radii = np.array([n[3] for n in self.nodes])

    def search(self, own: int, q: np.ndarray, k: int, floor_: int | None) -> list[tuple[int, int]]:
        """The k best (score, vec_id) that reach ``floor_``, the k-th score known elsewhere."""
        f = q.astype(np.float64)
        bound = self.centres @ f + np.sqrt(f @ f) * self.radii
        bound = bound + np.abs(bound) * 1e-9 + 1.0
        best: list[tuple[int, int]] = []
        kth = floor_ if floor_ is not None else -(2 ** 63)
        heap = [(-bound[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            if -b < kth:
                break
            a, e, _, _, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= kth:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            scores = dot(self.x[a:e], q)
            for i in np.flatnonzero((scores >= kth) & (self.ids[a:e] != own)):
                best.append((int(scores[i]), int(self.ids[a + i])))
            if len(best) > k:
                best = sorted(best, key=lambda s: (-s[0], s[1]))[:k]
            if len(best) == k:
                kth = max(kth, min(s for s, _ in best))
        return sorted(best, key=lambda s: (-s[0], s[1]))[:k]


def _search(k: int):
    """Rows sorted by shard, its vectors before its queries."""
    names = ["qn", "query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vecs, shard = None, [], [], None
        for b in batches:
            out = []
            for key, own, qn, v, low in zip(*(b.column(c).to_pylist() for c in ("key", "vec_id", "qn", "v", "low"))):
                if key != at:
                    at, ids, vecs, shard = key, [], [], None
                if qn is None:
                    ids.append(own)
                    vecs.append(np.frombuffer(v, dtype=np.int64))
                    continue
                if shard is None and ids:
                    shard = Shard(np.array(ids, dtype=np.int64), np.stack(vecs))
                    vecs = []
                if shard is not None:
                    out += [(qn, own, i, s) for s, i in shard.search(own, np.frombuffer(v, dtype=np.int64), k, low)]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)
    return run


def _packed(df: DataFrame, columns: str) -> DataFrame:
    """``v`` as bytes: one compact value instead of a long list, on every exchange."""
    keep = [c for c in df.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [np.array(x, dtype=np.int64).tobytes() for x in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(v, pa.binary())], names=[*keep, "v"])
    return df.select(*keep, "v").mapInArrow(run, columns)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score."""
    x = integers(vectors).withColumn("dim", F.size("v"))
    x = cut(_packed(x, "vec_id long, dim int, v binary"))
    n = x.count()
    shards = max(1, -(-n // shard_rows))
    sharded = x.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(shards)).cast("int"))
    queries = cut(x.where(F.col("vec_id") % every == 0)
                  .withColumn("qn", F.monotonically_increasing_id())
                  .withColumn("home", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(shards)).cast("int")))
    found = None
    done, width = 0, 1
    while done < shards:
        upto = min(shards, done + width)
        ask = queries
        if found is not None:
            # the k-th best so far: nothing below it can enter the answer
            kth = (found.withColumn("r", F.row_number().over(Window.partitionBy("qn").orderBy(F.desc("score"), "vec_id")))
                   .where(F.col("r") == k).select("qn", F.col("score").alias("low")))
            ask = ask.join(kth, "qn", "left")
        else:
            ask = ask.withColumn("low", F.lit(None).cast("long"))
        sent = (ask.withColumn("shard", F.explode(F.expr(f"transform(sequence({done}, {upto - 1}), i -> cast(pmod(home + i, {shards}) AS int))")))
                .select("shard", "dim", "vec_id", "qn", "v", "low"))
        rows = sharded.select("shard", "dim", "vec_id", F.lit(None).cast("long").alias("qn"), "v", F.lit(None).cast("long").alias("low"))
        got = (rows.union(sent).withColumn("key", F.concat_ws(":", "shard", "dim"))
               .repartition(max(1, min(shards, 4096)), "key").sortWithinPartitions("key", F.asc_nulls_first("qn"))
               .select("key", "vec_id", "qn", "v", "low")
               .mapInArrow(_search(k), "qn long, query_id long, vec_id long, score long"))
        found = cut(got if found is None else found.union(got))
        done, width = upto, width * 8
    order = Window.partitionBy("qn").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM x q JOIN x c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
