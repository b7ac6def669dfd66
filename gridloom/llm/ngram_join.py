"""N-gram Jaccard join (operator 5).

Sets are the distinct five-word shingles of whole texts, as 64-bit hashes.  Equal sets
form one class; classes are linked where 100 * intersection >= 75 * union.

Method.  Rare shingles first: two linked sets share a shingle among the first
``n - ceil(0.75 n) + 1`` of any common order, so classes meet in the tiles of those
shingles, where a row meets only rows of its size band (``n`` to ``n * 100 / 75``).
Hashed bitmap signatures bound each candidate's overlap from above by bit counts; what
the bound leaves is decided by exact intersection of the sorted arrays.

Skew.  A tile never lists its pairs outright.  Pivot rounds come first: each ties the
classes of a tile that are still alone to one of them, the tile's pivot (in the first round
the row richest in frequent shingles, then one picked by hash), and they go on while a
round ties a twentieth of the classes left.  So every group of near copies becomes a cluster
about a lead at one comparison a copy.  Then only tiles that still hold two components count.
Their leads are compared, and two clusters are looked into only where the triangle inequality
of the Jaccard distance leaves room: ``d(p, q) - r(p) - r(q) <= 0.25``.  Between two clusters of
several members each, a member stays only if what it shares with the union of the
other cluster's sets could make a link; the likeliest member of either side is compared with
all of the other's, and a link there settles the pair.  Members are listed against each
other only where all this leaves both open.  Every step but the last costs one
comparison a member, and no link is lost.  Frequent shingles go to the end of the order.  They are found
from shingles seen twice or more within a block of texts: one held by d texts over t blocks
gathers about d * d / t sightings, so the cut-off follows the square root of their number.
The order, being one and the same for all texts, is free to be any; only speed hangs on it.

Edge cases: null, empty or blank text has no shingles, is linked with nothing and is
its own component; a null ``doc_id`` has a null component; repeated rows come back as often
as they came; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import textkit as T
from gridloom.llm.components import connected
from gridloom.llm.io import cut_close, hashed_set, in_set, shuffles_freed
from gridloom.llm.io import cut_close as cut

SIMILARITY = 75               # percent
FREQUENT = 64                 # sightings from which a shingle counts as frequent
BLOCK_SHINGLES = 2_000_000    # shingles counted together in a task
LEAST_TIED = 20               # pivot rounds go on while one class in so many is tied
SET_ROWS = 500                # sets read in a task, at least
NARROW, WIDE = 1024, 8192     # bits of a signature: up to NARROW shingles, and beyond


def needed_overlap(na, nb, pct: int = SIMILARITY):
    """Smallest intersection of two linked sets of these sizes."""
    return -((-pct * (na + nb)) // (100 + pct))


def prefix_length(n, pct: int = SIMILARITY):
    return n - (-((-pct * n) // 100)) + 1


def class_key(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set (0, 0 for none)."""
    if not len(s):
        return 0, 0
    a = T.mix64(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = T.mix64(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(T.as_signed(np.array([a]))[0]), int(T.as_signed(np.array([b]))[0])


def signature(s: np.ndarray) -> bytes:
    width = NARROW if len(s) <= NARROW else WIDE
    bits = np.zeros(width, dtype=np.uint8)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _shingled(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None):
    """(doc_id, sorted set) of each row; ``wanted``: only ids whose bit is set."""
    for batch in T.slices(batches):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        if wanted is not None:
            at = [i for i, x in enumerate(ids) if x is not None]
            ok = in_set(wanted, T.as_unsigned(np.array([ids[i] for i in at], dtype=np.int64))) if at else []
            keep = [i for i, k in zip(at, ok) if k]
            ids, texts = [ids[i] for i in keep], [texts[i] for i in keep]
        for first, held in T.chunks(texts):
            for i, s in enumerate(T.text_shingles(held)):
                yield ids[first + i], s


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: size, class and signature; per block of texts the shingles seen twice or more."""
    rows, seen, held, total = [], set(), [], 0

    def out(rows):
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary()),
             pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64())],
            names=["doc_id", "n", "cls", "cls2", "bits", "hot", "seen"])

    def repeats(held):
        keys, n = _counts(np.concatenate(held)) if held else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        keys, n = keys[n >= 2], n[n >= 2]
        for i in range(0, len(keys), 100_000):
            k, c = T.as_signed(keys[i:i + 100_000]), n[i:i + 100_000]
            none = pa.nulls(len(k), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(k), pa.binary()),
                                              pa.array(k), pa.array(c)],
                                             names=["doc_id", "n", "cls", "cls2", "bits", "hot", "seen"])

    for doc_id, s in _shingled(batches):
        a, b = class_key(s)
        # rows without id are in no class: their signature would be lost with them
        first = doc_id is not None and len(s) and (a, b) not in seen
        rows.append((doc_id, len(s), a, b, signature(s) if first else b""))
        if first:
            seen.add((a, b))
            held.append(s)
            total += len(held[-1])
        if len(rows) >= 2000:
            yield out(rows)
            rows = []
        if total >= BLOCK_SHINGLES:
            yield from repeats(held)
            held, total = [], 0
    if rows:
        yield out(rows)
    yield from repeats(held)


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each comes."""
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return x[at], np.diff(np.append(at, len(x)))


def _postings(frequent: np.ndarray, pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out, size = set(), [], 0

        def flush():
            cols = [np.concatenate([x[i] for x in out]) for i in range(6)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["s", "cls", "n", "rest", "hot", "rich"])

        for _, s in _shingled(batches):
            key = class_key(s)
            if not len(s) or key in seen:
                continue
            seen.add(key)
            hot = in_set(frequent, s)
            p = prefix_length(len(s), pct)
            rare = s[~hot][:p]
            tail = s[hot][:p - len(rare)]
            k = len(rare) + len(tail)
            # shingles from this one on, in the common order: the most that a text met here
            # for the first time can share
            at = np.arange(len(s), len(s) - k, -1, dtype=np.int32)
            out.append((T.as_signed(np.concatenate((rare, tail))), np.full(k, key[0], dtype=np.int64),
                        np.full(k, len(s), dtype=np.int32), at, np.repeat(np.array([False, True]), [len(rare), len(tail)]),
                        np.full(k, hot.sum(), dtype=np.int32)))
            size += k
            if size >= 200_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()
    return run


def _shared(pct: int):
    """Of a partition that holds whole tiles of rarer shingles: rows of tiles with two
    classes or more that can be linked there, each class once, with the tile's pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        s, cls, n, rest = (t.column(c).to_numpy() for c in ("s", "cls", "n", "rest"))
        order = np.argsort(s, kind="stable")
        s, cls, n, rest = s[order], cls[order], n[order], rest[order]
        start = np.concatenate(([True], s[1:] != s[:-1]))
        many = ~(start & np.concatenate((start[1:], [True])))
        s, cls, n, rest = s[many], cls[many], n[many].astype(np.int64), rest[many]
        if not len(s):
            return
        order = np.lexsort((cls, n, s))
        s, cls, n, rest = s[order], cls[order], n[order], rest[order]
        # a class comes once from each task that holds a copy of it
        once = np.concatenate(([True], (s[1:] != s[:-1]) | (cls[1:] != cls[:-1])))
        s, cls, n, rest = s[once], cls[once], n[once], rest[once]
        for _ in range(2):                          # the second time without those dropped first
            if not len(s):
                return
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            size = np.diff(np.append(first, len(s)))
            least, most = np.repeat(n[first], size), np.repeat(n[first + size - 1], size)
            mate = np.maximum(least, -((-pct * n) // 100))
            fit = (np.repeat(size, size) > 1) & (needed_overlap(n, mate, pct) <= rest) & (100 * n >= pct * least)
            fit &= mate <= most
            s, cls, n, rest = s[fit], cls[fit], n[fit], rest[fit]
        if not len(s):
            return
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        size = np.diff(np.append(first, len(s)))
        top = np.repeat(first + size - 1, size)
        keep = np.repeat(size > 1, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep].astype(k)) for x, k in ((s, np.int64), (cls, np.int64), (n, np.int32), (rest, np.int32),
                                                      (cls[top], np.int64), (n[top], np.int32))],
            names=["s", "cls", "n", "rest", "pivot", "pn"])
    return run


def _bound(pct: int):
    """Adds the upper bound of the overlap from the bit counts of two signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = b.column("na").to_numpy().astype(np.int64), b.column("nb").to_numpy().astype(np.int64)
            most = np.minimum(na, nb)
            xs, ys = b.column("bits_a").to_pylist(), b.column("bits_b").to_pylist()
            pairs: dict[int, list[int]] = {}
            for i, (x, y) in enumerate(zip(xs, ys)):
                pairs.setdefault(min(len(x), len(y)), []).append(i)
            for w, at in pairs.items():
                x = np.stack([_fold(xs[i], w) for i in at])
                y = np.stack([_fold(ys[i], w) for i in at])
                for own, other, n in ((x, y, na), (y, x, nb)):
                    alone = np.bitwise_count(own & ~other).sum(axis=1, dtype=np.int64)
                    most[at] = np.minimum(most[at], n[at] - alone)
            cols = [b.column(c) for c in ("a", "b", "na", "nb", "rep_a", "rep_b")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(most)], names=["a", "b", "na", "nb", "rep_a", "rep_b", "most"])
    return run


def _fold(bits: bytes, width: int) -> np.ndarray:
    x = np.frombuffer(bits, dtype=np.uint64)
    return np.bitwise_or.reduce(x.reshape(-1, width // 8), axis=0) if len(bits) > width else x


def _sets(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, size = [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "set"])

        for _, s in _shingled(batches, wanted):
            keys.append(class_key(s)[0])
            sets.append(s.tobytes())
            size += len(sets[-1])
            if size >= 8_000_000:
                yield out()
                keys, sets, size = [], [], 0
        if keys:
            yield out()
    return run


def with_class(documents: DataFrame) -> DataFrame:
    """``documents`` with ``class_id``, the class of each text; null without words."""
    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes) + ", class_id long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches):
            found = [class_key(s)[0] if len(s) else None for _, held in T.chunks(b.column("text").to_pylist())
                     for s in T.text_shingles(held)]
            yield b.append_column("class_id", pa.array(found, pa.int64()))
    return documents.mapInArrow(T.bounded(run), schema)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = [len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64),
                                   assume_unique=True))
                for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("a", "b", "na", "nb")), pa.array(both, pa.int64())],
                                         names=["a", "b", "na", "nb", "both"])


class _Verifier:
    """Decides pairs of classes: bitmap bound first, then exact intersection."""

    def __init__(self, docs: DataFrame, classes: DataFrame, pct: int):
        self.docs, self.classes, self.pct = docs, classes, pct

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, na, nb) with the ids that stand for their classes and ``most``, the bound on their overlap."""
        c = self.classes
        side = lambda x: c.select(F.col("cls").alias(x), *(F.col(y).alias(f"{y}_{x}") for y in ("bits", "rep")))
        return (pairs.join(side("a"), "a").join(side("b"), "b")
                .select("a", "b", "na", "nb", "rep_a", "rep_b", "bits_a", "bits_b")
                .mapInArrow(T.bounded(_bound(self.pct)),
                            "a long, b long, na long, nb long, rep_a long, rep_b long, most long"))

    def sets(self, need: DataFrame) -> DataFrame:
        """(cls, set) of the classes in ``need`` (cls, rep), read from the texts anew."""
        return cut_close(T.map_batches(self.docs, ["doc_id", "text"], "cls long, set binary", _sets(hashed_set(need, "rep")))
                         .join(need.select("cls").distinct(), "cls").groupBy("cls").agg(F.first("set").alias("set")), SET_ROWS)

    def links(self, bounded: DataFrame) -> DataFrame:
        """Linked pairs (a, b, na, nb, both)."""
        p = self.pct
        left = cut(bounded.where(F.expr(f"most * {100 + p} >= {p} * (na + nb)")))
        if left.isEmpty():
            return left.select("a", "b", "na", "nb", F.lit(0).cast("long").alias("both")).limit(0)
        sets = self.sets(left.selectExpr("inline(array(struct(a AS cls, rep_a AS rep), struct(b AS cls, rep_b AS rep)))"))
        side = lambda x: sets.select(F.col("cls").alias(x), F.col("set").alias(f"set_{x}"))
        return cut(left.join(side("a"), "a").join(side("b"), "b")
                   .select("a", "b", "na", "nb", "set_a", "set_b")
                   .mapInArrow(T.bounded(_overlaps), "a long, b long, na long, nb long, both long")
                   .where(F.expr(f"both * {100 + p} >= {p} * (na + nb)")))


def _stars(tiles: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b, na, nb): each class with the pivot that it meets in most of ``tiles``."""
    return cut(tiles.where("cls <> pivot").where(_in_band("n", "pn", pct))
               .groupBy("cls", "pivot").agg(F.count(F.lit(1)).alias("k"), F.max("n").cast("long").alias("na"),
                                            F.max("pn").cast("long").alias("nb"))
               .groupBy(F.col("cls").alias("a")).agg(F.max(F.struct("k", "nb", "pivot", "na")).alias("m"))
               .select("a", F.col("m.pivot").alias("b"), "m.na", "m.nb"))


def _in_band(na: str, nb: str, pct: int) -> str:
    return f"100 * least({na}, {nb}) >= {pct} * greatest({na}, {nb})"


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for cls, held in zip(b.column("cls").to_pylist(), b.column("set").to_pylist()):
            s = np.frombuffer(held, dtype=np.int64)
            for i in range(0, len(s), 100_000):
                part = s[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), cls, dtype=np.int64)), pa.array(part)],
                                                 names=["cls", "g"])


def _between(check: _Verifier, near: DataFrame, members: DataFrame, pct: int) -> tuple[DataFrame, DataFrame]:
    """Clusters of several members each (``near``: pairs of leads pa < pb; ``members``: cls, n, lead).

    Returns links (a, b, na, nb, both) between them, and (cls, other): members that cannot be linked
    with any of the other lead's.  Pairs of clusters with no more pairs of members than members
    are left as they are."""
    none = near.select(F.col("pa").alias("a"), F.col("pb").alias("b"), *(F.lit(0).cast("long").alias(x) for x in ("na", "nb", "both"))).limit(0)
    size = members.groupBy("lead").agg(F.count("cls").alias("k"), F.min("n").alias("least"), F.max("n").alias("most"))
    side = lambda x, y: size.select(F.col("lead").alias(x), *(F.col(c).alias(f"{c}_{y}") for c in ("k", "least", "most")))
    wide = cut(near.join(side("pa", "a"), "pa").join(side("pb", "b"), "pb").where("k_a * k_b > k_a + k_b"))
    arms = (wide.select(F.col("pa").alias("lead"), F.col("pb").alias("other"), F.col("least_b").alias("least"), F.col("most_b").alias("most"))
               .union(wide.select("pb", "pa", "least_a", "most_a")).join(members, "lead"))
    if wide.isEmpty():
        return none, none.select(F.col("a").alias("cls"), F.col("b").alias("other"))
    need = cut(arms.select("cls").distinct().join(check.classes.select("cls", "rep"), "cls"))
    each = cut(check.sets(need).mapInArrow(T.bounded(_elements), "cls long, g long"))
    union = each.join(members.select("cls", "lead"), "cls").select(F.col("lead").alias("other"), "g").distinct()
    share = (arms.select("cls", "other").join(each, "cls").join(union, ["other", "g"])
             .groupBy("cls", "other").agg(F.count(F.lit(1)).alias("share")))
    mate = f"greatest(least, cast(ceil({pct} * n / 100) AS bigint))"     # the smallest that could be linked
    arms = cut(arms.join(share, ["cls", "other"], "left").withColumn("share", F.coalesce("share", F.lit(0)))
               .withColumn("open", F.expr(f"{mate} <= most AND share * {100 + pct} >= {pct} * (n + {mate})")))
    open_ = arms.where("open")
    best = (open_.groupBy("lead", "other").agg(F.max(F.struct(F.expr(f"share * {100 + pct} - {pct} * n").alias("room"), "cls", "n")).alias("m"))
            .select(F.col("lead").alias("other"), F.col("other").alias("lead"), F.col("m.cls").alias("b"), F.col("m.n").alias("nb")))
    pairs = (open_.join(best, ["lead", "other"]).where(_in_band("n", "nb", pct))
             .select(F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b"),
                     F.expr("if(cls < b, n, nb)").alias("na"), F.expr("if(cls < b, nb, n)").alias("nb")).distinct())
    return check.links(check.bounded(cut(pairs))), cut(arms.where("NOT open").select("cls", "other"))


def jaccard_components(documents: DataFrame, pct: int = SIMILARITY, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id, class_id (of
    equal sets) and component_class (which tells components apart where an id has several texts)."""
    with shuffles_freed(documents.sparkSession):
        return _components(documents, pct, frequent)


def _components(documents: DataFrame, pct: int, frequent: int) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = cut(T.map_batches(docs, ["doc_id", "text"],
                               "doc_id long, n long, cls long, cls2 long, bits binary, hot long, seen long", _sketch))
    rows = sketch.where("n IS NOT NULL").select("doc_id", "n", "cls", "cls2", "bits")
    hot = sketch.where("hot IS NOT NULL").groupBy("hot").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= frequent)
    bits = hashed_set(hot, "hot")

    classes = cut(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("cls")
                  .agg(F.min("doc_id").alias("rep"), F.max("n").cast("long").alias("n"),
                       F.max("bits").alias("bits"),
                       (F.min("n") != F.max("n")).alias("n_off"), (F.min("cls2") != F.max("cls2")).alias("c_off")))
    if not classes.where("n_off OR c_off").isEmpty():
        raise RuntimeError("two different sets share a 64-bit class hash; change the constants of class_key")

    post = T.map_batches(docs.where("doc_id IS NOT NULL"), ["doc_id", "text"],
                         "s long, cls long, n int, rest int, hot boolean, rich int", _postings(bits, pct))
    # tiles of rarer shingles meet whole in one task; those of frequent ones are only
    # aggregated (partial minima and maxima) and joined, so none of them is ever gathered
    rare = cut(post.where("NOT hot").select("s", "cls", "n", "rest").repartition(F.col("s"))
               .mapInArrow(T.bounded(_shared(pct)), "s long, cls long, n int, rest int, pivot long, pn int"))
    tail = cut(post.where("hot").select("s", "cls", "n", "rest", "rich").distinct())
    low = tail.groupBy("s").agg(F.min("n").alias("low"), F.count("cls").alias("k")).where("k > 1").drop("k")
    mate = f"greatest(low, cast(ceil({pct} * n / 100) AS int))"
    tail = cut(tail.join(low, "s").where(F.expr(f"rest * {100 + pct} >= {pct} * (n + {mate})")).drop("low"))
    pivots = (tail.groupBy("s").agg(F.max(F.struct("rich", "n", "cls")).alias("p"), F.count("cls").alias("k"))
              .where("k > 1").select("s", F.col("p.cls").alias("pivot"), F.col("p.n").alias("pn")))
    tail = cut(tail.join(pivots, "s").select("s", "cls", "n", "rest", "pivot", "pn"))
    tiles = rare.union(tail)

    check = _Verifier(docs, classes, pct)
    first = check.links(check.bounded(_stars(tiles, pct)))
    for turn in itertools.count(1):
        tied = first.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        free = tiles.select("s", "cls", "n").join(tied, "cls", "left_anti")
        pivots = (free.groupBy("s").agg(F.max(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "n", "cls")).alias("p"),
                                        F.count("cls").alias("k"))
                  .where("k > 1").select("s", F.col("p.cls").alias("pivot"), F.col("p.n").alias("pn")))
        stars = _stars(free.join(pivots, "s"), pct)
        if stars.isEmpty():
            break
        more = check.links(check.bounded(stars))
        first = first.union(more)
        if LEAST_TIED * more.count() <= stars.count():
            break
    first = cut(first)
    label = connected(first)

    # tiles that still hold two components
    dist = F.expr("1 - both / (na + nb - both)")
    centre = first.select(F.col("b").alias("cls")).distinct()
    arm = (first.join(centre.select(F.col("cls").alias("a")), "a", "left_anti")
           .groupBy(F.col("a").alias("cls")).agg(F.min(F.struct(dist.alias("d"), F.col("b").alias("lead"),
                                                               F.col("nb").alias("ln"))).alias("m"))
           .select("cls", "m.d", "m.lead", "m.ln"))
    known = cut(label.withColumnRenamed("node", "cls").join(arm, "cls", "left"))
    named = (tiles.select("s", "cls", F.col("n").cast("long").alias("n"), "rest").join(known, "cls", "left")
             .select("s", "cls", "n", "rest", F.coalesce("label", "cls").alias("label"),
                     F.coalesce("lead", "cls").alias("lead"), F.coalesce("ln", "n").alias("ln"),
                     F.coalesce("d", F.lit(0.0)).alias("d")))
    split = (named.groupBy("s").agg(F.min("label").alias("l1"), F.max("label").alias("l2"))
             .where("l1 <> l2").select("s"))
    open_ = cut(named.join(split, "s"))
    lead = cut(open_.groupBy("s", "lead", "ln", "label").agg(F.max("d").alias("r"), F.max("rest").alias("rest")))
    # a row that stands for itself alone obeys the bounds of its own tile
    x = lead.select("s", F.col("lead").alias("a"), F.col("ln").alias("na"), F.col("label").alias("la"), F.col("r").alias("ra"),
                    F.when(F.col("r") == 0, F.col("rest")).alias("ta"))
    y = lead.select("s", F.col("lead").alias("b"), F.col("ln").alias("nb"), F.col("label").alias("lb"), F.col("r").alias("rb"),
                    F.when(F.col("r") == 0, F.col("rest")).alias("tb"))
    alone = f"(ra + rb > 0 OR least(ta, tb) * {100 + pct} >= {pct} * (na + nb))"
    # two rows of r(p) and r(q) at most 0.25 from their pivots are in one band only if
    # the pivots are in a band wider by as much on either side
    leads = (x.join(y, "s").where("a < b AND la <> lb").where(alone)
             .where(f"(ra + rb > 0 AND 100 * least(na, nb) >= {pct} * greatest(na, nb) * 0.5) OR "
                    + _in_band("na", "nb", pct))
             .groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"),
                                    F.max("ra").alias("ra"), F.max("rb").alias("rb")))
    leads = cut(leads)
    near = (check.bounded(leads.select("a", "b", "na", "nb")).join(leads.select("a", "b", "ra", "rb"), ["a", "b"])
            .where(F.expr(f"1 - most / (na + nb - most) - ra - rb <= {(100 - pct) / 100} + 1e-9"))
            .select(F.col("a").alias("pa"), F.col("b").alias("pb")))
    near = cut(near)
    both = near.union(near.select(F.col("pb").alias("pa"), F.col("pa").alias("pb")))
    members = cut(open_.groupBy("cls").agg(F.max("n").alias("n"), F.first("lead").alias("lead"))
                  .join(both.select(F.col("pa").alias("lead")).distinct(), "lead", "left_semi"))
    found, closed = _between(check, near, members, pct)
    if not found.isEmpty():
        first = first.union(found)
        label = connected(first)
    now = label.withColumnRenamed("node", "cls").withColumnRenamed("label", "now")
    m = (open_.select("s", "cls", "n", "rest", "lead").join(members.select("cls"), "cls", "left_semi")
         .join(now, "cls", "left").withColumn("now", F.coalesce("now", "cls")))
    m1 = m.select("s", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("now").alias("la"), F.col("lead").alias("pa"),
                  F.col("rest").alias("ta"))
    m2 = m.select("s", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("now").alias("lb"), F.col("lead").alias("pb"),
                  F.col("rest").alias("tb"))
    # a member goes into a tile's join once for each cluster there that it is still open to
    meets = cut(x.join(y, "s").where("a < b AND la <> lb").select("s", F.col("a").alias("pa"), F.col("b").alias("pb"))
                .join(near, ["pa", "pb"], "left_semi"))
    m1 = (m1.join(meets, ["s", "pa"]).join(closed.select(F.col("cls").alias("a"), F.col("other").alias("pb")), ["a", "pb"], "left_anti"))
    m2 = (m2.join(meets, ["s", "pb"]).join(closed.select(F.col("cls").alias("b"), F.col("other").alias("pa")), ["b", "pa"], "left_anti"))
    rest = (m1.join(m2, ["s", "pa", "pb"]).where("la <> lb").where(_in_band("na", "nb", pct))
            .where(f"least(ta, tb) * {100 + pct} >= {pct} * (na + nb)")
            .groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb")))
    second = check.links(check.bounded(cut(rest)))

    final = label if second.isEmpty() else connected(first.select("a", "b").union(second.select("a", "b")))
    ids = (classes.select("cls", "rep").join(final.withColumnRenamed("node", "cls"), "cls", "left")
           .select("cls", "rep", F.coalesce("label", "cls").alias("label")))
    least = ids.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = ids.join(least, "label").select("cls", "component_id", "label")
    own = F.when(F.col("n") == 0, F.col("doc_id"))
    return (rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
            .join(named, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", own)).alias("component_id"),
                    F.col("cls").alias("class_id"), F.col("label").alias("component_class")))
