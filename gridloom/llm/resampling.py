"""Target-distribution importance resampling (operator 11).

Features of a text are its words and pairs of neighbouring words, hashed into ``BUCKETS``
buckets.  A bucket's gain compares its smoothed share in the target texts with that in all
documents; a document's weight is the floored mean of the gains of its features.  Weight plus
Gumbel noise from the document's id is its score; the highest scores are drawn without
replacement.

* Counting and scoring read the texts batch by batch in numpy.  CRC-32 is linear, so a pair's
  value comes from its words' values by table look-ups; no pair is spelled out.  A task sends
  at most ``BUCKETS`` counts; the gains are an array of ``BUCKETS`` longs, whatever the data.
* Ranks come from a distributed LSD radix sort (``radix_ranks``): stable counting-sort passes
  from the lowest digit of the id to the highest digit of the score.  A pass counts digits
  per block, prefix sums over (digit, block) give every row's destination, and rows are
  exchanged by blocks of destinations.  Blocks have equal numbers of rows whatever the keys
  hold, and a checkpoint after each exchange fixes rows and order, so a lost executor cannot
  change a destination already used.

Edge cases: a null or empty text has no features and weight 0; a null ``doc_id`` is hashed as
``7:`` and comes after all ids in ties; rows equal in every column get ranks next to each
other; an empty table gives no rows; without target texts T is 0.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.io import cut
from gridloom.llm.textkit import chunks, map_batches, slices, text_of, utf8, word_spans

BUCKETS = 10_000
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
DIGIT_BITS = 11               # of a pass at most: 2048 counts a block
BLOCK_ROWS = 100_000          # rows of a block at most, beyond four blocks a shuffle partition
SHORT = 64                    # bytes of a word that the tables serve; longer ones go one by one

_APART = np.ones(256, dtype=bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _APART[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@functools.cache
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """(the byte table of the CRC, effect of 0..SHORT zero bytes on each byte of the register)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    moved = np.empty((SHORT + 1, 4, 256), dtype=np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(SHORT):
        moved[n + 1] = step[moved[n] & 0xFF] ^ (moved[n] >> 8)
    return step, moved.reshape(-1)


def _word_crcs(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, all words one byte further at a time."""
    step, _ = _crc_tables()
    out = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    short = lens <= SHORT
    order = np.flatnonzero(short)
    order = order[np.argsort(-lens[order], kind="stable")]
    at, size = starts[order], lens[order]
    state = out[order]
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, side="left"))       # words longer than j bytes
        state[:n] = step[(state[:n] ^ data[at[:n] + j]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(~short):
        out[i] = zlib.crc32(data[starts[i]:starts[i] + lens[i]])
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, bucket) of every feature; in any order."""
    raw, begin = utf8(texts)
    data = _LOWER[raw]
    starts, ends = word_spans(data, _APART)
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    lens = ends - starts
    crc = _word_crcs(data, starts, lens)
    own = text_of(starts, begin)
    left = np.flatnonzero(own[1:] == own[:-1])
    step, moved = _crc_tables()
    a, b, n = ~crc[left], crc[left + 1], lens[left + 1]
    a = ~(step[(a ^ np.uint32(32)) & 0xFF] ^ (a >> 8))         # the first word and a space
    row = np.minimum(n, SHORT) * 1024
    pair = b.copy()
    for k in range(4):
        pair ^= moved[row + (k * 256) + ((a >> np.uint32(8 * k)) & 0xFF)]
    for i in np.flatnonzero(n > SHORT):
        w = left[i] + 1
        pair[i] = zlib.crc32(data[starts[w]:ends[w]], int(a[i]))
    return np.concatenate((own, own[left])), np.concatenate((crc, pair)).astype(np.int64) % BUCKETS


def bucket_counts(table: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in slices(batches):
            for _, texts in chunks(b.column("text").to_pylist()):
                total += np.bincount(features(texts)[1], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])
    part = map_batches(table.select(F.col("text").cast("string").alias("text")), ["text"], "bucket long, n long", run)
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in part.groupBy("bucket").agg(F.sum("n")).collect():       # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000 * log of each bucket's smoothed target share over its source share."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (float(source.sum()) + len(s)) / ((s + 1) * (float(target.sum()) + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def scored(documents: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for at, part in chunks(texts):
                own, bucket = features(part)
                n = np.bincount(own, minlength=len(part)).astype(np.int64)
                total = np.zeros(len(part), dtype=np.int64)
                np.add.at(total, own, gain[bucket])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(part)), pa.array(n), pa.array(weight)],
                                                 names=["doc_id", "n_features", "weight"])
    rows = map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       ["doc_id", "text"], "doc_id long, n_features long, weight long", run)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + noise).cast("long"))


def _number(names: list[str], digit_at: int):
    """nth: how many rows of the same block and digit stand before a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, np.zeros(0, dtype=np.int64)           # digits counted so far in the block at hand
        for b in batches:
            block, digit = b.column("block").to_numpy(), b.column(digit_at).to_numpy()
            nth = np.empty(len(block), dtype=np.int64)
            edges = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)])) if len(block) else [0]
            for i, j in zip(edges[:-1], edges[1:]):             # blocks stand one after the other
                if block[i] != last:
                    last, seen = block[i], np.zeros(1 << DIGIT_BITS, dtype=np.int64)
                order = np.argsort(digit[i:j], kind="stable")
                d = digit[i:j][order]
                first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
                size = np.diff(np.append(first, len(d)))
                nth[i + order] = np.arange(len(d)) - np.repeat(first, size) + seen[d]
                seen[d[first]] += size
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nth)], names=[*names, "nth"])
    return run


def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One counting-sort pass: ``dest``, the place of each row (block, order within it) once
    rows are sorted by ``digit``, rows of one digit keeping their order."""
    names = [*rows.columns, "digit"]
    with_digit = rows.withColumn("digit", digit.cast("int"))
    schema = ", ".join(f"{n} {t}" for n, t in with_digit.dtypes) + ", nth long"
    numbered = with_digit.mapInArrow(_number(names, len(names) - 1), schema)
    counts = cut(numbered.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")))
    below, upto = 0, {}
    for d, n in sorted(tuple(r) for r in counts.groupBy("digit").agg(F.sum("n")).collect()):   # one row a digit
        upto[d], below = below, below + n
    start = F.element_at(F.array(*[F.lit(upto.get(d, 0)) for d in range(max(upto) + 1)]), F.col("digit") + 1)
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("digit", "block", (start + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("base"))
    return numbered.join(base, ["digit", "block"]).withColumn("dest", F.col("base") + F.col("nth")).drop("digit", "nth", "base")


def radix_ranks(rows: DataFrame, score: str, key: str, digit_bits: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``rank`` (from 1) by ``score`` descending, then ``key`` ascending, null keys last.

    ``rows`` must have fixed partitions and order (a checkpoint).  Only digits in which rows
    differ take a pass: one exchange of the rows each, and one row a (block, digit)."""
    n, keys, low, high, most, least = rows.agg(
        F.count(F.lit(1)), F.count(key), F.coalesce(F.min(key), F.lit(0)), F.coalesce(F.max(key), F.lit(0)),
        F.max(score), F.min(score)).first()
    if not n:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    digits = []
    unsigned = F.coalesce(F.col(key), F.lit(high)).bitwiseXOR(F.lit(-2 ** 63))
    for column, bits in ((unsigned, (low ^ high).bit_length() if (low < 0) == (high < 0) else 64),
                         (F.col(key).isNull().cast("int"), int(keys < n)),
                         (F.lit(most) - F.col(score), (most - least).bit_length())):
        passes = -(-bits // digit_bits)
        width = -(-bits // passes) if passes else 0
        digits += [F.shiftrightunsigned(column, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(passes)]
    if not digits:                                     # all rows alike: any order is right
        digits = [F.lit(0)]
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(4 * parts, -(-n // block_rows))
    size = -(-n // blocks)
    columns = rows.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        for b in batches:
            yield b.append_column("block", pa.array(np.full(b.num_rows, me, dtype=np.int64)))

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", block long"
    now = rows.mapInArrow(place, schema)               # the order before the first pass is that of the checkpoint
    for i, digit in enumerate(digits):
        now = _pass(now, digit)
        if i + 1 < len(digits):
            now = now.withColumn("block", F.floor(F.col("dest") / size))
            now = cut(now.repartition(parts, "block").sortWithinPartitions("block", "dest").select(*columns, "block"))
    return now.select(*columns, (F.col("dest") + 1).alias("rank"))


def resample(documents: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null where the row is not drawn."""
    gain = gains(bucket_counts(documents), bucket_counts(target))
    rows = cut(scored(documents, gain, seed))
    enough = F.col("n_features") >= 2 * min_words - 1          # w words: w + (w - 1) features
    taking = cut(rows.where(enough))
    drawn = taking.count() * percent // 100
    ranked = radix_ranks(taking, "score", "doc_id")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return (ranked.withColumn("rank", rank)
            .unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))))


SQL = r"""
WITH RECURSIVE tab(i, b, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, b + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM tab WHERE b < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM tab WHERE b = 8),
src AS (SELECT 'd' AS part, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
w AS (SELECT part, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM src),
f AS (SELECT part, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
g AS (SELECT part, doc_id, f, count(*) AS n FROM f GROUP BY ALL),
u AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM g),
k AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x) // 2),
                lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
                lambda a, y: xor(a >> 8, t[xor(a, y) % 256 + 1])), 4294967295) % 10000 AS k FROM u, crc),
c AS (SELECT k, coalesce(sum(n) FILTER (part = 'd'), 0) AS s, coalesce(sum(n) FILTER (part = 'b'), 0) AS t FROM g JOIN k USING (f) GROUP BY k),
gain AS (SELECT k, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST((SELECT sum(s) FROM c) AS DOUBLE) + 10000)
                / ((CAST(s AS DOUBLE) + 1) * (CAST((SELECT sum(t) FROM c) AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM c),
m AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, CAST(floor(CAST(sum(n * gain) AS DECIMAL(38, 0)) / sum(n)) AS BIGINT) AS weight
      FROM g JOIN k USING (f) JOIN gain USING (k) WHERE part = 'd' GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) AS h FROM documents LEFT JOIN m USING (doc_id)),
e AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM d),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM e WHERE n_features >= 39)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM r) * 25 // 100 THEN rank END AS rank
FROM e LEFT JOIN r USING (doc_id)
"""
