"""Source divergence audit (operator 12): how far the sources of a language differ in their terms.

* Counting is one Arrow compute pipeline inside ``mapInArrow``: ``ascii_lower``,
  ``split_pattern_regex``, ``dictionary_encode``, then a hash ``group_by`` per (row, term) and
  per (language, source, term).  A task merges its partial counts, again by ``group_by``, and
  sends them on whenever ``HELD_ROWS`` of them are held.
* Counts are merged in Spark by (language, term); the terms that at least ``MIN_DOCS`` rows of
  the language hold stay.  They are dealt into shards by hash, each with at most about
  ``SHARD_TERMS`` terms and ``SHARD_CELLS`` (term, source) cells.  Every shard also gets one
  row for each source of its language, so that terms a source lacks are counted too.
* A shard makes one dense array source x term of shares, adds up absolute differences for
  each pair of sources, and keeps its best ``TERM_RANKS`` terms of each source.  Sums and best terms
  of all shards are merged by Spark.  Shares are whole numbers; all arithmetic is exact.

No group holds more than one shard or the pairs of one language's sources (which the
report lists by contract).  Nothing but one row of maxima goes to the driver.

Edge cases: null text, lang and source are read as ''; a source without terms, or a language
without kept terms (all its pairs are 0), still gets its rows; repeated rows each count as a
document; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.io import cut
from gridloom.llm.textkit import map_batches

MIN_DOCS = 30
PRIOR = 5
UNIT = 1_000_000_000
TERM_RANKS = 50
SHARD_TERMS = 1024
SHARD_CELLS = 1 << 20
HELD_ROWS = 400_000           # partial counts a task holds before it sends them on
SLICE_BYTES = 4_000_000       # text handled at once
_APART = r"[\x00-\x60\x7B-\x7F]+"     # after ascii_lower no A-Z is left


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``SLICE_BYTES`` of text; a text is never cut."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _merge(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts).combine_chunks()
    return (t.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
            .select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"]))


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and rows of each (lang, source, term) in some rows."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=_APART)
    row, term = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(term, "")                     # the split leaves '' at the ends
    code = pc.dictionary_encode(term.filter(real))
    by_row = (pa.table({"row": row.filter(real), "code": code.indices})
              .group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")]))
    keys = pa.table({"lang": batch.column("lang"), "source": batch.column("source")}).take(by_row["row"])
    t = pa.table({"lang": keys["lang"], "source": keys["source"], "code": by_row["code"], "n": by_row["count_all"]})
    t = t.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table({"lang": t["lang"], "source": t["source"], "term": code.dictionary.take(t["code"].combine_chunks()),
                     "n": pc.cast(t["n_sum"], pa.int64()), "docs": pc.cast(t["count_all"], pa.int64())})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for part in _slices(batch):
            held.append(_counted(part))
            rows += held[-1].num_rows
            if rows > HELD_ROWS:
                held = [_merge(held)]
                rows = held[0].num_rows
                if rows > HELD_ROWS // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, rows = [], 0
    if held:
        yield from _merge(held).to_batches(max_chunksize=50_000)


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows): partial counts of the tasks, not yet merged."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = documents.select(as_text("text"), as_text("lang"), as_text("source"))
    return map_batches(rows, ["text", "lang", "source"], "lang string, source string, term string, n long, docs long", _count)


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * count / total) for 0 <= count <= total, by long division in base 1000."""
    out, rest = count // total, count % total
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return out + 1


def _compare(table: pa.Table) -> pa.Table:
    """One shard: partial sums of each pair of sources, best terms of each source."""
    names = ["lang", "source", "part", "item", "value"]
    kinds = [pa.string()] * 4 + [pa.int64()]
    groups = table.filter(pc.is_null(table["term"]))
    order = np.argsort(np.array(groups["source"].to_pylist(), dtype=object), kind="stable")
    sources = [groups["source"][int(i)].as_py() for i in order]
    size, terms_of_lang, lang_size = (groups[c].to_numpy()[order] for c in ("n", "kept", "lang_n"))
    lang = table["lang"][0].as_py()
    cells = table.filter(pc.is_valid(table["term"]))
    code = pc.dictionary_encode(cells["term"].combine_chunks())
    terms, col = code.dictionary.to_pylist(), code.indices.to_numpy()
    at = {s: i for i, s in enumerate(sources)}
    row = np.fromiter((at[s] for s in cells["source"].to_pylist()), dtype=np.int64, count=cells.num_rows)
    count = np.zeros((len(sources), len(terms)), dtype=np.int64)
    count[row, col] = cells["n"].to_numpy()
    v = int(terms_of_lang[0])
    out: list[tuple] = []
    if v:
        p = _share(count + PRIOR, (size + PRIOR * v)[:, None])
        q = _share(count.sum(axis=0) + PRIOR, np.int64(lang_size[0] + PRIOR * v))
    else:
        p, q = count, count[:0].sum(axis=0)
    for i, a in enumerate(sources):
        f = np.abs(p[i + 1:] - p[i]).sum(axis=1)
        out += [(lang, a, "pair", b, int(x)) for b, x in zip(sources[i + 1:], f)]
        more = p[i] - q
        best = np.flatnonzero((count[i] > 0) & (more > 0)) if v else []
        best = sorted(((-int(more[j]), terms[j].encode(), terms[j]) for j in best))[:TERM_RANKS]
        out += [(lang, a, "term", t, -x) for x, _, t in best]
    return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(zip(names, kinds))})


def audit(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: distances of each source to the others of its
    language (``pair``), and the terms it uses more than its language does (``term``)."""
    merged = (term_counts(documents).repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = cut(merged.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("of"))
               .where(F.col("docs") >= min_docs).select("lang", "term", "of"))
    counts = kept.select("lang", "term", F.inline("of"))
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    per_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum(
        F.aggregate("of", F.lit(0).cast("long"), lambda x, y: x + y["n"])).alias("lang_n"))
    groups = (documents.select(as_text("lang"), as_text("source")).distinct()
              .join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0, ["n", "kept", "lang_n"]))
    groups = cut(groups)
    most = groups.groupBy("lang").agg(F.max("kept").alias("v"), F.count(F.lit(1)).alias("s")).agg(
        F.max("v").alias("v"), F.max(F.col("v") * F.col("s")).alias("cells")).first()
    shards = max(1, -(-(most.v or 0) // SHARD_TERMS), -(-(most.cells or 0) // SHARD_CELLS))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard")
    none = F.lit(0).cast("long")
    cells = counts.select("lang", shard, "source", "term", "n", none.alias("kept"), none.alias("lang_n"))
    every = F.explode(F.sequence(F.lit(0), F.when(F.col("kept") > 0, F.lit(shards - 1)).otherwise(F.lit(0)))).alias("shard")
    heads = groups.select("lang", every, "source", F.lit(None).cast("string").alias("term"), "n", "kept", "lang_n")
    parts = cut(cells.unionByName(heads).groupBy("lang", "shard").applyInArrow(
        _compare, "lang string, source string, part string, item string, value long"))
    sums = (parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    pairs = sums.select("lang", F.inline(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))),
                        F.lit("pair").alias("part"), "value")
    rows = pairs.select("lang", "source", "part", "item", "value").unionByName(parts.where("part = 'term'"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= TERM_RANKS))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (gn.n + 5 * v.v) AS p
      FROM gn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
q AS (SELECT t.lang, t.term, 1 + (CAST(1000000000 AS HUGEINT) * (t.n + 5)) // (s.n + 5 * v.v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) t JOIN (SELECT lang, sum(n) AS n FROM c GROUP BY ALL) s USING (lang) JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, (SELECT coalesce(sum(abs(x.p - y.p)), 0) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
            WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
t AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM t)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 50
"""
