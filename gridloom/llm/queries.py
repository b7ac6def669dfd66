"""The registered queries of this subpackage and their DuckDB oracles.

Each query applies its operator, with production parameters, to its whole table.  Where SQL
cannot express the method there is no oracle and ``tests/llm`` holds the query against brute
force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import (decontaminate, langid, line_dedup, ngram_join, packing, pii, resampling, secrets, sharding,
                          source_audit, tool_calls, topk_search, toxicity)
from gridloom.llm.io import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return keep


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string")) % parts


@_query("op1_tool_calls", tool_calls.SQL)
def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls linked with their results, ordered, validated and written as canonical JSON."""
    return tool_calls.link(*tool_calls.calls_of(read(spark, sf_dir, "conversations")))


@_query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: pattern spans, and those the skip-chain field adds."""
    docs = read(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.train(docs)))


@_query("op3_best_fit")
def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


@_query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(na.n_shingles) + any_value(nb.n_shingles) - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY 1, 2
"""


@_query("op5_ngram_jaccard", OP5_SQL)
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 75 % alike."""
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: pattern spans, and those the linear-chain field adds."""
    docs = read(spark, sf_dir, "documents")
    return pii.digest(secrets.find(docs, secrets.train(docs)), secrets.ALL_KINDS, by_kind=False).drop("n_tagged")


@_query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    model = langid.train(docs.where(_fold(4) != 2))
    return langid.predict(docs, model).select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score")


@_query("op8_topk_search", topk_search.SQL)
def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products of every hundredth vector against all others."""
    return topk_search.top_k(read(spark, sf_dir, "embeddings"))


@_query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best window of each item."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query("op10_histogram_shards")
def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    return sharding.shard(read(spark, sf_dir, "documents"))


@_query("op11_resample", resampling.SQL)
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's word distribution, with ranks."""
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query("op12_source_audit", source_audit.SQL)
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and each source's own terms."""
    return source_audit.audit(read(spark, sf_dir, "documents"))


@_query("op13_line_dedup", line_dedup.SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold, dropped from all but the largest doc_id."""
    docs = read(spark, sf_dir, "documents")
    return line_dedup.digest(docs, line_dedup.keep_bitmaps(docs))
