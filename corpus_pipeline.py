"""Corpus pipeline: language ID, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, langid, ngram_join, packing, secrets
from gridloom.llm.io import cut_close, hashed_set, read, rows_in_set
from gridloom.session import checkpoint_root

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose language is told; learned from the labelled rows outside op7's
    held-out fold.  Null texts and texts without a letter go; repeated rows all stay or all go."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    return langid.accepted(docs.select(*COLUMNS), langid.train(docs.where(fold != 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked ones: that with the smallest id, and of
    several texts under that id the one with the smallest class; of rows that repeat it the
    smallest.  Documents without id or words are linked with nothing and stay."""
    docs = docs.select(*COLUMNS)
    groups = cut_close(ngram_join.jaccard_components(docs).where("doc_id IS NOT NULL"))
    again = cut_close(groups.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    gone = cut_close(groups.where("doc_id <> component_id").select("doc_id").distinct().join(again, "doc_id", "left_anti"))
    # only rows that may be concerned are exchanged; all others pass where they are
    bits = hashed_set(gone.union(again), "doc_id")
    near = rows_in_set(docs, "doc_id", bits, True)
    kept = (rows_in_set(docs, "doc_id", bits, False)
            .unionByName(near.join(gone, "doc_id", "left_anti").join(again, "doc_id", "left_anti")))
    if not again.isEmpty():                     # ids that come with several rows: every row by its own class
        many = ngram_join.with_class(near.join(again, "doc_id", "left_semi"))
        best = (groups.where("class_id IS NOT NULL").groupBy("component_class")
                .agg(F.min(F.struct("doc_id", "class_id")).alias("m")).select("m.doc_id", "m.class_id"))
        one = (many.join(best, ["doc_id", "class_id"], "left_semi").groupBy("doc_id", "class_id")
               .agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("d")).select("doc_id", "d.*"))
        kept = kept.unionByName(one).unionByName(many.where("class_id IS NULL").drop("class_id"))
    return kept.select(*COLUMNS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null and empty texts stay, repeated rows are
    judged alike."""
    return decontaminate.clean(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; every document stays, null texts as they are."""
    return secrets.masked(docs.select(*COLUMNS), secrets.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens; a null text is empty and one
    piece, repeated rows are packed as often as they come."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

#: Learned models and a tokenizer stand in the way of SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the cluster's shared
    folder and read again."""
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
