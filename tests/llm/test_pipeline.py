"""The pipeline stage by stage against brute force on the small tables."""

import re

import corpus_pipeline as P
from gridloom.llm import secrets
from test_operators import components


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a = P.language(spark, docs, sf_dir)
    assert a.columns == list(P.COLUMNS)
    kept = {r.doc_id: r.text for r in a.collect()}
    told = {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert len(told - set(kept)) <= 0.01 * len(told)          # clean documents stay
    b = P.near_duplicates(spark, a, sf_dir)
    want = {i for i, (_, c) in components(list(kept.items())).items() if i == c}
    assert {r.doc_id for r in b.collect()} == want
    c = P.benchmark_free(spark, b, sf_dir)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {r.doc_id: r.text for r in c.collect()}
    assert not [i for i, t in left.items() if any(x in t for x in items)]
    assert all(any(x.split()[0] in kept[i] for x in items) for i in want - set(left))
    d = P.without_secrets(spark, c, sf_dir)
    assert d.count() == len(left)
    assert not [r.doc_id for r in d.collect() if secrets.base_spans(r.text)]
    e = P.packed(spark, d, sf_dir).collect()
    assert {r.doc_id for r in e} == set(left)


def test_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 456", "en", "s", 7), (None, "the and of the", "en", "s", 14),
            (4, "the and of with that", "en", "s", 20), (4, "the and of with that", "en", "s", 20), (5, "the and of with that", "en", "s", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    a = P.language(spark, docs, sf_dir)
    assert sorted(r.doc_id or 0 for r in a.collect()) == [0, 4, 4, 5]
    b = P.near_duplicates(spark, a, sf_dir)
    assert sorted(r.doc_id or 0 for r in b.collect()) == [0, 4]


def test_ids_with_several_texts(spark, sf_dir):
    """Every row by its own class: unlike texts under one id all stay, copies of one go."""
    word = lambda c, n=12: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, None), (1, word("a")), (1, word("b")), (1, word("b")), (2, word("b")), (2, word("c")), (3, word("c")), (4, ""), (4, ""), (5, word("d"))]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in order], "doc_id long, text string, lang string, source string, n_chars long")
        got = sorted(((r.doc_id, r.text or "") for r in P.near_duplicates(spark, docs, sf_dir).collect()))
        assert got == sorted([(1, ""), (1, word("a")), (1, word("b")), (2, word("c")), (4, ""), (4, ""), (5, word("d"))])


def test_later_stages_take_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the and", "en", "s", 7), (3, "x " * 9000, "en", "s", 18000),
            (3, "x " * 9000, "en", "s", 18000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for stage in (P.benchmark_free, P.without_secrets):
            assert sorted(map(str, stage(spark, docs, sf_dir).collect())) == sorted(map(str, docs.collect()))
        pieces = P.packed(spark, docs, sf_dir).collect()
        assert sum(r.piece == 0 for r in pieces) == len(part)
