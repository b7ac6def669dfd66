"""Operators 11 to 13 against brute force on odd rows: nulls, empty and long texts, ties,
repeated rows, empty tables, and extra columns whose names clash with results."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import line_dedup, resampling, source_audit
from gridloom.llm.io import cut

DOCS = ("doc_id long, text string, lang string, source string, score string, rank string, term string, keep string, "
        "n long, pos long, th string, data string, held string, block string")


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, *["clash"] * 4, 1, 2, *["clash"] * 4) for i, t, g, s in rows], DOCS)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---------------------------------------------------------------- op 11
def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def test_feature_buckets_are_crc32():
    rng = np.random.default_rng(1)
    signs = list("ab ZÉ日1.-\n") + ["x" * 63, "y" * 64, "z" * 65, "q" * 300, "É" * 33]
    texts = ["".join(rng.choice(signs, size=int(rng.integers(0, 30)))) for _ in range(300)] + ["", "one", "a b"]
    own, bucket = resampling.features(texts)
    got = defaultdict(list)
    for o, b in zip(own.tolist(), bucket.tolist()):
        got[o].append(b)
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(zlib.crc32(g.encode()) % 10_000 for g in grams(t))


def drawn(rows, target, min_words=20, percent=25):
    """(doc_id, n_features, weight, score) -> how often, and the ranks of the drawn in order."""
    src, tgt = Counter(), Counter()
    for _, t in rows:
        src.update(zlib.crc32(g.encode()) % 10_000 for g in grams(t))
    for t in target:
        tgt.update(zlib.crc32(g.encode()) % 10_000 for g in grams(t))
    big, small = sum(src.values()), sum(tgt.values())
    out, race = [], []
    for i, t in rows:
        f = grams(t)
        total = 0
        for g in f:
            k = zlib.crc32(g.encode()) % 10_000
            total += math.floor(1000 * math.log((tgt[k] + 1.0) * (big + 10_000) / ((src[k] + 1.0) * (small + 10_000))))
        weight = total // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        row = (i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        out.append(row)
        if len(f) >= 2 * min_words - 1:
            race.append(row)
    race.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return Counter(out), [(r[3], r[0]) for r in race[:len(race) * percent // 100]]


def test_resample_odd_rows(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "Zed"]
    text = lambda n: " ".join(rng.choice(vocabulary, size=n))
    rows = [(i, text(int(rng.integers(0, 60)))) for i in range(-40, 160)]
    rows += [(None, text(30)), (None, None), (500, None), (501, ""), (502, " .. "), (503, text(30_000)), (2 ** 63 - 1, text(25)),
             (-2 ** 63, text(25))] + [(7, text(40))] + [(600, rows[60][1])] * 12
    target = [text(25), None, "", "w1 w2 w3"]
    got = resampling.resample(table(spark, [(i, t, "en", "s") for i, t in rows]),
                              spark.createDataFrame([(t,) for t in target], "text string"), percent=60).collect()
    want, order = drawn(rows, target, percent=60)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(order) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == order


def test_resample_empty(spark):
    none = table(spark, [])
    assert resampling.resample(none, none).collect() == []
    got = resampling.resample(table(spark, [(1, " ".join("abcdefghijklmnopqrstuvwxyz"), "", "")]), none).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in got] == [(1, 51, None)]


@pytest.mark.parametrize("digit_bits,block_rows", [(4, 30), (11, 100_000)])
def test_radix_ranks(spark, digit_bits, block_rows):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(-9, 9)), None if rng.random() < .05 else int(rng.integers(40, 90)), j) for j in range(500)]
    rows += [(3, 50, 500 + j) for j in range(300)]              # a third of the rows share one key
    df = cut(spark.createDataFrame(rows, "score long, k long, j long"))
    got = {r.j: r["rank"] for r in resampling.radix_ranks(df, "score", "k", digit_bits, block_rows).collect()}
    assert sorted(got.values()) == list(range(1, len(rows) + 1))
    seen = [(-s, k is None, k or 0) for s, k, j in sorted(rows, key=lambda r: got[r[2]])]
    assert seen == sorted(seen)


# ---------------------------------------------------------------- op 12
def audited(rows, min_docs):
    docs, count = defaultdict(set), Counter()
    groups = {(g or "", s or "") for _, g, s in rows}
    for r, (t, g, s) in enumerate(rows):
        for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)):
            docs[g or "", w].add(r)
            count[g or "", s or "", w] += 1
    out = set()
    for lang in {g for g, _ in groups}:
        terms = [w for (g, w), d in docs.items() if g == lang and len(d) >= min_docs]
        sources = [s for g, s in groups if g == lang]
        n = {s: sum(count[lang, s, w] for w in terms) for s in sources}
        share = lambda c, total: 1 + 1_000_000_000 * (c + 5) // (total + 5 * len(terms))
        p = {(s, w): share(count[lang, s, w], n[s]) for s in sources for w in terms}
        q = {w: share(sum(count[lang, s, w] for s in sources), sum(n.values())) for w in terms}
        for s in sources:
            pairs = sorted((-sum(abs(p[s, w] - p[b, w]) for w in terms), b.encode()) for b in sources if b != s)
            out |= {(lang, s, "pair", b.decode(), -v, i + 1) for i, (v, b) in enumerate(pairs)}
            own = sorted((q[w] - p[s, w], w.encode()) for w in terms if count[lang, s, w] and p[s, w] > q[w])[:50]
            out |= {(lang, s, "term", w.decode(), -v, i + 1) for i, (v, w) in enumerate(own)}
    return out


def test_audit_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "SHARD_TERMS", 16)       # several shards
    rng = np.random.default_rng(4)
    vocabulary = [f"{a}{b}" for a in "abcdeÉ日ß" for b in "fghijklm"] + ["İx", "AB", "ab"]
    rows = []
    for _ in range(400):
        lang = rng.choice(["en", "de", "xx"], p=[.7, .28, .02])
        source = rng.choice(["s1", "s2", "s3", "É", "zz"], p=[.5, .2, .1, .1, .1])
        rows.append((" ".join(rng.choice(vocabulary, size=int(rng.integers(0, 60)))) + "1x9 A_b", str(lang), str(source)))
    rows += [(None, "en", "s1"), ("", "en", "only empty"), ("ab ab", None, None), (None, "", "s"), ("12 _", "de", None),
             (" ".join(rng.choice(vocabulary, size=40_000)), "en", "s2")] + [rows[0]] * 5
    got = source_audit.audit(table(spark, [(i, *r) for i, r in enumerate(rows)]), min_docs=12).collect()
    assert {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got} == audited(rows, 12)
    assert len(got) == len(set(got))
    assert source_audit.audit(table(spark, [])).collect() == []


def test_shares_are_exact():
    rng = np.random.default_rng(5)
    total = rng.integers(1, 9_000_000_000_000_000, 1000)
    count = (total * rng.random(1000)).astype(np.int64)
    count[:10] = total[:10]
    assert source_audit._share(count, total).tolist() == [1 + 10 ** 9 * int(c) // int(t) for c, t in zip(count, total)]


# ---------------------------------------------------------------- op 13
def deduped(rows):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is not None, i or 0)
    where = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                where[key(x)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(where.get(key(x), ())) >= 3 and max(where[key(x)], key=order) != i)]
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("partitions", [1, 9, 40])
def test_line_dedup_odd_rows(spark, partitions):
    rng = np.random.default_rng(6)
    lines = [f"This is the line number {i}, long enough" for i in range(40)] + ["short", "", "x" * 19, "É" * 19, "É" * 20, "\ty" * 30]
    text = lambda n: "\n".join(str(x) for x in rng.choice(lines, size=n))
    hot = "  A line of EVERY document, everywhere \r"
    rows = [(i, "\n".join([hot] * int(rng.integers(0, 4)) + [text(int(rng.integers(0, 12)))])) for i in range(150)]
    rows += [(None, text(9)), (None, text(9)), (200, None), (201, ""), (202, "\n"), (203, "\n".join([hot.lower()] * 5_000)),
             (204, "z" * 50_000), (204, text(5)), (-2 ** 63, text(9))] + [(3, rows[3][1])] * 3
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # keep all partitions, so that hashes cross their borders
    try:
        docs = table(spark, [(i, t, "en", "s") for i, t in rows])
        got = line_dedup.digest(docs, line_dedup.keep_bitmaps(docs)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == deduped(rows)


def test_line_dedup_two_or_three(spark):
    same = "a line that a few documents share"
    for n, gone in ((2, 0), (3, 2)):
        docs = table(spark, [(i, f"{same}\nown {i}", "en", "s") for i in range(n)])
        got = {r.doc_id: r.n_dropped for r in line_dedup.digest(docs, line_dedup.keep_bitmaps(docs)).collect()}
        assert sum(got.values()) == gone and got[n - 1] == 0
    none = table(spark, [])
    assert line_dedup.digest(none, line_dedup.keep_bitmaps(none)).collect() == []


# ---------------------------------------------------------------- earlier operators
def test_pii_takes_numbers_of_any_length():
    from gridloom.llm import pii
    zeros = "0" * 5000
    assert ("ip", 0, 5007) in pii.base_spans(zeros + "1.2.3.4")
    assert [s for s in pii.base_spans("9" * 5000 + ".2.3.4") if s[0] == "ip"] == []


def test_jaccard_of_an_id_with_two_texts(spark):
    """Links do not depend on the order of rows where one id comes with two texts."""
    from gridloom.llm import ngram_join
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a[:-1], "x"])), (3, " ".join([*b[:-1], "y"]))]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        got = ngram_join.jaccard_components(spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1)]
        assert len({r.component_class for r in got}) == 2
