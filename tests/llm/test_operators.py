"""The training-data operators against brute force on small tables: odd rows first."""

import hashlib
import json
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import (decontaminate, langid, ngram_join, packing, pii, secrets, sharding, textkit, tool_calls,
                          topk_search, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def documents(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = [f"w{i % 977}x{i % 31}" for i in range(20_000)]
    near = base + [f"n{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, " ".join(base)), (7, " ".join(base)),
            (8, " ".join(near)), (9, " ".join(near[:40] + ["changed"] + near[41:])), (10, " ".join(long)),
            (11, " ".join(long[:10_000] + ["z"] + long[10_000:])), (None, "no id here at all"), (12, "日本 语 <|endoftext|> x"),
            (7, " ".join(base))]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_components(documents):
    want = components([(r.doc_id, r.text) for r in documents.collect()])
    got = ngram_join.jaccard_components(documents).collect()
    assert len(got) == documents.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_jaccard_frequent_tiles_and_second_round(spark):
    """Clusters of near copies, a passage in all texts, frequency cut-off forced low."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for c in range(6):
        core = [f"c{c}w{i}" for i in range(90)]
        for v in range(25):
            w = list(core)
            for at in rng.choice(90, size=int(rng.integers(0, 4)), replace=False):
                w[at] = f"x{rng.integers(1e6)}"
            rows.append((len(rows), " ".join(w + passage)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, frequent=4).collect()}
    assert got == components(rows)


def test_jaccard_clusters_just_apart_are_not_listed_in_pairs(spark, monkeypatch):
    """Two groups of near copies a little over the distance: comparisons follow the number of copies."""
    asked, bounded = [], ngram_join._Verifier.bounded
    monkeypatch.setattr(ngram_join._Verifier, "bounded", lambda self, p: (asked.append(p.count()), bounded(self, p))[1])
    rng = np.random.default_rng(8)
    core = [[f"w{i}" if c == 0 or i % 30 else f"v{i}" for i in range(15, 215)] for c in (0, 1)]

    def pairs(n):
        rows = []
        for c in range(2 * n):
            w = list(core[c % 2])
            w[int(rng.integers(200))] = f"x{c}"
            rows.append((c, " ".join(w)))
        asked.clear()
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
        return got, rows, sum(asked)

    got, rows, few = pairs(20)
    assert got == components(rows) and {c for _, c in got.values()} == {0, 1}
    assert pairs(40)[2] <= 2.5 * few and few <= 8 * 40


def test_jaccard_links_between_clusters(spark):
    """Groups of near copies where only some members of one are linked with some of the other."""
    rng = np.random.default_rng(9)
    for k in (4, 6):
        rows = []
        for c in range(36):
            w = [f"w{i}" if c % 3 == 0 or i % 200 // 8 % 12 >= k or i % 8 else f"g{c % 3}v{i}" for i in range(200)]
            for at in rng.choice(200, size=int(rng.integers(0, 3)), replace=False):
                w[at] = f"x{rng.integers(1e6)}"
            rows.append((c, " ".join(w)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}
        assert got == components(rows)


def test_bitmap_bound_is_never_below():
    rng = np.random.default_rng(1)
    for n in (5, 200, 3000):
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 2 ** 63, n // 2).astype(np.uint64))))
        x, y = ngram_join.signature(a), ngram_join.signature(b)
        w = min(len(x), len(y))
        p, q = ngram_join._fold(x, w), ngram_join._fold(y, w)
        most = min(len(a) - int(np.bitwise_count(p & ~q).sum()), len(b) - int(np.bitwise_count(q & ~p).sum()))
        assert most >= len(np.intersect1d(a, b))


def test_packing_round_trip(documents):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packing.pack(documents).collect()
    seqs, by = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert len(seqs) == -(-sum(r.length for r in got) // 2048)
    for doc in documents.collect():
        ids = tok.encode(doc.text or "", add_special_tokens=False).ids + [0]
        if doc.doc_id == 7:                                  # a repeated row is packed twice
            assert len(by[7]) == 2
            continue
        at = 0
        for r in sorted(by[doc.doc_id], key=lambda r: r.piece):
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes()))
            assert r.piece == 0 or r.length == 2048
            at += r.length
        assert at == len(ids)


def test_pretokens_equal_the_tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    rng = np.random.default_rng(3)
    tok, own = Tokenizer.from_file(P.path("byte_bpe_50k.json")), packing.Encoder()
    signs = list("ab'stmdrevl 1.\n é|\t")
    texts = ["".join(rng.choice(signs, size=int(rng.integers(0, 40)))) for _ in range(2000)]
    assert [list(x) for x in own.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_best_fit_matches_one_by_one():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 65, size=int(rng.integers(1, 200))).tolist()
        bins = []
        for n in sorted(lengths, reverse=True):
            fits = [i for i, free in enumerate(bins) if free >= n]
            if fits:
                bins[min(fits, key=lambda i: bins[i])] -= n
            else:
                bins.append(64 - n)
        runs = packing.best_fit(Counter(lengths), 64)
        placed = [(f + j, o, n) for n, _, m, f, o in runs for j in range(m)]
        assert sorted(n for _, _, n in placed) == sorted(lengths)
        assert len({s for s, _, _ in placed}) == len(bins)


def test_shards(documents):
    rows = sorted((hashlib.md5((r.text or "").encode()).hexdigest()[:15], -2 ** 63 if r.doc_id is None else r.doc_id,
                   len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
                  for r in documents.dropDuplicates(["doc_id", "text"]).collect())
    total, cum, slots, want = sum(r[2] for r in rows), 0, Counter(), set()
    for _, i, size, crc in rows:
        s = min(15, 16 * (2 * cum + size) // (2 * total))
        want.add((None if i == -2 ** 63 else i, size, crc, s, slots[s]))
        slots[s] += 1
        cum += size
    got = sharding.shard(documents.dropDuplicates(["doc_id", "text"]), cell_rows=1).collect()
    assert {(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got} == want
    assert {r.law for r in got} == {"bytes"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pii_base_is_the_patterns():
    rng = np.random.default_rng(4)
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 13 <= len(d := re.sub("[ -]", "", t)) <= 19 and luhn(d)),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(re.sub("[^0-9]", "", t)) <= 15))
    signs = list("ab0129.@-+ ()%_\n")
    for _ in range(3000):
        t = "".join(rng.choice(signs, size=int(rng.integers(0, 45))))
        assert pii.base_spans(t) == [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, t) if ok(m[0])]


def test_secret_base_is_the_patterns():
    rng = np.random.default_rng(4)
    parts = ["token", "API_KEY", "=", ":", " ", '"', "AKIA", "ABCDEFGHIJKLMN1", "0123456789abcdef", "é", "K", "deadbeefdead", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(parts, size=int(rng.integers(0, 12))))
        want = [("assign", m.start(), m.end()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert secrets.base_spans(t) == sorted(want, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_skip_chain_marginals_are_exact_on_a_tree():
    f = pii.Field()
    rng = np.random.default_rng(0)
    f.w, f.chain, f.skip = (rng.normal(0, 0.5, x.shape) for x in (f.w, f.chain, f.skip))
    f.skip = (f.skip + f.skip.T) / 2
    g = pii.Graph()
    g.add(0, "12345 x 777 and later 12345")
    assert g.skip == [(0, 2)] and not g.chain
    u = f.unary(g)
    joint = np.exp(u[0][:, None, None] + u[1][None, :, None] + u[2][None, None, :] + f.skip[:, None, :])
    joint /= joint.sum()
    want = np.stack([joint.sum(axis=(1, 2)), joint.sum(axis=(0, 2)), joint.sum(axis=(0, 1))])
    assert np.allclose(f.marginals(g), want, atol=1e-2)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    f = secrets.Field()
    f.w, f.step = rng.normal(size=f.w.shape), rng.normal(size=(3, 3))
    chain = [(0, 1, list(rng.choice(len(secrets.NAMES), 5, replace=False))) for _ in range(6)]
    s, step = f._scores(chain), f.step.copy()
    step[0, 2] = -1e9
    best = max(np.ndindex(*(3,) * 6), key=lambda y: sum(s[t, y[t]] for t in range(6)) + sum(step[a, b] for a, b in zip(y, y[1:])))
    assert tuple(f.viterbi(chain)) == best


def test_taggers_add_and_keep(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for module, kinds, by_kind in ((pii, pii.KINDS, True), (secrets, secrets.ALL_KINDS, False)):
        field = module.train(docs)
        rows = pii.digest(module.find(docs, field), kinds, by_kind).collect()
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in rows:
            base = ",".join(f"{k}:{a}:{b}" for k, a, b in module.base_spans(texts[r.doc_id] or ""))
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert set(base.split(",")) <= set(r.spans.split(",")) | {""}
        assert module.find(documents, field).count() == documents.count()
    masked = {r.doc_id: r for r in secrets.masked(docs, field).collect()}
    assert all(not secrets.base_spans(m.text) for m in masked.values())


def test_language(spark, sf_dir, documents, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(documents, model).collect()}
    assert odd[1] == odd[2] == odd[3] == ("und", 0.0)
    assert {r.lang_pred for r in langid.predict(docs, langid.train(empty)).collect()} == {"und"}
    word = next(iter(model.tables[0][0]))
    assert np.allclose(model.tables[0][1][model.tables[0][0][word]], langid.Scorer(model).rows[model.tables[0][0][word]])


def test_toxicity(spark):
    rng = np.random.default_rng(1)
    vocab = [f"v{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        w = list(rng.choice(vocab, size=40))
        bad = i % 4 == 0
        if bad:
            w[int(rng.integers(40))] = ["vile", "vileness", "awful"][i // 4 % 3]
        docs.append((i, " ".join(w), "en"))
        labels.append((i, int(bad)))
    d = spark.createDataFrame([*docs, (9001, None, None), (9002, "", "en")], "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(d, toxicity.train(d, lab)).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 for r in got.values())
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i, _ in held)
    assert sum(got[i].predicted == y for i, y in held) >= 0.95 * len(held)


def test_top_k_against_all(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    rows += [(800, rows[3][1]), (801, rows[3][1]), (900, None), (901, [float("nan")] * 8), (902, [None] * 8), (903, []), (1000, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk_search.top_k(df, shard_rows=100).collect()]
    x = {i: [math.floor(1024 * float(np.float32(c))) for c in v] for i, v in rows
         if v and all(c is not None and math.isfinite(c) for c in v)}
    want = []
    for q in x:
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(x[q], x[c])), c) for c in x if c != q and len(x[c]) == len(x[q]))[:10]
            want += [(q, r + 1, c, -v) for r, (v, c) in enumerate(s)]
    assert sorted(got) == sorted(want)


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(40))
    near = item.replace("q20", "changed")
    far = " ".join(f"q{i}" if i % 3 else "other" for i in range(40))
    docs = spark.createDataFrame(
        [(1, "before it " + item + " after"), (2, near.upper()), (3, far), (4, None), (5, ""), (6, "short one"), (7, "a b short one c")],
        "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "short one")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 10): 1.0, (2, 10): round(31 / 41, 6), (6, 13): 1.0, (7, 13): 1.0}
    assert [r.doc_id for r in decontaminate.clean(docs, bench).orderBy("doc_id").collect()] == [3, 4, 5]


def test_multi_index_misses_none():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    index = decontaminate._index(prints, decontaminate.RADIUS)
    for i in range(300):
        fp = int(prints[i])
        for b in rng.choice(64, size=decontaminate.RADIUS, replace=False):
            fp ^= 1 << int(b)
        assert any(i in index[j].get(fp >> (8 * j) & 255, ()) for j in range(8))


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [(1, "a", None, "lookup", '{"query": "x", "limit": 2}'), (1, "b", "a", "lookup", '{"limit": 9, "query": "é\\n"}'),
         (1, "c", "b", "search", '{"query": 5, "limit": 1, "z": {"k": 1.0, "a": null}}'), (1, "d", "gone", "nope", "{}"),
         (2, "r1", "r2", "lookup", None), (2, "r2", "r1", "lookup", "not json"), (3, None, None, "lookup", '{"query": "y", "limit": 1}'),
         (1, "a", None, "lookup", '{"query": "x", "limit": 2}')],
        "conv_id long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame([("a", "one"), ("b", None), ("zz", "lost"), (None, "nobody")], "call_id string, content string")
    rows = tool_calls.link(calls, results).collect()
    got = {r.call_id: r for r in rows if r.call_id}
    assert len(rows) == 9
    assert {k: (r.status, r.level, r.n_calls, r.n_results) for k, r in got.items()} == {
        "a": ("linked", 0, 2, 1), "b": ("linked", 1, 1, 1), "c": ("unanswered", 2, 1, 0), "d": ("unanswered", 0, 1, 0),
        "r1": ("cyclic", None, 1, 0), "r2": ("cyclic", None, 1, 0), "zz": ("orphan", None, 0, 1)}
    assert json.loads(got["c"].line)["errors"] == ["query: not string"]
    assert '"arguments":{"limit":1,"query":5,"z":{"a":null,"k":1}}' in got["c"].line
    assert json.loads(got["d"].line)["errors"] == ["unknown tool", "parent: missing"]
    assert got["a"].valid and not got["b"].valid


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (ngram_join.jaccard_components(empty), packing.pack(empty), sharding.shard(empty), pii.find(empty, pii.train(empty)),
               secrets.find(empty, secrets.train(empty)), toxicity.classify(empty, toxicity.train(empty, labels)),
               langid.predict(empty, langid.train(empty)), decontaminate.contaminated(empty, bench), topk_search.top_k(vectors),
               tool_calls.link(*tool_calls.calls_of(turns))):
        assert df.count() == 0


def test_word_hash_does_not_depend_on_the_place():
    a = textkit.word_hashes(textkit.utf8(["x yy Zz"])[0])[0]
    b = textkit.word_hashes(textkit.utf8(["", "zz  yy é", "x"])[0])[0]
    assert len(set(a.tolist()) & set(b.tolist())) == 3


def test_language_words_kept_are_the_most_frequent(spark):
    from gridloom.llm import langid
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(" ".join([w] * (i % 7 + 1)), "en") for i, w in enumerate(words)] + [("uno dos dos", "es")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), words_kept=40)
    want = sorted(((i % 7 + 1, w) for i, w in enumerate(words)), key=lambda x: (-x[0], x[1]))[:40]
    whole = langid.Model(sorted([("en", w, n) for n, w in want] + [("es", "dos", 2), ("es", "uno", 1)]))
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(999, "dos aa")], "doc_id long, text string")
    assert langid.predict(docs, model).orderBy("doc_id").collect() == langid.predict(docs, whole).orderBy("doc_id").collect()


def test_toxicity_thresholds_cover_all_labelled_rows(spark):
    """Far more labelled rows than the sample holds, few of them toxic, two languages."""
    rng = np.random.default_rng(8)
    docs, labels = [], []
    for i in range(6000):
        lang = "ab"[i % 4 == 0]
        w = [f"{lang}{x}" for x in rng.integers(0, 200, 20)]
        bad = rng.random() < 0.12
        if rng.random() < (0.7 if bad else 0.06):
            w[0] = f"{lang}vile"
        docs.append((i, " ".join(w), lang))
        labels.append((i, int(bad)))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"), per_label=100)
    fold = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 5 == 1]
    b, cuts = toxicity.word_ids([docs[i][1] for i in fold])
    z, guess = model.net.logits(b, cuts), model.guess(b, cuts)
    y = np.array([labels[i][1] for i in fold])
    for k in range(2):
        zk, yk = z[guess == k], y[guess == k]
        f1 = lambda c: 2 * yk[zk >= c].sum() / ((zk >= c).sum() + yk.sum())  # noqa: E731, B023
        assert f1(model.cut[k]) >= max(map(f1, zk)) - 0.02


def test_toxicity_sample_is_calibrated_in_portions(monkeypatch):
    """Thresholds of a large sample are those of all its texts at once, with little memory beside it."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(toxicity.Net, "fit", lambda *a: None)
    assert np.iinfo(toxicity.ROW).max >= toxicity.BUCKETS - 1
    sample = [(rng.integers(0, toxicity.BUCKETS, (2, toxicity.SAMPLE_WORDS if i % 9 else 3)).astype(toxicity.ROW),
               int(i % 3 == 0), "ab"[i % 2]) for i in range(300)]
    tracemalloc.start()
    try:
        model = toxicity.Model(sample)
        assert tracemalloc.get_traced_memory()[1] < 50e6           # 19 MB; 132 MB with all texts at once
    finally:
        tracemalloc.stop()
    got = model.cut.copy()
    cuts = np.concatenate(([0], np.cumsum([s[0].shape[1] for s in sample])))
    b = np.concatenate([s[0] for s in sample], axis=1)
    model.calibrate(Counter(zip(model.guess(b, cuts).tolist(), toxicity.step_of(model.net.logits(b, cuts)).tolist(),
                                [s[1] for s in sample])))
    assert np.array_equal(got, model.cut)
    assert list(toxicity.portions([5, 1, 2, 9, 0, 3, 3], 5)) == [(0, 1), (1, 3), (3, 4), (4, 6), (6, 7)]
    assert list(toxicity.portions([], 5)) == [] and list(toxicity.portions([9], 5)) == [(0, 1)]


def test_language_counts_cover_all_words(spark):
    """The n-grams of words beyond those looked up count, and no language is left out."""
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), size=5))
    rows = [("the the the", "en"), ("los los los", "es")]
    rows += [(word("abcdef"), "en") for _ in range(300)] + [(word("qwxyzk"), "es") for _ in range(300)]
    rows += [(f"l{chr(97 + i // 26)}{chr(97 + i % 26)}" * 2, f"x{i}") for i in range(230)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = langid.train(df, looked_up=1)
    want = langid.Model([(lang, w, 1) for text, lang in rows for w in text.split()])
    assert model.langs == want.langs and len(model.langs) == 232
    for (index, t), (whole, u) in zip(model.tables, want.tables):
        assert np.allclose(t.missing, u.missing)
        assert set(index) <= set(whole) and all(np.allclose(t[index[g]], u[whole[g]]) for g in index)
    assert [set(x) for x, _ in model.tables[1:]] == [set(x) for x, _ in want.tables[1:]]
    assert len(model.tables[0][0]) < len(want.tables[0][0])
    fresh = [(i, word(("abcdef", "qwxyzk")[i % 2])) for i in range(60)]
    got = langid.predict(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()
    assert sum(r.lang_pred == ("en", "es")[r.doc_id % 2] for r in got) >= 58


def test_jaccard_row_without_id_before_its_copy(spark):
    base = [f"n{i}" for i in range(60)]
    near = " ".join(base[:30] + ["changed"] + base[31:])
    rows = [(None, " ".join(base)), (2, " ".join(base)), (1, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df).collect()}
    assert got == {None: None, **{i: c for i, (_, c) in components(rows).items()}} == {None: None, 1: 1, 2: 1}


def test_jaccard_gives_up_its_shuffle_files(spark):
    """Shuffle files of the steps go when they end, not with the driver's next garbage collection."""
    from gridloom.llm.io import FREED
    texts = [" ".join(f"w{(i // 4) * 50 + j}" for j in range(40)) + f" end{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_(\d+)_", disk.getAllBlocks().mkString(" ")))

    before, earlier = spark.conf.get(FREED), shuffles()
    hold = []                                       # keeps every frame, and so its files, from the garbage collector
    with pytest.MonkeyPatch.context() as m:
        kept = ngram_join.cut
        m.setattr(ngram_join, "cut", lambda d: hold.append(d) or kept(d))
        got = ngram_join.jaccard_components(df)
    for _ in range(50):                             # files are removed in the background
        if len(left := shuffles() - earlier) < 5:   # a stage that was called off may end after its execution
            break
        time.sleep(0.2)
    assert len(hold) > 10 and len(left) < 5
    assert spark.conf.get(FREED) == before
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: i // 4 * 4 for i in range(60)}


def test_jaccard_runs_no_task_for_every_empty_partition(spark):
    """Few rows over many partitions: later stages read them in few tasks, so tasks do not multiply."""
    texts = [" ".join(f"w{(i // 4) * 50 + j}" for j in range(40)) + f" end{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    df.count()
    sc, track = spark.sparkContext, spark.sparkContext.statusTracker()
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("96", "false")):
            spark.conf.set(k, v)
        sc.setJobGroup("jaccard-tasks", "")
        got = ngram_join.jaccard_components(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    stages = {i for j in track.getJobIdsForGroup("jaccard-tasks") if (x := track.getJobInfo(j)) for i in x.stageIds}
    tasks = [x.numCompletedTasks for i in stages if (x := track.getStageInfo(i)) and x.numCompletedTasks]
    assert len(tasks) > 20 and sum(tasks) < 0.7 * 96 * len(tasks), (len(tasks), sum(tasks))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: i // 4 * 4 for i in range(60)}


def test_rows_read_again_in_as_many_tasks_as_they_are_worth(spark):
    from gridloom.llm.io import cut_close
    least = 2 * spark.sparkContext.defaultParallelism
    few, none, many = (cut_close(spark.range(0, n, 1, 64), 100) for n in (1000, 0, 50 * least * 100))
    assert few.rdd.getNumPartitions() == max(10, min(64, least)) and none.rdd.getNumPartitions() == 1
    assert many.rdd.getNumPartitions() == 64
    assert sorted(r.id for r in few.collect()) == list(range(1000)) and none.collect() == [] and many.count() == 50 * least * 100


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges(spark, seed):
    """Repeated and reversed edges, self loops, hubs and long paths."""
    from gridloom.llm.components import connected
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(-60, 60, (70, 2))]
    edges += [(b, a) for a, b in edges[:20]] + edges[10:30] + [(x, 200) for x in range(201, 220)]
    edges += [(300 + i, 301 + i) for i in range(30)] + [(400, 400)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert len(got) == len(linked) and {r.node: r.label for r in got} == {x: top(x) for x in linked}


def test_decontamination_blocks_change_nothing(spark):
    """Passages that many items share weigh less, whichever block holds those items."""
    rng = np.random.default_rng(2)
    shared = [[f"s{k}x{i}" for i in range(25)] for k in range(4)]
    items = [(i, " ".join(shared[i % 4] + [f"i{i}w{j}" for j in range(30)])) for i in range(40)]
    docs = []
    for i, text in items:
        for cut in (0, 3, 6, 9, 12, 15):
            w = text.split()
            for at in rng.choice(25, size=cut // 3, replace=False):
                w[at] = f"d{at}"
            docs.append((len(docs), " ".join(["before", *w[:len(w) - cut // 3], *w[:3], "after"])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items)
    assert len(list(decontaminate.item_blocks(b, -(-size // 6)))) == 3
    one, three = (sorted(map(tuple, decontaminate.contaminated(d, b, most_words=m).collect()))
                  for m in (decontaminate.ITEM_WORDS, -(-size // 6)))
    assert one == three and 0 < len(one) < 10 * len(docs)


def test_short_secrets_by_a_key_word_are_open_and_learned():
    rng = np.random.default_rng(7)
    value = lambda n: "".join(rng.choice(list("abcdefghkmnpqrstuvwxyzABCDEFGH23456789"), size=n - 1)) + "7"
    prose = "the token was here and a key to the house with some secret of old times 12 or 2024 words"
    texts = [f"{k}{s}{value(int(n))} {prose}\n" for n in rng.integers(8, 30, 40) for k, s in
             (("password", ": "), ("secret", " = "), ("token", '": "'))] + [prose] * 40
    field = secrets.learn(texts)
    for text, want in (("login\npassword: Tr0ub4dor\n", "Tr0ub4dor"), ('{"pwd": "hunter2-xy"}', "hunter2-xy"),
                       ("api_key = a7Bd93kq\n", "a7Bd93kq"), ("password=Tr0ub4d7\n", "password=Tr0ub4d7")):
        assert want in [text[a:b] for _, a, b in secrets.spans(field, text)[1]]
    for text, want in (("pin: 4711", "4711"), ("password: correcthorsebatter", "correcthorsebatter"), ("Bearer abc", "abc")):
        assert want in [text[a:b] for a, b in secrets.open_runs(text, [])]
    assert secrets.spans(field, prose) == ([], [])


def test_language_bound_holds_before_collecting(spark):
    """Beyond the bound the languages with most words stay; entries are held for them alone."""
    rows = [(" ".join(["ab"] * (i + 1)), f"l{i:02}") for i in range(30)] + [("cd", "l29")]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), languages=4)
    assert model.langs == ["l26", "l27", "l28", "l29"]
    words_, table = model.tables[0]
    assert len(table.langs) == len(table.more) == 5 and set(words_) == {"ab", "cd"}   # no dense rows
