"""Convolutional toxicity classifier (operator 4).

Words are runs of letters and digits, ASCII lower-cased.  A word's embedding joins two
hashed rows, one of the whole word and one of its stem (the first ``STEM`` bytes), so
inflected forms not met in training are still placed.  Filters of several widths slide over
the embedded words; each keeps its maximum over the whole text, and a logistic layer reads
the maxima.  The network is trained in numpy (Adam) on a bounded sample of labelled rows.
Thresholds are calibrated by language on all labelled rows of a fold kept out of the fit: a
small word-count model guesses the language from the text alone, each language's threshold
becomes logit 0, and so score >= 0.5 means "toxic" in every language.  Tasks score the
fold's texts, Spark counts them by language, label and logit (steps of 1 / ``STEPS``), and the
thresholds follow from the counts; a language with fewer than ``ENOUGH`` rows of a label in
the fold takes the threshold of all languages together.

The bound, for fit and language guess only: at most ``SAMPLE`` rows of each label, those
smallest by hash of the id, among texts of at most ``SAMPLE_WORDS`` words; the driver then
holds at most 2 * SAMPLE * SAMPLE_WORDS words of 4 bytes, and works on few texts of them at a
time.  Calibration and scoring cover every word of every text.

Edge cases: a null, empty or word-less text is scored from the bias alone; without labels of
both kinds every score is 0; repeated rows are scored as often as they come; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import textkit as T
from gridloom.llm.io import hashed_set, rows_in_set

SAMPLE = 4000
SAMPLE_WORDS = 4000
BUCKETS = 1 << 16
ROW = np.uint16               # holds a row of the tables
STEM = 5
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 6                       # per table
EPOCHS = 14
CHUNK = 600_000
CELLS = 1 << 18               # words times languages of the sample that the driver calibrates at once
STEPS, FARTHEST = 64, 40      # steps of a logit that are counted apart, up to this size
ENOUGH = 20                   # rows of each label for a threshold of a language's own

_APART = np.ones(256, dtype=bool)
_APART[48:58] = _APART[65:91] = _APART[97:123] = False
_APART[128:] = False


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word of all texts in the word and in the stem table, and where each
    text's words start."""
    data, starts = T.utf8(texts)
    begin, end = T.word_spans(data, _APART)
    mask = np.uint64(BUCKETS - 1)
    if not len(begin):
        return np.zeros((2, 0), dtype=np.int64), np.searchsorted(begin, starts)
    whole = T.span_hashes(data, begin, end) & mask
    stem = T.span_hashes(data, begin, np.minimum(end, begin + STEM)) & mask
    return np.stack((whole, stem)).astype(np.int64), np.searchsorted(begin, starts)


class Net:
    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        f = np.float32
        self.p = {"e0": g.normal(0, 0.1, (BUCKETS, DIM)).astype(f), "e1": g.normal(0, 0.1, (BUCKETS, DIM)).astype(f),
                  "out": g.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(f), "bias": np.zeros(1, f)}
        for w in WIDTHS:
            self.p[f"w{w}"] = g.normal(0, 0.4 / np.sqrt(w), (w * 2 * DIM, FILTERS)).astype(f)
            self.p[f"b{w}"] = np.zeros(FILTERS, f)

    def pooled(self, b: np.ndarray, cuts: np.ndarray, arg: bool = False):
        """Maxima of each filter over each text (0 where no window fits), and their places."""
        x = np.concatenate((self.p["e0"][b[0]], self.p["e1"][b[1]]), axis=1)
        n = len(cuts) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), dtype=np.float32)
        places = np.full((n, len(WIDTHS) * FILTERS), -1, dtype=np.int64) if arg else None
        for k, w in enumerate(WIDTHS):
            if len(x) < w:
                continue
            m = len(x) - w + 1
            z = np.zeros((m, FILTERS), dtype=np.float32)
            for j in range(w):
                z += x[j:j + m] @ self.p[f"w{w}"][j * 2 * DIM:(j + 1) * 2 * DIM]
            z += self.p[f"b{w}"]
            first, last = cuts[:-1], cuts[1:] - w + 1
            fits = np.flatnonzero(last > first)
            if not len(fits):
                continue
            # windows that run into the next text never win
            valid = np.zeros(m + 1, dtype=np.int8)
            np.add.at(valid, first[fits], 1)
            np.add.at(valid, last[fits], -1)
            z[np.cumsum(valid[:m]) == 0] = -np.inf
            top = np.maximum.reduceat(z, first[fits], axis=0)
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            out[fits, cols] = np.maximum(top, 0)
            if arg:
                for i in fits:
                    a = np.argmax(z[first[i]:last[i]], axis=0) + first[i]
                    places[i, cols] = np.where(top[np.searchsorted(fits, i)] > 0, a, -1)
        return (out, places) if arg else out

    def logits(self, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return self.pooled(b, cuts) @ self.p["out"] + self.p["bias"][0]

    def fit(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01,
            seed: int = 11) -> None:
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        for _ in range(epochs):
            order = g.permutation(len(texts))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                b = np.concatenate([texts[i] for i in rows], axis=1)
                cuts = np.concatenate(([0], np.cumsum([texts[i].shape[1] for i in rows])))
                pool, places = self.pooled(b, cuts, arg=True)
                z = pool @ self.p["out"] + self.p["bias"][0]
                d = ((1 / (1 + np.exp(-z)) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
                grad = {"out": pool.T @ d, "bias": np.array([d.sum()], np.float32)}
                back = d[:, None] * self.p["out"][None, :]
                touched, slopes = [], []
                for k, w in enumerate(WIDTHS):
                    gw, gb = np.zeros_like(self.p[f"w{w}"]), np.zeros(FILTERS, np.float32)
                    for f in range(FILTERS):
                        c = k * FILTERS + f
                        ok = places[:, c] >= 0
                        at0, s = places[ok, c], back[ok, c]
                        gb[f] = s.sum()
                        for j in range(w):
                            part = slice(j * 2 * DIM, (j + 1) * 2 * DIM)
                            i = b[:, at0 + j]
                            x = np.concatenate((self.p["e0"][i[0]], self.p["e1"][i[1]]), axis=1)
                            gw[part, f] += s @ x
                            touched.append(i)
                            slopes.append(s[:, None] * self.p[f"w{w}"][part, f][None, :])
                    grad[f"w{w}"], grad[f"b{w}"] = gw, gb
                step += 1
                fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for name, gr in grad.items():
                    m[name] += 0.1 * (gr - m[name])
                    v[name] += 0.001 * (gr * gr - v[name])
                    self.p[name] -= rate * fix * m[name] / (np.sqrt(v[name]) + 1e-7)
                i, s = np.concatenate(touched, axis=1), np.concatenate(slopes)
                for t in (0, 1):         # only the rows that windows touched
                    u, back_to = np.unique(i[t], return_inverse=True)
                    gr = np.zeros((len(u), DIM), np.float32)
                    np.add.at(gr, back_to, s[:, t * DIM:(t + 1) * DIM])
                    name = f"e{t}"
                    m[name][u] += 0.1 * (gr - m[name][u])
                    v[name][u] += 0.001 * (gr * gr - v[name][u])
                    self.p[name][u] -= rate * fix * m[name][u] / (np.sqrt(v[name][u]) + 1e-7)


def step_of(z: np.ndarray) -> np.ndarray:
    """The counted step that each logit lies in."""
    return np.floor(np.clip(z.astype(np.float64), -FARTHEST, FARTHEST) * STEPS).astype(np.int64)


def threshold(counts: dict[int, tuple[int, int]]) -> float:
    """The logit with the best F1, in the middle of its gap; ``counts``: rows of label 0 and
    of label 1 by step."""
    steps = sorted(counts, reverse=True)
    n = np.array([counts[x] for x in steps], dtype=np.float64)
    f1 = 2 * np.cumsum(n[:, 1]) / (np.cumsum(n.sum(axis=1)) + n[:, 1].sum())
    best = int(np.argmax(f1))
    low = steps[best] / STEPS
    below = (steps[best + 1] + 1) / STEPS if best + 1 < len(steps) else low - 2
    return (low + below) / 2


def portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs (start, end) of items that together have at most ``most``; a larger item stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Model:
    """Network, language guess and a threshold per language."""

    def __init__(self, sample: list[tuple[np.ndarray, int, str | None]]):
        y = np.array([s[1] for s in sample], dtype=np.float32)
        self.trained = len(set(y.tolist())) == 2
        self.langs = sorted({s[2] for s in sample if s[2] is not None})
        self.words = np.zeros((BUCKETS, max(1, len(self.langs))), dtype=np.float32)
        if not self.trained:
            return
        for h, _, lang in sample:
            if lang is not None:
                np.add.at(self.words[:, self.langs.index(lang)], h[0], 1)
        self.words = np.log((self.words + 0.1) / (self.words.sum(axis=0) + 0.1 * BUCKETS))
        self.net = Net()
        self.net.fit([s[0] for s in sample], y)
        # holds until calibrated, and where the fold has not both labels
        counts: Counter = Counter()
        for at, end in portions([s[0].shape[1] for s in sample], CELLS // max(1, len(self.langs))):
            part = [s[0] for s in sample[at:end]]
            cuts = np.concatenate(([0], np.cumsum([w.shape[1] for w in part])))
            b = np.concatenate(part, axis=1)
            counts.update(zip(self.guess(b, cuts).tolist(), step_of(self.net.logits(b, cuts)).tolist(),
                              y[at:end].astype(int).tolist()))
        self.calibrate(counts)

    def calibrate(self, counts: dict[tuple[int, int, int], int]) -> None:
        """Thresholds from the rows by (language, step, label), if there are rows of both labels."""
        if len({label for _, _, label in counts}) < 2:
            return
        by: dict[int, dict[int, list[int]]] = {}
        for (lang, step, label), n in counts.items():
            for k in (-1, lang):                           # -1: all languages together
                by.setdefault(k, {}).setdefault(step, [0, 0])[label] += n
        self.cut = np.full(max(1, len(self.langs)), threshold(by[-1]), dtype=np.float32)
        for k, own in by.items():
            if k >= 0 and min(sum(n[label] for n in own.values()) for label in (0, 1)) >= ENOUGH:
                self.cut[k] = threshold(own)

    def guess(self, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Index of the likeliest language of each text, from its words alone."""
        run = np.concatenate((np.zeros((1, self.words.shape[1])), np.cumsum(self.words[b[0]], axis=0, dtype=np.float64)))
        return np.argmax(run[cuts[1:]] - run[cuts[:-1]], axis=1)

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        b, cuts = word_ids(texts)
        z = self.net.logits(b, cuts) - self.cut[self.guess(b, cuts)]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def train(documents: DataFrame, labels: DataFrame, per_label: int = SAMPLE, most_words: int = SAMPLE_WORDS) -> Model:
    """Model from labelled rows: fitted to a sample of those whose crc32 of the id modulo 5 is
    2, 3 or 4, calibrated on all of those where it is 1."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    ids = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    by = (F.xxhash64("doc_id"), "doc_id")
    # twice the bound of ids: some texts are too long or missing
    fit = ids.where(rest > 1)
    few = fit.where("toxic = 1").orderBy(*by).limit(2 * per_label).union(
        fit.where("toxic = 0").orderBy(*by).limit(2 * per_label)).dropDuplicates(["doc_id"])
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
            .join(F.broadcast(few), "doc_id")                 # bounded by per_label
            .select("doc_id", "toxic", "lang", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            out, keep = [], []
            for first, held in T.chunks(texts):
                ids, cuts = word_ids(held)
                for i in range(len(held)):
                    if 0 < cuts[i + 1] - cuts[i] <= most_words:
                        out.append(ids[:, cuts[i]:cuts[i + 1]].astype(ROW).tobytes())
                        keep.append(first + i)
            b = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "toxic", "lang")),
                                              pa.array(out, pa.binary())],
                                             names=["doc_id", "toxic", "lang", "words"])

    hashed = rows.mapInArrow(T.bounded(run), "doc_id long, toxic int, lang string, words binary")
    got = []
    for label in (0, 1):
        got += hashed.where(F.col("toxic") == label).orderBy(*by, "words").limit(per_label).collect()
    model = Model([(np.frombuffer(r["words"], dtype=ROW).reshape(2, -1), r["toxic"], r["lang"]) for r in got])
    if model.trained:
        model.calibrate(fold_counts(documents, ids.where(rest == 1).distinct(), model))
    return model


def fold_counts(documents: DataFrame, labelled: DataFrame, model: Model) -> dict[tuple[int, int, int], int]:
    """Rows by (guessed language, step of the logit, label) of all ``labelled`` (doc_id, toxic);
    at most 2 * (2 * STEPS * FARTHEST + 1) for each language of the sample."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, steps = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
            for _, held in T.chunks(batch.column("text").to_pylist(), CHUNK):
                b, cuts = word_ids(held)
                langs.append(shared.value.guess(b, cuts))
                steps.append(step_of(shared.value.net.logits(b, cuts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(langs)),
                                              pa.array(np.concatenate(steps))], names=["doc_id", "guessed", "step"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 1)
    # texts stay where they are: only places in the count are joined with the labels
    scored = rows_in_set(docs, "doc_id", hashed_set(labelled, "doc_id"), True).mapInArrow(
        T.bounded(run), "doc_id long, guessed long, step long")
    found = scored.join(labelled, "doc_id").groupBy("guessed", "step", "toxic").count().collect()
    return {(r["guessed"], r["step"], r["toxic"]): r["count"] for r in found}


def classify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)   # fixed size, see BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.empty(0)]
            for _, held in T.chunks(b.column("text").to_pylist(), CHUNK):
                got.append(shared.value.score(held))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(got))], names=["doc_id", "score"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = docs.mapInArrow(T.bounded(run), "doc_id long, score double")
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
