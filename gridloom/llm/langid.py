"""Word-first backoff language identification (operator 7).

Known words score by their log frequency in each language.  A word the model has not seen
falls back to its character n-grams: the longest n of which the model knows any gives the
mean of their log frequencies, times a discount per step down.  A text's score per
language is the sum over its words; the answer is the best one, its confidence the
posterior over the mean word, spread with the number of words up to ``SPREAD``.

Counts cover every word of every training row: tasks count their own words, Spark adds them
up (partial sums, so a language with a third of all rows is no burden), counts the n-grams of
all words with their multiplicity, and totals both per language.  Only the table of whole
words is bounded: it holds the ``WORDS`` most frequent of each language (fewer where there
are so many languages that this exceeds ``ENTRIES``); all others go by their n-grams.  The
n-gram tables hold every n-gram met.  Languages are totalled in Spark before anything is
collected; ``LANGUAGES``, more than there are language codes, only stops a column that does
not hold languages.  Counts are held sparsely, as (language, count) of each word or n-gram.

Words are runs of letters, lower-cased.  Edge cases: a null text or one without letters is
``und`` with score 0; a model without languages answers ``und``; rows with a null language
do not train; repeated rows are answered as often as they come; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import textkit as T
from gridloom.llm.io import cut

WORDS = 20_000                # most frequent words of a language that are looked up whole
ENTRIES = 4_000_000           # the same, of all languages together
SHARES = 64                   # parts in which a language's words are ranked first
LANGUAGES = 8_000             # ISO 639-3 has fewer codes
LONGEST = 4                   # character n-grams of this many letters, and shorter
DISCOUNT = 0.85               # per step from words down to single letters
SPREAD = 20                   # words whose evidence a confidence adds up
CACHE = 150_000               # unseen words kept per process
CACHE_ENTRIES = 4_000_000     # and their entries
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}
    size = 0

    def out():
        for lang, c in held.items():
            keys, n = list(c.keys()), list(c.values())
            for i in range(0, len(keys), 20_000):
                k = keys[i:i + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.string()),
                                                  pa.array(n[i:i + 20_000], pa.int64())], names=["lang", "word", "n"])

    for batch in T.slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            c = held.setdefault(lang, Counter())
            before = len(c)
            c.update(words(text))
            size += len(c) - before
            if size > 250_000:        # bounds a task's memory; counts are added up later
                yield from out()
                held, size = {}, 0
    yield from out()


def _grams(word: str, m: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[j:j + m] for j in range(len(padded) - m + 1)]


def _count_grams(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            pairs, n = list(held.keys()), list(held.values())
            for i in range(0, len(pairs), 20_000):
                lang, gram = zip(*pairs[i:i + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(gram, pa.string()),
                                                  pa.array(n[i:i + 20_000], pa.int64())], names=["lang", "gram", "n"])

        for batch in T.slices(batches):
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                for m in range(1, longest + 1):
                    for g in _grams(word, m):
                        held[lang, g] += n
                if len(held) > 250_000:       # bounds a task's memory; counts are added up later
                    yield from out()
                    held.clear()
        yield from out()
    return run


def _places(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of these rows, and for each the index into ``rows``."""
    n = starts[rows + 1] - starts[rows]
    which = np.repeat(np.arange(len(rows)), n)
    return np.arange(len(which)) + np.repeat(starts[rows] - np.cumsum(n) + n, n), which


class Table:
    """Log frequencies, held as what an entry adds to the value of a missing one."""

    def __init__(self, grams: pa.Array, langs: np.ndarray, counts: np.ndarray, totals: np.ndarray, size: int | None = None):
        """Each (gram, language) once; ``totals`` by language and ``size``, the number of
        distinct grams, of all there are, held here or not."""
        order = np.lexsort((langs, codes := np.asarray((every := grams.dictionary_encode()).indices)))
        rows = len(every.dictionary)
        self.index = {g: i for i, g in enumerate(every.dictionary.to_pylist())}
        self.starts = np.searchsorted(codes[order], np.arange(rows + 1)).astype(np.int64)
        self.langs = langs[order].astype(np.int32)
        self.more = np.log(2.0 * counts[order] + 1).astype(np.float32)      # log of (n + 0.5) / 0.5
        self.missing = np.log(0.5 / (totals + 0.5 * (rows if size is None else size) + 1))

    def __getitem__(self, row: int) -> np.ndarray:
        out = self.missing.copy()
        at = slice(self.starts[row], self.starts[row + 1])
        out[self.langs[at]] += self.more[at]
        return out


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, rows: list[tuple[str, str, int]], longest: int = LONGEST, discount: float = DISCOUNT):
        held: Counter = Counter()
        grams: Counter = Counter()
        for lang, word, n in rows:
            held[lang, word] += n
            for m in range(1, longest + 1):
                for g in _grams(word, m):
                    grams[lang, g] += n
        total = Counter()
        for (lang, _), n in held.items():
            total[lang] += n
        as_table = lambda c: pa.table({"lang": pa.array([x for x, _ in c], pa.string()),
                                       "gram": pa.array([g for _, g in c], pa.string()),
                                       "n": pa.array(list(c.values()), pa.int64())})
        self._fill(as_table(held), as_table(grams), total, None, longest, discount)

    @classmethod
    def counted(cls, held: pa.Table, grams: pa.Table, total: dict[str, int], size: int,
                longest: int = LONGEST, discount: float = DISCOUNT) -> Model:
        """From words to look up and all n-grams (lang, gram, n), with the words of each
        language and the distinct words counted over all of them."""
        out = cls.__new__(cls)
        out._fill(held, grams, total, size, longest, discount)
        return out

    def _fill(self, held: pa.Table, grams: pa.Table, total: dict[str, int], size: int | None, longest: int,
              discount: float) -> None:
        self.langs, self.discount = sorted(total), discount
        k = len(self.langs)
        names = pa.array(self.langs, pa.string())

        def table(t: pa.Table, totals: np.ndarray | None, size: int | None) -> Table:
            langs = pc.index_in(t["lang"], names).to_numpy().astype(np.int64)
            n = t["n"].to_numpy().astype(np.float64)
            totals = np.bincount(langs, n, k) if totals is None else totals
            return Table(t["gram"].combine_chunks(), langs, n, totals, size)

        every = [table(held, np.array([total[x] for x in self.langs], dtype=np.float64), size)]
        length = pc.utf8_length(grams["gram"])
        every += [table(grams.filter(pc.equal(length, m)), None, None) for m in range(1, longest + 1)]
        self.tables: list[tuple[dict[str, int], Table]] = [(t.index, t) for t in every]       # 0: whole words


class Scorer(dict):
    """Row of each word met in growing sparse tables.

    A word's scores are the base of its level (whole word, n-gram length, or nothing known)
    and what its entries add to that."""

    def __init__(self, model: Model):
        self.model, self.rows = model, model.tables[0][1]
        deepest = len(model.tables) - 1
        self.factor = [model.discount ** (deepest + 1 - m) if m else 1.0 for m in range(deepest + 1)]
        self.base = np.stack([t.missing * f for (_, t), f in zip(model.tables, self.factor)]
                             + [np.zeros(len(model.langs))])
        self.known = len(self.rows.index)
        super().__init__()
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.update(self.rows.index)
        self.level = np.zeros(self.known, dtype=np.int8)
        self.starts, self.langs, self.more = self.rows.starts, self.rows.langs, self.rows.more
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self.level) + len(self.new)
        self.new.append(word)
        return at

    def _learn(self) -> None:
        """Rows of the new words, from the longest n-grams of which any is known."""
        k, tables = len(self.model.langs), self.model.tables
        level = np.full(len(self.new), len(tables), dtype=np.int8)
        rows: list[list[int]] = [[] for _ in tables]
        words_: list[list[int]] = [[] for _ in tables]
        share = np.ones(len(self.new))
        for i, word in enumerate(self.new):
            for m in range(len(tables) - 1, 0, -1):
                index = tables[m][0]
                got = [index[g] for g in dict.fromkeys(_grams(word, m)) if g in index]
                if got:
                    level[i] = m
                    rows[m] += got
                    words_[m] += [i] * len(got)
                    share[i] = self.factor[m] / len(got)
                    break
        keys, sums = [np.empty(0, dtype=np.int64)], [np.empty(0)]
        for m in range(1, len(tables)):
            if rows[m]:
                t = tables[m][1]
                at, which = _places(t.starts, np.array(rows[m]))
                key, back = np.unique(np.array(words_[m])[which] * k + t.langs[at], return_inverse=True)
                keys.append(key)
                sums.append(np.bincount(back, t.more[at], len(key)))
        key, more = np.concatenate(keys), np.concatenate(sums)
        order = np.argsort(key)
        key, more = key[order], more[order]
        word = key // max(1, k)
        self.langs = np.concatenate((self.langs, (key % max(1, k)).astype(np.int32)))
        self.more = np.concatenate((self.more, (more * share[word]).astype(np.float32)))
        ends = np.searchsorted(word, np.arange(len(self.new)), side="right") + self.starts[-1]
        self.starts = np.concatenate((self.starts, ends))
        self.level = np.concatenate((self.level, level))
        self.new = []

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        ids, ends = [], []
        for t in texts:
            if t:
                ids.extend(map(self.__getitem__, words(t)))
            ends.append(len(ids))
        if self.new:
            self._learn()
        k = len(self.model.langs)
        if not k:
            return [(UNKNOWN, 0.0)] * len(texts)
        flat = np.array(ids, dtype=np.int64)
        n = np.diff(np.array([0, *ends]))
        text = np.repeat(np.arange(len(texts)), n)
        deep = len(self.base)
        levels = np.bincount(text * deep + self.level[flat], minlength=len(texts) * deep).reshape(-1, deep)
        at, which = _places(self.starts, flat)
        sums = np.bincount(text[which] * k + self.langs[at], self.more[at], len(texts) * k).reshape(-1, k)
        sums = sums + levels @ self.base
        out = []
        for total, count in zip(sums, n.tolist()):
            if not count:
                out.append((UNKNOWN, 0.0))
                continue
            mean = total / count
            p = np.exp((mean - mean.max()) * min(count, SPREAD))
            best = int(np.argmax(p))
            out.append((self.model.langs[best], float(p[best] / p.sum())))
        if len(self) > self.known + CACHE or len(self.more) > len(self.rows.more) + CACHE_ENTRIES:
            self._reset()
        return out


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of each language's ``most`` most frequent words.  They are ranked in shares by
    hash first: one of the best is among the best of its share, so no task ranks more than
    SHARES * most words of a language."""
    share = F.pmod(F.xxhash64("word"), F.lit(SHARES))
    for by in (["lang", share], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "word"))
        counts = counts.withColumn("place", place).where(F.col("place") <= most).drop("place")
    return counts


def train(rows: DataFrame, words_kept: int | None = None, looked_up: int = WORDS, languages: int = LANGUAGES) -> Model:
    """Model of the (text, lang) rows; null languages or texts do not count.  ``words_kept``:
    learn from so many words of each language alone; all words where it is not given."""
    usable = rows.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = cut(T.map_batches(usable, ["lang", "text"], "lang string, word string, n long", _count)
                 .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    if words_kept is not None:
        counts = _most_frequent(counts, words_kept)
    found = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    total = {r["lang"]: r["n"] for r in found}
    if counts.select("lang").distinct().count() > len(total):
        names = rows.sparkSession.createDataFrame([(x,) for x in total], "lang string")
        counts = counts.join(F.broadcast(names), "lang", "left_semi")      # at most ``languages``
    size = counts.select("word").distinct().count()
    held = _most_frequent(counts, max(1, min(looked_up, ENTRIES // max(1, len(total))))).select("word").distinct()
    held = counts.join(held, "word", "left_semi").select("lang", F.col("word").alias("gram"), "n").toArrow()
    grams = (T.map_batches(counts, ["lang", "word", "n"], "lang string, gram string, n long", _count_grams(LONGEST))
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    order = [("gram", "ascending"), ("lang", "ascending")]     # rows, and so sums, in one order
    return Model.counted(held.sort_by(order), grams.sort_by(order), total, size)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score added (doc_id, text in; doc_id, lang_pred, score out)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words: see ENTRIES; n-grams: all of up to LONGEST letters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in T.slices(batches):
            texts = b.column("text").to_pylist()
            got = []
            for _, held in T.chunks(texts, 500_000):
                got += scorer.score(held)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return T.map_batches(docs, ["doc_id", "text"], "doc_id long, lang_pred string, score double", run)


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (every column kept) whose language is found with at least this
    confidence; the others are rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in T.slices(batches):
            got = []
            for _, held in T.chunks(b.column("text").cast(pa.string()).to_pylist(), 500_000):
                got += scorer.score(held)
            keep = pa.array([g[0] != UNKNOWN and g[1] >= least for g in got], pa.bool_())
            yield b.filter(keep)
    return docs.mapInArrow(T.bounded(run), docs.schema)
