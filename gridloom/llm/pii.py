"""Personal data: fixed patterns and a skip-chain conditional random field (operator 2).

Tokens are runs of anything but white space.  A token without a digit or an at sign is
``none`` by a hard constraint, so the field's nodes are the other ("open") tokens; constrained
neighbours enter their potentials.  Each node sees its shape and its neighbours' words; a chain
edge joins open tokens that follow one another; a skip edge joins each open token to
the next one in the document with the same letters and digits, or, for longer ones, the
same shape and first characters.  Weights come from pseudo-likelihood in numpy, on labels
that the fixed patterns give to a bounded sample.  Decoding is loopy sum-product message
passing over a whole batch of documents at once; tokens whose marginal passes
``CERTAIN`` and that no pattern has claimed become further spans.

Pattern spans stay as they are: the field only adds.  Edge cases: null and empty texts
have no spans; repeated rows are answered as often as they come; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import textkit as T
from gridloom.llm.io import sample_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000
CERTAIN = 0.9
ROUNDS, DAMP = 30, 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OPEN = re.compile(r"[0-9@]")
_SPACES = "\t\n\v\f\r "


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by kind, then start.  Each scan is linear in the text."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append(("email", a, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    ips, cards, phones = [], [], []
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        a = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            b = a + sum(map(len, four)) + 3
            if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in four):
                ips.append(("ip", a, b))
            a = b + 1
    for m in _DIGITS.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            cards.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                phones.append(("phone", m.start(), m.end()))
    return out + ips + cards + phones


# ------------------------------------------------------------------ features
_WORD = re.compile(r"[^\t\n\v\f\r ]+")
_EDGE = ".,;:!?()[]{}<>\"'|"


def _feature_names() -> dict[str, int]:
    names = ["bias", "at", "plus", "paren", "slash", "percent", "letters", "dots0", "dots1", "dots2", "dots3", "dots4",
             "hyphens0", "hyphens1", "hyphens2", "octets", "luhn", "alldigits", "domain", "local",
             "prev_plus", "prev_paren", "next_paren", "prev_digits", "next_digits", "prev_open", "next_open", "colon"]
    names += [f"digits{n}" for n in range(21)] + [f"prevlen{n}" for n in range(8)] + [f"nextlen{n}" for n in range(8)]
    return {n: i for i, n in enumerate(names)}


NAMES = _feature_names()


def _features(words: list[str], i: int) -> list[int]:
    raw = words[i]
    w = raw.strip(_EDGE)
    n = sum(c in "0123456789" for c in w)
    prev, nxt = (words[i - 1] if i else ""), (words[i + 1] if i + 1 < len(words) else "")
    on = ["bias", f"digits{min(n, 20)}", f"dots{min(w.count('.'), 4)}", f"hyphens{min(w.count('-'), 2)}",
          f"prevlen{min(sum(c.isdigit() for c in prev), 7)}", f"nextlen{min(sum(c.isdigit() for c in nxt), 7)}"]
    parts = w.split(".")
    digits = "".join(c for c in w if c in "0123456789")
    tests = (("at", "@" in w), ("plus", w.startswith("+")), ("paren", raw.startswith("(")), ("slash", "/" in w),
             ("percent", "%" in w), ("letters", any(c.isalpha() for c in w)),
             ("octets", len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)),
             ("luhn", 13 <= n <= 19 and luhn(digits)), ("alldigits", n == len(w) > 0),
             ("domain", "@" in w and "." in w.rpartition("@")[2].strip(".")),
             ("local", "@" in w and bool(w.partition("@")[0])), ("prev_plus", prev.startswith("+")),
             ("prev_paren", prev.startswith("(")), ("next_paren", nxt.startswith("(")),
             ("prev_digits", prev.isdigit()), ("next_digits", nxt.isdigit()), ("prev_open", bool(_OPEN.search(prev))),
             ("next_open", bool(_OPEN.search(nxt))), ("colon", ":" in w))
    on += [name for name, yes in tests if yes]
    return [NAMES[x] for x in on]


class Graph:
    """Open tokens of many documents with their chain and skip edges."""

    def __init__(self):
        self.text: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.on: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.free: list[tuple[bool, bool]] = []      # a constrained neighbour before, after

    def add(self, index: int, text: str) -> None:
        found = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[a:b] for a, b in found]
        last: dict[str, int] = {}
        before = -2
        for i, w in enumerate(words):
            if not _OPEN.search(w):
                continue
            node = len(self.text)
            a, b = found[i]
            lead, tail = len(w) - len(w.lstrip(_EDGE)), len(w) - len(w.rstrip(_EDGE))
            if w[lead:lead + 1] and w[max(0, lead - 1):lead] == "(" and lead:
                lead -= 1                            # the bracket of an area code belongs to it
                tail = max(0, tail - 1) if ")" in w[len(w) - tail:] else tail
            self.text.append(index)
            self.span.append((a + lead, b - tail) if lead + tail < len(w) else (a, b))
            self.on.append(_features(words, i))
            if before == i - 1:
                self.chain.append((node - 1, node))
            self.free.append((before != i - 1, i + 1 >= len(words) or not _OPEN.search(words[i + 1])))
            before = i
            core = "".join(c for c in w.lower() if c.isalnum())
            keys = [core] if len(core) >= 5 else []
            if len(core) >= 9:
                keys.append("~" + "".join("9" if c.isdigit() else "a" for c in core) + core[:4])
            linked = set()
            for k in keys:
                if k in last and last[k] not in linked:
                    self.skip.append((last[k], node))
                    linked.add(last[k])
                last[k] = node


def _expand(on: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, on), dtype=np.int64, count=len(on))
    return np.concatenate([np.array(x, dtype=np.int64) for x in on]), np.concatenate(([0], np.cumsum(n)))


class Field:
    """Weights: features by label, chain and skip potentials; label 0 is none."""

    def __init__(self):
        k = len(KINDS) + 1
        self.w, self.chain, self.skip = np.zeros((len(NAMES), k)), np.zeros((k, k)), np.zeros((k, k))

    def unary(self, g: Graph) -> np.ndarray:
        flat, cuts = _expand(g.on)
        u = np.add.reduceat(self.w[flat], cuts[:-1], axis=0)
        free = np.array(g.free, dtype=bool)
        u[free[:, 0]] += self.chain[0]               # from a neighbour fixed to none
        u[free[:, 1]] += self.chain[:, 0]
        return u

    def fit(self, texts: list[str], steps: int = 250, rate: float = 0.1, decay: float = 1e-4) -> "Field":
        """Pseudo-likelihood: each label given its neighbours' labels."""
        g, y = Graph(), []
        for i, t in enumerate(texts):
            at = len(g.text)
            g.add(i, t)
            spans = base_spans(t)
            for a, b in g.span[at:]:
                y.append(next((KINDS.index(k) + 1 for k, s, e in spans if s < b and a < e), 0))
        if not y:
            return self
        y = np.array(y)
        flat, cuts = _expand(g.on)
        owner = np.repeat(np.arange(len(y)), np.diff(cuts))
        c, s = np.array(g.chain or np.zeros((0, 2)), dtype=np.int64), np.array(g.skip or np.zeros((0, 2)), dtype=np.int64)
        free = np.array(g.free, dtype=bool)
        k = len(KINDS) + 1
        hot = np.eye(k)[y]
        params = [self.w, self.chain, self.skip]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            z = np.add.reduceat(self.w[flat], cuts[:-1], axis=0)
            z[free[:, 0]] += self.chain[0]
            z[free[:, 1]] += self.chain[:, 0]
            np.add.at(z, c[:, 1], self.chain[y[c[:, 0]]])
            np.add.at(z, c[:, 0], self.chain[:, y[c[:, 1]]].T)
            np.add.at(z, s[:, 1], self.skip[y[s[:, 0]]])
            np.add.at(z, s[:, 0], self.skip[y[s[:, 1]]])
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - hot) / len(y)
            gw, gc, gs = (np.zeros_like(x) for x in params)
            np.add.at(gw, flat, d[owner])
            gc[0] += d[free[:, 0]].sum(axis=0)
            gc[:, 0] += d[free[:, 1]].sum(axis=0)
            np.add.at(gc, y[c[:, 0]], d[c[:, 1]])
            np.add.at(gc.T, y[c[:, 1]], d[c[:, 0]])
            np.add.at(gs, y[s[:, 0]], d[s[:, 1]])
            np.add.at(gs, y[s[:, 1]], d[s[:, 0]])
            gs = (gs + gs.T) / 2
            for x, gr, a, b in zip(params, (gw, gc, gs), m, v):
                gr = gr + decay * x
                a += 0.1 * (gr - a)
                b += 0.001 * (gr * gr - b)
                x -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        return self

    def marginals(self, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Loopy belief propagation, all edges of all documents at once, damped, until the
        messages settle or ``rounds`` are over.  Exact where a document's graph is a tree."""
        u = self.unary(g)
        k = u.shape[1]
        edges = np.array(g.chain + g.skip, dtype=np.int64).reshape(-1, 2)
        if len(edges):
            pair = np.concatenate((np.repeat(self.chain[None], len(g.chain), axis=0),
                                   np.repeat(self.skip[None], len(g.skip), axis=0)))
            src = np.concatenate((edges[:, 0], edges[:, 1]))
            dst = np.concatenate((edges[:, 1], edges[:, 0]))
            pots = np.concatenate((pair, pair.transpose(0, 2, 1)))
            back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
            msg = np.zeros((len(src), k))
            for _ in range(rounds):
                belief = u.copy()
                np.add.at(belief, dst, msg)
                out = (belief[src] - msg[back])[:, :, None] + pots
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                moved = np.abs(new - msg).max()
                msg = DAMP * msg + (1 - DAMP) * new
                if moved < 1e-3:
                    break
            np.add.at(u, dst, msg)
        p = np.exp(u - u.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def train(documents: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Field:
    return Field().fit(sample_texts(documents, "[0-9@]", rows, chars))


def added_spans(field: Field, texts: list[str], base: list[list[tuple[str, int, int]]],
                certain: float = CERTAIN) -> list[list[tuple[str, int, int]]]:
    """Spans that the field adds to each text."""
    g = Graph()
    for i, t in enumerate(texts):
        if _OPEN.search(t):
            g.add(i, t)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not g.text:
        return out
    p = field.marginals(g)
    best = p.argmax(axis=1)
    tied = {b for _, b in g.chain}
    prev = None                                  # the span that the last node ended
    for node in np.flatnonzero((best > 0) & (p.max(axis=1) >= certain)).tolist():
        i, (a, b) = g.text[node], g.span[node]
        kind = KINDS[best[node] - 1]
        if any(s < b and a < e for _, s, e in base[i]):
            prev = None
            continue
        # the parts of a phone number, one space apart, are one span
        if (prev and kind == "phone" and prev == (node - 1, i, kind) and node in tied
                and texts[i][out[i][-1][2]:a].strip("() ") == "" and a - out[i][-1][2] <= 2):
            out[i][-1] = (kind, out[i][-1][1], b)
        else:
            out[i].append((kind, a, b))
        prev = (node, i, kind)
    return out


def find(documents: DataFrame, field: Field) -> DataFrame:
    """One row per row: doc_id, base (array of kind, start, end) and added likewise."""
    shared = documents.sparkSession.sparkContext.broadcast(field)      # fixed size
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    as_rows = lambda x: [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every, more = [], []
            for _, held in T.chunks(b.column("text").to_pylist()):
                base = [base_spans(t) if _OPEN.search(t) else [] for t in held]
                every += as_rows(base)
                more += as_rows(added_spans(shared.value, held, base))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(every, span), pa.array(more, span)],
                                             names=["doc_id", "base", "added"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.mapInArrow(T.bounded(run), f"doc_id long, base {kind}, added {kind}")


def digest(found: DataFrame, kinds: tuple[str, ...] = KINDS, by_kind: bool = True) -> DataFrame:
    """Counts, hash of the base spans and all spans, from ``find``'s rows."""
    order = "array_position(array({}), x.kind)".format(", ".join(f"'{k}'" for k in kinds))
    first, second = (order, "x.start") if by_kind else ("x.start", order)
    line = ("array_join(transform(array_sort(transform({c}, x -> struct({a} AS a, {b} AS b, x.kind AS kind, "
            "x.start AS start, x.end AS end))), x -> concat_ws(':', x.kind, x.start, x.end)), ',')")
    text = lambda c: F.expr(line.format(c=c, a=first, b=second))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"),
                        text("concat(base, added)").alias("spans"), F.size("added").cast("long").alias("n_added"))
