"""Secret scan: fixed patterns and a linear-chain conditional random field (operator 6).

Tokens are runs of ``[A-Za-z0-9+/_.=~-]``.  Open are, whatever their length, the token after a
key word (``_NEAR``, with quotes, blanks and a colon or equals sign between them, or only
some of these) and one that holds a key word, an equals sign and a value; elsewhere those of ``SHORTEST``
characters with a digit and those of ``LONG``.  All other tokens are outside by a hard
constraint, so a text's chain falls apart, without any change to its best path, into the
stretches of open tokens between them.  An open token sees its own shape, the words and
signs around it and its file's make-up.  Tags are begin, inside and outside; training
maximises the likelihood of the chains (forward-backward in numpy) on tags that the fixed
patterns give to a bounded sample, where a value with a digit counts at any length, and
decoding is Viterbi.  Decoded secrets that no pattern has claimed become further spans, of
kind ``tagged``.

Pattern spans stay as they are.  Edge cases: null and empty texts have no spans; repeated
rows are answered as often as they come; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import textkit as T
from gridloom.llm.io import sample_texts

KINDS = ("assign", "access", "hex")
ALL_KINDS = (*KINDS, "tagged")
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000
SHORTEST, LONG = 12, 20       # away from key words an open token has so many characters and a digit, or this many

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=~-]{12,}")
_DIGIT = re.compile(r"[0-9]")
_NEAR = re.compile(r"(?i)(pass|pwd|secret|token|key|auth|bearer|cred|private|api)", re.A)
# the next token after a key word, and what is glued to one by an equals sign
_AFTER = re.compile(r"""(?i:pass|pwd|secret|token|key|auth|bearer|cred|private|api|\bpin\b)[A-Za-z0-9_-]{0,40}"""
                    r"""(?:["']?[ \t]{0,8}(?:[:=]|=>|:=)[ \t]{0,8}["']?|["']?[ \t]{1,8}["']?)(?=[A-Za-z0-9+/_.~-])""", re.A)
_CODE = re.compile(r"[={};<>]")
_WORD = _TOKEN = re.compile(r"[A-Za-z0-9+/_.=~-]+")


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Pattern spans by start, then kind.  All of them lie around a run of 12 or more of a
    token's characters; ``runs`` are those, where known."""
    if runs is None:
        runs = [m.span() for m in _RUN.finditer(text)]
    if not runs:
        return []
    out = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    for a, b in runs:
        if b - a >= 16:
            out += [("hex", *m.span()) for m in _HEX.finditer(text, a, b)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def open_runs(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Open tokens: of ``runs``, those of 12 characters or more, and of any length by a key word."""
    found = {(a, b) for a, b in runs if b - a >= LONG or _DIGIT.search(text, a, b)}
    at = done = 0
    while (m := _AFTER.search(text, at)) is not None:
        a = b = at = m.end()
        if a < done:                                       # in the token found last
            continue
        while a and _TOKEN.match(text, a - 1):             # a token glued to its key is one token
            a -= 1
        b = done = _TOKEN.match(text, b).end()
        found.add((a, b))
    return sorted(found)


def taught_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the field learns from: pattern spans, and values of the assign pattern that are
    shorter but have a digit."""
    if not any(k in text.lower() for k in _KEYS):
        return base
    short = [("assign", *m.span()) for m in _ASSIGN.finditer(text)
             if len(m.group(1)) < SHORTEST and _DIGIT.search(m.group(1))]
    return sorted(base + short, key=lambda s: s[1])


# ------------------------------------------------------------------ features
def _names() -> dict[str, int]:
    n = ["bias", "upper", "lower", "digit", "all3", "hexlow", "hexup", "alldigits", "base64", "dot", "slash2", "hyphen2",
         "under", "equals", "known", "key_before", "key_inside", "set_before", "quote_before", "quote_after", "colon_before",
         "word_before", "word_after", "gap", "line_start", "file_code", "file_key", "file_many"]
    n += [f"len{i}" for i in range(6)] + [f"share{i}" for i in range(5)] + [f"turns{i}" for i in range(5)]
    n += [f"entropy{i}" for i in range(6)]
    return {x: i for i, x in enumerate(n)}


NAMES = _names()
_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "eyJ", "AIza", "glpat")


def _features(text: str, a: int, b: int, file: list[str]) -> list[int]:
    w = text[a:b]
    n = len(w)
    counts = Counter(w)
    digits = sum(counts[c] for c in "0123456789")
    upper, lower = any(map(str.isupper, counts)), any(map(str.islower, counts))
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = ["d" if c.isdigit() else "a" if c.isalpha() else "x" for c in w]
    turns = sum(x != y for x, y in zip(kinds, kinds[1:])) / n
    before, after = text[max(0, a - 40):a], text[b:b + 12]
    near = before.rstrip(" \"'=:")
    word = near[max(near.rfind(" "), near.rfind("\n")) + 1:]
    tests = (("upper", upper), ("lower", lower), ("digit", digits > 0), ("all3", upper and lower and digits > 0),
             ("hexlow", not upper and all(c in "0123456789abcdef" for c in counts)),
             ("hexup", not lower and all(c in "0123456789ABCDEF" for c in counts)), ("alldigits", digits == n),
             ("base64", "+" in counts or w.endswith("=")), ("dot", "." in counts), ("slash2", counts["/"] >= 2),
             ("hyphen2", counts["-"] >= 2), ("under", "_" in counts), ("equals", "=" in w[:-2]),
             ("known", w.startswith(_STARTS)), ("key_before", bool(_NEAR.search(word))),
             ("key_inside", bool(_NEAR.search(w))), ("set_before", before.rstrip(" \"'").endswith("=")),
             ("colon_before", before.rstrip(" \"'").endswith(":")), ("quote_before", before.endswith(("\"", "'"))),
             ("quote_after", after.startswith(("\"", "'"))), ("word_before", word.isalpha()),
             ("word_after", after[1:2].isalpha()), ("gap", before.endswith("  ")),
             ("line_start", not before or before.endswith("\n")))
    on = ["bias", f"len{min(5, n // 12)}", f"share{min(4, 5 * digits // n)}", f"turns{min(4, int(turns * 6))}",
          f"entropy{min(5, int(entropy))}", *file]
    return [NAMES[x] for x in on + [name for name, yes in tests if yes]]


def chains(text: str, runs: list[tuple[int, int]]) -> list[list[tuple[int, int, list[int]]]]:
    """Stretches of open tokens that follow one another: (start, end, features)."""
    open_ = open_runs(text, runs)
    if not open_:
        return []
    file = [name for name, yes in (("file_code", len(_CODE.findall(text)) * 200 > len(text)),
                                   ("file_key", bool(_NEAR.search(text))), ("file_many", len(open_) >= 10)) if yes]
    out, last = [], None
    for a, b in open_:
        if last is None or a - last > 64 or _WORD.search(text, last, a):
            out.append([])
        out[-1].append((a, b, _features(text, a, b, file)))
        last = b
    return out


class Field:
    """Linear chain over outside (0), begin (1), inside (2)."""

    def __init__(self):
        self.w = np.zeros((len(NAMES), 3))
        self.step = np.zeros((3, 3))

    def _scores(self, chain) -> np.ndarray:
        s = np.stack([self.w[on].sum(axis=0) for _, _, on in chain])
        s[0] += self.step[0]                       # what stands before and after is outside
        s[0, 2] = -1e9
        s[-1] += self.step[:, 0]
        return s

    def viterbi(self, chain) -> list[int]:
        s = self._scores(chain)
        step = self.step.copy()
        step[0, 2] = -1e9                          # inside never follows outside
        best, come = s[0], []
        for t in range(1, len(s)):
            z = best[:, None] + step
            come.append(z.argmax(axis=0))
            best = z.max(axis=0) + s[t]
        tags = [int(best.argmax())]
        for c in reversed(come):
            tags.append(int(c[tags[-1]]))
        return tags[::-1]

    def fit(self, data: list[tuple[list, list[int]]], rounds: int = 60, rate: float = 0.1, decay: float = 1e-3) -> "Field":
        """Gradient ascent (Adam) on the chains' likelihood; chains of one length at a time."""
        groups: dict[int, list] = {}
        for chain, tags in data:
            groups.setdefault(len(chain), []).append((chain, tags))
        packed = []
        for n, held in groups.items():
            on = np.zeros((len(held), n, len(NAMES)), dtype=np.float32)
            y = np.array([t for _, t in held])
            for i, (chain, _) in enumerate(held):
                for j, (_, _, f) in enumerate(chain):
                    on[i, j, f] = 1
            packed.append((on, y))
        total = sum(y.size for _, y in packed)
        m = [np.zeros_like(self.w), np.zeros_like(self.step)]
        v = [np.zeros_like(self.w), np.zeros_like(self.step)]
        for it in range(1, rounds + 1):
            gw, gs = np.zeros_like(self.w), np.zeros_like(self.step)
            for on, y in packed:
                s = on @ self.w
                s[:, 0] += self.step[0]
                s[:, -1] += self.step[:, 0]
                s[:, 0, 2] = -1e9
                step = self.step.copy()
                step[0, 2] = -1e9
                k = s.shape[1]
                fwd, bwd = [s[:, 0]], [np.zeros_like(s[:, 0])]
                for t in range(1, k):
                    fwd.append(_lse(fwd[-1][:, :, None] + step, 1) + s[:, t])
                for t in range(k - 1, 0, -1):
                    bwd.append(_lse(step + (s[:, t] + bwd[-1])[:, None, :], 2))
                bwd = bwd[::-1]
                z = _lse(fwd[-1], 1)
                for t in range(k):
                    p = np.exp(fwd[t] + bwd[t] - z[:, None])
                    d = np.eye(3)[y[:, t]] - p
                    gw += on[:, t].T @ d
                    if t == 0:
                        gs[0] += d.sum(axis=0)
                    if t == k - 1:
                        gs[:, 0] += d.sum(axis=0)
                    if t:
                        q = np.exp(fwd[t - 1][:, :, None] + step + (s[:, t] + bwd[t])[:, None, :] - z[:, None, None])
                        np.add.at(gs, (y[:, t - 1], y[:, t]), 1)
                        gs -= q.sum(axis=0)
            for x, g, a, b in zip((self.w, self.step), (gw, gs), m, v):
                g = g / max(1, total) - decay * x
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                x += rate * (a / (1 - 0.9 ** it)) / (np.sqrt(b / (1 - 0.999 ** it)) + 1e-8)
        return self


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def learn(texts: list[str]) -> Field:
    """Field from the tags that the fixed patterns give."""
    data = []
    for text in texts:
        runs = [m.span() for m in _RUN.finditer(text)]
        base = taught_spans(text, base_spans(text, runs))
        for chain in chains(text, runs):
            for i in range(0, len(chain), 50):
                part, tags, own = chain[i:i + 50], [], None
                for a, b, _ in part:
                    hit = next((s for s in base if s[1] < b and a < s[2]), None)
                    tags.append(0 if hit is None else 2 if hit == own and tags[-1] else 1)
                    own = hit
                data.append((part, tags))
    return Field().fit(data) if data else Field()


def train(documents: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Field:
    return learn(sample_texts(documents, r"[A-Za-z0-9+/_.=~-]{20}|[0-9][A-Za-z0-9+/_.=~-]{11}|[A-Za-z0-9+/_.=~-]{11}[0-9]|"
                              + _AFTER.pattern, rows, chars))


def spans(field: Field, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(pattern spans, spans that the field adds)."""
    runs = [m.span() for m in _RUN.finditer(text)]
    base = base_spans(text, runs)
    more = []
    for chain in chains(text, runs):
        begin = None
        tags = field.viterbi(chain)
        for i, tag in enumerate([*tags, 0]):
            if begin is not None and tag != 2:
                a, b = chain[begin][0], chain[i - 1][1]
                if not any(s < b and a < e for _, s, e in base):
                    more.append(("tagged", a, b))
                begin = None
            if tag == 1:
                begin = i
    return base, more


def find(documents: DataFrame, field: Field) -> DataFrame:
    """One row per row: doc_id, base (array of kind, start, end) and added likewise."""
    shared = documents.sparkSession.sparkContext.broadcast(field)      # fixed size
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    as_row = lambda s: [{"kind": k, "start": a, "end": b} for k, a, b in s]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [spans(shared.value, t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([as_row(x) for x, _ in got], span),
                                              pa.array([as_row(y) for _, y in got], span)],
                                             names=["doc_id", "base", "added"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.mapInArrow(T.bounded(run), f"doc_id long, base {kind}, added {kind}")


def masked(documents: DataFrame, field: Field, mark: str = "[secret]") -> DataFrame:
    """``documents``, all columns, with each secret of ``text`` replaced; overlapping spans
    are replaced as one.  Null texts stay null; ``n_chars``, where there, follows the text."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    schema = documents.schema

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base, more = spans(shared.value, text)
        if not base and not more:
            return text
        out, last = [], 0
        for _, a, b in sorted(base + more, key=lambda s: s[1:]):
            if a >= last:
                out += [text[last:a], mark]
            last = max(last, b)
        return "".join([*out, text[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("text")
            before = b.column(at).to_pylist()
            after = [clean(t) for t in before]
            b = b.set_column(at, b.schema.field(at), pa.array(after, b.schema.field(at).type))
            k = b.schema.get_field_index("n_chars")
            if k >= 0:
                n = [c if x is y or x == y else len(y) for c, x, y in zip(b.column(k).to_pylist(), before, after)]
                b = b.set_column(k, b.schema.field(k), pa.array(n, b.schema.field(k).type))
            yield b
    return documents.mapInArrow(T.bounded(run), schema)
