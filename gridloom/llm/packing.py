"""Best-fit packing planned on the length histogram (operator 3).

A document is its byte-level BPE ids followed by id 0.  Documents longer than the capacity
are cut into capacity-long pieces, the first one taking the rest.  Planning sees only how
many pieces there are of each length (at most ``capacity`` counts, whatever the corpus):
best-fit decreasing runs over those counts and yields runs of equal slots.  Pieces then
take the planned slots by their rank within their length, which comes from per-partition
counts and running sums, so no length, however common, is gathered in one task.

Ids.  The pre-tokens of a batch are cut and hashed with vector operations and looked up in
a per-process table; only pre-tokens not met before are encoded, once, with the same
merges.  Texts with characters outside the Latin range or with a special token's string go
whole through ``tokenizers``.  Tests hold both ways to the same ids.

Edge cases: null or empty text is the single id 0; repeated rows are packed as often as they
come; a null ``doc_id`` stays null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window

from gridloom.llm import textkit as T
from gridloom.llm.io import cut

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k"
CACHE_ENTRIES = 500_000       # pre-tokens kept per process

_UNUSUAL = re.compile("[^\t\n\r -~¡-ɏ]|<\\|endoftext\\|>")
_LETTER, _NUMBER, _OTHER, _BLANK, _END = 1, 2, 3, 4, 0


def _kinds() -> np.ndarray:
    """Letter, number, white space or other, by code point below 0x250; 0 ends a text."""
    k = np.full(0x250, _OTHER, dtype=np.uint8)
    k[0] = _END
    k[[9, 10, 13, 32]] = _BLANK
    for a, b in ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA),
                 (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F)):
        k[a:b + 1] = _LETTER
    for a, b in ((0x30, 0x39), (0xB2, 0xB3), (0xB9, 0xB9), (0xBC, 0xBE)):
        k[a:b + 1] = _NUMBER
    return k


_KIND = _kinds()


def pretoken_starts(codes: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points whose texts each end with a 0.

    A pre-token is a contraction, a run of letters, numbers or other signs with at most one
    space before it, or white space; the last white space before a word stands alone unless
    it is a space, which then belongs to the word."""
    kind = _KIND[codes]
    start = np.ones(len(codes), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    start[kind == _END] = True
    # white space right before a word
    last = np.flatnonzero((kind[:-1] == _BLANK) & (kind[1:] != _BLANK) & (kind[1:] != _END))
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    quote = np.flatnonzero((codes == 39) & start)
    if len(quote):
        padded = np.concatenate((codes, np.zeros(2, dtype=codes.dtype)))
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for at, n in ((quote[one], 1), (quote[two & ~one], 2)):
            start[at + 1] = False
            start[at + n + 1] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of whole texts; one per process."""

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers as P
        import tiktoken

        self.path, self.whole = P.path(f"{name}.json"), None     # read only when a text needs it
        with open(P.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.piece = tiktoken.Encoding("pieces", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.newline = self.piece.encode_ordinary("\n")[0]
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.at = np.empty(0, dtype=np.int64)
        self.n = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        """Encodes new pre-tokens, in one call, one to a line."""
        if len(self.keys) + len(words) > CACHE_ENTRIES:
            self.forget()
        plain = [i for i, w in enumerate(words) if not _BLANKS.search(w)]
        ids: list[np.ndarray] = [None] * len(words)
        if plain:
            got = np.asarray(self.piece.encode_to_numpy("".join(words[i] + "\n" for i in plain)), dtype=np.uint32)
            ends = np.flatnonzero(got == self.newline)
            begin = np.concatenate(([0], ends[:-1] + 1))
            for i, a, b in zip(plain, begin.tolist(), ends.tolist()):
                ids[i] = got[a:b]
        for i, x in enumerate(ids):
            if x is None:
                ids[i] = np.array(self.piece.encode_ordinary(words[i]), dtype=np.uint32)
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        at = len(self.flat) + np.cumsum(n) - n
        self.flat = np.concatenate((self.flat, *ids))
        keys, at, n = (np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.n, n)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.n = keys[order], at[order], n[order]

    def _usual(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        start = pretoken_starts(codes)
        end = np.append(start[1:], len(codes))
        stop = codes[start] == 0
        run = codes.astype(np.uint64) + np.uint64(1)
        run *= T.powers(T._BASE, len(codes))
        np.cumsum(run, out=run)
        before = np.where(start > 0, run[start - 1], np.uint64(0))
        keys = T.mix64((run[end - 1] - before) * T.powers(T._INVERSE, len(codes))[start]
                       + (end - start).astype(np.uint64) * T._M1)
        text_end = np.flatnonzero(stop)
        word = ~stop
        keys, start, end = keys[word], start[word], end[word]
        # tokens of text i: those before its end mark
        upto = text_end - np.arange(len(text_end))
        if not len(keys):
            return [np.empty(0, dtype=np.uint32) for _ in texts]
        uniq, first, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        have = np.zeros(len(uniq), dtype=bool)
        inside = at < len(self.keys)
        have[inside] = self.keys[at[inside]] == uniq[inside]
        if not have.all():
            new = np.flatnonzero(~have) if len(self.keys) + (~have).sum() <= CACHE_ENTRIES else np.arange(len(uniq))
            self._learn([joined[start[first[i]]:end[first[i]]] for i in new.tolist()], uniq[new])
            at = np.searchsorted(self.keys, uniq)
        at = at[back]
        n, src = self.n[at], self.at[at]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = self.flat[np.repeat(src - total[:-1], n) + np.arange(total[-1])]
        cuts = np.concatenate(([0], total[upto]))
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = [i for i, t in enumerate(texts) if _UNUSUAL.search(t)]
        if not odd:
            return self._usual(texts)
        out: list[np.ndarray] = [None] * len(texts)
        rest = [i for i in range(len(texts)) if i not in set(odd)]
        for i, x in zip(rest, self._usual([texts[i] for i in rest])):
            out[i] = x
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.path)
        for i in odd:
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32)
        return out


_BLANKS = re.compile(r"[\t\n\r]|^ +$|^ .* ")
_encoders: dict[str, Encoder] = {}


def encoder(name: str = TOKENIZER) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)] if n > first else [(0, n)]


def _pieces(capacity: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        part = TaskContext.get().partitionId()
        tok = encoder(name)
        zero = np.zeros(1, dtype="<u4")
        for batch in T.slices(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            rows = []
            for begin, held in T.chunks(batch.column("text").to_pylist(), 300_000):
                for i, ids in enumerate(tok.encode(held)):
                    raw = np.concatenate((ids, zero)).astype("<u4").tobytes()
                    for k, (a, n) in enumerate(piece_bounds(len(raw) // 4, capacity)):
                        rows.append((doc_ids[begin + i], k, a, n, zlib.crc32(raw[4 * a:4 * (a + n)]), part, int(ranks[n])))
                        ranks[n] += 1
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
    return run


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (length, first rank, how many, first sequence,
    offset); the r-th item of a run goes to sequence first + r.

    ``room[r]`` lists intervals of sequences with r ids left.  All sequences of an interval
    take the same items, as one-by-one best fit would deal them: the fullest one that still
    has room is filled until nothing more of that length fits."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs, sequences = [], 0
    for length in sorted((n for n in counts if counts[n] > 0), reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, many: int, free: int) -> int:
            """Items of this length into ``many`` sequences with ``free`` ids left each."""
            nonlocal rank
            q, need = free // length, left
            whole = min(many, need // q)
            used = 0
            if whole:
                for j in range(q):
                    runs.append((length, rank, whole, first, capacity - free + j * length))
                    rank += whole
                room[free - q * length].append((first, whole))
                used = whole * q
            part = min(need - used, q - 1) if whole < many else 0
            if part:
                for j in range(part):
                    runs.append((length, rank, 1, first + whole, capacity - free + j * length))
                    rank += 1
                room[free - part * length].append((first + whole, 1))
                used += part
                whole += 1
            if whole < many:
                room[free].append((first + whole, many - whole))
            return used

        for free in range(length, capacity + 1):
            while left and room[free]:
                first, many = room[free].pop()
                left -= fill(first, many, free)
            if not left:
                break
        if left:
            q = capacity // length
            many = -(-left // q)
            left -= fill(sequences, many, capacity)
            sequences += many
    return runs


def _slots(runs: list[tuple[int, int, int, int, int]]):
    runs = sorted(runs)
    key = np.array([(r[0] << 40) + r[1] for r in runs], dtype=np.int64)
    rank, seq, off = (np.array([r[i] for r in runs], dtype=np.int64) for i in (1, 3, 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, (n << 40) + r, side="right") - 1
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq[at] + r - rank[at]), pa.array(off[at])],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32",
                                                    "sequence_id", "offset"])
    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut(T.map_batches(docs, ["doc_id", "text"],
                               "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long",
                               _pieces(capacity, tokenizer)))
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("k"))
    histogram = {r["length"]: r["k"] for r in per_part.groupBy("length").agg(F.sum("k").alias("k")).collect()}
    runs = best_fit(histogram, capacity)          # at most ``capacity`` counts came to the driver
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _slots(runs), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
