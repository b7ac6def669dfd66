"""Line dedup (operator 13): lines that many documents hold stay only in the one with the largest id.

* A task hashes the keys of its long lines (128 bits) and emits (hash, doc_id, text hash,
  position); no text is exchanged for the search.
* These rows are range-partitioned by (hash, doc_id descending, text, position) and sorted so.
  The range covers the whole key, so a line of any frequency is split over as many tasks as
  its rows need.  A checkpoint fixes rows and order.
* Streaming a partition, the first document of a hash keeps its lines; the second one's wait until
  a third document is seen; all further ones go.  What waits is one document's lines.
* A hash may reach over partition borders: a first look at each partition gives its first and last
  hash with up to three documents each, one row a partition, and the driver hands every
  partition the documents before and after it.
* The result is one compressed keep bitmap a document (``keep_bitmaps``); only ``digest``, which
  hashes the text that is left, brings bitmaps and texts together.

Edge cases: a null or empty text is one empty line; documents are told apart by ``doc_id``: rows
without id count as one document that comes before all ids, and rows that repeat an id as one
document, of which each keeps its lines; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.io import cut
from gridloom.llm.textkit import map_batches, slices

MIN_CHARS = 20
MIN_DOCS = 3
_BLANK = b" \t\n\x0b\x0c\r"
_NO_ID = -2 ** 63             # what stands for a null id in the sort; a real id of this value is told apart by ``held``
_KEY = ["h1", "h2", "held", "doc", "th", "pos"]
_KEY_SCHEMA = "h1 long, h2 long, held boolean, doc long, th long, pos int"


def _with_hash(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return documents.select(doc.isNotNull().alias("held"), F.coalesce(doc, F.lit(_NO_ID)).alias("doc"),
                            F.xxhash64(text).alias("th"), F.encode(text, "UTF-8").alias("data"))


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            digests, rows, positions = [], [], []
            for i, data in enumerate(b.column("data").to_pylist()):
                for at, line in enumerate(data.split(b"\n")):
                    if len(line) < min_chars:
                        continue
                    key = line.strip(_BLANK).lower()               # bytes: folds A-Z only
                    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
                        continue
                    digests.append(xxhash.xxh3_128_digest(key))
                    rows.append(i)
                    positions.append(at)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])),
                 *[b.column(c).take(take) for c in ("held", "doc", "th")], pa.array(positions, pa.int32())], names=_KEY)
    return run


def line_keys(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each line whose key is long enough, sorted by (hash, document descending,
    text, position) over all partitions; fixed by a checkpoint."""
    rows = map_batches(_with_hash(documents), ["held", "doc", "th", "data"], _KEY_SCHEMA, _keys(min_chars))
    order = [F.col("h1"), F.col("h2"), F.col("held").desc(), F.col("doc").desc(), F.col("th"), F.col("pos")]
    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order))


def _runs(b: pa.RecordBatch):
    """Where hashes and documents change in a batch: (new hash, new document) flags, columns."""
    h1, h2, doc = (b.column(c).to_numpy() for c in ("h1", "h2", "doc"))
    held = b.column("held").to_numpy(zero_copy_only=False)
    new_hash = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    new_doc = new_hash | np.concatenate(([True], (doc[1:] != doc[:-1]) | (held[1:] != held[:-1])))
    return h1, h2, held, doc, new_hash, new_doc


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: first and last hash of the partition, each with its first ``MIN_DOCS`` documents,
    and whether it is one hash throughout."""
    first = last = None
    docs: list[tuple] = []
    head: list[tuple] = []
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, held, doc, new_hash, new_doc = _runs(b)
        starts = np.append(np.flatnonzero(new_hash), b.num_rows)
        # only runs at the batch's ends can touch the partition's ends
        for i, j in {(int(starts[0]), int(starts[1])): 0, (int(starts[-2]), int(starts[-1])): 0}:
            h = (int(h1[i]), int(h2[i]))
            if h != last:
                if first is not None and last == first and not head:
                    head = docs
                last, docs = h, []
                first = first or h
            if len(docs) < MIN_DOCS:
                for k in i + np.flatnonzero(new_doc[i:j])[:MIN_DOCS + 1]:
                    d = (bool(held[k]), int(doc[k]))
                    if d not in docs and len(docs) < MIN_DOCS:
                        docs.append(d)
    if first is not None:
        head = head if last != first else docs
        yield pa.RecordBatch.from_pylist([{
            "part": TaskContext.get().partitionId(), "one": first == last, "f1": first[0], "f2": first[1], "l1": last[0], "l2": last[1],
            "head": [{"held": a, "doc": d} for a, d in head], "tail": [{"held": a, "doc": d} for a, d in docs]}], schema=_ENDS)


_DOCS = pa.list_(pa.struct([("held", pa.bool_()), ("doc", pa.int64())]))
_ENDS = pa.schema([("part", pa.int32()), ("one", pa.bool_()), ("f1", pa.int64()), ("f2", pa.int64()),
                   ("l1", pa.int64()), ("l2", pa.int64()), ("head", _DOCS), ("tail", _DOCS)])
_ENDS_SPARK = ("part int, one boolean, f1 long, f2 long, l1 long, l2 long, "
               "head array<struct<held: boolean, doc: long>>, tail array<struct<held: boolean, doc: long>>")


def _borders(ends: list) -> dict[int, tuple[list, list]]:
    """partition -> (documents before it of its first hash, documents after it of its last hash),
    ``MIN_DOCS`` of each at most, in order."""
    ends = sorted(ends, key=lambda r: r.part)
    docs = lambda x: [(d.held, d.doc) for d in x]
    add = lambda a, b: (a + [d for d in b if d not in a])[:MIN_DOCS]
    before, after = {}, {}
    have: list = []
    for i, r in enumerate(ends):
        same = i > 0 and (ends[i - 1].l1, ends[i - 1].l2) == (r.f1, r.f2)
        before[r.part] = have = have if same else []
        have = add(have, docs(r.tail)) if r.one else docs(r.tail)
    have = []
    for i in range(len(ends) - 1, -1, -1):
        r = ends[i]
        same = i + 1 < len(ends) and (r.l1, r.l2) == (ends[i + 1].f1, ends[i + 1].f2)
        after[r.part] = have = have if same else []
        have = add(docs(r.head), have) if r.one else docs(r.head)
    return {r.part: (before[r.part], after[r.part]) for r in ends}


def _drop(borders: dict[int, tuple[list, list]], min_docs: int):
    """Streams a sorted partition and emits the lines to drop."""
    names = ["held", "doc", "th", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, end = borders.get(TaskContext.get().partitionId(), ([], []))
        hash_, docs, waiting, opened = None, [], [], False
        for b in batches:
            if not b.num_rows:
                continue
            h1, h2, held, doc, new_hash, new_doc = _runs(b)
            begun = np.flatnonzero(new_hash)
            # nth document of its hash, for every row of the batch that belongs to a hash begun here
            run_no = np.cumsum(new_doc)
            nth = run_no - run_no[begun][np.cumsum(new_hash) - 1]
            total = np.append(run_no[begun[1:] - 1], run_no[-1]) - run_no[begun] + 1
            inner = np.ones(len(begun), dtype=bool)
            inner[[0, -1]] = False                               # hashes that may go on outside the batch
            whole = inner[np.cumsum(new_hash) - 1]
            gone = whole & (nth > 0) & (total[np.cumsum(new_hash) - 1] >= min_docs)
            if gone.any():
                yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(gone)) for c in names], names=names)
            for i in dict.fromkeys((0, len(begun) - 1)):
                lo, hi = int(begun[i]), int(begun[i + 1]) if i + 1 < len(begun) else b.num_rows
                h = (h1[lo], h2[lo])
                if h != hash_:
                    hash_, waiting = h, []                       # what waited had fewer documents: it stays
                    docs, opened = ([] if opened else list(start)), True
                own = np.append(lo + np.flatnonzero(new_doc[lo:hi]), hi)
                for at, to in zip(own[:-1].tolist(), own[1:].tolist()):
                    d = (bool(held[at]), int(doc[at]))
                    if len(docs) < min_docs and d not in docs:
                        docs.append(d)
                    if d == docs[0]:
                        continue
                    if len(docs) >= min_docs:                    # from here on only the first one keeps its lines
                        yield from waiting
                        waiting = []
                        yield b.slice(at, hi - at).select(names)
                        break
                    waiting.append(b.slice(at, to - at).select(names))
        if waiting and len(docs + [d for d in end if d not in docs]) >= min_docs:
            yield from waiting
    return run


def dropped_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """held, doc, th, pos of every line that goes; ``keys`` from ``line_keys``."""
    if not 2 <= min_docs <= MIN_DOCS:
        raise ValueError(f"min_docs must be 2 to {MIN_DOCS}")
    borders = _borders(keys.mapInArrow(_ends, _ENDS_SPARK).collect())        # one row a partition
    return keys.mapInArrow(_drop(borders, min_docs), "held boolean, doc long, th long, pos int")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        maps = []
        for gone in b.column("gone"):
            at = np.unique(gone.values.to_numpy())
            keep = np.ones((int(at[-1]) // 8 + 1) * 8, dtype=np.uint8)
            keep[at] = 0
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6))
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("held", "doc", "th")] + [pa.array(maps, pa.binary())],
                                         names=["held", "doc", "th", "keep"])


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """held, doc, th, keep: a compressed bitmap (zlib; bit i, lowest first, is line i; lines beyond
    its end stay) of every document that loses lines.  ``th`` is xxhash64 of the text, which
    tells rows apart that repeat an id."""
    gone = dropped_lines(line_keys(documents, min_chars), min_docs)
    lists = gone.groupBy("held", "doc", "th").agg(F.collect_list("pos").alias("gone"))        # one document's lines
    return map_batches(lists, ["held", "doc", "th", "gone"], "held boolean, doc long, th long, keep binary", _bitmaps)


def kept_lines(data: bytes, keep: bytes | None) -> tuple[list[bytes], int]:
    """(lines that stay, number of lines before) of a text in UTF-8."""
    lines = data.split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), bitorder="little")
    return [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]], len(lines)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        n, gone, sha = [], [], []
        for data, keep in zip(b.column("data").to_pylist(), b.column("keep").to_pylist()):
            lines, total = kept_lines(data, keep)
            n.append(total)
            gone.append(total - len(lines))
            sha.append(hashlib.sha256(b"\n".join(lines)).hexdigest())
        doc = pc.if_else(b.column("held"), b.column("doc"), pa.scalar(None, pa.int64()))
        yield pa.RecordBatch.from_arrays([doc, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                         names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def digest(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    rows = _with_hash(documents).join(bitmaps, ["held", "doc", "th"], "left")
    return map_batches(rows, ["held", "doc", "data", "keep"], "doc_id long, n_lines long, n_dropped long, kept_sha256 string", _digest)


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND f.keeper <> k.doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
