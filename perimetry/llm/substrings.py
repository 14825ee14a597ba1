"""Removal of repeated passages: difference-cover anchors, then exact windows.

Method. A cover D modulo v is a set of residues whose differences are all residues. For any two
positions i, j there is a shift below v that brings both onto D. So if a document hashes its anchors
(``window - v + 1`` words) only at positions p with p mod v in D, any passage of ``window`` words that
stands in two documents has an anchor which both of them hash: with v = 31, 6 of 31 positions.

1. anchors: shared ones (in at least two documents) are found by hash;
2. extension: a shared anchor is extended to every window of ``window`` words around it; the windows'
   64-bit hashes are brought together, and the smallest ``doc_id`` of each is found;
3. every document drops the words of windows that start in a document with a smaller ``doc_id``.

Scale. Hashes travel packed, as arrays per (batch, bucket of the hash space); buckets hold a fixed
expected number of hashes, so their count follows the size of the corpus. Before each shuffle a batch
sends one id per hash to the bucket: all its other documents are decided on the spot, and their answers
travel by the group of texts they go to, which has a fixed size. A passage that stands in a third of all
documents thus puts one entry per batch into its bucket (more only if different texts there share the
smallest id). Texts are shuffled once, into groups of a fixed size, and both later steps read that exchange.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import WordHashes, as_bytes, blank_words, word_hashes

_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so each has an inverse modulo 2^64
_INVERSE = tuple(pow(b, -1, 1 << 64) for b in _BASE)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_DOC = np.dtype([("id", "<i8"), ("tag", "<u8")])
# ``bucket`` is -1 - part in rows of answers, which hold no hashes
_PACK = pa.schema([("bucket", pa.int64()), ("docs", pa.binary()), ("hash", pa.binary()),
                   ("doc", pa.binary()), ("pos", pa.binary()), ("shared", pa.binary())])
_PACK_DDL = "bucket long, docs binary, hash binary, doc binary, pos binary, shared binary"
_ANSWER = pa.schema([("part", pa.int64()), ("docs", pa.binary()), ("doc", pa.binary()), ("pos", pa.binary())])
_ANSWER_DDL = "part long, docs binary, doc binary, pos binary"


@cache
def difference_cover(period: int) -> tuple[int, ...]:
    """A small set of residues whose differences are all residues modulo ``period``, by iterative deepening."""

    def search(found: list[int], size: int) -> list[int] | None:
        differences = {(a - b) % period for a in found for b in found}
        if len(differences) == period:
            return found
        left = size - len(found)
        if left == 0 or len(differences) + 2 * sum(range(len(found), size)) < period:
            return None
        for nxt in range(found[-1] + 1, period):
            if done := search([*found, nxt], size):
                return done
        return None

    for size in range(1, period + 1):
        if done := search([0], size):
            return tuple(done)
    raise ValueError(f"no cover of {period}")


@cache
def _powers(which: int, inverse: bool, length: int) -> np.ndarray:
    step = (_INVERSE if inverse else _BASE)[which]
    out = np.full(length, step, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _window_hashes(hashes: np.ndarray, which: int, length: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """A hash of every ``length`` consecutive words, or of those that start ``at``, from prefix sums modulo 2^64."""
    n = len(hashes)
    room = 1 << max(10, n.bit_length())
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes[:, which] * _powers(which, False, room)[:n], out=sums[1:])
    count = n - length + 1
    found = (sums[length:][at] - sums[:count][at]) * _powers(which, True, room)[:count][at]
    found ^= found >> np.uint64(33)
    found *= _MIX
    return found ^ (found >> np.uint64(29))


def _tag(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


class _Batch:
    """Hashes of several documents, packed by bucket."""

    def __init__(self, buckets: int, groups: int):
        self.buckets, self.groups, self.docs, self.parts, self.known = buckets, groups, [], [], set()

    def add(self, doc_id: int, tag: int, place: np.ndarray, hashes: np.ndarray, pos: np.ndarray) -> None:
        """``place`` chooses the bucket, ``hashes`` identifies within it. Answers name (id, tag), so a repeat adds none."""
        if (doc_id, tag) in self.known:
            return
        self.known.add((doc_id, tag))
        self.parts.append((place, hashes, np.full(len(hashes), len(self.docs), np.uint32), pos.astype(np.uint32)))
        self.docs.append((doc_id, tag))

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        docs = np.array(self.docs, dtype=_DOC)
        by_id = np.argsort(docs["id"], kind="stable")
        place, hashes, doc, pos = (np.concatenate(c) for c in zip(*(self.parts[i] for i in by_id)))
        self.parts.clear()  # not held a second time
        # by bucket, hash and id; sorts are stable, and few buckets are sorted by counting
        bucket = (place % np.uint64(self.buckets)).astype(np.uint16 if self.buckets <= 1 << 16 else np.int64)
        order = np.argsort(hashes, kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        bucket, hashes, doc, pos = bucket[order], hashes[order], doc[order], pos[order]
        # a document counts once per hash, at its first position
        once = np.ones(len(doc), bool)
        once[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1])
        bucket, hashes, doc, pos = bucket[once], hashes[once], doc[once], pos[once]
        starts = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1])])
        lengths = np.diff(np.r_[starts, len(hashes)])
        ids = docs["id"][doc]
        several = ids[starts] != ids[starts + lengths - 1]  # sorted by id within a hash
        # of each hash the documents with the smallest id go on, the others are answered here
        smallest = ids == np.repeat(ids[starts], lengths)
        yield from _answer_rows(_answers(docs, doc[~smallest], pos[~smallest], self.groups))
        shared = np.repeat(several, lengths)[smallest]
        bucket, hashes, doc, pos = bucket[smallest], hashes[smallest], doc[smallest], pos[smallest]
        for b, low, high in _runs(bucket):
            part = slice(low, high)
            yield _pack_row(b, docs, hashes[part], doc[part], pos[part], shared[part])


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else []
    for low, high in zip(starts, np.r_[starts[1:], len(values)] if len(values) else []):
        yield int(values[low]), int(low), int(high)


def _pack_row(bucket, docs, hashes, doc, pos, shared) -> pa.RecordBatch:
    used, renumbered = np.unique(doc, return_inverse=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([docs[used].tobytes()], pa.binary()),
         pa.array([hashes.tobytes()], pa.binary()), pa.array([renumbered.astype(np.uint32).tobytes()], pa.binary()),
         pa.array([pos.tobytes()], pa.binary()), pa.array([shared.astype(np.uint8).tobytes()], pa.binary())],
        schema=_PACK,
    )


def _answers(docs: np.ndarray, doc: np.ndarray, pos: np.ndarray, parts: int) -> list[pa.RecordBatch]:
    """(document, position) pairs, packed by the group of documents they go to."""
    if not len(doc):
        return []
    part = _part(docs, parts)[doc]
    order = np.argsort(part, kind="stable")
    out = []
    for p, low, high in _runs(part[order]):
        used, renumbered = np.unique(doc[order[low:high]], return_inverse=True)
        out.append(pa.RecordBatch.from_arrays(
            [pa.array([p], pa.int64()), pa.array([docs[used].tobytes()], pa.binary()),
             pa.array([renumbered.astype(np.uint32).tobytes()], pa.binary()),
             pa.array([pos[order[low:high]].tobytes()], pa.binary())], schema=_ANSWER))
    return out


def _answer_rows(answers: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers as rows that pass ``_meet`` in a group of their own."""
    for b in answers:
        part, docs, doc, pos = b.columns
        none = pa.array([b""] * len(b), pa.binary())
        key = pa.compute.subtract(pa.scalar(-1, pa.int64()), part)
        yield pa.RecordBatch.from_arrays([key, docs, none, doc, pos, none], schema=_PACK)


def _part(docs: np.ndarray, parts: int) -> np.ndarray:
    mixed = (docs["id"].view(np.uint64) if docs["id"].flags.c_contiguous else docs["id"].astype(np.uint64)) * _MIX
    return ((mixed ^ docs["tag"]) % np.uint64(parts)).astype(np.int64)


def _unpacked(table: pa.Table):
    """Entries of one bucket: documents, hash, document of each entry, position, known to be shared."""
    docs, hashes, doc, pos, shared, base = [], [], [], [], [], 0
    for row in table.to_pylist():
        d = np.frombuffer(row["docs"], _DOC)
        docs.append(d)
        hashes.append(np.frombuffer(row["hash"], np.uint64))
        doc.append(np.frombuffer(row["doc"], np.uint32).astype(np.int64) + base)
        pos.append(np.frombuffer(row["pos"], np.uint32))
        shared.append(np.frombuffer(row["shared"], np.uint8).astype(bool))
        base += len(d)
    if not docs:
        return np.empty(0, _DOC), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, bool)
    return tuple(np.concatenate(c) for c in (docs, hashes, doc, pos, shared))


def _meet(parts: int, windows: bool):
    """Within a bucket: which entries have a hash that another document has too (anchors), or that a
    document with a smaller id has (windows). Answers already given are passed on."""

    def run(table: pa.Table) -> pa.Table:
        if len(table) and table["bucket"][0].as_py() < 0:  # one group of texts
            key = pa.compute.subtract(pa.scalar(-1, pa.int64()), table["bucket"])
            return pa.Table.from_arrays([key, table["docs"], table["doc"], table["pos"]], schema=_ANSWER)
        out = []
        docs, hashes, doc, pos, shared = _unpacked(table)
        ids = docs["id"][doc]
        order = np.lexsort((ids, hashes))
        hashes, doc, pos, shared, ids = hashes[order], doc[order], pos[order], shared[order], ids[order]
        if len(hashes):
            starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            lengths = np.diff(np.r_[starts, len(hashes)])
            if windows:
                found = ids != np.repeat(ids[starts], lengths)
            else:
                several = (ids[starts] != ids[starts + lengths - 1]) | np.logical_or.reduceat(shared, starts)
                found = np.repeat(several, lengths)
            out += _answers(docs, doc[found], pos[found], parts)
        return pa.Table.from_batches(out, schema=_ANSWER)

    return run


def _told(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Positions by document (id, tag)."""
    doc, pos, keys = [], [], []
    base = 0
    for row in table.to_pylist():
        d = np.frombuffer(row["docs"], _DOC)
        keys.append(d)
        doc.append(np.frombuffer(row["doc"], np.uint32).astype(np.int64) + base)
        pos.append(np.frombuffer(row["pos"], np.uint32))
        base += len(d)
    if not keys:
        return {}
    named, number = np.unique(np.concatenate(keys), return_inverse=True)
    doc, pos = number[np.concatenate(doc)], np.concatenate(pos)
    order = np.argsort(doc, kind="stable")
    doc, pos = doc[order], pos[order]
    return {(int(named["id"][d]), int(named["tag"][d])): pos[low:high] for d, low, high in _runs(doc)}


def remove_repeats(
    docs: DataFrame, window: int = 50, period: int = 31, id_col: str = "doc_id", text_col: str = "text",
    keep_text: bool = False, entries_per_bucket: int = 200_000, bytes_per_group: int = 16 << 20,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) of every row.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    ``doc_id``. Null, empty and short texts lose nothing. A row without ``doc_id`` neither loses words
    nor takes any. Rows that repeat a ``doc_id`` do not remove each other's words. An empty table gives
    an empty result; other columns are not read. ``entries_per_bucket`` and ``bytes_per_group`` bound
    the memory of a task and do not change results.
    """
    cover = np.array(difference_cover(period))
    anchor = window - period + 1
    if anchor < 1:
        raise ValueError("the period must not exceed the window")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = size / 4  # of four bytes, blank included: rather too many buckets than too few
    buckets = max(1, math.ceil(words * len(cover) / period / entries_per_bucket))
    parts = max(1, math.ceil(size / bytes_per_group))

    def anchors_of(hashes: np.ndarray):
        count = len(hashes) - anchor + 1
        at = (np.arange(0, count, period)[:, None] + cover[None, :]).ravel()
        at = at[at < count]
        return at, _window_hashes(hashes, 0, anchor, at), _window_hashes(hashes, 1, anchor, at)

    def hash_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            out = _Batch(buckets, parts)
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                found = blank_words(text)
                if doc_id is None or len(found) < window:
                    continue
                at, place, hashes = anchors_of(word_hashes(found, known))
                out.add(doc_id, _tag(text), place, hashes, at)
            yield from out.packed()

    def hash_windows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        told, known, out = _told(answers), WordHashes(), _Batch(buckets, parts)
        for doc_id, text in zip(texts["doc_id"].to_pylist(), texts["text"]) if told else ():
            text = text.as_py()
            shared = told.get((doc_id, _tag(text))) if text and doc_id is not None else None
            if shared is None:
                continue
            hashes = word_hashes(blank_words(text), known)
            count = len(hashes) - window + 1
            at, place, _ = anchors_of(hashes)
            at = at[np.isin(place, _window_hashes(hashes, 0, anchor, shared))]  # repeats in the document as well
            near = np.zeros(len(hashes) + 1, dtype=np.int64)  # +1 at each first, -1 after each last window
            np.add.at(near, np.maximum(at - period + 1, 0), 1)
            np.add.at(near, at + 1, -1)
            starts = np.flatnonzero(np.cumsum(near)[:count] > 0)
            out.add(doc_id, _tag(text), _window_hashes(hashes, 0, window, starts),
                    _window_hashes(hashes, 1, window, starts), starts)
        return pa.Table.from_batches(list(out.packed()), schema=_PACK)

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    if keep_text:
        fields.append(("kept", pa.string()))
    schema = pa.schema(fields)

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        told, known, out = _told(answers), WordHashes(), []
        for doc_id, text in zip(texts["doc_id"].to_pylist(), texts["text"]):
            text = text.as_py()
            found = blank_words(text)
            starts = told.get((doc_id, _tag(text))) if text and doc_id is not None else None
            kept = found
            if starts is not None:
                hashes = _window_hashes(word_hashes(found, known), 1, window)
                starts = np.flatnonzero(np.isin(hashes, hashes[starts]))
                over = np.zeros(len(found) + 1, dtype=np.int64)
                over[starts] += 1
                over[starts + window] -= 1
                kept = [w for w, c in zip(found, np.cumsum(over).tolist()) if not c]
            joined = b" ".join(kept)
            row = [doc_id, len(found), len(found) - len(kept), hashlib.sha256(joined).hexdigest()]
            out.append([*row, joined.decode("utf-8", "replace")] if keep_text else row)
        columns = zip(*out) if out else [[] for _ in schema]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            # rows without id meet no others and are spread, equal texts too
            keys = np.array([(n if i is None else i, _tag(t or b""))
                             for n, (i, t) in enumerate(zip(b.column(0).to_pylist(), texts))], dtype=_DOC)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(_part(keys, parts))], names=["doc_id", "text", "part"]
            )

    grouped = rows.mapInArrow(numbered, "doc_id long, text binary, part long")
    shared = rows.mapInArrow(hash_anchors, _PACK_DDL).groupBy("bucket").applyInArrow(_meet(parts, False), _ANSWER_DDL)
    hashed = grouped.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(hash_windows, _PACK_DDL)
    removed = hashed.groupBy("bucket").applyInArrow(_meet(parts, True), _ANSWER_DDL)
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text
    return grouped.groupBy("part").cogroup(removed.groupBy("part")).applyInArrow(cut, ddl)
