"""Benchmark decontamination by a prefix-filtered set join on word windows.

Method. The shingles of an item are its windows of ``window`` consecutive words (an item with fewer
words is one window). Words are ordered by rarity, that is by the number of documents they stand in,
counted over all documents. Containment is asked for whole windows, so the necessary prefix of a window
in that order is its rarest word: a document that holds the window holds this word. Each occurrence of
such a word in a document is joined with its postings (item, place in the item); the length and
positional bounds leave the starts at which the window fits into the document, and the words around
are then compared one by one. Neighbouring windows with the same rarest word are verified together.

Scale. The index is built from blocks of items with at most about ``block_words`` words; one block at a
time is sent to the tasks, and every document is held against every block, so benchmarks of any size
need bounded memory and no document is shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.llm.text import alnum_words, as_bytes
from perimetry.plans.storage import written


def _document_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many of all documents each word of the block's vocabulary stands."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for b in batches:
            for text in b.column(0):
                for word in known.value.intersection(alnum_words(text.as_py())):
                    counts[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "docs"]
        )

    counted = docs.select(as_bytes(text_col)).mapInArrow(run, "word binary, docs long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("docs").alias("n")).collect()}


class _Index:
    """Postings of a block: rarest word of windows -> places in items with the range of their windows."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], rarity: dict[bytes, int], window: int):
        self.number: dict[bytes, int] = {}
        self.items: list[tuple[list[int], int, str | None]] = []
        self.postings: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for name, words in items:
            if not words:
                continue
            size = min(window, len(words))
            ranks = [(rarity.get(w, 0), w) for w in words]
            numbers = [self.number.setdefault(w, len(self.number)) for w in words]
            at = len(self.items)
            self.items.append((numbers, size, name))
            place = None
            for start in range(len(words) - size + 1):
                rarest = min(range(start, start + size), key=ranks.__getitem__)
                if rarest == place:  # one posting for neighbouring windows
                    self.postings[numbers[rarest]][-1] = (at, rarest, first, start)
                else:
                    place, first = rarest, start
                    self.postings[numbers[rarest]].append((at, rarest, first, start))
        self.anchor = np.zeros(len(self.number) + 1, dtype=bool)  # the last place stands for other words
        self.anchor[list(self.postings)] = True

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words inside occurring windows, and the items whose windows occur."""
        get, other = self.number.get, len(self.number)
        doc = [get(w, other) for w in words]
        spans, names, n = [], set(), len(doc)
        for p in np.flatnonzero(self.anchor[np.array(doc, dtype=np.int64)]).tolist() if n else ():
            for at, place, first, last in self.postings[doc[p]]:
                item, size, name = self.items[at]
                # positional bound: starts at which the window lies in the document
                low, high = max(first, place - p), min(last, place - p + n - size)
                if low > high:
                    continue
                left = place
                while left > low and doc[p - place + left - 1] == item[left - 1]:
                    left -= 1
                right = place + 1
                while right < high + size and doc[p - place + right] == item[right]:
                    right += 1
                if right - left >= size:  # whole windows start from left to right - size
                    spans.append((p - place + left, p - place + right))
                    if name is not None:
                        names.add(name)
        return spans, names


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for low, high in sorted(spans):
        if out and low <= out[-1]:
            out[-1] = max(out[-1], high)
        else:
            out += [low, high]
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 1_000_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row: ``spans`` are disjoint [start, end) word ranges that
    occurring windows cover, flat; ``items`` the sorted ids, as strings, of the items they come from.

    Null and empty texts have no words. Items without words have no windows. An item without id marks
    words but names no item; items that repeat an id count once. Repeated documents give repeated rows,
    an empty benchmark marks nothing, and other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), as_bytes(item_text_col).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 6 / block_words))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), as_bytes(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        held = [(r.item, alnum_words(bytes(r.text) if r.text is not None else None)) for r in part.collect()]
        counts = _document_counts(docs, text_col, {w for _, words in held for w in words})
        index = spark.sparkContext.broadcast(_Index(held, counts, window))

        def scan(batches: Iterator[pa.RecordBatch], index=index, last=block == blocks - 1):
            for b in batches:
                n_words, spans, names = [], [], []
                for text, old_spans, old_names in zip(b["text"], b["spans"], b["items"]):
                    words = alnum_words(text.as_py())
                    found, named = index.value.hits(words)
                    flat = old_spans.as_py()
                    n_words.append(len(words))
                    spans.append(_merged(found + list(zip(flat[::2], flat[1::2]))))
                    names.append(sorted(named.union(old_names.as_py())))
                texts = pa.nulls(len(n_words), pa.binary()) if last else b["text"]
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], texts, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                     pa.array(names, pa.list_(pa.string()))], names=["doc_id", "text", "n_words", "spans", "items"])

        rows = rows.mapInArrow(scan, f"doc_id {kind}, text binary, n_words long, spans array<int>, items array<string>")
        if block < blocks - 1:
            rows = written(rows, "decontaminate")
    return rows.drop("text")


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """Digest of ``contamination``: contaminated if hit words are at least one in ``share``."""
    ends_less_starts = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    hit = F.aggregate(ends_less_starts, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.withColumn("n_hit", hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, all columns unchanged. Each row is judged by its own text."""
    # never null, and apart for rows that share a text
    key = F.concat_ws("#", F.sha2(docs["text"], 256), docs["doc_id"].cast("string"))
    found = judged(contamination(docs.select(key.alias("doc_id"), docs["text"]), benchmark))
    found = found.where("contaminated").select(F.col("doc_id").alias("_contaminated")).distinct()
    return docs.join(found, key == found["_contaminated"], "left_anti")
