"""SimHash near-duplicates: fingerprints of word shingles, compared bit-sliced.

Method. Distinct fingerprints are put into buckets that agree on a quarter of the bits not yet fixed:
within ``radius`` < ``parts`` differing bits at least one of ``parts`` equal slices agrees, so no link
is lost. A bucket with more than ``limit`` fingerprints is divided again by the same rule on its
remaining bits, until it fits; distinct fingerprints that agree on all but r bits are at most 2^r, so
that ends, and no task compares more than ``limit`` rows of one bucket with each other.

Inside a bucket the comparison is bit-sliced: 64 fingerprints stand side by side in a word per bit
plane, and the distances of one fingerprint to those 64 are kept in vertical carry-save counters
(two bit planes and one overflow plane for radius 3). Every few planes, words in which all distances
have overflowed are abandoned. A bucket yields one edge per fingerprint to the smallest fingerprint it
is connected with there, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.llm.components import connected_components
from perimetry.llm.text import as_bytes, batch, blank_words
from perimetry.plans.storage import discard, scratch_path, written

_SHINGLES = 65_536  # hashed at a time
_WORDS = 65_536  # compared at a time
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included; 0 for a text without words.

    A-Z are lower-cased. A text of fewer words than ``shingle`` is one shingle.
    """
    words = blank_words(text.lower()) if text else []  # bytes.lower() touches A-Z only
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, _SHINGLES):
        part = words[start : min(start + _SHINGLES, count) + shingle - 1]
        if len(part) < shingle:
            grams = [part]
        else:
            grams = zip(*(part[i : len(part) - shingle + 1 + i] for i in range(shingle)))
        hashes = np.array([digest(b" ".join(g), seed) for g in grams], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), as_bytes(text_col)).mapInArrow(run, f"doc_id {kind}, fp bigint")


def close_within_buckets(fps: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by bucket: the index of the first row of the same bucket that each row is
    connected with by links of at most ``radius`` differing bits."""
    n = len(fps)
    root = np.arange(n)
    if n < 2:
        return root
    width = -(-n // 64)
    padded = np.zeros(width * 64, dtype=np.uint64)
    padded[:n] = fps
    raw = padded.view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(raw, axis=1, bitorder="little")  # (rows, 64)
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)  # plane b: 64 rows in a word
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))  # end of each row's bucket
    later = ends - np.arange(n) - 1
    first_word = (np.arange(n) + 1) // 64
    words = np.where(later > 0, (ends - 1) // 64 - first_word + 1, 0)
    total = np.r_[0, np.cumsum(words)]
    levels = max(1, int(radius).bit_length())  # counter planes
    for low in range(0, int(total[-1]), _WORDS):
        slot = np.arange(low, min(low + _WORDS, int(total[-1])))
        row = np.searchsorted(total, slot, side="right") - 1
        word = first_word[row] + slot - total[row]
        # columns of the word that are later rows of the same bucket
        above = np.maximum(row + 1 - word * 64, 0).astype(np.uint64)
        below = np.minimum(ends[row] - word * 64, 64).astype(np.uint64)
        live = (_ALL << above) & (_ALL >> (np.uint64(64) - below))
        over = ~live
        counter = [np.zeros(len(slot), dtype=np.uint64) for _ in range(levels)]
        for plane in range(64):
            carry = planes[plane][word] ^ (np.uint64(0) - bits[row, plane].astype(np.uint64))
            for level in range(levels):
                counter[level], carry = counter[level] ^ carry, counter[level] & carry
            over |= carry
            if plane % 8 == 7:
                open_ = over != _ALL
                if not open_.all():  # abandon words in which every distance is beyond the radius
                    row, word, over = row[open_], word[open_], over[open_]
                    counter = [c[open_] for c in counter]
                    if not len(row):
                        break
        if radius + 1 < 1 << levels and len(row):  # counters can hold more than the radius
            beyond = np.zeros(len(row), dtype=np.uint64)
            for value in range(radius + 1, 1 << levels):
                match = np.full(len(row), _ALL)
                for level in range(levels):
                    match &= counter[level] if value >> level & 1 else ~counter[level]
                beyond |= match
            over |= beyond
        if len(row):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k, bit = np.nonzero(near)
            root = joined(root, row[k], word[k] * 64 + bit)
    return root


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees of ``root`` along the links (a, b); every row then points to its smallest one."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _bucket_edges(radius: int):
    """Over partitions sorted by bucket: edges from each fingerprint to the first one it is close to."""

    def edges(fps: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
        root = close_within_buckets(fps.view(np.uint64), bucket, radius)
        tied = root != np.arange(len(root))
        return batch(_EDGES, fps[tied], fps[root[tied]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_fps, kept_bucket = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            fps = np.r_[kept_fps, b.column("fp").to_numpy(zero_copy_only=False)]
            bucket = np.r_[kept_bucket, b.column("bucket").to_numpy(zero_copy_only=False)]
            cut = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0  # the last bucket may go on
            if cut:
                yield edges(fps[:cut], bucket[:cut])
            kept_fps, kept_bucket = fps[cut:], bucket[cut:]
        yield edges(kept_fps, kept_bucket)

    return run


def _divided(rows: DataFrame, parts: int) -> DataFrame:
    """Each row once per slice of its bits that are not fixed yet; the slice becomes fixed.

    ``fixed`` is the mask of bits that the bucket agrees on. The free bits are dealt out in order, so
    that slices differ by at most one bit.
    """
    free = [F.when(F.col("fixed").bitwiseAND(F.shiftleft(F.lit(1).cast("long"), i)) == 0, F.lit(i)) for i in range(64)]
    places = F.filter(F.array(*free), lambda x: x.isNotNull())
    size = F.size("places")
    slices = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda s: F.aggregate(
            F.slice(
                "places",
                (F.floor(s * size / parts) + 1).cast("int"),
                (F.floor((s + 1) * size / parts) - F.floor(s * size / parts)).cast("int"),
            ),
            F.lit(0).cast("long"),
            lambda mask, i: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
        ),
    )
    masks = rows.select("fixed").distinct().withColumn("places", places).select("fixed", F.explode(slices).alias("more"))
    return rows.join(F.broadcast(masks), "fixed").select(
        "fp", F.col("fixed").bitwiseOR(F.col("more")).alias("fixed")
    )


def near_edges(fps: DataFrame, radius: int = 3, limit: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links within
    ``radius`` bits. ``fps`` holds distinct ``fp`` values."""
    spark = fps.sparkSession
    parts = radius + 1
    found: DataFrame | None = None
    rows = fps.select("fp", F.lit(0).cast("long").alias("fixed"))
    while True:
        # masks per depth are (radius + 1) ** depth, whatever the data: a bounded broadcast
        rows = written(
            _divided(rows, parts).withColumn(
                "bucket", F.xxhash64("fixed", F.col("fp").bitwiseAND(F.col("fixed")))
            ),
            "simhash-buckets",
        )
        sizes = written(rows.groupBy("bucket").count().where("count > 1"), "simhash-sizes")
        sized = rows.join(sizes, "bucket")
        compared = (
            sized.where(F.col("count") <= limit)
            .select("bucket", "fp")
            .repartition("bucket")
            .sortWithinPartitions("bucket", "fp")
            .mapInArrow(_bucket_edges(radius), "a bigint, b bigint")
        )
        found = compared if found is None else found.union(compared)
        large = sized.where(F.col("count") > limit).select("fp", "fixed")
        if large.isEmpty():
            return found
        rows = large


def simhash_components(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Rows link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    ``doc_id`` reachable by links. Equal fingerprints are one node, so copies are never paired. Null
    and empty texts have fingerprint zero and link like any other. A null ``doc_id`` is never the
    smallest unless the component holds no other. Repeated rows give repeated rows. Other columns of
    ``docs`` are not read, whatever their names.
    """
    marked = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    rooted = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), radius)
    # stored, so that the join on a component of any size can be split
    smallest = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-smallest")
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(classes: DataFrame, radius: int) -> DataFrame:
    """``classes``, one row per ``fp``, with the ``root`` of the component each belongs to."""
    spark = classes.sparkSession
    path = scratch_path(spark, "simhash-edges")
    near_edges(classes.select("fp"), radius).write.parquet(path)
    parts = connected_components(spark.read.parquet(path))
    discard(spark, path)
    return classes.join(parts, classes.fp == parts.node, "left").select(
        *classes.columns, F.coalesce("component", "fp").alias("root")
    )


def _whole_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """(row, fp, doc_id, content, place) of every row, stored: ``row`` has all columns; ``place`` tells equal
    rows apart, but only among those without ``doc_id``, as rows that repeat one are the same document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["row", "fp"]
            )

    rows = docs.select(F.struct("*").alias("row"), as_bytes("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())])
    place = F.when(F.col("row.doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    return written(
        rows.mapInArrow(run, schema).select(
            "row", "fp", "row.doc_id", F.xxhash64("row.text").alias("content"), place.alias("place")
        ),
        "simhash-rows",
    )


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of each component, all columns unchanged: the one with the smallest ``doc_id``, of
    different texts under that id the one with the smallest hash.

    Rows that repeat the kept document's ``doc_id`` and text are that document and stay. A component in
    which no row has a ``doc_id`` keeps one row, with the smallest hash of its text.
    """
    marked = _whole_rows(docs, shingle)
    # in this order; rows without id come last
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content", "place", "fp")
    rooted = _rooted(marked.groupBy("fp").agg(F.min(first).alias("first")), radius)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(
        *[F.col(f"first.{c}").alias(f"_{c}") for c in ("doc_id", "content", "place", "fp")]
    )
    # stored, so that the join can be split where one document is repeated
    kept = written(kept, "simhash-kept")
    same = [marked["fp"] == kept["_fp"], marked["content"] == kept["_content"], marked["place"] == kept["_place"],
            marked["doc_id"].eqNullSafe(kept["_doc_id"])]
    return marked.join(kept, same, "left_semi").select("row.*")
