"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosines.

Method. Vectors are normalized; a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Each
of ``tables`` hash tables quantizes ``projections`` random Gaussian (2-stable) projections with cells of
width ``cell * r``; vectors that agree in all cells of a table share its bucket. Per projection two
vectors at distance r agree with probability p (0.90 for cell = 8), and closer ones more often, so a
link is missed with probability (1 - p^projections)^tables at most: 2e-6 with the defaults. Candidates
are compared by their cosine in double precision.

Copies (equal label and vector) are one row from the start, with their number. Buckets with one row are
dropped by a count before vectors are moved. A larger bucket is cut into blocks of about ``block`` rows
and each pair of blocks is a task of its own, so that bucket of any size is spread out. A pair is
counted only in the first table in which it meets, so link counts need no list of pairs; of the links
only a spanning forest per task goes on to the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.llm.components import connected_components
from perimetry.llm.simhash import joined
from perimetry.llm.text import batch
from perimetry.plans.storage import discard, scratch_path, written

_ROWS = 1024  # compared at a time with all others of a task
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _signatures(vectors: np.ndarray, least: float, projections: int, tables: int, cell: float, seed: int) -> np.ndarray:
    """(rows, tables) 32-bit names of the buckets of normalized vectors."""
    rng = np.random.default_rng(seed)
    width = cell * math.sqrt(max(2 - 2 * least, 1e-12))
    planes = rng.normal(size=(vectors.shape[1], tables * projections))
    shift = rng.uniform(0, width, size=tables * projections)
    cells = np.floor((vectors @ planes + shift) / width).astype(np.int64).reshape(len(vectors), tables, projections)
    mixed = np.zeros(cells.shape[:2], dtype=np.uint64)
    for k in range(projections):
        mixed = (mixed ^ cells[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def _normalized(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat, np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)


def _hash(least: float, projections: int, tables: int, cell: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, ends = _normalized(b["embedding"])
            sizes = np.diff(ends)
            names = np.zeros((b.num_rows, tables), dtype=np.uint32)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                v = np.stack([flat[ends[i] : ends[i + 1]] for i in rows])
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                names[rows] = _signatures(v, least, projections, tables, cell, seed)
            yield pa.RecordBatch.from_arrays(
                [b["rep"], pa.array(names.astype(np.int64).tolist(), pa.list_(pa.int64()))], names=["rep", "names"])

    return run


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _links_of_task(rows: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """One task of a bucket, the rows of one block or of two blocks against each other: the number of links
    of each row, and the first row of the task that each is connected with."""
    own, first, second = (int(rows[k][0]) for k in ("bucket_table", "first", "second"))
    n = len(rows["rep"])
    left, right = np.flatnonzero(rows["block"] == first), np.flatnonzero(rows["block"] == second)
    links, root = np.zeros(n, dtype=np.int64), np.arange(n)
    v, names, weight = rows["unit"], rows["names"], rows["n"]
    for low in range(0, len(left), _ROWS):
        part = left[low : low + _ROWS]
        i, j = np.nonzero(v[part] @ v[right].T >= least)
        i, j = part[i], right[j]
        if first == second:
            i, j = i[i < j], j[i < j]
        for start in range(0, len(i), 1 << 16):
            a, b = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
            # met already in an earlier table: counted there
            fresh = (names[a] == names[b]).argmax(axis=1) == own
            a, b = a[fresh], b[fresh]
            if len(a):
                links += np.bincount(a, weights=weight[b], minlength=n).astype(np.int64)
                links += np.bincount(b, weights=weight[a], minlength=n).astype(np.int64)
                root = joined(root, a, b)
    return links, root


def _compare(least: float):
    """Over partitions sorted by length and task: links of each row of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for b in batches:
            table = pa.Table.from_batches([b])
            table = table if kept is None else pa.concat_tables([kept, table])
            task = table["task"].to_numpy()
            cut = len(task) - int((task[::-1] != task[-1]).argmax()) if (task != task[-1]).any() else 0
            yield from compared(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None:
            yield from compared(kept)

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        for size, part in _by_size(table):
            part = part.combine_chunks()
            rows = {k: part[k].to_numpy() for k in ("task", "bucket_table", "first", "second", "block", "rep", "n")}
            rows["unit"] = _matrix(part["embedding"].chunk(0)).astype(np.float64)
            rows["unit"] /= np.linalg.norm(rows["unit"], axis=1, keepdims=True)
            rows["names"] = _matrix(part["names"].chunk(0))
            starts = np.flatnonzero(np.r_[True, rows["task"][1:] != rows["task"][:-1]])
            out = []
            for low, high in zip(starts, np.r_[starts[1:], len(rows["task"])]):
                if high - low > 1:
                    links, root = _links_of_task({k: v[low:high] for k, v in rows.items()}, least)
                    at = np.flatnonzero(links)
                    if len(at):
                        out.append((rows["rep"][low + at], rows["rep"][low + root[at]], links[at]))
            if out:
                yield batch(_FOUND, *map(np.concatenate, zip(*out)))

    def _by_size(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
        sizes = table["size"].to_numpy()
        for size in np.unique(sizes):
            yield int(size), table.filter(pa.array(sizes == size))

    return run


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, projections: int = 12, tables: int = 40, cell: float = 8.0,
    block: int = 512, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and the cosine is at least ``least``. Rows whose label or vector
    is null, whose vector is empty, zero or holds null or non-finite components link with nothing, nor do
    vectors of different length. ``n_links`` counts other rows, copies included; ``component_id`` is the
    smallest id reachable. Rows that repeat an id are rows of their own, each judged by its vector; a row without
    id links with nothing. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = written(
        rows.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("rep", F.monotonically_increasing_id()), "vectors")  # numbered once: the table is stored
    hashed = written(
        classes.select("rep", "embedding").mapInArrow(_hash(least, projections, tables, cell, seed), "rep long, names array<long>"),
        "vector-names")
    keys = classes.select("rep", "label", F.size("embedding").alias("size")).join(hashed, "rep").select(
        "rep", "label", "size", F.posexplode("names").alias("bucket_table", "name"))
    bucket = ["label", "size", "bucket_table", "name"]
    # stored, so that the join on a bucket of any size can be split
    sizes = written(keys.groupBy(*bucket).count().where("count > 1"), "vector-buckets").withColumn(
        "blocks", F.ceil(F.col("count") / block).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = keys.join(sizes, bucket).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = members.select(
        "rep", "block", "bucket_table", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        F.xxhash64(*bucket, F.least("block", "other"), F.greatest("block", "other")).alias("task"), "size")
    whole = tasks.join(classes.select("rep", "n", "embedding"), "rep").join(hashed, "rep")
    group = ["size", "task", "bucket_table", "first", "second"]
    path = scratch_path(spark, "vector-links")
    rows_of_task = whole.select(*group, "block", "rep", "n", "embedding", "names").repartition("task").sortWithinPartitions(*group)
    rows_of_task.mapInArrow(_compare(least), "a long, b long, links long").write.parquet(path)
    found = spark.read.parquet(path)
    counts = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    parts = connected_components(found.select("a", "b"))
    placed = classes.join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "embedding", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    # stored, so that the join on a component of any size can be split
    smallest = written(placed.groupBy("component").agg(F.min("least").alias("component_id")), "vector-components")
    named = placed.join(smallest, "component").select("label", "embedding", "n_links", "component_id")
    linked = rows.where(usable).join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
