"""Line dedup: lines that stand in many documents are dropped from all of them.

Method. The documents each line key stands in are counted in sorted runs, kept in levels like those of
a log-structured merge tree. A batch of documents becomes one run of (key hash, documents): its keys are
counted, keys that the runs already know to be frequent are anti-joined away (their fate is settled,
so the commonest lines are not carried again), and the rest is written as a sorted run of level 0. As
soon as a level has ``fanout`` runs they are merged into one run of the next level. In the end the
runs are merged, and the frequent keys are joined back to the places of their lines.

Keys are known by 128 bits of hash. Counts and joins are DataFrame operations; a line that stands in a
third of all documents is pre-aggregated before it is shuffled, and only meets its places in a join
against unique keys, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.llm.text import lower_ascii
from perimetry.plans.storage import discard, scratch_path, written

_BLANKS = " \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(_BLANKS)))


class LineRuns:
    """Levelled sorted runs of (h1, h2, docs) in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = []

    def _runs(self) -> DataFrame | None:
        paths = [path for level in self.levels for path in level]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, pairs: DataFrame) -> None:
        """Add a batch of (h1, h2, document) rows; each document is in one batch only."""
        run = pairs.distinct().groupBy(*_KEY).agg(F.count("*").alias("docs"))
        known = self._runs()
        if known is not None:
            settled = known.where(F.col("docs") >= self.min_docs).select(*_KEY).distinct()
            run = run.join(settled, _KEY, "left_anti")
        self._push(run, 0)

    def _push(self, run: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions(*_KEY).write.parquet(path)
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level]
            self.levels[level] = []
            self._push(self._merged(self.spark.read.parquet(*merged)), level + 1)
            for old in merged:
                discard(self.spark, old)

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*_KEY).agg(F.sum("docs").alias("docs"))

    def frequent(self) -> DataFrame:
        """(h1, h2) of keys found in at least ``min_docs`` documents, as a run of its own: a join against
        a stored table can split a hot key, one against an aggregate cannot."""
        last = self._merged(self._runs()).where(F.col("docs") >= self.min_docs).select(*_KEY)
        return written(last, "line-run-last")


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``kept`` (text without the dropped lines), ``n_lines`` and ``n_dropped``.

    A null or empty text is one empty line. Keys of fewer than ``min_chars`` code points are never
    dropped. A document is a ``doc_id``; rows without one are a document per distinct text. Rows that
    repeat a document count once and all lose their lines. If all lines of a text go, ``kept`` is
    empty. An empty table gives an empty result. Columns of ``docs`` keep their names and values, but for
    those called ``kept``, ``n_lines`` or ``n_dropped``, which the result replaces. ``batches`` and
    ``fanout`` do not change the result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # null-safe key of a row: rows that agree in it have the same lines
    row_key = [F.col(id_col).cast("string").alias("k1"), F.xxhash64(text).alias("k2")]
    places_path = scratch_path(spark, "line-places")
    lines = docs.select(*row_key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= max(1, min_chars))
    keyed.select(
        "k1", "k2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        F.pmod(F.xxhash64(F.coalesce("k1", F.col("k2").cast("string"))), F.lit(batches)).cast("int").alias("batch"),
    ).write.partitionBy("batch").parquet(places_path)
    schema = "k1 string, k2 long, pos int, h1 long, h2 long, batch int"
    places = spark.read.schema(schema).parquet(places_path)
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        document = F.when(F.col("k1").isNull(), F.col("k2"))
        runs.add(places.where(F.col("batch") == batch).select(*_KEY, "k1", document.alias("k2")))
    dropped = (
        places.join(runs.frequent(), _KEY).groupBy("k1", "k2").agg(F.collect_set("pos").alias("_dropped"))
        .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_dropped")
    )
    text, gone = F.coalesce(docs[text_col], F.lit("")), dropped["_dropped"]
    same = docs[id_col].cast("string").eqNullSafe(dropped["_k1"]) & (F.xxhash64(text) == dropped["_k2"])
    found = docs.join(dropped, same, "left")
    split = F.split(text, "\n", -1)

    def rest(own: Column) -> Column:
        """``own`` lines without the dropped ones."""
        left = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), gone)
        return F.array_join(F.transform(left, lambda i: own[i]), "\n")

    return found.select(
        *[docs[c] for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")],
        F.when(gone.isNull(), text)
        .otherwise(F.transform(F.array(split), rest)[0]).alias("kept"),  # bound, so that a text is split once
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of ``drop_frequent_lines``'s rows."""
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
