"""The unified table, the rejects and the report on storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.config import Settings
from perimetry.functions.geometry import bbox
from perimetry.functions.wkb import from_wkb, to_wkb
from perimetry.operators.dedup import source_priority

SRID = 4326


def in_system(srid: Column, expected: int, row: Column) -> Column:
    """``srid``; the job fails at the first row that is in another system or in none."""
    wrong = F.concat(F.lit("row "), F.coalesce(row.cast("string"), F.lit("?")), F.lit(" is in EPSG:"), F.coalesce(srid.cast("string"), F.lit("?")),
                     F.lit(f", the table in EPSG:{expected}"))
    return F.when(srid == expected, srid).otherwise(F.raise_error(wrong).cast("int"))


def write_unified(df: DataFrame, path: str, srid: int = SRID) -> None:
    """Parquet with ``geometry`` as WKB, its ``bbox`` and ``srid``. Rows are dealt out by ranges of
    incident and date and sorted by them, so a lookup of one incident opens few files and skips row
    groups; a hot incident is split by its dates. Bloom filters tell an identifier that is absent between two others.

    Rows bring their system as ``srid``; one in another system than ``srid`` fails the job before anything
    is published. A table without that column says by calling this that it is in ``srid``.
    """
    own = in_system(F.col("srid"), srid, F.col("row_id")) if "srid" in df.columns else F.lit(srid)
    (
        df.withColumns({"geometry": to_wkb("geom"), "bbox": bbox(F.col("geom")), "srid": own})
        .drop("geom")
        .repartitionByRange("incident_id", "perimeter_date")
        .sortWithinPartitions("incident_id", "perimeter_date")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#incident_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the identifiers of the row group
        .parquet(path)
    )


def write_by_priority(df: DataFrame, path: str, settings: Settings) -> None:
    """The table in the order (priority of its source, place of reading): range partitions, one file after the
    other, each sorted. No task holds more than its range."""
    ranked = df.withColumn("priority", source_priority(F.col("source_dataset"), settings))
    order = ["priority", "row_id"]
    ranked.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """A table of ordered files with ``place``, the number of its row from 0. Files count in the order of their
    names, rows in the order within their file; only a count per file is put in one order."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_file", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn("place", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def read_unified(spark: SparkSession, path: str) -> DataFrame:
    """The unified table as stored. Joins and filters see ``geometry`` as WKB and ``bbox``; the
    polygon functions take WKB, so only geometries they look at are ever decoded."""
    return spark.read.parquet(path)


def with_geom(table: DataFrame) -> DataFrame:
    """``geometry`` decoded to nested arrays as ``geom``."""
    return table.withColumn("geom", from_wkb("geometry")).drop("geometry")


# Quotes are doubled as other CSV readers expect, outer blanks and line breaks stay. Null is the text \\N;
# a text that starts with a backslash gets one more, so that no text equals null.
_NULL = "\\N"
_CSV = {
    "header": "true", "quote": '"', "escape": '"', "nullValue": _NULL, "emptyValue": "", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _texts(df: DataFrame, change) -> DataFrame:
    """``change`` applied to the text columns that start with a backslash."""
    columns = {
        f.name: F.when(F.startswith(F.col(f.name), F.lit("\\")), change(F.col(f.name))).otherwise(F.col(f.name))
        for f in df.schema if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(columns)


def write_rejects(df: DataFrame, path: str) -> bool:
    """CSV with a header that ``read_rejects`` reads back unchanged; nothing is written when there are
    no rejects."""
    if df.isEmpty():
        return False
    escaped = _texts(df, lambda c: F.concat(F.lit("\\"), c))
    escaped.write.mode("overwrite").options(**_CSV, quoteAll="true").csv(path)
    return True


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records that ``write_rejects`` wrote, with their types."""
    found = spark.read.schema(schema).options(**_CSV, multiLine="true", enforceSchema="false", mode="FAILFAST").csv(path)
    return _texts(found, lambda c: F.substring(c, 2, 2**31 - 1))


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as one JSON document, nulls included, with the time of writing."""
    stamp = F.replace(F.current_timestamp().cast("string"), F.lit(" "), F.lit("T"))
    whole = report.withColumn("processing_timestamp", stamp)
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    whole.select(text).coalesce(1).write.mode("overwrite").text(path)
