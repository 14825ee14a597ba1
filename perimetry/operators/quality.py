"""Why a record is rejected: the first failing rule, in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.config import Settings
from perimetry.functions.barrier import stage
from perimetry.functions.dates import in_year_range
from perimetry.functions.shapes import centroid, measure
from perimetry.operators import polygons
from perimetry.operators.identity import NO_ID
from perimetry.plans.storage import written


def _missing(field: str) -> str:
    if field == "geometry":
        return "geom IS NULL"
    return f"({field} IS NULL OR {field} IN ('', 'None'))"


def max_year(settings: Settings) -> int | str:
    return "year(current_date()) + 1" if settings.max_year is None else settings.max_year


def classify(df: DataFrame, settings: Settings) -> DataFrame:
    """Add ``reject_reason``: ``no_id``, ``invalid_date``, ``missing_<field>``, ``invalid_geometry``
    or null for a record that passes. A missing date passes; only a date out of range fails.

    The cheap rules come first; the geometry test sees null for records they reject. Its by-product
    ``centroid`` is kept for the duplicate key.
    """
    in_range = in_year_range("perimeter_date", settings.min_year, max_year(settings))
    rules = [(f"id_type = '{NO_ID}'", "no_id"), (f"perimeter_date IS NOT NULL AND NOT {in_range}", "invalid_date")]
    rules += [(_missing(field), f"missing_{field}") for field in settings.required_fields]
    first = " ".join(f"WHEN {rule} THEN '{reason}'" for rule, reason in rules)
    df = stage(df, _early=f"CASE {first} END")
    if settings.validity == "joins":
        return _classified_by_joins(df)
    looked_at = F.expr("CASE WHEN _early IS NULL THEN geom END")
    # the stage keeps a later filter on the reason from evaluating the function a second time
    return stage(
        df.withColumn("_measured", measure(looked_at)),
        reject_reason="coalesce(_early, CASE WHEN NOT _measured.valid THEN 'invalid_geometry' END)",
        centroid="_measured.centroid",
    ).drop("_early", "_measured")


def _classified_by_joins(df: DataFrame) -> DataFrame:
    """The geometry test as joins of edges: records are stored, and keys of invalid ones joined to them."""
    looked_at = F.expr("CASE WHEN _early IS NULL THEN geom END")
    rows = written(df.withColumn("centroid", centroid(looked_at)), "records")
    shapes = rows.where("_early IS NULL AND geom IS NOT NULL").select("row_id", "geom")
    marked = polygons.with_flag(rows, ["row_id"], polygons.invalid(shapes, ["row_id"], "geom"), "_invalid", F.lit(True))
    return marked.withColumn(
        "reject_reason", F.expr("coalesce(_early, CASE WHEN _invalid THEN 'invalid_geometry' END)")).drop("_early", "_invalid")


def passed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNull())


def without_id(df: DataFrame) -> DataFrame:
    """Records no tier could identify, all columns but the geometry."""
    return df.filter(F.col("id_type") == NO_ID).drop("geom", "centroid", "reject_reason", "year_filled")


def reason_counts(df: DataFrame) -> DataFrame:
    """(reason, records); records that pass count as ``passed``."""
    return df.groupBy(F.coalesce("reject_reason", F.lit("passed")).alias("reason")).agg(
        F.count("*").alias("records")
    )


def quality_counters() -> list[Column]:
    """Aggregates over classified records: those with an identifier, by what became of them."""
    reason = F.col("reject_reason")
    return [
        F.count_if(F.col("id_type") != NO_ID).alias("total_input"),
        F.count_if(reason.startswith("missing_")).alias("missing_required_fields"),
        F.count_if(reason == "invalid_date").alias("invalid_dates"),
        F.count_if(reason == "invalid_geometry").alias("invalid_geometry"),
        F.count_if(reason.isNull()).alias("passed"),
    ]


def quality_stats(df: DataFrame) -> DataFrame:
    """One row of counters over the records that have an identifier."""
    return df.agg(*quality_counters())
