"""Counts and distributions of the unify job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perimetry.config import SourceSpec
from perimetry.operators.quality import quality_counters


def dataset_counts(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("source_dataset").agg(F.count("*").alias("raw_count"))


def id_type_distribution(identified: DataFrame) -> DataFrame:
    """(id_type, records, percent), most frequent first. The window spans seven rows at most."""
    counts = identified.groupBy("id_type").agg(F.count("*").alias("records"))
    total = F.sum("records").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn(
        "percent", F.round(100 * F.try_divide("records", total), 1)
    ).orderBy(F.desc("records"), "id_type")


def incident_sizes(unified: DataFrame) -> DataFrame:
    """Per incident: its perimeters and the range of its dates and years."""
    return (
        unified.filter(F.col("incident_id").isNotNull())
        .groupBy("incident_id")
        .agg(
            F.count("*").alias("n"),
            F.min("perimeter_date").alias("min_date"),
            F.max("perimeter_date").alias("max_date"),
            F.min("fire_year").alias("min_year"),
            F.max("fire_year").alias("max_year"),
        )
    )


def incident_stats(unified: DataFrame, key: str = "incident_id") -> DataFrame:
    """One row: incidents with one and with more perimeters, mean and largest size."""
    sizes = unified.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(*_size_aggregates())


def _size_aggregates():
    n = F.col("n")
    return (
        F.count("*").alias("total_incidents"),
        F.count_if(n == 1).alias("single_perimeter_incidents"),
        F.count_if(n > 1).alias("multi_perimeter_incidents"),
        F.avg(n).alias("avg_perimeters_per_incident"),
        F.max(n).alias("max_perimeters"),
    )


def overall_stats(unified: DataFrame) -> DataFrame:
    """One row over the unified table: size, ranges and incident statistics, in one aggregation."""
    return incident_sizes(unified).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count("*").alias("unique_incidents"),
        F.min("min_date").cast("string").alias("min_date"),
        F.max("max_date").cast("string").alias("max_date"),
        F.min("min_year").cast("int").alias("min_year"),
        F.max("max_year").cast("int").alias("max_year"),
        *_size_aggregates(),
    )


_COUNTERS = ("total_input", "missing_required_fields", "invalid_dates", "invalid_geometry", "passed", "years_filled")


def classified_stats(classified: DataFrame, sources: Sequence[SourceSpec]) -> DataFrame:
    """One row over the classified records, which are read once: the counters, identifier type -> records, and
    dataset key -> (raw_count, source) of the datasets with records.

    Records shrink to one row per (source, identifier type); the rest works on those few rows.
    """
    few = classified.groupBy("source_dataset", "id_type").agg(
        F.count("*").alias("records"), *quality_counters(), F.count_if("year_filled").alias("years_filled")
    )
    kinds = few.groupingSets([["source_dataset"], ["id_type"]], "source_dataset", "id_type").agg(
        F.grouping("id_type").alias("_by_source"), *[F.sum(c).alias(c) for c in ("records", *_COUNTERS)]
    )
    by_source = F.col("_by_source") == 1
    keys = F.create_map(*[F.lit(v) for s in sources for v in (s.name, s.key)])
    key = F.coalesce(F.try_element_at(keys, F.col("source_dataset")), F.col("source_dataset"))
    dataset = F.struct(key.alias("key"), F.struct(F.col("records").alias("raw_count"), F.col("source_dataset").alias("source")).alias("value"))
    return kinds.agg(
        F.map_from_entries(F.collect_list(F.when(by_source, dataset))).alias("datasets"),
        F.map_from_entries(F.collect_list(F.when(~by_source, F.struct("id_type", "records")))).alias("id_types"),
        *[F.coalesce(F.sum(F.when(by_source, F.col(c))), F.lit(0)).alias(c) for c in _COUNTERS],
    )


def merge_rows(*rows: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side, without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])


def processing_report(
    classified: DataFrame, unified: DataFrame, sources: Sequence[SourceSpec]
) -> DataFrame:
    """The nested one-row report of the unify job. Each of the two tables is read once."""
    row = merge_rows(overall_stats(unified), classified_stats(classified, sources))
    # fixed values: the field names of the report
    overall = F.struct(
        "total_records",
        "unique_incidents",
        F.struct(F.col("min_date").alias("min"), F.col("max_date").alias("max")).alias("date_range"),
        F.struct(F.col("min_year").alias("min"), F.col("max_year").alias("max")).alias("year_range"),
        F.col("id_types").alias("id_type_distribution"),
        F.struct(
            "total_input", "missing_required_fields", "invalid_dates", "invalid_geometry", "passed"
        ).alias("quality_filter_stats"),
        F.struct(
            F.col("passed").alias("total_input"),
            (F.col("passed") - F.col("total_records")).alias("duplicates_removed"),
            F.col("total_records").alias("unique_output"),
        ).alias("deduplication_stats"),
        F.struct(
            "total_incidents",
            "single_perimeter_incidents",
            "multi_perimeter_incidents",
            "avg_perimeters_per_incident",
            "max_perimeters",
        ).alias("incident_stats"),
        F.col("years_filled"),
    )
    return row.select("datasets", overall.alias("overall"))
