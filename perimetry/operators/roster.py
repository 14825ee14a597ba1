"""One row per incident of a year-to-date file: name, start and largest size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.config import ROSTER_ALIASES
from perimetry.functions.dates import with_parsed_date
from perimetry.operators.fields import first_present

# The same for records whose fields the reader has resolved already.
RESOLVED = {name: (name,) for name in ROSTER_ALIASES}

# Fixed values: (heading, width) of the report columns.
REPORT_COLUMNS = (("Fire Name", 40), ("Start Date", 12), ("Incident ID", 30), ("Max Acres", 12))


def roster_input(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = ROSTER_ALIASES, row_id: str = "row_id"
) -> DataFrame:
    """Pick the roster fields by presence: ``incident_id, fire_name, fire_start, acres, row_id``."""
    picked = df.select(
        first_present(df, aliases["incident_id"]).cast("string").alias("incident_id"),
        first_present(df, aliases["fire_name"]).cast("string").alias("fire_name"),
        first_present(df, aliases["fire_start_raw"]).cast("string").alias("fire_start_raw"),
        first_present(df, aliases["acres"], "double").try_cast("double").alias("acres"),
        F.col(row_id).alias("row_id"),
    )
    return with_parsed_date(picked, "fire_start_raw", "fire_start").drop("fire_start_raw")


def roster(records: DataFrame) -> DataFrame:
    """First non-null name and start in reading order, largest acres, ordered by start.

    All three aggregate partially, so an incident with most of the rows costs no more than others.
    """

    def first_given(column: str) -> Column:
        order = F.when(F.col(column).isNotNull(), F.col("row_id"))
        return F.min_by(column, order).alias(column)

    return (
        records.filter(F.col("incident_id").isNotNull())
        .groupBy("incident_id")
        .agg(first_given("fire_name"), first_given("fire_start"), F.max("acres").alias("max_acres"))
        .orderBy(F.asc_nulls_last("fire_start"), "incident_id")
    )


def roster_lines(rows: DataFrame) -> DataFrame:
    """Add ``line``: the fixed-width report row."""
    unknown = F.lit("Unknown")
    cells = (
        F.coalesce("fire_name", unknown),
        F.coalesce(F.to_date("fire_start").cast("string"), unknown),
        F.col("incident_id"),
        F.coalesce(F.format_number("max_acres", 0), unknown),
    )
    padded = [F.rpad(c, width, " ") for c, (_, width) in zip(cells, REPORT_COLUMNS)]
    return rows.withColumn("line", F.concat_ws(" ", *padded))
