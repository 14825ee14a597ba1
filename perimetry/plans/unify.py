"""Normalized records -> the unified perimeter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.config import Settings
from perimetry.functions.text import to_number
from perimetry.operators.dedup import deduplicate
from perimetry.operators.identity import identify
from perimetry.operators.quality import classify, passed
from perimetry.schema import OUTPUT_COLUMNS


def classified(normalized: DataFrame, settings: Settings) -> DataFrame:
    """Every record with its date, year, identifier and reject reason. Narrow: no shuffle."""
    return classify(identify(normalized), settings)


def unified(classified_records: DataFrame, settings: Settings) -> DataFrame:
    """The passing records, one per duplicate key, in the output schema; an ``srid`` comes along. One shuffle."""
    kept = deduplicate(passed(classified_records), settings)
    return kept.withColumn("fire_year", F.expr(to_number("fire_year"))).select(
        *OUTPUT_COLUMNS, *[c for c in ("srid",) if c in kept.columns])
