"""Perimeter date, fire year and the unified incident identifier of each record."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perimetry.functions.barrier import stage
from perimetry.functions.dates import with_parsed_date
from perimetry.functions.text import canonical_year, is_given, is_valid_id, strip

# Fixed values: (name of the tier, column that feeds it), best first.
ID_TIERS = (
    ("formal", "incident_id_raw"),
    ("irwin", "irwin_id_raw"),
    ("local", "local_incident_id"),
    ("for_id", "for_id"),
    ("geo_id", "geo_id"),
    ("global_id", "global_id"),
)
NO_ID = "none"


def fill_year(df: DataFrame) -> DataFrame:
    """Canonical ``fire_year`` text, a null year taken from the date; ``year_filled`` marks those.

    Only nulls are filled: an empty or placeholder year stays and is judged by the quality rules.
    """
    return stage(
        df,
        fire_year=f"coalesce({canonical_year('fire_year')}, cast(year(perimeter_date) AS string))",
        year_filled="fire_year IS NULL AND perimeter_date IS NOT NULL",
    )


def unify_ids(df: DataFrame) -> DataFrame:
    """``id_type``: the first tier with a usable identifier, or ``none``; ``incident_id``: its value.

    A local number is unique only with its year and unit, so without both that tier is skipped.
    """
    tiers, values = "", ""
    for name, column in ID_TIERS:
        usable, value = is_valid_id(column), strip(column)
        if name == "local":
            usable += f" AND {is_given('fire_year')} AND {is_given('unit_id')}"
            value = f"concat_ws('-', fire_year, unit_id, {column})"
        tiers += f" WHEN {usable} THEN '{name}'"
        values += f" WHEN '{name}' THEN {value}"
    df = stage(df, id_type=f"CASE {tiers} ELSE '{NO_ID}' END")
    return stage(df, incident_id=f"CASE id_type {values} END")


def identify(df: DataFrame) -> DataFrame:
    """Normalized records -> the same plus date, filled year and identifier. Narrow: no shuffle."""
    return unify_ids(fill_year(with_parsed_date(df, "perimeter_date_raw", "perimeter_date")))
