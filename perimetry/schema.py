"""The two fixed schemas: what every source is normalized to, and what the unified table holds."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = "struct<x:double,y:double>"
# polygons -> rings (the first is the shell) -> points
GEOM = f"array<array<array<{POINT}>>>"
POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOM_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(POINT_TYPE)))

# The column names below.
ID_COLUMNS = (
    "incident_id_raw",
    "irwin_id_raw",
    "local_incident_id",
    "for_id",
    "geo_id",
    "global_id",
)
TEXT_COLUMNS = (
    *ID_COLUMNS,
    "incident_name",
    "fire_year",
    "unit_id",
    "state",
    "perimeter_date_raw",
)
# `row_id` is the place of a record in the reading order of all sources. It is the tie-breaker
# everywhere, so no result depends on partitioning.
NORMALIZED_COLUMNS = (*TEXT_COLUMNS, "source_dataset", "geom", "row_id")
NORMALIZED_DDL = ", ".join(
    [f"{c} string" for c in TEXT_COLUMNS] + ["source_dataset string", f"geom {GEOM}", "row_id bigint"]
)

OUTPUT_COLUMNS = (
    "incident_id",
    "incident_name",
    "fire_year",
    "unit_id",
    "perimeter_date",
    "geom",
    "source_dataset",
    "id_type",
    "row_id",
)
