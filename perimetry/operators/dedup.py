"""Keep one record per incident, year and centroid: that of the best source."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perimetry.config import Settings
from perimetry.functions.shapes import centroid


def source_priority(source: Column, settings: Settings) -> Column:
    """Rank of a source by name; the default for one that is not listed."""
    default = F.lit(settings.default_priority)
    if not settings.priorities:
        return default
    ranks = F.create_map(*[F.lit(v) for v in chain.from_iterable(settings.priorities.items())])
    return F.coalesce(F.try_element_at(ranks, source), default)


def with_dedup_key(df: DataFrame, settings: Settings) -> DataFrame:
    """Add the key columns ``cx``, ``cy`` (null for an empty geometry) and ``priority``."""
    if "centroid" not in df.columns:
        df = df.withColumn("centroid", centroid("geom"))
    x, y = F.col("centroid.x"), F.col("centroid.y")
    if settings.key_decimals is not None:
        x, y = F.round(x, settings.key_decimals), F.round(y, settings.key_decimals)
    priority = source_priority(F.col("source_dataset"), settings)
    return df.withColumns({"cx": x, "cy": y, "priority": priority}).drop("centroid")


def deduplicate(df: DataFrame, settings: Settings) -> DataFrame:
    """First record of each key by (priority, reading order). The date is not part of the key.

    ``row_number() = 1`` becomes a window group limit: each task keeps the best record per key
    before the shuffle, so copies of one record, however many, never gather in one task.
    """
    key = ["incident_id", "fire_year", "cx", "cy"]
    best = Window.partitionBy(*key).orderBy("priority", "row_id")
    ranked = with_dedup_key(df, settings).withColumn("_rank", F.row_number().over(best))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "cx", "cy", "priority")
