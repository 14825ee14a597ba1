"""Raw perimeter files -> normalized records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.config import ROSTER_ALIASES, Settings, SourceSpec
from perimetry.functions.geometry import to_wgs84, wgs84_srid
from perimetry.operators.fields import union_all
from perimetry.schema import NORMALIZED_COLUMNS, TEXT_COLUMNS
from perimetry.sources.archives import stage
from perimetry.sources.files import wanted_tasks
from perimetry.sources.shapefile import SPLIT_BYTES, ShapefileSource


def _row_id(rank: int) -> str:
    """Place in the reading order: source (7 bits), file (24 bits), record (32 bits)."""
    return f"shiftleft({rank}L, 56) | shiftleft(cast(file_no AS bigint), 32) | record_no"


def _load(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(ShapefileSource)
    return spark.read.format(ShapefileSource.name()).options(tasks=str(wanted_tasks(spark)), **options).load()


def scan(
    spark: SparkSession, raw_dir: str, spec: SourceSpec, rank: int, settings: Settings, mode: str = "PERMISSIVE",
    staged: str | None = None,
) -> DataFrame:
    """One dataset in the normalized schema and WGS84, plus the ``srid`` of its geometry, ``file`` and ``error``.

    No matching folder or archive gives an empty frame. ``staged`` names the copies of large archives that
    ``stage_archives`` made; without it each archive is read by one task. The reader resolves the aliases of each
    file, so this is a plain projection.
    """
    raw = _load(
        spark,
        path=raw_dir,
        pattern=spec.pattern,
        columns=",".join(TEXT_COLUMNS),
        aliases=json.dumps({c: list(settings.aliases.get(c, ())) for c in TEXT_COLUMNS}),
        nad83_as_wgs84=str(settings.nad83_as_wgs84),
        split_bytes=str(settings.split_bytes),
        staged=staged or "",
        mode=mode,
    )
    return raw.select(
        *TEXT_COLUMNS,
        F.lit(spec.name).alias("source_dataset"),
        to_wgs84(F.col("geom"), F.col("srid")).alias("geom"),
        F.expr(_row_id(rank)).alias("row_id"),
        wgs84_srid(F.col("srid")).alias("srid"),
        "file",
        "error",
    )


def stage_archives(spark: SparkSession, raw_dir: str, settings: Settings) -> str | None:
    """Stage the archives above ``split_bytes`` of all sources; the scratch folder, or None if there are none."""
    return stage(spark, raw_dir, [s.pattern for s in settings.sources], settings.split_bytes)


def scan_all(
    spark: SparkSession, raw_dir: str, settings: Settings, mode: str = "PERMISSIVE", staged: str | None = None
) -> DataFrame:
    """All datasets of ``settings`` in read order, one bag."""
    if len(settings.sources) > 127:
        raise ValueError("record numbers hold 127 sources")
    frames = [scan(spark, raw_dir, s, rank, settings, mode, staged) for rank, s in enumerate(settings.sources)]
    if not frames:
        return union_all(spark, []).selectExpr(*NORMALIZED_COLUMNS, "4326 AS srid", "'' AS file", "cast(NULL AS string) AS error")
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def readable(rows: DataFrame) -> DataFrame:
    """Records of files that were read without error; a file that failed halfway gives none."""
    # sent to the records, which else are shuffled by file: the driver has listed all files, so it holds these
    failed = F.broadcast(unreadable(rows).select("file").distinct())
    return rows.filter("error IS NULL").join(failed, "file", "left_anti")


def unreadable(rows: DataFrame) -> DataFrame:
    """``file, error`` of the files that could not be read."""
    return rows.filter("error IS NOT NULL").select("file", "error").distinct()


def scan_roster(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    """The roster fields of a year-to-date dataset, resolved by exact spelling, with ``row_id``.
    An unreadable file is an error here. A large archive is staged first; the copy is scratch."""
    raw = _load(
        spark,
        path=raw_dir,
        pattern=pattern,
        columns=",".join(ROSTER_ALIASES),
        aliases=json.dumps({c: list(names) for c, names in ROSTER_ALIASES.items()}),
        match="exact",
        staged=stage(spark, raw_dir, [pattern], SPLIT_BYTES) or "",
        mode="FAILFAST",
    )
    return raw.select(*ROSTER_ALIASES, F.expr(_row_id(0)).alias("row_id"))
