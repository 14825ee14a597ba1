"""Queries that write the adapter's records to files and read them back through the library."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.config import SOURCES
from perimetry.functions.geometry import degrees_to_mercator, to_wgs84, wgs84_srid
from perimetry.operators import quality
from perimetry.plans import jobs
from perimetry.plans.storage import scratch_path, written
from perimetry.plans.unify import classified, unified
from perimetry.queries.adapter import SETTINGS, adapter, normalized
from perimetry.schema import OUTPUT_COLUMNS, TEXT_COLUMNS
from perimetry.sinks.outputs import (
    read_in_order, read_rejects, read_unified, with_geom, write_by_priority, write_rejects, write_unified,
)
from perimetry.sources.files import open_fs
from perimetry.sources.perimeters import readable, scan_all, stage_archives

# Source field name (ten characters at most) of each normalized column.
FIELDS = {
    "incident_id_raw": "uniquefire", "irwin_id_raw": "IrwinID", "local_incident_id": "local_num",
    "for_id": "FORID", "geo_id": "geo_id", "global_id": "GlobalID", "incident_name": "IncidentNa",
    "fire_year": "FireYear", "unit_id": "UnitID", "perimeter_date_raw": "poly_polyg",
}
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]]]'

LOOKED_UP = "GEO144"
SOME_IDS = ("F-42", "F-42x", "GEO144", "GEO144x", "absent", "{G-19}")


def shapefile_parts(attributes: dict[str, list[str | None]], shapes: list[list[np.ndarray] | None]) -> dict[str, bytes]:
    """Suffix -> content of a shapefile of text attributes and single polygons (rings of points)."""
    body, index = _records(shapes)

    def main(payload: bytes) -> bytes:
        words = (100 + len(payload)) // 2
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + payload

    cells = {k: [(v or "").encode() for v in vs] for k, vs in attributes.items()}
    widths = {k: max([1, *map(len, vs)]) for k, vs in cells.items()}
    head = b"".join(
        k.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14) for k, w in widths.items()
    )
    count = len(shapes)
    table = struct.pack("<4BIHH20x", 3, 124, 1, 1, count, 33 + len(head), 1 + sum(widths.values())) + head + b"\r"
    columns = [np.frombuffer(b"".join(c.ljust(w) for c in cells[k]), np.uint8).reshape(count, w) for k, w in widths.items()]
    rows = np.hstack([np.full((count, 1), ord(" "), np.uint8), *columns])
    return {
        ".shp": main(body), ".shx": main(index), ".dbf": table + rows.tobytes(),
        ".prj": WGS84.encode(), ".cpg": b"UTF-8",
    }


def _records(shapes: list[list[np.ndarray] | None]) -> tuple[bytes, bytes]:
    """The records of the shapes, and their entries in the index. All is put in its place as words of four bytes."""
    rings = [r for some in shapes for r in some or ()]
    points = np.concatenate([np.zeros((0, 2)), *rings]).astype("<f8")
    parts = np.array([len(some or ()) for some in shapes], np.int64)
    ring_sizes = np.array([len(r) for r in rings], np.int64)
    ring_starts = np.append(0, np.cumsum(ring_sizes))
    bounds = ring_starts[np.append(0, np.cumsum(parts))]  # of each shape's points
    sizes = np.diff(bounds)
    present = np.array([some is not None for some in shapes], bool)
    words = np.where(present, 11 + parts + 4 * sizes, 1)
    at = np.cumsum(2 + words) - 2 - words
    body = np.zeros(int((2 + words).sum()), "<i4")
    body[at], body[at + 1] = np.arange(1, len(shapes) + 1).astype(">i4").view("<i4"), (2 * words).astype(">i4").view("<i4")
    body[at[present] + 2], body[at[present] + 11], body[at[present] + 12] = 5, parts[present], sizes[present]
    some = np.flatnonzero(sizes)
    if len(some):
        box = np.hstack([np.minimum.reduceat(points, bounds[some]), np.maximum.reduceat(points, bounds[some])])
        body[at[some, None] + 3 + np.arange(8)] = box.view("<i4")
    firsts = np.cumsum(parts) - parts
    body[np.repeat(at + 13 - firsts, parts) + np.arange(len(rings))] = ring_starts[:-1] - np.repeat(bounds[:-1], parts)
    body[np.repeat(at + 13 + parts - 4 * bounds[:-1], 4 * sizes) + np.arange(4 * len(points))] = points.view("<i4").ravel()
    return body.tobytes(), np.column_stack([50 + 2 * at, 2 * words]).astype(">i4").tobytes()


def _write_files(raw_dir: str, folders: dict[str, str], members: int, packed: bool):
    """Task body: each batch becomes one archive or folder per source, of ``members`` shapefiles. Names depend
    only on the partition and batch, so a repeated task writes the same files again."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_fs(raw_dir)
        system.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            for source, rows in batch.groupby("source_dataset"):
                name = f"{root}/{folders[source]}{part:05d}_{number:05d}"
                step = max(1, -(-len(rows) // members))
                files = {
                    f"Perimeters{start // step or ''}{suffix}": content
                    for start in range(0, len(rows), step)
                    for suffix, content in _parts(rows[start : start + step]).items()
                }
                if packed:
                    with system.open_output_stream(f"{name}.zip") as out:
                        out.write(_zipped(files))
                    continue
                system.create_dir(name)
                for file, content in files.items():
                    with system.open_output_stream(f"{name}/{file}") as out:
                        out.write(content)
            yield pd.DataFrame({"records": [len(batch)]})

    return write


def _parts(rows: pd.DataFrame) -> dict[str, bytes]:
    texts = {field: [None if pd.isna(v) else v for v in rows[column]] for column, field in FIELDS.items()}
    return shapefile_parts(texts, _rings(rows))


def _zipped(files: dict[str, bytes]) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in files.items():
            archive.writestr(name, content)
    return packed.getvalue()


def _rings(rows: pd.DataFrame) -> list[list[np.ndarray] | None]:
    x, y, h = (rows[c].to_numpy(float) for c in ("cx", "cy", "half"))
    low, high = np.stack([x - h, y - h]), np.stack([x + h, y + h])
    box = np.stack([low, [low[0], high[1]], high, [high[0], low[1]], low]).transpose(2, 0, 1)
    crossed = box[:, [0, 2, 1, 3, 4]]
    made = {"null": lambda i: None, "empty": lambda i: [], "box": lambda i: [box[i]]}
    return [made.get(kind, lambda i: [crossed[i]])(i) for i, kind in enumerate(rows["geom_kind"])]


def _raw_files(spark: SparkSession, sf_dir: str, members: int = 1, packed: bool = True) -> str:
    """The adapter as shapefiles of the five sources, zipped or not; unlisted ones become the last source."""
    raw_dir = scratch_path(spark, "raw")
    last = SOURCES[-1].name
    known = [s.name for s in SOURCES[:-1]]
    rows = adapter(spark, sf_dir).drop("geom").withColumn(
        "source_dataset", F.when(F.col("source_dataset").isin(known), F.col("source_dataset")).otherwise(last)
    )
    folders = {s.name: s.pattern.rstrip("*") for s in SOURCES}
    rows.mapInPandas(_write_files(raw_dir, folders, members, packed), "records bigint").write.format("noop").mode("overwrite").save()
    return raw_dir


def q29_shapefile_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter as zipped shapefiles of the five sources, scanned by the shapefile reader."""
    return _scanned(written(scan_all(spark, _raw_files(spark, sf_dir), SETTINGS), "scanned"))


def q38_staged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q29, from archives of two shapefiles that are staged first and then read in pieces of 64 KB."""
    raw_dir = _raw_files(spark, sf_dir, members=2)
    settings = replace(SETTINGS, split_bytes=1 << 16)
    staged = stage_archives(spark, raw_dir, replace(settings, split_bytes=0))
    return _scanned(written(scan_all(spark, raw_dir, settings, staged=staged), "scanned"))


def q39_split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q29, from folders of two unpacked shapefiles that are read in pieces of 64 KB."""
    raw_dir = _raw_files(spark, sf_dir, members=2, packed=False)
    return _scanned(written(scan_all(spark, raw_dir, replace(SETTINGS, split_bytes=1 << 16)), "scanned"))


def q40_incident_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several incidents, some of them absent, looked up in a stored table."""
    found = jobs.incidents(spark, _stored(spark, sf_dir), SOME_IDS)
    return found.select("row_id", "incident_id", F.col("perimeter_date").cast("string").alias("perimeter_date"), "source_dataset")


def _scanned(rows: DataFrame) -> DataFrame:
    records = readable(rows)
    x = F.expr("flatten(flatten(geom)).x")
    return records.select(
        "source_dataset", *[c for c in TEXT_COLUMNS if c != "state"],
        F.coalesce(F.size(x), F.lit(-1)).alias("points"), F.array_min(x).alias("xmin"), F.array_max(x).alias("xmax"),
        F.expr("coalesce(size(array_distinct(flatten(flatten(geom)))), -1)").alias("corners"),
    )


def q30_sinks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table written as Parquet with WKB and read back."""
    path = scratch_path(spark, "perimeters")
    write_unified(unified(classified(normalized(spark, sf_dir), SETTINGS), SETTINGS), path)
    return with_geom(read_unified(spark, path)).select(
        "row_id", "incident_id", "incident_name", "fire_year", "unit_id",
        F.col("perimeter_date").cast("string").alias("perimeter_date"), "source_dataset", "id_type",
        F.expr("size(flatten(flatten(geom)))").alias("points"),
        F.expr("array_max(flatten(flatten(geom)).y)").alias("ymax"),
        F.col("bbox.xmin").alias("xmin"), "srid",
    )


def q36_mixed_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in degrees, in NAD83 and in mercator metres, brought to one system that the sink asserts."""
    rows = normalized(spark, sf_dir).withColumn("srid", F.expr("element_at(array(4326, 4269, 3857), CAST(row_id % 3 AS INT) + 1)"))
    given = rows.withColumn("geom", F.when(F.col("srid") == 3857, degrees_to_mercator(F.col("geom"))).otherwise(F.col("geom")))
    same = given.withColumns({
        "geom": to_wgs84(F.col("geom"), F.col("srid"), nad83_as_wgs84=True), "srid": wgs84_srid(F.col("srid"), nad83_as_wgs84=True)})
    path = scratch_path(spark, "systems")
    write_unified(quality.passed(classified(same, SETTINGS)).select(*OUTPUT_COLUMNS, "srid"), path)
    steps = [F.round(F.col(f"bbox.{c}") * 1024).cast("long").alias(c) for c in ("xmin", "ymax")]  # corners are multiples of 1/1024
    return read_unified(spark, path).select("row_id", "incident_id", *steps, "srid")


def q37_ordered_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table written in the order of source priority and reading, and the place of each row in its files."""
    path = scratch_path(spark, "ordered")
    write_by_priority(unified(classified(normalized(spark, sf_dir), SETTINGS), SETTINGS), path, SETTINGS)
    return read_in_order(spark, path).select("row_id", "priority", "place")


def q30_rejects_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records without identifier written as CSV and read back."""
    path = scratch_path(spark, "no_id")
    rejected = quality.without_id(classified(normalized(spark, sf_dir), SETTINGS))
    if not write_rejects(rejected, path):
        return rejected
    return read_rejects(spark, path, rejected.schema).withColumn("perimeter_date", F.col("perimeter_date").cast("string"))


def _unify_job(spark: SparkSession, sf_dir: str) -> jobs.UnifyOutputs:
    settings = replace(SETTINGS, validity="joins")
    return jobs.unify(spark, _raw_files(spark, sf_dir), scratch_path(spark, "outputs"), settings)


def q31_unify_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unify job as users call it, from archives to the stored table. Which of several equal records
    stays depends on their order in the files, so the columns that they share are compared."""
    table = read_unified(spark, _unify_job(spark, sf_dir).table)
    return table.select("incident_id", "fire_year", "source_dataset", "id_type", "srid")


def q32_unify_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report file of the unify job, read back."""
    report = spark.read.json(_unify_job(spark, sf_dir).report)
    counts = [f"overall.quality_filter_stats.{c}" for c in ("total_input", "missing_required_fields", "invalid_dates", "invalid_geometry", "passed")]
    return report.select(
        "overall.total_records", "overall.unique_incidents", *counts, "overall.deduplication_stats.duplicates_removed", "overall.years_filled",
        "overall.incident_stats.single_perimeter_incidents", "overall.incident_stats.multi_perimeter_incidents",
        "overall.incident_stats.max_perimeters", F.col("overall.id_type_distribution.formal").alias("formal_ids"),
    )


def _stored(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "perimeters")
    write_unified(unified(classified(normalized(spark, sf_dir), SETTINGS), SETTINGS), path)
    return path


def q33_training_pairs_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training pairs job on a stored table; both geometries come along."""
    found = jobs.training_pairs(spark, _stored(spark, sf_dir), SETTINGS)
    both = F.col("curr_geom").isNotNull() & F.col("next_geom").isNotNull()
    return found.select("incident_id", "curr_row", "next_row", "overlaps", both.alias("both_shapes"))


def q34_incident_lookup_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline job: one incident looked up in a stored table."""
    items, _ = jobs.incident_timeline(spark, _stored(spark, sf_dir), LOOKED_UP, SETTINGS)
    return items.select(
        "incident_id", F.col("ts").cast("string").alias("ts"), "row", "position", "perimeters",
        F.round("progress", 6).alias("progress"), "is_label", "label",
        F.col("label_point.x").alias("x"), F.col("label_point.y").alias("y"),
    )
