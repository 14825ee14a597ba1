"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.functions.geometry import bbox, bboxes_meet, point_text
from perimetry.functions.shapes import centroid
from perimetry.functions.text import is_valid_id
from perimetry.operators import dedup, fields, funnel, identity, pairs, polygons, quality, report, roster, timeline
from perimetry.functions.dates import with_parsed_date
from perimetry.plans.storage import scratch_path, written
from perimetry.plans.unify import classified, unified
from perimetry.queries import roundtrips
from perimetry.queries.adapter import SETTINGS, adapter, dealt_out, normalized, table
from perimetry.schema import GEOM, ID_COLUMNS, TEXT_COLUMNS
from perimetry.sinks.outputs import read_unified, write_unified

Query = Callable[[SparkSession, str], DataFrame]

ORDERS = {"key": "o_custkey", "ts": "o_orderdate"}

# One set of source field names per source of the adapter. The fourth uses a name that is no alias
# of the incident id; the fifth has two fields that normalize alike and a name field that is its
# own output name, which is no alias either.
RENAMES: dict[str, dict[str, str]] = {
    "Interagency Fire Perimeter History": {
        "incident_id_raw": "UniqueFireIdentifier", "irwin_id_raw": "IRWINID", "local_incident_id": "LocalIncid",
        "for_id": "FORID", "geo_id": "GEO_ID", "global_id": "GlobalID", "incident_name": "IncidentName",
        "fire_year": "FireYear", "unit_id": "UnitID", "perimeter_date_raw": "PerimeterDateTime",
    },
    "Historic GeoMAC (2000-2018)": {
        "incident_id_raw": "Unqe_Fire_", "irwin_id_raw": "irwin_id", "local_incident_id": "local_num",
        "for_id": "attr_forid", "geo_id": "geoid", "global_id": "Global ID", "incident_name": "incident",
        "fire_year": "Fire_Year", "unit_id": "unit_id", "perimeter_date_raw": "date_cur",
    },
    "WFIGS Recent (2016-2025)": {
        "incident_id_raw": "uniquefire", "irwin_id_raw": "attr_irwinid", "local_incident_id": "attr_local",
        "for_id": "poly_forid", "geo_id": "GEOID", "global_id": "GLOBALID", "incident_name": "IncidentNa",
        "fire_year": "year", "unit_id": "poo_resp_i", "perimeter_date_raw": "poly_polyg",
    },
    "WFIGS Year to Date": {
        "incident_id_raw": "attr_Uniqu", "irwin_id_raw": "attr_irwin_id", "local_incident_id": "localinci",
        "for_id": "ForId", "geo_id": "geo_id", "global_id": "global_id", "incident_name": "poly_incid",
        "fire_year": "FIRE_YEAR", "unit_id": "attr_unit_id", "perimeter_date_raw": "poly_polygondatetime",
    },
    "Unlisted source": {
        "incident_id_raw": "uniquefir", "irwin_id_raw": "IrwinID", "local_incident_id": "LOCAL_NUM",
        "for_id": "forid", "geo_id": "geo_id", "global_id": "globalid", "incident_name": "incident_name",
        "fire_year": "fireyear", "unit_id": "Unit ID", "perimeter_date_raw": "perimeterdatetime",
    },
}


def q01_normalize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalized(spark, sf_dir).drop("state")
    frames = []
    for source, names in RENAMES.items():
        raw = rows.filter(F.col("source_dataset") == source).drop("source_dataset")
        if source == "Unlisted source":
            raw = raw.select(F.lit("shadowed").alias("unit_id_"), *raw.columns).withColumnRenamed("unit_id_", "UNIT_ID ")
        frames.append(fields.normalize(raw.withColumnsRenamed(names), source))
    result = fields.union_all(spark, frames)
    return result.select("row_id", "source_dataset", *TEXT_COLUMNS)


def q02_valid_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [f"{is_valid_id(c)} AS {c}_ok" for c in ID_COLUMNS]
    return normalized(spark, sf_dir).selectExpr("row_id", *flags)


def q03_unify_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.identify(normalized(spark, sf_dir)).select("row_id", "id_type", "incident_id")


def q04_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = with_parsed_date(normalized(spark, sf_dir), "perimeter_date_raw", "perimeter_date")
    return dated.select("row_id", F.col("perimeter_date").cast("string").alias("perimeter_date"))


def q05_year_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = with_parsed_date(normalized(spark, sf_dir), "perimeter_date_raw", "perimeter_date")
    return identity.fill_year(dated).select("row_id", "fire_year", "year_filled")


def q06_quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reason_counts(_classified(spark, sf_dir))


def q07_rejects_no_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quality.without_id(_classified(spark, sf_dir))
    return rejected.withColumn("perimeter_date", F.col("perimeter_date").cast("string"))


def q08_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c")
    return (
        normalized(spark, sf_dir)
        .select("row_id", centroid("geom").alias("c"))
        .select("row_id", c["x"].alias("x"), c["y"].alias("y"), (point_text(c) == "NOGEOM").alias("no_geom"))
    )


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding read as a ring of 32 points, closed with the first: ``vec_id, geom``."""
    points = "transform(sequence(0, 31), i -> named_struct('x', cast(embedding[2 * i] AS double), 'y', cast(embedding[2 * i + 1] AS double)))"
    ring = f"concat(slice({points}, 1, 32), slice({points}, 1, 1))"
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", f"array(array({ring})) AS geom")


def q08_centroid_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c")
    return rings(spark, sf_dir).select("vec_id", centroid("geom").alias("c")).select(
        "vec_id", F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y")
    )


def _judged(shapes: DataFrame, key: str) -> DataFrame:
    """(key, valid) of geometries; null for a missing one."""
    found = polygons.with_flag(shapes, [key], polygons.invalid(shapes, [key], "geom"), "invalid", F.col("geom").isNotNull())
    return found.select(key, (~F.col("invalid")).alias("valid"))


def q09_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged(normalized(spark, sf_dir).select("row_id", "geom"), "row_id")
    return judged.selectExpr("row_id", "CASE WHEN valid THEN 'valid' WHEN NOT valid THEN 'invalid' ELSE 'missing' END AS verdict")


def q09_validity_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(rings(spark, sf_dir), "vec_id")


def q09_validity_by_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rings with the points of every other one in the order of their angles, which makes them valid."""
    points = "transform(sequence(0, 31), i -> named_struct('x', cast(embedding[2 * i] AS double), 'y', cast(embedding[2 * i + 1] AS double)))"
    turned = f"transform(array_sort(transform({points}, (p, i) -> named_struct('a', if(vec_id % 2 = 0, atan2(p.y, p.x), i), 'p', p))), s -> s.p)"
    ring = f"concat({turned}, slice({turned}, 1, 1))"
    shaped = table(spark, sf_dir, "embeddings").selectExpr("vec_id", f"array(array({ring})) AS geom")
    return _judged(shaped, "vec_id")


def q35_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triangles per embedding, the second a quarter as large: their boxes often meet where they do not."""

    def triangle(first: int, scale: str) -> str:
        corners = ", ".join(
            f"named_struct('x', cast(embedding[{i}] AS double) * {scale}, 'y', cast(embedding[{i + 1}] AS double) * {scale})"
            for i in (first, first + 2, first + 4, first)
        )
        return f"array(array(array({corners})))"

    shaped = table(spark, sf_dir, "embeddings").selectExpr("vec_id", f"{triangle(0, '1D')} AS a", f"{triangle(6, '0.25D')} AS b")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    found = polygons.with_flag(shaped, ["vec_id"], polygons.intersecting(shaped, ["vec_id"], "a", "b"), "overlaps", both)
    found = polygons.with_flag(found, ["vec_id"], polygons.containing(shaped, ["vec_id"], "a", "b"), "a_contains_b", both)
    return found.select("vec_id", bboxes_meet(bbox(F.col("a")), bbox(F.col("b"))).alias("boxes_meet"), "overlaps", "a_contains_b")


def q10_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.deduplicate(quality.passed(_classified(spark, sf_dir)), SETTINGS)
    return kept.select("row_id", "incident_id", "fire_year", "source_dataset")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(normalized(spark, sf_dir), SETTINGS)


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(_classified(spark, sf_dir), SETTINGS)


def _unified_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table written and read back, as the later jobs find it."""
    path = scratch_path(spark, "unified")
    write_unified(_unified(spark, sf_dir), path)
    return read_unified(spark, path)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pairs are made of. Pairs alone need no stored table and no geometry."""
    return _unified(spark, sf_dir).select("row_id", "incident_id", "perimeter_date")


def q11_unified_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unified(spark, sf_dir).select(
        "row_id", "incident_id", "incident_name", "fire_year", "unit_id",
        F.col("perimeter_date").cast("string").alias("perimeter_date"), "source_dataset", "id_type",
        F.expr("size(flatten(flatten(geom)))").alias("points"),
    )


def q12_dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.dataset_counts(normalized(spark, sf_dir))


def q13_id_type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.id_type_distribution(identity.identify(normalized(spark, sf_dir)))


def q14_overall_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(_classified(spark, sf_dir).drop("geom"), "classified")
    no_shapes = rows.withColumn("geom", F.lit(None).cast(GEOM))  # the duplicate key needs the centroid alone
    kept = written(unified(no_shapes, SETTINGS).select("incident_id", "perimeter_date", "fire_year"), "kept")
    whole = report.processing_report(rows, kept, SETTINGS.sources)
    return whole.select(
        "overall.total_records", "overall.unique_incidents",
        F.col("overall.date_range.min").alias("min_date"), F.col("overall.date_range.max").alias("max_date"),
        F.col("overall.year_range.min").alias("min_year"), F.col("overall.year_range.max").alias("max_year"),
        "overall.quality_filter_stats.*", "overall.deduplication_stats.duplicates_removed",
        "overall.years_filled", "overall.incident_stats.single_perimeter_incidents",
        "overall.incident_stats.multi_perimeter_incidents", "overall.incident_stats.max_perimeters",
        F.round("overall.incident_stats.avg_perimeters_per_incident", 6).alias("avg_perimeters_per_incident"),
        F.col("overall.id_type_distribution")["formal"].alias("formal_ids"),
        F.col("datasets")["wfigs_ytd"]["raw_count"].alias("year_to_date_records"),
    )


def q15_incident_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.incident_stats(table(spark, sf_dir, "orders"), "o_custkey")
    return stats.withColumn("avg_perimeters_per_incident", F.round("avg_perimeters_per_incident", 6))


def q16_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel(table(spark, sf_dir, "orders"), **ORDERS)


def q16_funnel_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel_steps(q16_funnel(spark, sf_dir))


def q17_funnel_with_missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel(_unified(spark, sf_dir))


def _readable(found: DataFrame) -> DataFrame:
    texts = {c: F.col(c).cast("string") for c in ("curr_ts", "next_ts")}
    return found.withColumns(texts)


def q18_pairs_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(pairs.elapsed_pairs(_dated(spark, sf_dir)))


def q19_pairs_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(pairs.calendar_pairs(_dated(spark, sf_dir)))


def q20_gap_rule_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = pairs.pair_counts(_unified(spark, sf_dir))
    return counts.filter("elapsed_pairs <> calendar_pairs").select(
        "incident_id", "perimeters", "elapsed_pairs", "calendar_pairs"
    )


def q21_bbox_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified_table(spark, sf_dir)
    near = pairs.with_bbox_overlap(pairs.consecutive(rows), rows)
    return near.select("incident_id", "curr_row", "next_row", "bbox_overlap")


def q22_overlap_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified_table(spark, sf_dir)
    return pairs.overlap_counts(pairs.with_overlap(pairs.elapsed_pairs(rows), rows, "geometry"))


def q22_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified_table(spark, sf_dir)
    found = pairs.with_overlap(pairs.consecutive(rows), rows, "geometry")
    return found.select("incident_id", "curr_row", "next_row", "overlaps")


def q23_contains_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified_table(spark, sf_dir)
    found = pairs.with_containment(pairs.consecutive(rows), rows, "geometry")
    return found.select("incident_id", "curr_row", "next_row", "curr_contains", "next_contains")


def q24_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.sequences(_unified(spark, sf_dir))


def q25_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified_table(spark, sf_dir)
    items = timeline.timeline(written(pairs.elapsed_pairs(rows), "pairs"))
    placed = timeline.with_label_points(items, rows, "geometry")
    return _timeline_columns(placed, "incident_id", F.col("label_point.x").alias("x"), F.col("label_point.y").alias("y"))


def _timeline_columns(items: DataFrame, key: str, *more) -> DataFrame:
    return items.select(
        key, F.col("ts").cast("string").alias("ts"), "row", "position", "perimeters",
        F.round("progress", 6).alias("progress"), "is_label", "label", *more,
    )


def q25_timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _unified(spark, sf_dir).select("row_id", "incident_id", "incident_name", "perimeter_date")
    titled = timeline.timeline_title(timeline.timeline_summary(pairs.elapsed_pairs(rows)), rows)
    dates = {c: F.col(c).cast("string") for c in ("first_date", "last_date")}
    return titled.withColumns(dates)


def q25_timeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    found = pairs.elapsed_pairs(events, key="user_id", ts="ts", row="event_id")
    return _timeline_columns(timeline.timeline(written(found, "pairs"), "user_id"), "user_id")


def _roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a year-to-date file in which the preferred name field is absent."""
    raw = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("string")).select(
        F.expr("CASE WHEN event_id % 50 <> 0 THEN concat('2024-', user_id) END").alias("attr_Uniqu"),
        F.expr("CASE WHEN event_id % 3 <> 0 THEN concat(event_type, ' by user ', user_id, ' on a long-named ridge') END").alias("attr_Inc_1"),
        F.expr("CASE WHEN event_id % 4 <> 0 THEN concat(substr(t, 6, 2), '/', substr(t, 9, 2), '/', substr(t, 1, 4), ' ', substr(t, 12)) END").alias("attr_Fir_7"),
        (F.col("value") * 1000).alias("poly_Acres"),
        F.col("event_id").alias("row_id"),
    )
    return roster.roster(roster.roster_input(dealt_out(raw)))


def q26_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster(spark, sf_dir).withColumns(
        {"fire_start": F.col("fire_start").cast("string"), "max_acres": F.round("max_acres", 3)}
    )


def q27_roster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster.roster_lines(_roster(spark, sf_dir)).select("incident_id", "line")


def q28_pairs_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey", "l_shipdate", "l_orderkey * 8 + l_linenumber AS row_id"
    )
    found = pairs.consecutive(lines, key="l_partkey", ts="l_shipdate")
    near = pairs.within_elapsed_days(F.col("curr_ts"), F.col("next_ts"), 6)
    return found.groupBy("l_partkey").agg(
        F.count("*").alias("distinct_pairs"),
        F.count_if(near).alias("near_pairs"),
        F.sum(F.when(near, F.col("curr_row"))).alias("curr_rows"),
        F.sum(F.when(near, F.col("next_row"))).alias("next_rows"),
    )


def q28_pair_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_counts(table(spark, sf_dir, "lineitem"), key="l_partkey", ts="l_shipdate")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q01_normalize_schema, q02_valid_id, q03_unify_id, q04_parse_date, q05_year_fill,
        q06_quality_reasons, q07_rejects_no_id, q08_centroid, q08_centroid_rings, q09_validity,
        q09_validity_rings, q09_validity_by_angle, q10_dedup, q11_unified_table, q12_dataset_counts,
        q13_id_type_distribution, q14_overall_report, q15_incident_stats, q16_funnel,
        q16_funnel_steps, q17_funnel_with_missing_dates, q18_pairs_elapsed, q19_pairs_calendar,
        q20_gap_rule_difference, q21_bbox_overlap_pairs, q22_overlap_count, q22_overlap_pairs,
        q23_contains_pairs, q24_sequences, q25_timeline, q25_timeline_summary,
        q25_timeline_events, q26_roster, q27_roster_report, q28_pairs_lineitem,
        q28_pair_counts_lineitem, roundtrips.q29_shapefile_roundtrip, roundtrips.q30_sinks_roundtrip,
        roundtrips.q30_rejects_roundtrip, roundtrips.q31_unify_job, roundtrips.q32_unify_job_report,
        roundtrips.q33_training_pairs_job, roundtrips.q34_incident_lookup_job, q35_triangles,
        roundtrips.q36_mixed_systems, roundtrips.q37_ordered_output,
        roundtrips.q38_staged_archives, roundtrips.q39_split_files, roundtrips.q40_incident_lookups,
    )
}
