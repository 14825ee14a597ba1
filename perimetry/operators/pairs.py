"""Consecutive perimeters of an incident.

Nothing here puts an incident into one task. Records first shrink to distinct (incident, moment)
rows with partial aggregation, moments are linked within an (incident, second), seconds within an hour, and
an incident as a whole is only ever ordered by hour: at most a million narrow rows (the microseconds of a second),
3,600, and one per hour of its life, whatever number of records it has. Geometry stays out of all of this and is joined in by
``row_id`` for the pairs that are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.functions.geometry import bbox, bboxes_meet
from perimetry.functions.wkb import from_wkb
from perimetry.operators import polygons
from perimetry.plans.storage import written


def within_elapsed_days(first: Column, second: Column, days: int) -> Column:
    """Different moments, at most ``days`` whole elapsed days apart."""
    return (first != second) & (F.timestamp_diff("DAY", first, second) <= days)


def within_calendar_days(first: Column, second: Column, days: int) -> Column:
    """Different moments whose calendar dates are at most ``days`` apart."""
    return (first != second) & (F.date_diff(second, first) <= days)


def hour_number(ts: str) -> Column:
    """Hours since 1970 of a ``timestamp_ntz``, whatever the session zone."""
    return F.expr(f"unix_date(to_date({ts})) * 24 + hour({ts})")


def second_number(ts: str) -> Column:
    """Seconds since 1970 of a ``timestamp_ntz``, whatever the session zone."""
    return F.expr(f"(unix_date(to_date({ts})) * 24L + hour({ts})) * 3600 + minute({ts}) * 60 + second({ts})")


def moments(df: DataFrame, key: str, ts: str, row: str) -> DataFrame:
    """Distinct (incident, moment) rows with the first and last record of each; nulls are dropped."""
    return (
        df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(key), F.col(ts).alias("ts"))
        .agg(F.min(row).alias("first_row"), F.max(row).alias("last_row"))
        .withColumns({"hour": hour_number("ts"), "second": second_number("ts")})
    )


def consecutive(
    df: DataFrame, key: str = "incident_id", ts: str = "perimeter_date", row: str = "row_id"
) -> DataFrame:
    """One row per pair of consecutive distinct moments of an incident:
    ``key, curr_ts, curr_row, next_ts, next_row``.

    In the order (moment, record) the last record of a moment precedes the first of the next one;
    all other neighbours share their moment and are never a pair.
    """
    spans = moments(df, key, ts, row).selectExpr(
        f"`{key}`", "hour", "second", "ts AS first_ts", "first_row", "ts AS last_ts", "last_row")
    links = []
    for cell in (["hour", "second"], ["hour"], []):
        if cell:  # one shuffle serves both the order within a cell and the summary of each
            spans = spans.repartition(key, cell[-1])
        names = ", ".join([f"`{key}`", *cell])
        inside = f"OVER (PARTITION BY {names} ORDER BY first_ts)"
        links.append(spans.selectExpr(
            f"`{key}`", "last_ts AS curr_ts", "last_row AS curr_row",
            f"lead(first_ts) {inside} AS next_ts", f"lead(first_row) {inside} AS next_row"))
        spans = spans.groupBy(key, *cell).agg(
            F.expr("min_by(first_row, first_ts) AS first_row"), F.expr("min(first_ts) AS first_ts"),
            F.expr("max_by(last_row, last_ts) AS last_row"), F.expr("max(last_ts) AS last_ts"))
    return reduce(DataFrame.unionByName, links).filter(F.col("next_row").isNotNull())


def elapsed_pairs(df: DataFrame, max_gap_days: int = 6, **names: str) -> DataFrame:
    """Consecutive pairs at most ``max_gap_days`` elapsed days apart."""
    gap = within_elapsed_days(F.col("curr_ts"), F.col("next_ts"), max_gap_days)
    return consecutive(df, **names).filter(gap)


def calendar_pairs(df: DataFrame, max_gap_days: int = 6, **names: str) -> DataFrame:
    """Consecutive pairs at most ``max_gap_days`` calendar days apart."""
    gap = within_calendar_days(F.col("curr_ts"), F.col("next_ts"), max_gap_days)
    return consecutive(df, **names).filter(gap)


def pair_counts(
    df: DataFrame, max_gap_days: int = 6, key: str = "incident_id", ts: str = "perimeter_date"
) -> DataFrame:
    """Per incident, without building any pair: ``perimeters, undated, moments, same_timestamp,
    calendar_pairs, elapsed_pairs``.

    Neighbours within one day always satisfy both gap rules, so only day-to-day gaps are looked at.
    """
    if max_gap_days < 0:
        raise ValueError("max_gap_days must not be negative")
    at = df.groupBy(F.col(key), F.col(ts).alias("ts")).agg(F.count("*").alias("n"))
    days = at.groupBy(key, F.to_date("ts").alias("day")).agg(
        F.expr("sum(n) AS n"), F.expr("count(ts) AS n_ts"), F.expr("min(ts) AS first_ts"), F.expr("max(ts) AS last_ts")
    )
    linked = days.selectExpr("*", f"lead(first_ts) OVER (PARTITION BY `{key}` ORDER BY day) AS next_ts")
    same_day = "sum(if(n_ts > 0, n_ts - 1, 0))"
    counts = {
        "perimeters": "sum(n)",
        "undated": "sum(if(day IS NULL, n, 0))",
        "moments": "sum(n_ts)",
        "same_timestamp": "sum(if(day IS NULL, 0, n - n_ts))",
        "calendar_pairs": f"{same_day} + count_if(datediff(next_ts, last_ts) <= {max_gap_days})",
        "elapsed_pairs": f"{same_day} + count_if(timestampdiff(DAY, last_ts, next_ts) <= {max_gap_days})",
    }
    return linked.groupBy(key).agg(*[F.expr(f"{sql} AS {name}") for name, sql in counts.items()])


def sequences(df: DataFrame, max_gap_days: int = 6, key: str = "incident_id", ts: str = "perimeter_date") -> DataFrame:
    """One row per incident with more than one perimeter (dated or not) and its number of pairs,
    which may be zero."""
    counts = pair_counts(df.filter(F.col(key).isNotNull()), max_gap_days, key, ts)
    return counts.filter(F.col("perimeters") > 1).select(
        key, "perimeters", F.col("elapsed_pairs").alias("pairs")
    )


def _with_sides(pairs: DataFrame, table: DataFrame, value: Column, name: str, row: str) -> DataFrame:
    """Add ``curr_<name>`` and ``next_<name>``. ``row_id`` is unique, so no join key is ever hot."""
    for side in ("curr", "next"):
        pairs = pairs.join(table.select(F.col(row).alias(f"{side}_row"), value.alias(f"{side}_{name}")), f"{side}_row")
    return pairs


def with_geometries(pairs: DataFrame, table: DataFrame, geom: str = "geom", row: str = "row_id") -> DataFrame:
    """Add ``curr_geom`` and ``next_geom`` to every pair."""
    return _with_sides(pairs, table, F.col(geom), "geom", row)


def with_bbox_overlap(pairs: DataFrame, table: DataFrame, geom: str = "geom", row: str = "row_id") -> DataFrame:
    """Add ``bbox_overlap``: false if the boxes are apart or one geometry is empty. Only boxes are
    joined; a table that stores them is not asked for its geometry."""
    box = F.col("bbox") if "bbox" in table.columns else bbox(F.col(geom))
    boxed = _with_sides(pairs, table, box, "bbox", row)
    meet = F.coalesce(bboxes_meet(F.col("curr_bbox"), F.col("next_bbox")), F.lit(False))
    return boxed.withColumn("bbox_overlap", meet).drop("curr_bbox", "next_bbox")


_PAIR = ["curr_row", "next_row"]


def _looked_at(pairs: DataFrame, table: DataFrame, geom: str, row: str) -> tuple[DataFrame, DataFrame]:
    """The pairs with ``bbox_overlap``, and both geometries of those whose boxes meet with a number ``pair``, a
    short key; both stored. Geometry is fetched only for the latter, and only their records' leaves the scan."""
    near = written(with_bbox_overlap(pairs, table, geom, row), "near-pairs")
    meeting = near.filter("bbox_overlap").select(*_PAIR)
    wanted = meeting.select(F.explode(F.array(*_PAIR)).alias(row)).distinct()
    shapes = table.select(row, geom).join(wanted, row, "left_semi")
    if isinstance(shapes.schema[geom].dataType, T.BinaryType):
        shapes = shapes.withColumn(geom, from_wkb(geom))
    both = with_geometries(meeting, shapes, geom, row).withColumn("pair", F.monotonically_increasing_id())
    return near, written(both, "looked-at")


def with_overlap(pairs: DataFrame, table: DataFrame, geom: str = "geom", row: str = "row_id") -> DataFrame:
    """Add ``bbox_overlap`` and ``overlaps`` (closed intersection, which containment implies); false where the boxes are
    apart. Pairs of rows are unique."""
    near, shapes = _looked_at(pairs, table, geom, row)
    found = polygons.intersecting(shapes, ["pair"], "curr_geom", "next_geom")
    found = shapes.select("pair", *_PAIR).join(found, "pair", "left_semi").drop("pair").distinct()
    return polygons.with_flag(near, _PAIR, found, "overlaps", F.lit(True))


def _may_hold(outer: Column, inner: Column) -> Column:
    """The box of ``outer`` holds that of ``inner``, without which the geometry cannot; true for points at no place."""
    a, b = bbox(outer), bbox(inner)
    held = (a["xmin"] <= b["xmin"]) & (b["xmax"] <= a["xmax"]) & (a["ymin"] <= b["ymin"]) & (b["ymax"] <= a["ymax"])
    ends = [box[end] for box in (a, b) for end in ("xmin", "ymin", "xmax", "ymax")]
    lost = reduce(lambda x, y: x | y, [F.isnan(end) | (F.abs(end) == float("inf")) for end in ends])
    return held | lost


def with_containment(pairs: DataFrame, table: DataFrame, geom: str = "geom", row: str = "row_id") -> DataFrame:
    """Add ``bbox_overlap``, ``curr_contains`` and ``next_contains``; false where the boxes are apart. Pairs of rows are
    unique. Both ways round are asked in one go, each only where one box holds the other."""
    near, shapes = _looked_at(pairs, table, geom, row)
    names = ("curr_contains", "next_contains")
    ways = F.array(*[
        F.struct((F.col("pair") * 2 + way).alias("asked"), F.col(outer).alias("outer"), F.col(inner).alias("inner"))
        for way, outer, inner in ((0, "curr_geom", "next_geom"), (1, "next_geom", "curr_geom"))])
    asked = shapes.select(F.explode(ways).alias("w")).select("w.*").where(_may_hold(F.col("outer"), F.col("inner")))
    found = written(polygons.containing(asked, ["asked"], "outer", "inner"), "containing")
    for way, name in enumerate(names):
        of_way = found.where(F.col("asked") % 2 == way).select(F.expr("asked DIV 2").alias("pair"))
        held = shapes.select("pair", *_PAIR).join(of_way, "pair", "left_semi").drop("pair").distinct()
        near = polygons.with_flag(near, _PAIR, held, name, F.lit(True))
    return near


def overlap_counts(overlapping: DataFrame) -> DataFrame:
    """One row: pairs and how many of them overlap."""
    return overlapping.agg(
        F.count("*").alias("pairs"), F.count_if("overlaps").alias("overlapping")
    )
