"""The distinct perimeters of an incident in order, with label positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perimetry.functions.shapes import centroid
from perimetry.operators.pairs import hour_number, second_number

# Fixed value: about this many perimeters of a timeline carry a label.
LABELS = 15


def timeline_items(pairs: DataFrame, key: str = "incident_id") -> DataFrame:
    """The first perimeter of every pair and the second of the last pair: ``key, ts, row``.

    The end of an earlier run, before a gap too long for a pair, is not part of the timeline.
    """
    firsts = pairs.select(key, F.col("curr_ts").alias("ts"), F.col("curr_row").alias("row"))
    last = pairs.groupBy(key).agg(
        F.max_by("next_ts", "curr_ts").alias("ts"), F.max_by("next_row", "curr_ts").alias("row")
    )
    return firsts.unionByName(last)


def with_positions(items: DataFrame, key: str = "incident_id") -> DataFrame:
    """Add ``position`` from 0 and ``perimeters`` in order of ``ts``.

    Items are numbered within a second; the seconds of an hour and the hours of an incident carry running offsets.
    """
    dated = items.withColumns({"hour": hour_number("ts"), "second": second_number("ts")}).repartition(key, "second")
    seconds = dated.groupBy(key, "hour", "second").agg(F.count("*").alias("n")).repartition(key, "hour")
    hours = seconds.groupBy(key, "hour").agg(F.sum("n").alias("n"))
    by_second, by_hour = Window.partitionBy(key, "hour").orderBy("second"), Window.partitionBy(key).orderBy("hour")
    hours = hours.select(
        key, "hour",
        (F.sum("n").over(by_hour) - F.col("n")).alias("before_hour"),
        F.sum("n").over(Window.partitionBy(key)).alias("perimeters"),
    )
    offsets = seconds.withColumn("before", F.sum("n").over(by_second) - F.col("n")).join(hours, [key, "hour"]).select(
        key, "second", (F.col("before_hour") + F.col("before")).alias("offset"), "perimeters"
    )
    in_second = Window.partitionBy(key, "second").orderBy("ts", "row")
    numbered = dated.withColumn("_no", F.row_number().over(in_second) - 1)
    return (
        numbered.join(offsets, [key, "second"])
        .withColumn("position", F.col("offset") + F.col("_no"))
        .drop("_no", "offset", "hour", "second")
    )


def with_labels(positioned: DataFrame) -> DataFrame:
    """Add ``progress`` in 0..1, ``is_label`` (every n-th perimeter and the last) and its text."""
    position, n = F.col("position"), F.col("perimeters")
    every = F.greatest(F.lit(1), F.floor(n / LABELS))
    return positioned.withColumns(
        {
            "progress": position / F.greatest(n - 1, F.lit(1)),
            "is_label": (position % every == 0) | (position == n - 1),
            "label": F.format_string("%02d/%02d", F.month("ts"), F.dayofmonth("ts")),
        }
    )


def with_label_points(items: DataFrame, table: DataFrame, geom: str = "geom") -> DataFrame:
    """Add ``label_point``, the centroid of a labelled perimeter; geometries of others stay out."""
    geoms = table.select(F.col("row_id").alias("row"), F.col(geom).alias("_geom"))
    labelled = items.filter("is_label").select("row").join(geoms, "row")
    points = labelled.select("row", centroid("_geom").alias("label_point"))
    return items.join(points, "row", "left")


def timeline(pairs: DataFrame, key: str = "incident_id") -> DataFrame:
    return with_labels(with_positions(timeline_items(pairs, key), key))


def timeline_summary(pairs: DataFrame, key: str = "incident_id") -> DataFrame:
    """Per incident: first and last date, training pairs, distinct perimeters. Consecutive pairs
    start at different moments, so there is one perimeter per pair and the last one's second."""
    return pairs.groupBy(key).agg(
        F.to_date(F.min("curr_ts")).alias("first_date"),
        F.to_date(F.max("next_ts")).alias("last_date"),
        F.count("*").alias("training_pairs"),
        (F.count("*") + 1).alias("perimeters"),
        F.min_by("curr_row", "curr_ts").alias("first_row"),
    )


def timeline_title(summary: DataFrame, table: DataFrame, key: str = "incident_id") -> DataFrame:
    """Add ``incident_name`` (of the first perimeter) and the three-line ``title``."""
    names = table.select(F.col("row_id").alias("first_row"), "incident_name")
    # fixed value: the wording of the title
    title = F.format_string(
        "%s (%s)\nPerimeter Growth: %s to %s\n%d training pairs, %d unique perimeters",
        F.col("incident_name"), F.col(key), F.col("first_date").cast("string"),
        F.col("last_date").cast("string"), F.col("training_pairs"), F.col("perimeters"),
    )
    return summary.join(names, "first_row").withColumn("title", title).drop("first_row")
