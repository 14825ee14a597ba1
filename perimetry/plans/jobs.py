"""The five jobs: unify, availability funnel, pairs with overlap, roster, timeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.config import Settings
from perimetry.operators import funnel as funnels
from perimetry.operators import pairs as pairing
from perimetry.operators import quality, report, roster, timeline
from perimetry.operators.funnel import funnel_text
from perimetry.plans.storage import discard, scratch_path
from perimetry.plans.unify import classified, unified
from perimetry.sinks.outputs import read_unified, write_rejects, write_report, write_unified
from perimetry.sinks.publish import current_run, new_run, publish, remove_run
from perimetry.sources.perimeters import readable, scan_all, scan_roster, stage_archives, unreadable


@dataclass(frozen=True)
class UnifyOutputs:
    """Outputs of one run. The two CSV folders exist only if there is something in them."""

    table: str
    report: str
    no_id: str
    unreadable: str


class EmptyResultError(RuntimeError):
    """No record is left for the unified table; only the report and the rejects were written, to ``outputs``,
    and the run was not published."""

    def __init__(self, message: str, outputs: UnifyOutputs) -> None:
        super().__init__(message)
        self.outputs = outputs


def unify(spark: SparkSession, raw_dir: str, out_dir: str, settings: Settings | None = None) -> UnifyOutputs:
    """Read all sources, write the unified table, the report and the rejects to a run's folder below ``out_dir``.

    The run is published when all its outputs are complete; ``published`` finds it. A failed one leaves the run
    before it in place. The sources are parsed once: classified records go to a table in the shared folder, and each
    output reads only its columns of that.
    """
    settings = settings or Settings()
    scratch, staged, run = scratch_path(spark, "classified"), None, new_run(out_dir)
    try:
        staged = stage_archives(spark, raw_dir, settings)
        classified(scan_all(spark, raw_dir, settings, staged=staged), settings).write.parquet(scratch)
        out = _outputs(spark, raw_dir, run, settings, spark.read.parquet(scratch))
        publish(spark, run)
        return out
    except EmptyResultError:
        raise
    except BaseException:
        remove_run(spark, run)
        raise
    finally:
        for path in filter(None, (scratch, staged)):
            discard(spark, path)


def published(spark: SparkSession, out_dir: str) -> UnifyOutputs | None:
    """The outputs of the last run of ``unify`` that was published below ``out_dir``."""
    run = current_run(spark, out_dir)
    return _paths(run) if run else None


def _paths(run: str) -> UnifyOutputs:
    return UnifyOutputs(
        table=f"{run}/perimeters.parquet",
        report=f"{run}/processing_report.json",
        no_id=f"{run}/no_id_records.csv",
        unreadable=f"{run}/unreadable_files.csv",
    )


def _outputs(spark: SparkSession, raw_dir: str, run: str, settings: Settings, scanned: DataFrame) -> UnifyOutputs:
    out = _paths(run)
    records = scanned
    if write_rejects(unreadable(scanned), out.unreadable):
        records = readable(scanned)
    records = records.drop("file", "error")
    write_rejects(quality.without_id(records), out.no_id)
    if quality.passed(records).isEmpty():
        nothing = unified(records, settings)
        write_report(report.processing_report(records, nothing, settings.sources), out.report)
        raise EmptyResultError(f"no record of {raw_dir} is left for the unified table", out)
    write_unified(unified(records, settings), out.table)
    kept = read_unified(spark, out.table)
    write_report(report.processing_report(records, kept, settings.sources), out.report)
    return out


def incidents(spark: SparkSession, table: str, ids: Sequence[str]) -> DataFrame:
    """The records of some incidents. Files are sorted by identifier and carry Bloom filters of it, so only the row
    groups that hold one of the identifiers are read; none if all are absent (up to ten identifiers, beyond
    which Spark asks the files only for their range)."""
    return read_unified(spark, table).filter(F.col("incident_id").isin(*sorted(set(ids))))


def availability(spark: SparkSession, table: str, settings: Settings | None = None) -> DataFrame:
    """Funnel counters of a unified table; ``funnel_text`` prints them."""
    settings = settings or Settings()
    return funnels.funnel(read_unified(spark, table), settings.max_gap_days)


def print_availability(spark: SparkSession, table: str, settings: Settings | None = None) -> None:
    print(funnel_text(availability(spark, table, settings).first().asDict()))


def training_pairs(spark: SparkSession, table: str, settings: Settings | None = None) -> DataFrame:
    """Consecutive pairs within the gap, with both geometries and whether they overlap."""
    settings = settings or Settings()
    rows = read_unified(spark, table)
    found = pairing.with_overlap(pairing.elapsed_pairs(rows, settings.max_gap_days), rows, "geometry")
    return pairing.with_geometries(found, rows, "geometry")


def roster_of(spark: SparkSession, raw_dir: str, pattern: str = "WFIGS_Interagency_Perimeters_YearToDate_*") -> DataFrame:
    """Roster of a year-to-date dataset, with the report line of each incident."""
    records = roster.roster_input(scan_roster(spark, raw_dir, pattern), roster.RESOLVED)
    return roster.roster_lines(roster.roster(records))


def incident_timeline(
    spark: SparkSession, table: str, incident_id: str, settings: Settings | None = None
) -> tuple[DataFrame, DataFrame]:
    """(perimeters in order with label positions, one-row summary) of one incident. The lookup is
    pushed down to the table; an incident without pairs gives empty frames."""
    settings = settings or Settings()
    rows = read_unified(spark, table).filter(F.col("incident_id") == incident_id)
    found = pairing.elapsed_pairs(rows, settings.max_gap_days)
    items = timeline.with_label_points(timeline.timeline(found), rows, "geometry")
    return items.orderBy("position"), timeline.timeline_title(timeline.timeline_summary(found), rows)

