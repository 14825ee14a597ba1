"""How many incidents and pairs survive each filter on the way to usable training pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perimetry.operators.pairs import pair_counts


def funnel(
    df: DataFrame, max_gap_days: int = 6, key: str = "incident_id", ts: str = "perimeter_date"
) -> DataFrame:
    """One row of counters. Incidents with any undated perimeter drop out as a whole."""
    counts = pair_counts(df.select(key, ts), max_gap_days, key, ts)
    known = f"`{key}` IS NOT NULL"
    multi = f"{known} AND perimeters > 1"
    dated = f"{multi} AND undated = 0"
    distinct = f"{dated} AND moments > 1"
    usable = f"{distinct} AND calendar_pairs > 0"

    def total(condition: str, value: str) -> str:
        return f"coalesce(sum(if({condition}, {value}, 0)), 0)"

    counters = {
        "perimeters": "coalesce(sum(perimeters), 0)",
        "incidents": f"count_if({known})",
        "single_incidents": f"count_if({known} AND perimeters = 1)",
        "multi_incidents": f"count_if({multi})",
        "multi_pairs": total(multi, "perimeters - 1"),
        "dated_incidents": f"count_if({dated})",
        "dated_pairs": total(dated, "perimeters - 1"),
        "same_timestamp_pairs": total(dated, "same_timestamp"),
        "distinct_incidents": f"count_if({distinct})",
        "distinct_pairs": total(distinct, "moments - 1"),
        "long_gap_pairs": total(distinct, "moments - 1 - calendar_pairs"),
        "usable_incidents": f"count_if({usable})",
        "usable_pairs": total(usable, "calendar_pairs"),
        "usable_percent": f"round(100 * try_divide(count_if({usable}), count_if({known})), 1)",
    }
    return counts.selectExpr(*[f"{sql} AS {name}" for name, sql in counters.items()])


def funnel_steps(row: DataFrame) -> DataFrame:
    """The counters of ``funnel`` as one row per step."""
    none = F.lit(None).cast("bigint")

    def step(number, before, removed, after, pairs_before, pairs_removed, pairs_after):
        values = (before, removed, after, pairs_before, pairs_removed, pairs_after)
        names = (
            "incidents_before", "incidents_removed", "incidents_after",
            "pairs_before", "pairs_removed", "pairs_after",
        )
        cells = [(none if v is None else F.expr(v)).cast("bigint").alias(k) for k, v in zip(names, values)]
        return F.struct(F.lit(number).alias("step"), *cells)

    steps = F.array(
        step(0, None, None, "incidents", None, None, None),
        step(1, "incidents", "single_incidents", "multi_incidents", None, None, "multi_pairs"),
        step(
            2, "multi_incidents", "multi_incidents - dated_incidents", "dated_incidents",
            "multi_pairs", "multi_pairs - dated_pairs", "dated_pairs",
        ),
        step(
            3, "dated_incidents", "dated_incidents - distinct_incidents", "distinct_incidents",
            "dated_pairs", "same_timestamp_pairs", "distinct_pairs",
        ),
        step(
            4, "distinct_incidents", "distinct_incidents - usable_incidents", "usable_incidents",
            "distinct_pairs", "long_gap_pairs", "usable_pairs",
        ),
    )
    return row.select(F.inline(steps))


# Fixed text of the printed report.
_TEXT = """\
{rule}
ML TRAINING PAIRS - STEP-BY-STEP FILTERING
{rule}

{step0:<50}
  Total perimeters: {perimeters:,}
  Total incidents: {incidents:,}

{step1:<50}
  Before: {incidents:,} incidents
  Removed (single perimeter): {single_incidents:,} incidents
  After: {multi_incidents:,} incidents
  Total pairs: {multi_pairs:,}

{step2:<50}
  Before: {multi_incidents:,} incidents
  Removed (missing dates): {undated_incidents:,} incidents
  After: {dated_incidents:,} incidents
  Total pairs: {dated_pairs:,}

{step3:<50}
  Before: {dated_incidents:,} incidents, {dated_pairs:,} pairs
  Removed pairs (same timestamp): {same_timestamp_pairs:,}
  After: {distinct_incidents:,} incidents, {distinct_pairs:,} pairs

{step4:<50}
  Before: {distinct_incidents:,} incidents, {distinct_pairs:,} pairs
  Removed pairs (gap > 6 days): {long_gap_pairs:,}
  After: {usable_incidents:,} incidents, {usable_pairs:,} pairs

{rule}
FINAL SUMMARY
{rule}

Usable for ML training:
  Incidents: {usable_incidents:,}
  Training pairs: {usable_pairs:,}

Reduction from original dataset:
  Started with: {incidents:,} incidents
  Ended with: {usable_incidents:,} incidents ({share})

{rule}"""
_STEPS = (
    "STEP 0: Starting dataset",
    "STEP 1: Filter to multi-perimeter incidents",
    "STEP 2: Filter to incidents with all dates",
    "STEP 3: Remove pairs with same timestamp",
    "STEP 4: Remove pairs with gap > 6 days",
)


def funnel_text(counters: dict) -> str:
    """The printed report of one row of ``funnel``."""
    share = "n/a" if counters["usable_percent"] is None else f"{counters['usable_percent']:.1f}%"
    return _TEXT.format(
        rule="=" * 70,
        undated_incidents=counters["multi_incidents"] - counters["dated_incidents"],
        share=share,
        **{f"step{i}": text for i, text in enumerate(_STEPS)},
        **counters,
    )
