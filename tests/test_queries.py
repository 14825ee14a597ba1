"""Registered queries against DuckDB, and the plans they run with."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as registered
import check
from pyspark.sql import functions as F

from perimetry.operators import funnel, pairs, timeline
from perimetry.plans.storage import release, shared_dir
from perimetry.plans.unify import classified, unified
from perimetry.queries import registry
from perimetry.queries.adapter import SETTINGS, normalized, table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert check.compare(spark, con, SMALL, name) == ""
    release(spark)
    folder = Path(shared_dir(spark).removeprefix("file:")) / "perimetry"
    assert not folder.exists() or not any(folder.iterdir())


def test_entry_and_keys(spark):
    assert registered.entry(spark).count() == 1
    assert set(registry.QUERIES) <= set(registered.queries())
    assert set(registry.QUERIES) <= set(registered.oracle_sql())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unify_has_one_keyed_shuffle(spark):
    text = plan(unified(classified(normalized(spark, SMALL), SETTINGS), SETTINGS))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"WindowGroupLimit", text)) == 2  # one on each side of the shuffle
    assert "BatchEvalPython" not in text and text.count("ArrowEvalPython") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_date_rewrite_appears_once(spark):
    optimized = classified(normalized(spark, SMALL), SETTINGS)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("janfebmar") == 1 * 2  # once per shape with a month name


def test_funnel_reads_two_columns_and_aggregates_before_each_shuffle(spark):
    text = plan(funnel.funnel(table(spark, SMALL, "orders"), **registry.ORDERS))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "partial_count" in text and "partial_sum" in text and "Python" not in text


def test_pairs_keep_geometry_out_of_the_windows(spark):
    rows = registry._unified_table(spark, SMALL)
    text = plan(pairs.consecutive(rows))
    assert "geom" not in text and "Python" not in text
    for spec in re.findall(r"Window \[.*?\], \[(.*?)\], \[", text):
        assert "hour" in spec or spec.count(",") == 0
    near = plan(pairs.with_bbox_overlap(pairs.consecutive(rows), rows))
    assert "bbox" in near and "geometry" not in near  # boxes alone are read
    text = plan(pairs.with_overlap(pairs.elapsed_pairs(rows), rows, "geometry"))
    assert "geom" not in text  # what the predicate found is stored: flags of pairs alone
    assert "Python" not in text and "NestedLoop" not in text
    assert "NestedLoop" not in plan(timeline.timeline(pairs.elapsed_pairs(rows)))


def test_link_levels_share_their_shuffles(spark):
    """One by moment, one by second, one by hour, one by incident."""
    found = pairs.consecutive(table(spark, SMALL, "orders"), "o_custkey", "o_orderdate", "o_orderkey")
    df = found.agg(F.sum(F.hash("*")))
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("- Exchange hashpartitioning(o_custkey") == 4


def test_lookup_is_pushed_down(spark):
    rows = registry._unified_table(spark, SMALL)
    text = plan(pairs.elapsed_pairs(rows.filter("incident_id = 'F-7'")))
    assert "EqualTo(incident_id,F-7)" in text


def test_generated_code_is_small_enough_to_compile(spark):
    """Methods above 8000 bytes of bytecode are never compiled by the JVM."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the code is made at run time
    try:
        df = classified(normalized(spark, SMALL), SETTINGS)
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000
