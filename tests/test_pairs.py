"""Pairs, funnel, sequences and timelines against plain Python over the same rows."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from perimetry.operators import funnel, pairs, timeline

START = datetime(2020, 1, 1)


def table(spark, rows):
    return spark.createDataFrame(
        [(k, t, i) for i, (k, t) in enumerate(rows)], "incident_id string, perimeter_date timestamp_ntz, row_id long"
    )


def random_rows(seed, incidents=12, rows=400, hot=True):
    """Ties, nulls, null keys, dense and sparse incidents; one holds a third of all rows."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        key = "hot" if hot and i % 3 == 0 else rng.choice([None, *[f"i{k}" for k in range(incidents)]])
        step = rng.choice([0.0, 0.25, 1, 6, 6.96, 7, 7.5, 30])
        t = START + timedelta(days=rng.randrange(40) * step)
        out.append((key, None if rng.random() < (0.0 if key == "hot" else 0.06) else t))
    return out


def by_incident(rows):
    groups = {}
    for i, (key, t) in enumerate(rows):
        if key is not None:
            groups.setdefault(key, []).append((t, i))
    return groups


def expected_links(rows):
    for key, group in by_incident(rows).items():
        dated = sorted(g for g in group if g[0] is not None)
        for (t1, r1), (t2, r2) in zip(dated, dated[1:]):
            if t1 != t2:
                yield key, t1, r1, t2, r2


def elapsed(t1, t2):
    return (t2 - t1).days <= 6


def calendar(t1, t2):
    return (t2.date() - t1.date()).days <= 6


def links(df):
    return sorted((r.incident_id, r.curr_ts, r.curr_row, r.next_ts, r.next_row) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs(spark, seed):
    rows = random_rows(seed)
    df = table(spark, rows)
    expected = sorted(expected_links(rows))
    assert links(pairs.consecutive(df)) == expected
    assert links(pairs.elapsed_pairs(df)) == [e for e in expected if elapsed(e[1], e[3])]
    assert links(pairs.calendar_pairs(df)) == [e for e in expected if calendar(e[1], e[3])]


def test_a_million_moments_of_one_incident(spark):
    """Sub-second moments spread over tasks by the second; none is lost where seconds, hours and days meet."""
    steps = "timestamp_ntz'2020-02-29 23:58:00' + make_dt_interval(0, 0, 0, cast(id as decimal(18, 6)) * 0.000207)"
    df = spark.range(1_000_000).selectExpr("'a' AS incident_id", f"{steps} AS perimeter_date", "id AS row_id")
    found = pairs.consecutive(df)
    spans = found.agg(F.count("*"), F.count_if(F.expr("next_row = curr_row + 1")), F.countDistinct("curr_row"), F.max("next_row"))
    assert tuple(spans.first()) == (999_999, 999_999, 999_999, 999_999)
    placed = timeline.with_positions(timeline.timeline_items(found))
    assert placed.filter("position != row OR perimeters != 1000000").count() == 0 and placed.count() == 1_000_000
    for spec in re.findall(r"Window \[.*?\], \[(.*?)\], \[", found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))):
        assert "second" in spec or "hour" in spec or spec.count(",") == 0


def test_moments_before_1970(spark):
    times = [datetime(1969, 12, 31, 23, 59, 59, 5), datetime(1969, 12, 31, 23, 59, 59, 6), datetime(1970, 1, 1), datetime(1901, 5, 6, 7, 8, 9)]
    found = pairs.consecutive(table(spark, [("a", t) for t in times]))
    assert sorted((r.curr_ts, r.next_ts) for r in found.collect()) == list(zip(sorted(times), sorted(times)[1:]))


def test_gap_rules_differ(spark):
    noon = datetime(2020, 1, 1, 12)
    for later, by_elapsed, by_calendar in (
        (noon, 0, 0), (noon + timedelta(days=6, hours=11), 1, 1), (noon + timedelta(days=6, hours=12), 1, 0),
        (noon + timedelta(days=7), 0, 0), (noon + timedelta(days=6, hours=23, minutes=59), 1, 0),
    ):
        df = table(spark, [("a", noon), ("a", later)])
        counts = pairs.pair_counts(df).first()
        assert (pairs.elapsed_pairs(df).count(), counts.elapsed_pairs) == (by_elapsed, by_elapsed)
        assert (pairs.calendar_pairs(df).count(), counts.calendar_pairs) == (by_calendar, by_calendar)


def expected_funnel(rows):
    groups = {k: [g[0] for g in v] for k, v in by_incident(rows).items()}
    multi = {k: v for k, v in groups.items() if len(v) > 1}
    dated = {k: sorted(v) for k, v in multi.items() if None not in v}
    steps = {k: list(zip(v, v[1:])) for k, v in dated.items()}
    distinct = {k: [p for p in v if p[0] != p[1]] for k, v in steps.items()}
    near = {k: [p for p in v if calendar(*p)] for k, v in distinct.items()}
    total = lambda d: sum(map(len, d.values()))
    some = lambda d: sum(1 for v in d.values() if v)
    return {
        "perimeters": len(rows), "incidents": len(groups), "single_incidents": len(groups) - len(multi),
        "multi_incidents": len(multi), "multi_pairs": total(multi) - len(multi),
        "dated_incidents": len(dated), "dated_pairs": total(steps),
        "same_timestamp_pairs": total(steps) - total(distinct), "distinct_incidents": some(distinct),
        "distinct_pairs": total(distinct), "long_gap_pairs": total(distinct) - total(near),
        "usable_incidents": some(near), "usable_pairs": total(near),
        "usable_percent": round(100 * some(near) / len(groups), 1),
    }


@pytest.mark.parametrize("seed,incidents", [(3, 12), (4, 150)])
def test_funnel(spark, seed, incidents):
    rows = random_rows(seed, incidents)
    row = funnel.funnel(table(spark, rows))
    counters = row.first().asDict()
    assert counters == expected_funnel(rows)
    # what the published report's own numbers satisfy
    assert counters["multi_incidents"] == counters["incidents"] - counters["single_incidents"]
    assert counters["distinct_pairs"] == counters["dated_pairs"] - counters["same_timestamp_pairs"]
    assert counters["usable_pairs"] == counters["distinct_pairs"] - counters["long_gap_pairs"]
    steps = funnel.funnel_steps(row).orderBy("step").collect()
    assert [s.incidents_after for s in steps] == [
        counters[c] for c in ("incidents", "multi_incidents", "dated_incidents", "distinct_incidents", "usable_incidents")
    ]
    text = funnel.funnel_text(counters)
    assert f"  Training pairs: {counters['usable_pairs']:,}\n" in text


def test_funnel_of_nothing(spark):
    counters = funnel.funnel(table(spark, [])).first().asDict()
    assert counters.pop("usable_percent") is None and set(counters.values()) == {0}
    assert "(n/a)" in funnel.funnel_text(counters | {"usable_percent": None})


def test_funnel_text_layout():
    counters = dict(
        perimeters=159225, incidents=134403, single_incidents=125384, multi_incidents=9019, multi_pairs=24822,
        dated_incidents=3758, dated_pairs=14472, same_timestamp_pairs=8139, distinct_incidents=2649,
        distinct_pairs=6333, long_gap_pairs=3596, usable_incidents=512, usable_pairs=2737, usable_percent=0.4,
    )
    lines = funnel.funnel_text(counters).splitlines()
    assert lines[0] == lines[-1] == "=" * 70
    assert "  Removed (missing dates): 5,261 incidents" in lines
    assert "  Before: 3,758 incidents, 14,472 pairs" in lines
    assert "  Ended with: 512 incidents (0.4%)" in lines


def test_sequences_count_undated_rows(spark):
    rows = [("a", None), ("a", START), ("b", START), ("c", START), ("c", START + timedelta(days=1)), (None, START), (None, START)]
    out = {r.incident_id: (r.perimeters, r.pairs) for r in pairs.sequences(table(spark, rows)).collect()}
    assert out == {"a": (2, 0), "c": (2, 1)}


def expected_timeline(rows):
    out = {}
    for key, t1, r1, t2, r2 in expected_links(rows):
        if elapsed(t1, t2):
            out.setdefault(key, []).append(((t1, r1), (t2, r2)))
    for key, found in out.items():
        items = [p[0] for p in found] + [found[-1][1]]
        n = len(items)
        every = max(1, n // 15)
        for i, (t, r) in enumerate(items):
            yield key, t, r, i, n, i / max(n - 1, 1), i % every == 0 or i == n - 1, t.strftime("%m/%d")


@pytest.mark.parametrize("seed", [5, 6])
def test_timeline(spark, seed):
    rows = random_rows(seed, incidents=8, rows=300)
    df = table(spark, rows)
    found = pairs.elapsed_pairs(df)
    out = sorted(
        (r.incident_id, r.ts, r.row, r.position, r.perimeters, r.progress, r.is_label, r.label)
        for r in timeline.timeline(found).collect()
    )
    expected = sorted(expected_timeline(rows))
    assert out == expected
    assert any(not e[6] for e in expected)  # some incident is long enough to skip labels
    summary = {r.incident_id: r for r in timeline.timeline_summary(found).collect()}
    for key in {e[0] for e in expected}:
        mine = [e for e in expected if e[0] == key]
        assert (summary[key].first_date, summary[key].last_date) == (mine[0][1].date(), mine[-1][1].date())
        assert summary[key].perimeters == len(mine) == summary[key].training_pairs + 1


def test_timeline_loses_the_end_of_a_broken_run(spark):
    days = [0, 1, 2, 40, 41]
    df = table(spark, [("a", START + timedelta(days=d)) for d in days])
    items = timeline.timeline(pairs.elapsed_pairs(df)).orderBy("position").collect()
    assert [(r.ts - START).days for r in items] == [0, 1, 40, 41]


@pytest.mark.parametrize("partitions", [1, 16])
def test_shuffled_input_changes_nothing(spark, partitions):
    rows = random_rows(7)
    df = table(spark, rows)
    mixed = df.orderBy("perimeter_date").repartition(partitions)
    assert links(pairs.consecutive(mixed)) == sorted(expected_links(rows))


def test_overlap_of_pairs(spark):
    def square(x, y, h):
        x, y = float(x), float(y)
        return [[[(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]]]

    geoms = [square(0, 0, 1), square(2, 0, 1), square(4.5, 0, 1), square(4.5, 0, 0.5), [], square(0, 0, 1)]
    df = spark.createDataFrame(
        [("a", START + timedelta(days=i), i, g) for i, g in enumerate(geoms)],
        "incident_id string, perimeter_date timestamp_ntz, row_id long, geom array<array<array<struct<x:double,y:double>>>>",
    )
    found = pairs.elapsed_pairs(df)
    out = pairs.with_overlap(found, df).orderBy("curr_row").collect()
    assert [r.overlaps for r in out] == [True, False, True, False, False]
    inside = pairs.with_containment(found, df).orderBy("curr_row").collect()
    assert [(r.curr_contains, r.next_contains) for r in inside] == [(False, False)] * 2 + [(True, False)] + [(False, False)] * 2
    assert pairs.overlap_counts(pairs.with_overlap(found, df)).first().asDict() == {"pairs": 5, "overlapping": 2}


def test_containment_is_asked_only_where_a_box_holds_the_other(spark, monkeypatch):
    def square(x, half):
        return [[[(x - half, -half), (x + half, -half), (x + half, half), (x - half, half), (x - half, -half)]]]

    shapes = [square(0.0, 1.0), square(0.0, 0.5), square(0.75, 0.5), square(1.0, 2.0), square(1.0, 2.0)]
    rows = [("a", START + timedelta(days=i), i, g) for i, g in enumerate(shapes)]
    df = spark.createDataFrame(
        rows, "incident_id string, perimeter_date timestamp_ntz, row_id long, geom array<array<array<struct<x:double,y:double>>>>")
    asked = []
    containing = pairs.polygons.containing
    monkeypatch.setattr(pairs.polygons, "containing", lambda ways, *names: asked.append(ways.count()) or containing(ways, *names))
    found = pairs.with_containment(pairs.consecutive(df), df).orderBy("curr_row").collect()
    assert [(r.curr_contains, r.next_contains) for r in found] == [(True, False), (False, False), (False, True), (True, True)]
    assert asked == [4]
