"""Identifiers, dates, years, quality rules and duplicates on small literal tables."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from perimetry.config import ALIASES, PRIORITIES, Settings
from perimetry.functions.dates import with_parsed_date
from perimetry.functions.text import canonical_year, normalize_name, plain_name, to_number
from perimetry.operators import dedup, identity, quality, report, roster
from perimetry.operators.fields import AliasIndex, normalize, union_all
from perimetry.plans.storage import release, written
from perimetry.plans.unify import classified, unified
from perimetry.schema import NORMALIZED_DDL, OUTPUT_COLUMNS, TEXT_COLUMNS

SETTINGS = Settings(max_year=2027, validity="in_place")
HISTORY, GEOMAC = "Interagency Fire Perimeter History", "Historic GeoMAC (2000-2018)"


def box(x, y, half=1.0):
    ring = [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]
    return [[ring]]


def records(spark, rows):
    """Normalized records from dicts; defaults make a valid record."""
    default = dict.fromkeys(TEXT_COLUMNS) | {
        "incident_id_raw": "X", "incident_name": "n", "fire_year": "2003", "source_dataset": HISTORY, "geom": box(0, 0),
    }
    names = [*TEXT_COLUMNS, "source_dataset", "geom"]
    data = [tuple((default | r)[n] for n in names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, NORMALIZED_DDL)


def test_field_names_are_spelled_alike_in_both_places(spark):
    names = [" Unit ID ", "\tUNIT_ID\u2003", "Straße  Nr", "a b c", "", "\x1cÀ\x1f", "ΣΑΣ x"]
    found = spark.createDataFrame([(n,) for n in names], "n string").selectExpr(f"{normalize_name('n')} AS p").collect()
    assert [r.p for r in found] == [plain_name(n) for n in names]


def test_field_names():
    assert plain_name(" Unit ID ") == "unit_id"
    assert AliasIndex(ALIASES).resolve(["A", "IncidentNa", "incident"])["incident_name"] == "incident"
    assert AliasIndex(ALIASES).resolve(["Unit ID", "UNIT_ID"])["unit_id"] == "UNIT_ID"
    assert AliasIndex(ALIASES).resolve(["attr_Uniqu", "incident_name"])["incident_name"] is None
    assert AliasIndex(ALIASES).resolve(["attr_Uniqu"])["incident_id_raw"] is None


def test_normalize_is_by_column_and_nulls_numeric_zero_ids(spark):
    df = spark.createDataFrame(
        [(1, None, "x", 0, 2003.0, None), (2, None, "y", 7, None, None)],
        "rec long, unqe_fire_ string, uniquefir string, ForID long, FireYear double, shape array<array<array<struct<x:double,y:double>>>>",
    )
    rows = normalize(df, "S", geom="shape", row_id="rec").orderBy("row_id").collect()
    assert [r.incident_id_raw for r in rows] == [None, None]  # the better alias is all null
    assert [r.for_id for r in rows] == [None, "7"]
    assert rows[0].fire_year == "2003.0" and rows[0].source_dataset == "S"
    assert rows[0].state is None
    assert union_all(spark, []).count() == 0


def test_text_rules(spark):
    df = spark.createDataFrame([("2003.0",), ("2003",), (" 2003 ",), ("2003d",), ("NaN",), ("1e3",), (None,)], "s string")
    out = df.selectExpr(f"{canonical_year('s')} y", f"{to_number('s')} n", f"{normalize_name('s')} f").collect()
    assert [r.y for r in out] == ["2003", "2003", " 2003 ", "2003d", "NaN", "1e3", None]
    assert [r.n for r in out] == [2003.0, 2003.0, 2003.0, None, None, 1000.0, None]


IDS = [
    ({"incident_id_raw": "\t F-1 \n"}, "formal", "F-1"),
    ({"incident_id_raw": " None ", "irwin_id_raw": "{I}"}, "irwin", "{I}"),
    ({"incident_id_raw": "NULL", "local_incident_id": " 7 ", "unit_id": "U"}, "local", "2003-U- 7 "),
    ({"incident_id_raw": "", "local_incident_id": "7", "unit_id": None, "for_id": "f"}, "for_id", "f"),
    ({"incident_id_raw": "", "local_incident_id": "7", "unit_id": "0", "geo_id": "g"}, "geo_id", "g"),
    ({"incident_id_raw": "nan", "local_incident_id": "7", "unit_id": "U", "fire_year": "", "global_id": "G"}, "global_id", "G"),
    ({"incident_id_raw": "0"}, "formal", "0"),
    ({"incident_id_raw": " "}, "formal", " "),
    ({"incident_id_raw": None}, "none", None),
    ({"incident_id_raw": None, "local_incident_id": "7", "unit_id": "U", "fire_year": None, "perimeter_date_raw": "20050102"}, "local", "2005-U-7"),
]


def test_identifier_tiers(spark):
    out = identity.identify(records(spark, [i[0] for i in IDS])).orderBy("row_id").collect()
    for row, (_, tier, value) in zip(out, IDS):
        if value == " ":
            continue  # see test_unicode_blank
        assert (row.id_type, row.incident_id) == (tier, value)


DATES = {
    "20020201000000": "2002-02-01 00:00:00", "20020201": "2002-02-01 00:00:00", "20020201T101112": "2002-02-01 10:11:12",
    "2002-02-01 10:11:12": "2002-02-01 10:11:12", "2002-02-01T10:11:12": "2002-02-01 10:11:12",
    "2002-2-1": "2002-02-01 00:00:00", "2002/02/01": "2002-02-01 00:00:00", "2002-02-01 10:11": "2002-02-01 10:11:00",
    "2002-02-01 10": "2002-02-01 10:00:00", "2002-02-01T10:11:12.5": "2002-02-01 10:11:12.500000",
    "2002-02-01T10:11:12.123456789": "2002-02-01 10:11:12.123456", "2002-02-01T10:11:12Z": "2002-02-01 10:11:12",
    "2002-02-01T10:11:12+05:00": "2002-02-01 05:11:12", "2002-02-01T10:11:12 -0530": "2002-02-01 15:41:12",
    "2002-02-01 10:11:12+05": "2002-02-01 05:11:12", "2/1/2002": "2002-02-01 00:00:00", "13/1/2002": "2002-01-13 00:00:00",
    "2/1/2002 3:04 PM": "2002-02-01 15:04:00", "2/1/2002 12:04:05 AM": "2002-02-01 00:04:05",
    "2/1/2002 15:04:05": "2002-02-01 15:04:05", "02-01-2002": "2002-02-01 00:00:00",
    "Fri, 01 Feb 2002 10:11:12 GMT": "2002-02-01 10:11:12", "Fri, 01 Feb 2002 10:11:12 +0500": "2002-02-01 05:11:12",
    "Feb 1 2002": "2002-02-01 00:00:00", "February 1, 2002": "2002-02-01 00:00:00", "01-Feb-2002": "2002-02-01 00:00:00",
    "2002": "2002-01-01 00:00:00", "2002-02": "2002-02-01 00:00:00", " 20020201 ": "2002-02-01 00:00:00",
    "2021-03-14 02:30:00": "2021-03-14 02:30:00", "1677-09-21 00:12:44": "1677-09-21 00:12:44",
    "2262-04-11 23:47:16": "2262-04-11 23:47:16", "9999-12-31": None, "1676-01-01": None, "1677-09-21 00:12:43": None,
    "20020201.0": None, "1012521600000": None, "2002-02-30": None, "": None, "  ": None, "garbage": None, "now": None,
    "today": None, "12:30": None, "200202": None, "2002-02-01Z": None, "2002-02-01T24:00:00": None,
    "2002-02-01 10:11:60": None, "2/1/2002 13:04 PM": None, "32/1/2002": None, "None": None,
}


def test_date_shapes(spark):
    df = spark.createDataFrame([(k,) for k in DATES] + [(None,)], "raw string")
    out = {r.raw: r.d for r in with_parsed_date(df, "raw", "d").collect()}
    assert out.pop(None) is None
    assert {k: None if v is None else str(v) for k, v in out.items()} == DATES


def test_dates_with_ansi_off(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "raw string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        out = {r.raw: None if r.d is None else str(r.d) for r in with_parsed_date(df, "raw", "d").collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert out == DATES


BOWTIE = [[[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]]
QUALITY = [
    ({}, None),
    ({"incident_id_raw": None, "geom": None}, "no_id"),
    ({"perimeter_date_raw": "18991231"}, "invalid_date"),
    ({"perimeter_date_raw": "19000101"}, None),
    ({"perimeter_date_raw": "20271231"}, None),
    ({"perimeter_date_raw": "20280101"}, "invalid_date"),
    ({"perimeter_date_raw": "99990101"}, None),  # not a date, so not out of range
    ({"perimeter_date_raw": "20280101", "incident_name": None}, "invalid_date"),
    ({"incident_name": None}, "missing_incident_name"),
    ({"incident_name": ""}, "missing_incident_name"),
    ({"incident_name": "None", "fire_year": None}, "missing_incident_name"),
    ({"incident_name": " "}, None),
    ({"incident_name": "nan"}, None),
    ({"fire_year": None}, "missing_fire_year"),
    ({"fire_year": "abc"}, None),
    ({"fire_year": "1500"}, None),
    ({"geom": None}, "missing_geometry"),
    ({"geom": []}, None),
    ({"geom": BOWTIE}, "invalid_geometry"),
]


def test_reject_reasons(spark):
    out = classified(records(spark, [q[0] for q in QUALITY]), SETTINGS)
    assert [r.reject_reason for r in out.orderBy("row_id").collect()] == [q[1] for q in QUALITY]
    stats = quality.quality_stats(out).first().asDict()
    assert stats == {
        "total_input": 18, "missing_required_fields": 5, "invalid_dates": 3, "invalid_geometry": 1, "passed": 9,
    }
    assert sum(r.records for r in quality.reason_counts(out).collect()) == len(QUALITY)
    assert quality.without_id(out).count() == 1


def test_default_max_year_is_next_year(spark):
    year = datetime.now().year
    rows = [{"perimeter_date_raw": f"{year + 1}0101"}, {"perimeter_date_raw": f"{year + 2}0101"}]
    out = classified(records(spark, rows), Settings(validity="in_place")).orderBy("row_id").collect()
    assert [r.reject_reason for r in out] == [None, "invalid_date"]


def test_duplicates(spark):
    rows = [
        {"source_dataset": "Unlisted", "incident_id_raw": "A"},
        {"source_dataset": GEOMAC, "incident_id_raw": "A"},
        {"source_dataset": HISTORY, "incident_id_raw": "A", "perimeter_date_raw": "20010101"},  # kept, date is no key
        {"source_dataset": HISTORY, "incident_id_raw": "A", "geom": box(0, 0, 2.0)},  # same centroid
        {"source_dataset": HISTORY, "incident_id_raw": "A", "fire_year": "2004"},  # kept
        {"source_dataset": HISTORY, "incident_id_raw": "A", "fire_year": "2004.0"},
        {"source_dataset": HISTORY, "incident_id_raw": "A", "geom": box(0, 1)},  # kept
        {"source_dataset": HISTORY, "incident_id_raw": "A", "geom": []},  # kept
        {"source_dataset": HISTORY, "incident_id_raw": "A", "geom": []},
        {"source_dataset": HISTORY, "incident_id_raw": "B_2003"},  # kept
    ]
    c = classified(records(spark, rows), SETTINGS)
    kept = dedup.deduplicate(quality.passed(c), SETTINGS)
    assert sorted(r.row_id for r in kept.collect()) == [2, 4, 6, 7, 9]
    u = unified(c, SETTINGS)
    assert tuple(u.columns) == OUTPUT_COLUMNS
    assert dict(u.dtypes)["fire_year"] == "double" and dict(u.dtypes)["perimeter_date"] == "timestamp_ntz"


def test_duplicate_key_decimals(spark):
    rows = [{}, {"geom": box(1e-9, 0)}]
    for decimals, number in ((None, 2), (6, 1)):
        settings = Settings(validity="in_place", max_year=2027, key_decimals=decimals)
        assert unified(classified(records(spark, rows), settings), settings).count() == number


def test_priorities_are_not_the_read_order(spark):
    assert PRIORITIES[HISTORY] < PRIORITIES[GEOMAC]
    settings = Settings(validity="in_place", max_year=2027, priorities={}, default_priority=5)
    rows = [{"source_dataset": "b"}, {"source_dataset": "a"}]
    assert unified(classified(records(spark, rows), settings), settings).first().row_id == 0


def test_reports(spark):
    rows = [{"incident_id_raw": "A"}, {"incident_id_raw": "A", "geom": box(5, 5), "perimeter_date_raw": "20010203"}, {"incident_id_raw": None}]
    c = classified(records(spark, rows), SETTINGS)
    whole = report.processing_report(c, unified(c, SETTINGS), SETTINGS.sources).first().asDict(True)
    assert whole["datasets"] == {"interagency_history": {"raw_count": 3, "source": HISTORY}}
    overall = whole["overall"]
    assert overall["id_type_distribution"] == {"formal": 2, "none": 1}
    assert overall["date_range"] == {"min": "2001-02-03 00:00:00", "max": "2001-02-03 00:00:00"}
    assert overall["incident_stats"]["avg_perimeters_per_incident"] == 2.0
    assert overall["deduplication_stats"] == {"total_input": 2, "duplicates_removed": 0, "unique_output": 2}
    shares = {r.id_type: r.percent for r in report.id_type_distribution(c).collect()}
    assert shares == {"formal": 66.7, "none": 33.3}


def test_the_report_reads_each_table_once(spark):
    c = written(classified(records(spark, [{"incident_id_raw": "A"}, {"incident_id_raw": None}]), SETTINGS), "classified")
    kept = written(unified(c, SETTINGS).drop("geom"), "kept")
    whole = report.processing_report(c, kept, SETTINGS.sources)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert whole.first().overall.quality_filter_stats.total_input == 1
    release(spark)


def test_report_of_nothing(spark):
    c = classified(union_all(spark, []), SETTINGS)
    overall = report.processing_report(c, unified(c, SETTINGS), SETTINGS.sources).first().overall
    assert overall.total_records == 0 and overall.date_range.min is None and overall.year_range.max is None
    assert overall.incident_stats.avg_perimeters_per_incident is None


def test_roster(spark):
    df = spark.createDataFrame(
        [
            ("a", None, "2025-05-01T00:00:00Z", 1.0, 3), ("a", "First", None, 12.5, 4), ("a", "Second", "2025-01-01", None, 5),
            (None, "x", "2025-01-01", 9.0, 1), ("b", None, None, None, 2), ("c", "C", "2025-04-01", 1234.5, 6),
        ],
        "attr_Uniqu string, attr_Inc_1 string, attr_Fir_7 string, poly_Acres double, row_id long",
    )
    rows = roster.roster_lines(roster.roster(roster.roster_input(df))).collect()
    assert [(r.incident_id, r.fire_name, r.max_acres) for r in rows] == [("c", "C", 1234.5), ("a", "First", 12.5), ("b", None, None)]
    assert str(rows[1].fire_start) == "2025-05-01 00:00:00"
    assert rows[0].line == f"{'C':<40} {'2025-04-01':<12} {'c':<30} {'1,234':<12}"
    assert rows[2].line == f"{'Unknown':<40} {'Unknown':<12} {'b':<30} {'Unknown':<12}"
    assert roster.roster_input(df.drop("poly_Acres")).select("acres").distinct().collect()[0].acres is None


@pytest.mark.parametrize("partitions", [1, 7])
def test_result_does_not_depend_on_partitions(spark, partitions):
    rows = [{"incident_id_raw": f"i{k % 5}", "geom": box(k % 3, 0), "source_dataset": GEOMAC if k % 2 else HISTORY} for k in range(60)]
    u = unified(classified(records(spark, rows).repartition(partitions), SETTINGS), SETTINGS)
    assert sorted(r.row_id for r in u.collect()) == [0, 2, 4, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28]


def test_rows_in_another_system_fail_the_sink(spark, tmp_path):
    """The system of each row is asserted on the way out; nothing is published when one is wrong."""
    from perimetry.sinks.outputs import read_unified, write_unified

    rows = classified(records(spark, [{}, {}]), SETTINGS).drop("reject_reason")
    write_unified(rows.withColumn("srid", F.lit(4326)), str(tmp_path / "good"))
    assert {r.srid for r in read_unified(spark, str(tmp_path / "good")).collect()} == {4326}
    for wrong in ("3857", "CAST(NULL AS INT)"):
        with pytest.raises(Exception, match="EPSG:4326"):
            write_unified(rows.withColumn("srid", F.expr(wrong)), str(tmp_path / "bad"))
        assert not (tmp_path / "bad" / "_SUCCESS").exists()


def test_output_in_order_of_priority(spark, tmp_path):
    from perimetry.sinks.outputs import read_in_order, write_by_priority

    names = [*SETTINGS.priorities, "elsewhere"]
    rows = spark.range(5000).select(
        F.col("id").alias("row_id"), F.element_at(F.array(*map(F.lit, names)), (F.hash("id") % 6 + 6).cast("int") % 6 + 1).alias("source_dataset"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_by_priority(rows, str(tmp_path / "t"), SETTINGS)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = read_in_order(spark, str(tmp_path / "t")).orderBy("place").collect()
    assert [r.place for r in back] == list(range(5000))
    assert [(r.priority, r.row_id) for r in back] == sorted((r.priority, r.row_id) for r in back)
    assert len({f for f in __import__("os").listdir(tmp_path / "t") if f.startswith("part-")}) > 1


def test_both_ways_to_clean_agree(spark):
    from perimetry.queries.adapter import normalized

    rows = normalized(spark, "/root/testdata/sf0.001")
    reasons = [
        {(r.row_id, r.reject_reason) for r in classified(rows, replace(SETTINGS, validity=way)).select("row_id", "reject_reason").collect()}
        for way in ("joins", "in_place")]
    assert reasons[0] == reasons[1] and {reason for _, reason in reasons[0]} > {None, "invalid_geometry"}
