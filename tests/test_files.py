"""Shapefile source, sinks and the five jobs on files written by the tests."""

import io
import itertools
import json
import os
import struct
import zipfile
from datetime import datetime
from glob import glob
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from perimetry.config import Settings, SourceSpec
from perimetry.plans import jobs
from perimetry.plans.storage import discard, release, shared_dir, written
from perimetry.queries.roundtrips import WGS84, shapefile_parts
from perimetry.schema import GEOM
from perimetry.sinks.outputs import read_rejects, read_unified, with_geom, write_rejects, write_unified
from perimetry.sinks.publish import prune
from perimetry.sources.perimeters import readable, scan, scan_all, stage_archives, unreadable
from perimetry.sources.files import packed
from perimetry.sources import shapefile
from perimetry.sources.shapefile import ShapefileReader, ShapefileSource, _contents, polygons_of, srid_of, UnsupportedFile

HISTORY = "InterAgencyFirePerimeterHistory_"
GEOMAC = "Historic_Geomac_"
YTD = "WFIGS_Interagency_Perimeters_YearToDate_"
SETTINGS = Settings(max_year=2027)
MERCATOR = 'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere",GEOGCS["GCS_WGS_1984"]]'
NAD83 = 'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983"]]'
UTM = 'PROJCS["WGS_1984_UTM_Zone_11N",GEOGCS["GCS_WGS_1984"]]'


def box(x, y, h=1.0, clockwise=True):
    ring = np.array([(x - h, y - h), (x - h, y + h), (x + h, y + h), (x + h, y - h), (x - h, y - h)], float)
    return ring if clockwise else ring[::-1]


def put(folder, attributes, shapes, name="Perimeters", **changes):
    folder.mkdir(parents=True, exist_ok=True)
    parts = shapefile_parts(attributes, shapes)
    parts.update({f".{k}": v for k, v in changes.items()})
    for suffix, content in parts.items():
        if content is not None:
            (folder / f"{name}{suffix}").write_bytes(content)
    return folder


def pack(folder, archive):
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(folder.iterdir()):
            out.write(path, path.name)


def simple(n=2, start=0):
    names = [f"f{start + i}" for i in range(n)]
    return {"uniquefire": names, "incident": [f"Fire {v}" for v in names], "FireYear": ["2003"] * n,
            "date_cur": [f"200301{i % 28 + 1:02d}" for i in range(n)]}, [[box(10.0 * (start + i), 0)] for i in range(n)]


def test_scan_matches_folders_files_and_archives(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw / f"{GEOMAC}a", *simple(3))
    put(raw / f"{GEOMAC}a", *simple(2, 10), name="Second")
    put(tmp_path / "z", *simple(2, 20))
    pack(tmp_path / "z", raw / f"{GEOMAC}b.zip")
    pack(tmp_path / "z", raw / f"{GEOMAC}a.zip")  # lies unpacked beside itself
    os.utime(raw / f"{GEOMAC}a.zip", (0, 0))
    put(raw / f"{GEOMAC}c" / "nested", *simple(1, 30))  # not a direct file of the folder
    (raw / f"{GEOMAC}plain").write_text("no folder")
    put(raw / "Other_a", *simple(1, 40))
    rows = scan(spark, str(raw), SETTINGS.sources[0], 0, SETTINGS).orderBy("row_id").collect()
    assert [r.incident_id_raw for r in rows] == ["f0", "f1", "f2", "f10", "f11", "f20", "f21"]
    assert [r.row_id for r in rows] == [0, 1, 2, 1 << 32, (1 << 32) + 1, 2 << 32, (2 << 32) + 1]
    assert rows[0].source_dataset == "Historic GeoMAC (2000-2018)" and rows[0].unit_id is None
    assert [tuple(p) for p in rows[1].geom[0][0]] == [tuple(p) for p in box(10.0, 0)]
    assert scan(spark, str(raw), SETTINGS.sources[1], 1, SETTINGS).count() == 0
    assert scan(spark, str(tmp_path / "absent"), SETTINGS.sources[0], 0, SETTINGS).count() == 0


def test_record_ranges_give_the_same_rows(spark, tmp_path):
    put(tmp_path / f"{GEOMAC}a", *simple(50))
    spark.dataSource.register(ShapefileSource)
    reader = spark.read.format("perimeter_shapefile").options(path=str(tmp_path), pattern=f"{GEOMAC}*", columns="uniquefire")
    whole, split = reader.load(), reader.option("split_bytes", "1000").load()
    assert split.rdd.getNumPartitions() > 4 > whole.rdd.getNumPartitions()
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_aliases_are_resolved_per_file(spark, tmp_path):
    shapes = [[box(0, 0)]]
    put(tmp_path / f"{GEOMAC}a", {"Unqe_Fire_": ["better"], "UniqueFir": ["worse"], "incident_n": ["n"]}, shapes)
    put(tmp_path / f"{GEOMAC}b", {"UniqueFir": ["only"], "attr_Uniqu": ["no alias"]}, shapes)
    rows = scan(spark, str(tmp_path), SETTINGS.sources[0], 0, SETTINGS).orderBy("row_id").collect()
    assert [(r.incident_id_raw, r.incident_name) for r in rows] == [("better", "n"), ("only", None)]
    more = Settings(aliases={"incident_id_raw": ("attr_uniqu",)})
    rows = scan(spark, str(tmp_path), more.sources[0], 0, more).orderBy("row_id").collect()
    assert [r.incident_id_raw for r in rows] == [None, "no alias"]


def typed_table(fields, rows):
    """A .dbf of (name, type, width, decimals) fields and rows of (mark, texts)."""
    head = b"".join(n.encode().ljust(11, b"\0") + k.encode() + bytes(4) + bytes([w, d]) + bytes(14) for n, k, w, d in fields)
    width = 1 + sum(f[2] for f in fields)
    top = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), 33 + len(head), width) + head + b"\r"
    return top + b"".join(m + b"".join(t.encode("latin-1").rjust(f[2]) for t, f in zip(ts, fields)) for m, ts in rows)


def test_attribute_types_and_deleted_records(spark, tmp_path):
    fields = [("uniquefire", "C", 8, 0), ("forid", "N", 9, 0), ("geoid", "N", 12, 3), ("year", "N", 4, 0), ("date_cur", "D", 8, 0), ("state", "L", 1, 0)]
    rows = [
        (b" ", ["é a", "0", "0.000", "0", "20030102", "T"]), (b"*", ["gone", "1", "1", "1", "20030102", "F"]),
        (b" ", ["", "12", "1.500", "2003", "", "?"]), (b" ", ["x", "****", "2.000", "", "00000000", "N"]),
    ]
    table = typed_table(fields, rows)
    shapes = [[box(0, 0)]] * 4
    put(tmp_path / f"{GEOMAC}a", {"x": ["1"] * 4}, shapes, dbf=table, cpg=None)
    out = scan(spark, str(tmp_path), SETTINGS.sources[0], 0, SETTINGS).orderBy("row_id").collect()
    assert [r.row_id for r in out] == [0, 2, 3]
    assert [r.for_id for r in out] == [None, "12", None]
    assert [r.geo_id for r in out] == [None, "1.5", "2.0"]
    assert [r.fire_year for r in out] == ["0", "2003", None]
    assert [r.perimeter_date_raw for r in out] == ["2003-01-02", None, None]
    assert [r.state for r in out] == ["True", None, "False"]
    assert [r.incident_id_raw for r in out] == ["é a", None, "x"]


def test_rings_become_polygons():
    outer, hole, far = box(0, 0, 5), box(0, 0, 1, clockwise=False), box(20, 0, 2)
    far_hole, orphan = box(20, 0, 1, clockwise=False), box(90, 0, 1, clockwise=False)

    def parts(*rings):
        content = shapefile_parts({"x": ["1"]}, [list(rings)])[".shp"][108:]
        return [[len(p), p[0][0].tolist()] for p in polygons_of(content)]

    assert parts(outer) == [[1, [-5.0, -5.0]]]
    assert parts(hole) == [[1, hole[0].tolist()]]
    assert parts(outer, hole) == [[2, [-5.0, -5.0]]]
    assert parts(far_hole, outer, far, hole, orphan) == [[2, [-5.0, -5.0]], [2, [18.0, -2.0]], [1, orphan[0].tolist()]]
    assert polygons_of(struct.pack("<i", 0)) is None
    with pytest.raises(UnsupportedFile):
        polygons_of(struct.pack("<i", 1))


def test_reference_system_texts():
    assert [srid_of(t, False) for t in (None, " ", WGS84, MERCATOR)] == [None, None, 4326, 3857]
    assert srid_of(NAD83, True) == 4326
    for text, option in ((NAD83, False), (UTM, True), ('GEOGCS["GCS_Other"]', False)):
        with pytest.raises(UnsupportedFile):
            srid_of(text, option)


def test_mercator_and_undeclared_files(spark, tmp_path):
    put(tmp_path / f"{GEOMAC}a", {"forid": ["m"]}, [[box(1113194.9079327357, 0)]], prj=MERCATOR.encode())
    put(tmp_path / f"{GEOMAC}b", {"forid": ["u"]}, [[box(10, 0)]], prj=None)
    rows = scan(spark, str(tmp_path), SETTINGS.sources[0], 0, SETTINGS).orderBy("row_id").collect()
    assert rows[0].geom[0][0][0].x == pytest.approx(10, abs=1e-4)
    assert rows[1].geom[0][0][0].x == 9.0


def test_bad_files_are_reported_and_the_rest_is_read(spark, tmp_path):
    good = shapefile_parts(*simple(3))
    cut = good[".shp"][:-20]
    (tmp_path / "raw").mkdir()
    put(tmp_path / "raw" / f"{GEOMAC}1_good", *simple(3))
    put(tmp_path / "raw" / f"{GEOMAC}2_cut", *simple(3, 10), shp=cut)
    put(tmp_path / "raw" / f"{GEOMAC}3_utm", *simple(3, 20), prj=UTM.encode())
    put(tmp_path / "raw" / f"{GEOMAC}4_short", *simple(3, 30), dbf=good[".dbf"][:-5])
    put(tmp_path / "raw" / f"{GEOMAC}5_noindex", *simple(3, 40), shx=None)
    (tmp_path / "raw" / f"{GEOMAC}6.zip").write_bytes(b"no archive")
    put(tmp_path / "z", *simple(3, 50), shp=cut)
    pack(tmp_path / "z", tmp_path / "raw" / f"{GEOMAC}7.zip")
    put(tmp_path / "half", *simple(2000, 60))
    pack(tmp_path / "half", tmp_path / "raw" / f"{GEOMAC}8.zip")
    body = bytearray((tmp_path / "half" / "Perimeters.shp").read_bytes())
    body[-136 + 8 : -136 + 12] = struct.pack("<i", 1)  # the last record is a point: fails after a batch
    (tmp_path / "half" / "Perimeters.shp").write_bytes(bytes(body))
    pack(tmp_path / "half", tmp_path / "raw" / f"{GEOMAC}8.zip")
    rows = scan(spark, str(tmp_path / "raw"), SETTINGS.sources[0], 0, SETTINGS)
    assert sorted(r.incident_id_raw for r in readable(rows).collect()) == ["f0", "f1", "f2"]
    reasons = {r.file.rsplit("/", 2 if r.file.endswith(".shp") else 1)[1][len(GEOMAC):]: r.error for r in unreadable(rows).collect()}
    assert sorted(k.split(".")[0] for k in reasons) == ["2_cut", "3_utm", "4_short", "5_noindex", "6", "7", "8"]
    assert "coordinate system" in reasons["3_utm"] and "cut off" in reasons["2_cut"]
    with pytest.raises(Exception, match="coordinate system|cut off|differ|No such file|zip"):
        scan(spark, str(tmp_path / "raw"), SETTINGS.sources[0], 0, SETTINGS, mode="FAILFAST").collect()


def incident(n=5):
    """One incident growing daily, seen by two sources, plus records that are rejected."""
    days = [f"2003010{i + 1}" for i in range(n)]
    shapes = [[box(-100, 40, 1.0 + i)] for i in range(n)]
    shapes = [[r[0] + [i / 8, 0]] for i, r in enumerate(shapes)]
    return {"uniquefire": ["F-1"] * n, "incident": ["Ridge's \"end\""] * n, "year": ["2003"] * n, "date_cur": days, "unit_id": ["U"] * n}, shapes


def test_unify_and_the_later_jobs(spark, tmp_path, capsys):
    raw, out = tmp_path / "raw", tmp_path / "out"
    put(raw / f"{GEOMAC}a", *incident())
    attributes, shapes = incident()
    attributes = attributes | {"uniquefire": ["F-1"] * 4 + [""], "date_cur": ["20030101"] * 4 + ["20990101"]}
    put(raw / f"{HISTORY}a", attributes, shapes)
    put(raw / f"{YTD}a", *simple(2), prj=UTM.encode())
    outputs = jobs.unify(spark, str(raw), str(out), SETTINGS)

    rows = with_geom(read_unified(spark, outputs.table)).orderBy("perimeter_date", "row_id").collect()
    # four of the older source lose to the better one, whose fifth has no identifier
    assert [r.source_dataset for r in rows] == ["Interagency Fire Perimeter History"] * 4 + ["Historic GeoMAC (2000-2018)"]
    assert {r.srid for r in rows} == {4326} and rows[0].geom[0][0][0].x == -101.0 and rows[0].bbox.xmin == -101.0
    assert set(spark.read.parquet(outputs.table).columns) >= {"incident_id", "geometry", "bbox", "srid", "id_type"}

    rejected = spark.read.option("header", True).csv(outputs.no_id).collect()
    assert len(rejected) == 1 and rejected[0].perimeter_date_raw == "20990101" and "geom" not in rejected[0].asDict()
    assert spark.read.option("header", True).csv(outputs.unreadable).count() == 1

    report = json.loads(open(glob(f"{outputs.report}/part-*")[0]).read())
    assert report["datasets"]["historic_geomac"] == {"raw_count": 5, "source": "Historic GeoMAC (2000-2018)"}
    assert "wfigs_ytd" not in report["datasets"]
    assert report["overall"]["quality_filter_stats"]["passed"] == 9
    assert report["overall"]["deduplication_stats"]["duplicates_removed"] == 4
    assert report["overall"]["incident_stats"]["max_perimeters"] == 5
    assert "T" in report["processing_timestamp"]

    funnel = jobs.availability(spark, outputs.table).first()
    assert (funnel.perimeters, funnel.incidents, funnel.same_timestamp_pairs, funnel.usable_pairs) == (5, 1, 3, 1)
    jobs.print_availability(spark, outputs.table)
    assert "Ended with: 1 incidents (100.0%)" in capsys.readouterr().out

    # the classified records were only scratch
    assert not glob(f"{shared_dir(spark)}/perimetry/classified-*")

    pairs = jobs.training_pairs(spark, outputs.table).collect()
    assert [(p.overlaps, p.bbox_overlap) for p in pairs] == [(True, True)]

    items, summary = jobs.incident_timeline(spark, outputs.table, "F-1")
    shown = items.collect()
    assert [r.label for r in shown] == ["01/01", "01/05"] and [r.progress for r in shown] == [0.0, 1.0]
    assert shown[0].label_point.y == pytest.approx(40) and shown[0].label_point.x == pytest.approx(-99.625)
    assert summary.first().title.startswith("Ridge's \"end\" (F-1)\nPerimeter Growth: 2003-01-01 to 2003-01-05\n1 training pairs, 2")
    nothing, none = jobs.incident_timeline(spark, outputs.table, "it's \"absent\"")
    assert nothing.count() == 0 and none.count() == 0


def test_empty_result_writes_only_the_report(spark, tmp_path):
    put(tmp_path / "raw" / f"{GEOMAC}a", {"incident": ["no id"], "year": ["2003"]}, [[box(0, 0)]])
    with pytest.raises(jobs.EmptyResultError) as empty:
        jobs.unify(spark, str(tmp_path / "raw"), str(tmp_path / "out"), SETTINGS)
    run = Path(empty.value.outputs.report).parent
    assert sorted(p.name for p in run.iterdir()) == ["no_id_records.csv", "processing_report.json"]
    assert [p for p in (tmp_path / "out").iterdir()] == [run] and jobs.published(spark, str(tmp_path / "out")) is None
    report = json.loads(open(glob(f"{run}/processing_report.json/part-*")[0]).read())
    assert report["overall"]["total_records"] == 0 and report["overall"]["date_range"] == {"min": None, "max": None}
    with pytest.raises(jobs.EmptyResultError):
        jobs.unify(spark, str(tmp_path / "absent"), str(tmp_path / "out2"), SETTINGS)


def test_own_sources_and_required_fields(spark, tmp_path):
    put(tmp_path / "raw" / "Mine_1", {"key": ["k"], "when": ["2003-05-06"]}, [[box(0, 0)]])
    settings = Settings(
        sources=(SourceSpec("mine", "Mine_*", "My source"),), max_year=2027, required_fields=("geometry",),
        aliases={"incident_id_raw": ("key",), "perimeter_date_raw": ("when",)}, priorities={},
    )
    outputs = jobs.unify(spark, str(tmp_path / "raw"), str(tmp_path / "out"), settings)
    row = read_unified(spark, outputs.table).first()
    assert (row.incident_id, row.fire_year, row.source_dataset, str(row.perimeter_date)) == ("k", 2003.0, "My source", "2003-05-06 00:00:00")
    assert scan_all(spark, str(tmp_path / "raw"), Settings(sources=())).count() == 0


def test_roster_job(spark, tmp_path):
    put(
        tmp_path / f"{YTD}1",
        {"attr_Uniqu": ["a", "a", ""], "attr_Inc_1": ["", "Name", "x"], "attr_Fir_7": ["2025-02-01", "2025-03-01", ""], "poly_Acres": ["10.4", "2500.5", "1"]},
        [[box(0, 0)]] * 3,
    )
    rows = jobs.roster_of(spark, str(tmp_path)).collect()
    assert [r.line.split() for r in rows] == [["Name", "2025-02-01", "a", "2,500"]]


class _Session:
    """Just what ``shared_dir`` asks of a session that names no shared folder."""

    def __init__(self, master):
        self.sparkContext = self.conf = self
        self.master = master

    def get(self, key, default=None):
        return "file:/warehouse" if key == "spark.sql.warehouse.dir" else default


def test_the_scratch_folder_must_be_named(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(_Session("local[2]")) == "file:/warehouse"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_Session(master))


def test_release_deletes_scratch_tables(spark):
    kept = written(spark.range(5), "numbers")
    assert kept.count() == 5
    folder = Path(shared_dir(spark).removeprefix("file:")) / "perimetry"
    assert any(folder.iterdir())
    release(spark)
    assert not any(folder.iterdir())


def test_rejects_keep_their_data(spark, tmp_path):
    texts = [None, "", " ", " F-7 ", "None", 'say "hi"', '"', '""', "a,b", "two\nlines", "win\r\nlines", "\\N", "\\\\N", "\\", "#x", "é\t", "'", "a\\"]
    rows = [(i, a, b, i % 2 == 0, datetime(2020, 1, 1, 5, i)) for i, (a, b) in enumerate(itertools.product(texts, texts[:9]), 0) if i < 60] + [
        (100 + i, t, t, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i long, a string, b string, c boolean, d timestamp_ntz")
    assert write_rejects(df, str(tmp_path / "out"))
    back = read_rejects(spark, str(tmp_path / "out"), df.schema)
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())
    assert not write_rejects(df.limit(0), str(tmp_path / "none"))
    table = pd.concat(pd.read_csv(f, keep_default_na=False, na_values=[]) for f in (tmp_path / "out").glob("*.csv"))
    assert set(table["b"]) >= {'say "hi"', "two\nlines", " F-7 "}


def test_outputs_of_a_run_are_published_together(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    attributes, shapes = incident()
    put(raw / f"{GEOMAC}a", attributes | {"uniquefire": ["F-1"] * 4 + [""]}, shapes)
    put(raw / f"{GEOMAC}b", *simple(3), prj=UTM.encode())
    first = jobs.unify(spark, str(raw), out, SETTINGS)
    assert jobs.published(spark, out) == first and Path(first.no_id).exists() and Path(first.unreadable).exists()

    monkeypatch.setattr(jobs, "write_report", lambda *_: 1 / 0)  # fails with its table already written
    with pytest.raises(ZeroDivisionError):
        jobs.unify(spark, str(raw), out, SETTINGS)
    monkeypatch.undo()
    assert jobs.published(spark, out) == first and len(list(Path(out).glob("run-*"))) == 1

    for folder in raw.iterdir():
        for file in folder.iterdir():
            file.unlink()
    put(raw / f"{GEOMAC}c", *simple(3))
    second = jobs.unify(spark, str(raw), out, SETTINGS)
    assert jobs.published(spark, out) == second and read_unified(spark, second.table).count() == 3
    assert not Path(second.no_id).exists() and not Path(second.unreadable).exists()  # nothing of the run before
    assert read_unified(spark, first.table).count() == 4  # a reader of the run before goes on
    assert prune(spark, out) == [Path(first.table).parent.name] and jobs.published(spark, out) == second
    assert not list(Path(out).glob("_*"))


def test_absent_incidents_read_no_row_group(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "concat('F-', lpad(id * 10, 9, '0')) AS incident_id", "timestamp_ntz'2003-01-01 00:00:00' AS perimeter_date", "id AS row_id",
        f"cast(NULL AS {GEOM}) AS geom")
    path = str(tmp_path / "table")
    write_unified(rows, path)

    def read(*ids):
        df = jobs.incidents(spark, path, ids)
        found = df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(found), leaf.metrics().apply("numOutputRows").value()

    assert read("F-000500005") == (0, 0) and read("F-000500001", "F-001000003", "x") == (0, 0)
    number, seen = read("F-000500000", "F-000500005", "F-001999990")
    assert number == 2 and seen < 150_000


def _two_members(raw, name, n=400):
    first, second = simple(n), simple(n, n)
    put(raw.parent / name, *first, name="A", shx=None)  # the archive's own index is not needed
    put(raw.parent / name, *second, name="B")
    raw.mkdir(exist_ok=True)
    pack(raw.parent / name, raw / f"{GEOMAC}{name}.zip")


def test_a_staged_archive_reads_in_pieces_as_a_streamed_one(spark, tmp_path):
    raw = tmp_path / "raw"
    _two_members(raw, "1")
    put(tmp_path / "z", *simple(3, 5000))
    pack(tmp_path / "z", raw / f"{GEOMAC}2.zip")
    small = Settings(max_year=2027, split_bytes=8 << 10)
    staged = stage_archives(spark, str(raw), small)
    columns = ["incident_id_raw", "incident_name", "fire_year", "perimeter_date_raw", "row_id", "srid", "file", "error", "geom"]
    pieces = scan(spark, str(raw), SETTINGS.sources[0], 0, small, staged=staged).select(columns)
    whole = scan(spark, str(raw), SETTINGS.sources[0], 0, small).select(columns)
    assert sorted(map(str, pieces.collect())) == sorted(map(str, whole.collect()))
    assert pieces.count() == 803 and whole.rdd.getNumPartitions() == 2 and pieces.rdd.getNumPartitions() > 10
    assert [Path(p).name for p in glob(f"{staged}/*")] == [f"{GEOMAC}1.zip"]  # the small one is streamed
    assert not glob(f"{staged}/*/*.part")
    assert stage_archives(spark, str(raw), SETTINGS) is None
    discard(spark, staged)


def test_staged_archives_report_what_is_wrong_with_them(spark, tmp_path):
    raw = tmp_path / "raw"
    _two_members(raw, "1", 20)
    (raw / f"{GEOMAC}2.zip").write_bytes(b"no archive")
    put(tmp_path / "cut", *simple(3, 50), shp=shapefile_parts(*simple(3))[".shp"][:-20])
    pack(tmp_path / "cut", raw / f"{GEOMAC}3.zip")
    put(tmp_path / "damaged", *simple(300, 60))
    pack(tmp_path / "damaged", raw / f"{GEOMAC}4.zip")
    body = bytearray((raw / f"{GEOMAC}4.zip").read_bytes())
    body[200:260] = bytes(60)
    (raw / f"{GEOMAC}4.zip").write_bytes(bytes(body))
    put(tmp_path / "bare", *simple(3, 70), dbf=None)
    pack(tmp_path / "bare", raw / f"{GEOMAC}5.zip")
    longer = bytearray(shapefile_parts(*simple(3))[".shp"])
    longer[104:108] = struct.pack(">i", 1 << 20)
    put(tmp_path / "longer", *simple(3, 80), shp=bytes(longer))
    pack(tmp_path / "longer", raw / f"{GEOMAC}6.zip")
    staged = stage_archives(spark, str(raw), Settings(split_bytes=0))
    rows = scan(spark, str(raw), SETTINGS.sources[0], 0, SETTINGS, staged=staged)
    assert sorted(r.incident_id_raw for r in readable(rows).collect()) == sorted(f"f{i}" for i in range(40))
    assert sorted(Path(r.file).stem[len(GEOMAC):] for r in unreadable(rows).collect()) == list("23456")
    with pytest.raises(Exception):
        scan(spark, str(raw), SETTINGS.sources[0], 0, SETTINGS, mode="FAILFAST", staged=staged).collect()
    discard(spark, staged)


def test_the_unify_job_stages_large_archives(spark, tmp_path):
    raw = tmp_path / "raw"
    _two_members(raw, "1", 30)
    before = set(glob(f"{shared_dir(spark)}/perimetry/*"))
    tables = [
        jobs.unify(spark, str(raw), str(tmp_path / f"out{size}"), Settings(max_year=2027, split_bytes=size)).table
        for size in (1, 1 << 30)
    ]
    found = [sorted(map(str, read_unified(spark, t).select("incident_id", "row_id", "geometry").collect())) for t in tables]
    assert found[0] == found[1] and len(found[0]) == 60
    assert not [p for p in set(glob(f"{shared_dir(spark)}/perimetry/*")) - before if "archives" in p]


def test_a_newer_archive_replaces_a_folder(spark, tmp_path):
    pack(put(tmp_path / "Set_1", {"uniquefire": ["a"]}, [[box(0, 0)]]), tmp_path / "Set_1.zip")
    reader = ShapefileReader({"path": str(tmp_path), "pattern": "Set_*", "columns": "uniquefire"})
    for age, archive in ((0, True), (1, False)):
        now = os.stat(tmp_path / "Set_1").st_mtime
        os.utime(tmp_path / "Set_1.zip", (now + 10 - 20 * age,) * 2)
        assert [p.stop < 0 for p in reader.partitions()] == [archive]


class _Counted:
    def __init__(self, data):
        self.data, self.reads = data, 0

    def read_at(self, size, at):
        self.reads += 1
        return self.data[at : at + size]


def test_a_batch_of_records_is_one_read():
    size = np.array([4, 8, 6])
    offset = np.array([100, 112, 128])
    file = _Counted(bytes(range(200)))
    assert _contents(file, offset, size) == [file.data[o + 8 : o + 8 + n] for o, n in zip(offset, size)] and file.reads == 1
    scattered = _Counted(bytes(2000))
    assert len(_contents(scattered, np.array([1500, 100, 900]), size)) == 3 and scattered.reads == 3


def test_many_small_pieces_share_tasks(spark, tmp_path):
    put(tmp_path / f"{GEOMAC}1", *simple(803))
    for i in range(40):
        pack(put(tmp_path / "members" / str(i), *simple(3, 5000 + 10 * i)), tmp_path / f"{GEOMAC}2_{i:02d}.zip")
    (tmp_path / f"{GEOMAC}2_07.zip").write_bytes(b"no archive")
    pieces = Settings(max_year=2027, split_bytes=512)
    staged = stage_archives(spark, str(tmp_path), Settings(split_bytes=0))
    whole = scan(spark, str(tmp_path), SETTINGS.sources[0], 0, SETTINGS).collect()
    for found in (scan(spark, str(tmp_path), SETTINGS.sources[0], 0, pieces, staged=s) for s in (None, staged)):
        assert found.rdd.getNumPartitions() <= 16
        rows = found.collect()
        assert sorted(str(r) for r in rows if r.error is None) == sorted(str(r) for r in whole if r.error is None)
        assert len(rows) == 803 + 39 * 3 + 1
    discard(spark, staged)
    assert packed(list("abcd"), [1, 1, 9, 1], 2) == [["a", "b"], ["c", "d"]]
    assert packed([1, 2, 3], [5, 0, 5], 3) == [[1], [2], [3]]
    assert max(map(len, packed(range(100), [64 << 20] * 100, 4))) <= 2  # a task's bytes are bounded


def _records(shapes):
    body, found = shapefile_parts({"a": ["x"] * len(shapes)}, shapes)[".shp"], []
    while len(body) > 100 + sum(len(c) + 8 for c in found):
        at = 100 + sum(len(c) + 8 for c in found)
        found.append(body[at + 8 : at + 8 + 2 * struct.unpack_from(">i", body, at + 4)[0]])
    return found


def test_records_of_one_ring_are_read_together(monkeypatch):
    plain = [None, [], [box(0, 0)], [box(1, 1)[:0]], [box(2, 2, clockwise=False)], [box(3, 3)[:2]], None]
    mixed = [*plain, [box(4, 4), box(4, 4, 0.5, clockwise=False)]]
    for shapes in (plain, mixed, [], [None], [[]]):
        contents = _records(shapes)
        expected = shapefile.geometry_array([polygons_of(c) for c in contents])
        assert shapefile.geometries(contents).to_pylist() == expected.to_pylist()
    contents, one_by_one = _records(plain), []
    monkeypatch.setattr(shapefile, "polygons_of", lambda c: one_by_one.append(c) or polygons_of(c))
    assert len(shapefile.geometries(contents)) == 7 and one_by_one == []
    for bad in (contents[2][:60], b"", struct.pack("<i", 3) + contents[2][4:]):
        with pytest.raises((struct.error, ValueError)):
            shapefile.geometries([contents[2], bad])


def test_written_boxes_are_those_of_each_record():
    shapes = [None, [box(0, 0), box(5, 5)], [], [box(2, 2)[:0]], [box(7, 1)]]
    boxes = [struct.unpack_from("<4d", c, 4) if len(c) > 4 else None for c in _records(shapes)]
    assert boxes == [None, (-1, -1, 6, 6), (0,) * 4, (0,) * 4, (6, 0, 8, 2)]
    assert [struct.unpack_from("<2i", c, 44) for c in _records(shapes)[1:2]] == [(0, 5)]


def test_pieces_of_a_file_in_one_task_open_it_once(tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    put(raw / f"{HISTORY}a", *simple(40))
    put(raw / f"{HISTORY}b", *simple(40))
    (raw / f"{HISTORY}b" / "Perimeters.dbf").write_bytes(b"cut")
    reader = ShapefileReader({"path": str(raw), "pattern": f"{HISTORY}*", "columns": "uniquefire", "split_bytes": "1000", "tasks": "1"})
    opened, real = [], shapefile._Files.opened
    monkeypatch.setattr(shapefile._Files, "opened", lambda self, system, base: opened.append(base) or real(self, system, base))
    (task,) = reader.partitions()
    rows = [r for b in reader.read(task) for r in b.to_pylist()]
    pieces = [r for r in task.ranges if "_a/" in r.path]
    assert len(pieces) > 3 and sum(base.endswith("_a/Perimeters") for base in opened) == 1
    assert [r["uniquefire"] for r in rows if not r["error"]] == [f"f{i}" for i in range(40)]
    assert [r["record_no"] for r in rows if r["error"]] == [r.start for r in task.ranges if "_b/" in r.path]


def test_records_are_not_shuffled_to_leave_out_failed_files(spark):
    rows = spark.createDataFrame([("a", None), ("b", None), ("b", "cut off")], "file string, error string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = readable(rows)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert [r.file for r in left.collect()] == ["a"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_plain_attributes_are_decoded_together():
    def read(*values):
        width = max(map(len, values))
        data = b"".join(v.ljust(width) for v in values)
        table = shapefile._Attributes.__new__(shapefile._Attributes)
        table.fields, table.encoding = {"a": (0, width, "C", 0)}, "utf-8"
        return table.texts(np.frombuffer(data, np.uint8).reshape(len(values), width), "a", False)

    plain = read(b" a b ", b"", b"   ", b"~!0")
    assert isinstance(plain, pa.Array) and plain.to_pylist() == ["a b", None, None, "~!0"]
    assert read(b" a b ", "é ".encode(), b"\tx", b"") == ["a b", "é", "x", None]


def test_records_of_an_archive_are_read_many_at_a_time():
    class Member(io.BytesIO):
        calls = 0

        def readinto(self, into):
            self.calls += 1
            return super().readinto(into)

        def read(self, n=-1):
            self.calls += 1
            return super().read(n)

    parts = shapefile_parts({"a": ["x"] * 500}, [[np.arange(8.0).reshape(4, 2)]] * 500)
    member = Member(parts[".shp"])
    member.read(100)
    found = [c for some in shapefile._records_of(member, 500) for c in some]
    assert len(found) == 500 and len(set(found)) == 1 and member.calls < 10


def test_shapes_of_several_rings_are_written_in_their_places():
    ring = np.array([(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)], float)
    shapes = [None, [], [ring, ring[::-1] / 2 + 1], [ring + 9], [np.zeros((0, 2))], [ring, ring + 20]]
    parts, at = shapefile_parts({"a": ["x"] * len(shapes)}, shapes), 100
    for number, some in enumerate(shapes):
        offset, length = struct.unpack_from(">ii", parts[".shx"], 100 + 8 * number)
        assert (2 * offset, struct.unpack_from(">ii", parts[".shp"], at)) == (at, (number + 1, length))
        content = parts[".shp"][at + 8 : at + 8 + 2 * length]
        if some is None:
            assert content == bytes(4)
        else:
            points = np.concatenate([np.zeros((0, 2)), *some])
            box = [*points.min(0), *points.max(0)] if len(points) else [0.0] * 4
            firsts = [sum(map(len, some[:i])) for i in range(len(some))]
            assert content == struct.pack(f"<i4dii{len(some)}i", 5, *box, len(some), len(points), *firsts) + points.tobytes()
        at += 8 + 2 * length
    assert at == len(parts[".shp"])
