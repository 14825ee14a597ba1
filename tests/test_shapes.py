"""Geometry: hand-made cases, and random polygons against the JTS library that ships with Spark."""

import math
import random

import pyarrow as pa
import pytest

from perimetry.functions import shapes
from perimetry.functions.geometry import bbox, is_empty, to_wgs84
from perimetry.functions.wkb import decode, encode, from_wkb, to_wkb
from perimetry.schema import GEOM
from pyspark.sql import functions as F

ARROW = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def ring(*points):
    closed = [*points, points[0]]
    return [(float(x), float(y)) for x, y in closed]


def square(x, y, h):
    return ring((x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h))


def batch(geoms):
    return pa.array(
        [g if g is None else [[[{"x": x, "y": y} for x, y in r] for r in p] for p in g] for g in geoms], ARROW
    )


def valid(*geoms):
    return shapes.valid_rows(shapes._Shapes(batch(geoms))).tolist()


class Jts:
    """Driver-side oracle."""

    def __init__(self, spark):
        self.reader = spark._jvm.org.locationtech.jts.io.WKTReader()

    def read(self, geom):
        def text(points):
            return "(" + ", ".join(f"{x!r} {y!r}" for x, y in points) + ")"

        parts = ["(" + ", ".join(map(text, rings)) + ")" for rings in geom]
        return self.reader.read(f"MULTIPOLYGON ({', '.join(parts)})" if parts else "MULTIPOLYGON EMPTY")


L_SHAPE = ring((0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3))
VALIDITY = {
    "box": ([[square(0, 0, 1)]], True),
    "L": ([[L_SHAPE]], True),
    "bowtie": ([[ring((0, 0), (1, 1), (1, 0), (0, 1))]], False),
    "hole": ([[square(0, 0, 3), square(0, 0, 1)]], True),
    "hole outside": ([[square(0, 0, 1), square(5, 0, 1)]], False),
    "hole touching shell once": ([[square(0, 0, 2), ring((-2, 0), (0, 1), (0, -1))]], True),
    "hole touching shell twice": ([[square(0, 0, 2), ring((-2, 0), (0, 1), (2, 0), (0, -1))]], False),
    "hole sharing an edge": ([[square(0, 0, 2), ring((-2, -1), (0, -1), (0, 1), (-2, 1))]], False),
    "hole crossing shell": ([[square(0, 0, 2), square(2, 0, 1)]], False),
    "hole equals shell": ([[square(0, 0, 2), square(0, 0, 2)]], False),
    "nested holes": ([[square(0, 0, 5), square(0, 0, 3), square(0, 0, 1)]], False),
    "two holes": ([[square(0, 0, 5), square(-2, 0, 1), square(2, 0, 1)]], True),
    "holes touching once": ([[square(0, 0, 5), square(-1, 0, 1), ring((0, 0), (2, 1), (2, -1))]], True),
    "island in hole": ([[square(0, 0, 5), square(0, 0, 3)], [square(0, 0, 1)]], True),
    "nested parts": ([[square(0, 0, 5)], [square(0, 0, 1)]], False),
    "parts apart": ([[square(0, 0, 1)], [square(5, 0, 1)]], True),
    "parts touching in a corner": ([[square(0, 0, 1)], [square(2, 2, 1)]], True),
    "parts sharing an edge": ([[square(0, 0, 1)], [square(2, 0, 1)]], False),
    "parts overlapping": ([[square(0, 0, 1)], [square(1, 0, 1)]], False),
    "parts crossing through corners": ([[ring((0, 0), (2, 0), (2, 2), (0, 2))], [ring((0, 0), (2, 2), (4, 0), (2, -2))]], False),
    "shell touching itself": ([[ring((0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1))]], False),
    "spike": ([[ring((0, 0), (2, 0), (2, 2), (2, 3), (2, 2), (0, 2))]], False),
    "repeated point": ([[[(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]], True),
    "flat": ([[ring((0, 0), (1, 1), (2, 2))]], False),
}


@pytest.mark.parametrize("name", VALIDITY)
def test_validity_cases(spark, name):
    geom, expected = VALIDITY[name]
    assert Jts(spark).read(geom).isValid() == expected  # the case says what it means to say
    assert valid(geom) == [expected]
    moved = [[[(x + 1024.0, y - 512.0) for x, y in r] for r in p] for p in geom]
    turned = [[[(y, x) for x, y in r[::-1]] for r in p] for p in geom]
    assert valid(moved, turned) == [expected] * 2


def test_broken_rings():
    nan = [[(0.0, 0.0), (1.0, float("nan")), (1.0, 1.0), (0.0, 0.0)]]
    open_ring = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]
    short = [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]
    inf = [[(0.0, 0.0), (1.0, float("inf")), (1.0, 1.0), (0.0, 0.0)]]
    assert valid([nan], [open_ring], [short], [inf], [], None, [[square(0, 0, 1)]]) == [False] * 4 + [True] * 3


PAIRS = {
    "apart": ([[square(0, 0, 1)]], [[square(5, 0, 1)]]),
    "only boxes meet": ([[ring((0, 0), (4, 0), (0, 4))]], [[ring((4, 4), (4, 3), (3, 4))]]),
    "edge": ([[square(0, 0, 1)]], [[square(2, 0, 1)]]),
    "corner": ([[square(0, 0, 1)]], [[square(2, 2, 1)]]),
    "cross": ([[ring((-3, -1), (3, -1), (3, 1), (-3, 1))]], [[ring((-1, -3), (1, -3), (1, 3), (-1, 3))]]),
    "inside": ([[square(0, 0, 3)]], [[square(0, 0, 1)]]),
    "inside touching": ([[square(0, 0, 2)]], [[square(1, 0, 1)]]),
    "equal": ([[square(0, 0, 1)]], [[square(0, 0, 1)[::-1]]]),
    "in the hole": ([[square(0, 0, 3), square(0, 0, 2)]], [[square(0, 0, 1)]]),
    "fills the hole": ([[square(0, 0, 3), square(0, 0, 2)]], [[square(0, 0, 2)]]),
    "covers the hole": ([[square(0, 0, 5), square(0, 0, 1)]], [[square(0, 0, 2)]]),
    "second part": ([[square(0, 0, 1)], [square(9, 0, 1)]], [[square(9, 0, 0.5)]]),
    "around": ([[square(0, 0, 1)], [square(9, 0, 1)]], [[square(4, 0, 20)]]),
    "bridge over a notch": ([[ring((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))]], [[ring((0, 3), (0, 4), (4, 4), (4, 3))]]),
    "same diagonal": ([[ring((0, 0), (3, 1), (0, 3))]], [[ring((0, 0), (3, 1), (0, 1))]]),
}


def star(rng, n, cx=0.0, cy=0.0, radius=1.0, grid=None):
    """A ring around a centre; on a coarse grid it often touches itself."""
    points = []
    for k in range(n):
        a, r = 2 * math.pi * k / n, radius * rng.uniform(0.3, 1.0)
        x, y = cx + r * math.cos(a), cy + r * math.sin(a)
        points.append((round(x * grid) / grid, round(y * grid) / grid) if grid else (x, y))
    return ring(*points)


def random_geometries(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        kind, grid = rng.randrange(5), rng.choice([None, 2, 4, 8])
        center = rng.uniform(-1, 1), rng.uniform(-1, 1)
        n = rng.randrange(3, 40)
        if kind == 0:
            yield [[ring(*[(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randrange(3, 7))])]]
        elif kind == 1:
            yield [[star(rng, n, *center, 2.0, grid)]]
        elif kind == 2:
            yield [[star(rng, n, *center, 3.0, grid), star(rng, 6, *center, 0.9, grid), star(rng, 5, center[0] + 0.7, center[1], 0.4, grid)]]
        elif kind == 3:
            yield [[star(rng, n, *center, 1.5, grid)], [star(rng, 7, center[0] + 2.0, center[1], 1.0, grid)]]
        else:
            yield [[square(rng.randrange(4), rng.randrange(4), rng.choice([0.5, 1, 2])) for _ in range(rng.randrange(1, 4))]]


def interior_cycle(geom):
    """Three or more rings that close a chain of touches: the one validity rule left out."""
    return len(geom[0]) >= 3


def test_random_validity_against_jts(spark):
    jts = Jts(spark)
    geoms = list(random_geometries(11, 1500))
    expected = [jts.read(g).isValid() for g in geoms]
    got = valid(*geoms)
    wrong = [g for g, e, v in zip(geoms, expected, got) if e != v and not interior_cycle(g)]
    assert wrong == []
    assert 200 < sum(expected) < 1300
    # rings around a cycle may only be missed in one direction
    assert not [g for g, e, v in zip(geoms, expected, got) if e and not v]


def test_exact_turns():
    """Points within rounding of a line are told apart."""
    base = [[ring((0.1, 0.1), (0.3, 0.3), (0.1, 0.5))]]
    assert shapes._turn(*(pa.array([v]).to_numpy() for v in (0.1, 0.1, 0.3, 0.3, 0.2, 0.2))).tolist() == [0]
    above = math.nextafter(0.2, 1)
    assert shapes._turn(*(pa.array([v]).to_numpy() for v in (0.1, 0.1, 0.3, 0.3, 0.2, above))).tolist() == [1]
    assert valid(*[base]) == [True]


def test_large_ring_and_small_chunks(monkeypatch):
    rng = random.Random(3)
    big = [[star(rng, 20000, 0, 0, 1.0)]]
    assert valid(big) == [True]
    monkeypatch.setattr(shapes, "_CHUNK", 7)
    geoms = list(random_geometries(13, 60))
    small = valid(*geoms)
    monkeypatch.undo()
    assert small == valid(*geoms)


def test_centroids(spark):
    cases = [
        ([[square(2, 3, 1)]], (2.0, 3.0)),
        ([[square(2, 3, 1)[::-1]]], (2.0, 3.0)),
        ([[L_SHAPE]], (1.1, 1.1)),
        ([[square(0, 0, 2), square(1, 0, 1)]], (-1 / 3, 0.0)),
        ([[square(0, 0, 1)], [square(4, 0, 1)]], (2.0, 0.0)),
        ([[ring((0, 0), (2, 2), (4, 4))]], (2.0, 2.0)),
        ([[[(1.0, 2.0)] * 4]], (1.0, 2.0)),
        ([[ring((0, 0), (1, 1), (1, 0), (0, 1))]], (0.5, 0.5)),
        ([], None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, geom {GEOM}")
    out = df.select("i", shapes.centroid("geom").alias("c"), is_empty(F.col("geom")).alias("e")).orderBy("i").collect()
    for row, (_, expected) in zip(out, cases):
        assert (row.c is None) == (expected is None)
        if expected:
            assert (row.c.x, row.c.y) == pytest.approx(expected, abs=1e-12)
    assert [r.e for r in out][-2:] == [True, None]


def test_random_centroids_against_jts(spark):
    jts = Jts(spark)
    geoms = [g for g in random_geometries(14, 300) if jts.read(g).isValid()]
    x, y, _ = shapes.centroids(shapes._Shapes(batch(geoms)))
    for g, px, py in zip(geoms, x, y):
        c = jts.read(g).getCentroid()
        assert (px, py) == pytest.approx((c.getX(), c.getY()), abs=1e-9)


def test_functions_in_spark(spark):
    geoms = [[[square(0, 0, 1)]], None, [], [[ring((0, 0), (1, 1), (1, 0), (0, 1))]], [[square(0, 0, 3), square(0, 0, 2)]]]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(geoms)], f"i int, geom {GEOM}")
    out = df.select(
        shapes.measure("geom").alias("m"), bbox(F.col("geom")).alias("b"), from_wkb(to_wkb("geom")).alias("back"), "geom",
    ).orderBy("i").collect()
    assert [r.m.valid for r in out] == [True, None, True, False, True]
    assert [r.geom == r.back for r in out] == [True] * 5
    assert out[0].b.asDict() == {"xmin": -1.0, "ymin": -1.0, "xmax": 1.0, "ymax": 1.0} and out[2].b is None


def test_wkb_forms(spark):
    reader = spark._jvm.org.locationtech.jts.io.WKBReader()
    assert reader.read(bytearray(encode([]))).isEmpty() and decode(encode([])) == []
    for geom in ([[square(0, 0, 1)]], [[square(0, 0, 3), square(0, 0, 1)], [square(9, 0, 1)]]):
        assert reader.read(bytearray(encode(geom))).equalsTopo(Jts(spark).read(geom))
    writer = spark._jvm.org.locationtech.jts.io.WKBWriter(2, 1)  # big endian
    data = bytes(writer.write(Jts(spark).read([[square(0, 0, 1)]])))
    assert [[r.tolist() for r in p] for p in decode(data)] == [[[list(p) for p in square(0, 0, 1)]]]


def test_reference_systems(spark):
    df = spark.createDataFrame(
        [(None, 10.0, 20.0), (4326, 10.0, 20.0), (3857, 1113194.9079327357, 2273030.926987689), (9999, 1.0, 1.0)],
        "srid int, x double, y double",
    ).withColumn("geom", F.array(F.array(F.array(F.struct("x", "y")))))
    out = [r.g for r in df.select(to_wgs84(F.col("geom"), F.col("srid")).alias("g")).collect()]
    for g in out[:3]:
        assert (g[0][0][0].x, g[0][0][0].y) == pytest.approx((10.0, 20.0))
    assert out[3] is None
