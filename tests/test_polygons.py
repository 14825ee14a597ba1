"""Polygon predicates as joins: hand-made cases and random polygons against JTS, exact turns, plans."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from perimetry.functions.exact import turn
from perimetry.operators import polygons
from perimetry.schema import GEOM
from tests.test_shapes import PAIRS, VALIDITY, Jts, random_geometries, ring, square


def frame(spark, rows, *names):
    points = [tuple(g if g is None else [[[(x, y) for x, y in r] for r in p] for p in g] for g in row) for row in rows]
    ddl = "id int, " + ", ".join(f"{n} {GEOM}" for n in names)
    return spark.createDataFrame([(i, *row) for i, row in enumerate(points)], ddl).repartition(3)


def keys(found):
    return sorted(r.id for r in found.collect())


def invalid(spark, geoms):
    return set(keys(polygons.invalid(frame(spark, [(g,) for g in geoms], "geom"), ["id"], "geom")))


def test_turns_are_exact(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(1500):
        ax, ay, dx, dy = (rng.uniform(-100, 100) for _ in range(4))
        t = rng.choice([0.5, rng.random(), 2, 1 / 3])
        nudge = rng.choice([0.0, 2.0 ** -rng.randrange(40, 60)])
        rows.append((ax, ay, ax + dx, ay + dy, ax + t * dx + nudge, ay + t * dy))
    rows += [tuple(rng.randrange(4) / 3 for _ in range(6)) for _ in range(300)]
    names = ["ax", "ay", "bx", "by", "cx", "cy"]
    for r in spark.createDataFrame(rows, names).select(*names, turn(*names).alias("t")).collect():
        a = [Fraction(v) for v in r[:6]]
        exact = (a[2] - a[0]) * (a[5] - a[1]) - (a[3] - a[1]) * (a[4] - a[0])
        assert r.t == (exact > 0) - (exact < 0)


def test_validity_cases(spark):
    geoms, expected = [], []
    for geom, valid in VALIDITY.values():
        moved = [[[(x + 1024.0, y - 512.0) for x, y in r] for r in p] for p in geom]
        turned = [[[(y, x) for x, y in r[::-1]] for r in p] for p in geom]
        geoms += [geom, moved, turned]
        expected += [valid] * 3
    bad = invalid(spark, geoms)
    assert [i not in bad for i in range(len(geoms))] == expected


def test_interior_cut_by_a_cycle_of_holes(spark):
    """Three holes that touch one another in different points cut a triangle out of the interior."""
    holes = [ring((0, 2), (2, 0), (3, 3)), ring((2, 0), (4, 2), (5, -1)), ring((4, 2), (0, 2), (2, 6))]
    chain = [ring((0, 2), (2, 0), (3, 1)), ring((2, 0), (4, 2), (5, -1))]
    at_shell = [ring((-10, 0), (-5, 5), (-5, 0)), ring((-5, 5), (0, 10), (-1, 5))]
    geoms = [[[square(0, 0, 10), *h]] for h in (holes[:1], chain, at_shell)]
    jts = Jts(spark)
    bad = invalid(spark, geoms)
    assert [i not in bad for i in range(len(geoms))] == [jts.read(g).isValid() for g in geoms]
    cycle = [[square(0, 0, 20), ring((0, 0), (4, 0), (2, -2)), ring((4, 0), (2, 4), (6, 4)), ring((2, 4), (0, 0), (-2, 4))]]
    assert jts.read(cycle).isValid() is False and invalid(spark, [cycle]) == {0}


def test_broken_rings(spark):
    nan = [[(0.0, 0.0), (1.0, float("nan")), (1.0, 1.0), (0.0, 0.0)]]
    open_ring = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]
    short = [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]
    inf = [[(0.0, 0.0), (1.0, float("inf")), (1.0, 1.0), (0.0, 0.0)]]
    assert invalid(spark, [[nan], [open_ring], [short], [inf], [], None, [[square(0, 0, 1)]]]) == {0, 1, 2, 3}


def both_ways(pairs):
    return [q for a, b in pairs for q in ((a, b), (b, a))]


def test_predicate_cases(spark):
    jts, rows = Jts(spark), both_ways(PAIRS.values())
    pairs = frame(spark, rows, "a", "b")
    assert keys(polygons.intersecting(pairs, ["id"], "a", "b")) == [i for i, (a, b) in enumerate(rows) if jts.read(a).intersects(jts.read(b))]
    assert keys(polygons.containing(pairs, ["id"], "a", "b")) == [i for i, (a, b) in enumerate(rows) if jts.read(a).contains(jts.read(b))]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_polygons(spark, seed):
    jts, geoms = Jts(spark), list(random_geometries(seed, 300))
    read = [jts.read(g) for g in geoms]
    bad = invalid(spark, geoms)
    assert [i not in bad for i in range(len(geoms))] == [g.isValid() for g in read]
    sound = [i for i, g in enumerate(read) if g.isValid()]
    rng = random.Random(seed)
    chosen = [(rng.choice(sound), rng.choice(sound)) for _ in range(300)]
    pairs = frame(spark, [(geoms[i], geoms[j]) for i, j in chosen], "a", "b")
    assert keys(polygons.intersecting(pairs, ["id"], "a", "b")) == [k for k, (i, j) in enumerate(chosen) if read[i].intersects(read[j])]
    assert keys(polygons.containing(pairs, ["id"], "a", "b")) == [k for k, (i, j) in enumerate(chosen) if read[i].contains(read[j])]


def wavy(n, radius, x=0.0):
    steps = [2 * math.pi * k / n for k in range(n)]
    return ring(*[(x + radius * (1 + 0.01 * math.sin(40 * t)) * math.cos(t), radius * (1 + 0.01 * math.sin(40 * t)) * math.sin(t)) for t in steps])


def test_many_vertices(spark):
    """Large rings: the join forms few pairs of edges for each edge."""
    a, inner, beside, across = ([[wavy(20_000, r, x)]] for r, x in ((10, 0), (5, 1), (5, 30), (8, 9)))
    pairs = frame(spark, [(a, inner), (a, beside), (a, across)], "a", "b")
    assert keys(polygons.intersecting(pairs, ["id"], "a", "b")) == [0, 2]
    assert keys(polygons.containing(pairs, ["id"], "a", "b")) == [0]
    assert invalid(spark, [a, [[wavy(20_000, 10), wavy(20_000, 12)]]]) == {1}
    edges = polygons.ring_edges(polygons.ring_points(frame(spark, [(a,)], "geom"), ["id"], "geom"), ["id"])
    box = {"left": F.min("x1"), "bottom": F.min("y1"), "right": F.max("x1"), "top": F.max("y1")}
    cells = polygons._in_cells(edges.join(polygons._grid(edges, ["id"], box), "id"))
    per_cell = cells.groupBy("id", "row", "column").count()
    assert cells.count() < 8 * 20_000 and per_cell.agg(F.max("count")).first()[0] < 2_000


def test_tall_and_wide_edges_stay_apart(spark):
    """A comb of tall teeth: rows of the grid would hold all of its edges."""
    teeth = [p for k in range(400) for p in ((k, 0), (k + 0.5, 100))]
    comb = [[ring(*teeth, (400, 0), (400, -1), (0, -1))]]
    turned = [[[(y, x) for x, y in comb[0][0]][::-1]]]
    assert invalid(spark, [comb, turned]) == set()
    assert keys(polygons.intersecting(frame(spark, [(comb, [[square(0.5, 200, 1)]]), (comb, turned)], "a", "b"), ["id"], "a", "b")) == [1]


def test_nothing(spark):
    none = frame(spark, [], "a", "b")
    for predicate in (polygons.intersecting, polygons.containing):
        assert predicate(none, ["id"], "a", "b").collect() == []
        odd = frame(spark, [(None, [[square(0, 0, 1)]]), ([], [[square(0, 0, 1)]]), (None, None), ([], [])], "a", "b")
        assert predicate(odd, ["id"], "a", "b").collect() == []
    assert polygons.invalid(none, ["id"], "a").collect() == []


def test_plans_have_no_python_and_no_nested_loop(spark):
    rows = frame(spark, [([[square(0, 0, 1)]], [[square(1, 0, 1)]])], "a", "b")
    for found in (polygons.intersecting(rows, ["id"], "a", "b"), polygons.containing(rows, ["id"], "a", "b"), polygons.invalid(rows, ["id"], "a")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian"))
