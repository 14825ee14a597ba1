"""Polygon predicates as joins of edges: intersects, contains, valid.

Geometries become edges, one row each, stored once. Two edges can only share a point if they share a cell of
a grid over the place where their geometries can meet; so edges are joined on (pair, cell), orientation is
a Column expression (``functions.exact``) and an aggregate per pair gives the verdict. The grid of a
pair has about as many cells as edges, fewer rows where many edges are tall and fewer columns where
many are wide, so the cells that an edge covers stay few. Whether a point lies inside is the parity of the
edges it sees to one side, joined on (pair, row of the grid). A polygon of any number of vertices is spread
over tasks by its cells, and no task holds a geometry as a whole but to explode it.

Cells are found by subtraction, division and floor, which are monotone also in floating point: edges
that share a point share its cell exactly, without any tolerance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.functions.exact import turn
from perimetry.plans.storage import written

_MOST_CELLS = 4096  # rows, and columns, of a grid
_ENDS = ("x1", "y1", "x2", "y2")


def _c(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def _low(axis: str, at: str = "") -> Column:
    return F.least(F.col(f"{at}{axis}1"), F.col(f"{at}{axis}2"))


def _high(axis: str, at: str = "") -> Column:
    return F.greatest(F.col(f"{at}{axis}1"), F.col(f"{at}{axis}2"))


def ring_points(shapes: DataFrame, key: list[str], geom: str) -> DataFrame:
    """(key, part, ring, points) of every ring; ``ring`` 0 is the shell of its part."""
    parts = shapes.select(*key, F.posexplode(geom).alias("part", "rings"))
    return parts.select(*key, "part", F.posexplode("rings").alias("ring", "points"))


def _finite(value: Column) -> Column:
    return (F.abs(value) < float("inf")) & ~F.isnan(value)


def ring_edges(rings: DataFrame, key: list[str]) -> DataFrame:
    """(key, part, ring, no, x1, y1, x2, y2) of all edges between different finite points."""
    n = F.size("points")
    ends = F.arrays_zip(F.slice("points", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("points", F.lit(2), n).alias("b"))
    rows = rings.select(*key, "part", "ring", F.posexplode(ends).alias("no", "e"))
    plus = lambda c: (c + F.lit(0.0))  # noqa: E731  no negative zero
    rows = rows.select(
        *key, "part", "ring", "no", plus(F.col("e.a.x")).alias("x1"), plus(F.col("e.a.y")).alias("y1"),
        plus(F.col("e.b.x")).alias("x2"), plus(F.col("e.b.y")).alias("y2"),
    )
    moves = (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))
    return rows.where(moves & reduce(lambda a, b: a & b, [_finite(F.col(e)) for e in _ENDS]))


# the grid


def _steps(edges: Column, extent: Column, travel: Column) -> Column:
    """Rows (or columns) of a grid: about the root of the number of edges, so few that all edges together cover
    no more than some four of them each."""
    most = F.when(travel > 0, 4 * edges * extent / travel).otherwise(F.lit(1.0))
    return F.greatest(F.lit(1), F.least(F.ceil(F.sqrt(edges)), F.ceil(most), F.lit(_MOST_CELLS))).cast("int")


def _grid(edges: DataFrame, key: list[str], over: dict[str, Column]) -> DataFrame:
    """(key, left, bottom, right, top, columns, rows) per key; ``over`` gives the box as aggregates of edges."""
    n = F.count("*").cast("double")
    found = edges.groupBy(*key).agg(
        n.alias("n"), F.sum(_high("x") - _low("x")).alias("wide"), F.sum(_high("y") - _low("y")).alias("tall"),
        *[c.alias(name) for name, c in over.items()])
    return found.select(
        *key, "left", "bottom", "right", "top",
        _steps(F.col("n"), F.col("right") - F.col("left"), F.col("wide")).alias("columns"),
        _steps(F.col("n"), F.col("top") - F.col("bottom"), F.col("tall")).alias("rows"),
    )


def _place(value: Column, start: str, end: str, steps: str) -> Column:
    """The row or column of a coordinate, kept inside the grid; monotone."""
    width = (F.col(end) - F.col(start)) / F.col(steps)
    at = F.when(width > 0, F.floor((value - F.col(start)) / width)).otherwise(F.lit(0))
    return F.least(F.greatest(at, F.lit(0)), F.col(steps) - 1).cast("int")


def _in_rows(edges: DataFrame) -> DataFrame:
    rows = F.sequence(_place(_low("y"), "bottom", "top", "rows"), _place(_high("y"), "bottom", "top", "rows"))
    return edges.withColumn("row", F.explode(rows))


def _in_cells(edges: DataFrame) -> DataFrame:
    columns = F.sequence(_place(_low("x"), "left", "right", "columns"), _place(_high("x"), "left", "right", "columns"))
    return _in_rows(edges).withColumn("column", F.explode(columns))


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{n}") == F.col(f"{b}.{n}") for n in names])


def _meet(a: str, b: str) -> Column:
    """The boxes of two edges share a point."""
    return reduce(lambda x, y: x & y, [
        (_low(axis, f"{p}.") <= _high(axis, f"{q}.")) for axis in "xy" for p, q in ((a, b), (b, a))])


def _with_turns(pairs: DataFrame) -> DataFrame:
    """Turns of the ends of each edge of ``p``, ``q`` as seen from the other, and what follows: whether they share a
    point, cross inside both, or share a stretch."""
    p, q = ([f"{s}.{e}" for e in _ENDS] for s in "pq")
    pairs = pairs.withColumns({
        "q1": turn(*p, *q[:2]), "q2": turn(*p, *q[2:]), "p1": turn(*q, *p[:2]), "p2": turn(*q, *p[2:])})
    share = (F.col("q1") * F.col("q2") <= 0) & (F.col("p1") * F.col("p2") <= 0)
    cross = (F.col("q1") * F.col("q2") < 0) & (F.col("p1") * F.col("p2") < 0)
    in_line = reduce(lambda a, b: a & b, [F.col(t) == 0 for t in ("q1", "q2", "p1", "p2")])
    longer = reduce(lambda a, b: a | b, [
        F.greatest(_low(axis, "p."), _low(axis, "q.")) < F.least(_high(axis, "p."), _high(axis, "q.")) for axis in "xy"])
    return pairs.withColumns({"share": share, "cross": cross, "stretch": in_line & longer})


# two geometries


def _sides(pairs: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """The rings of both geometries, ``side`` 0 and 1."""
    return ring_points(pairs.select(*key, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col(a).alias("geom")), F.struct(F.lit(1).alias("side"), F.col(b).alias("geom")))
    ).alias("s")).select(*key, "s.side", "s.geom"), [*key, "side"], "geom")


def _overlap_grid(edges: DataFrame, key: list[str]) -> DataFrame:
    """The grid over the box in which edges of the two sides can meet."""

    def edge_of(side: int, value: Column, pick) -> Column:
        return pick(F.when(F.col("side") == side, value))

    box = {
        "left": F.greatest(*[edge_of(s, _low("x"), F.min) for s in (0, 1)]), "bottom": F.greatest(*[edge_of(s, _low("y"), F.min) for s in (0, 1)]),
        "right": F.least(*[edge_of(s, _high("x"), F.max) for s in (0, 1)]), "top": F.least(*[edge_of(s, _high("y"), F.max) for s in (0, 1)]),
    }
    two_sides = F.count_distinct("side") == 2
    known = edges.groupBy(*key).agg(two_sides.alias("two")).where("two").drop("two")
    return _grid(edges, key, box).join(known, key, "left_semi").where("left <= right AND bottom <= top")


def _touching(edges: DataFrame, key: list[str]) -> DataFrame:
    """Pairs (p of side 0, q of side 1) of edges that share a point, once per common cell, with their relation."""
    grid = written(_overlap_grid(edges, key), "grid")
    near = edges.join(grid, key).where(
        (_low("x") <= F.col("right")) & (F.col("left") <= _high("x")) & (_low("y") <= F.col("top")) & (F.col("bottom") <= _high("y")))
    cells = _in_cells(near).drop("left", "bottom", "right", "top", "columns", "rows")
    p, q = cells.where("side = 0").alias("p"), cells.where("side = 1").alias("q")
    met = p.join(q, _same("p", "q", [*key, "row", "column"])).where(_meet("p", "q"))
    return _with_turns(met).where("share")


def _located(points: DataFrame, edges: DataFrame, key: list[str], one: Column | None = None) -> DataFrame:
    """``points`` (key, point, x, y) with ``inside`` (by even-odd) and ``on`` an edge of the same key; points that
    lie beside all edges are left out. ``one`` may limit which edges count for a point (``p``, ``q``)."""
    box = {"left": F.min(_low("x")), "bottom": F.min(_low("y")), "right": F.max(_high("x")), "top": F.max(_high("y"))}
    grid = written(_grid(edges, key, box), "grid")
    rows = _in_rows(edges.join(grid, key)).drop("left", "right", "bottom", "top", "columns", "rows").alias("q")
    inside_box = (F.col("left") <= F.col("x")) & (F.col("x") <= F.col("right")) & (F.col("bottom") <= F.col("y")) & (F.col("y") <= F.col("top"))
    placed = points.join(grid, key).where(inside_box).withColumn("row", _place(F.col("y"), "bottom", "top", "rows"))
    placed = placed.drop("left", "right", "bottom", "top", "columns", "rows").alias("p")
    x, y = F.col("p.x"), F.col("p.y")
    level = _same("p", "q", [*key, "row"]) & (_low("y", "q.") <= y) & (y <= _high("y", "q.")) & (x <= _high("x", "q."))
    met = placed.join(rows, level if one is None else level & one)
    seen = met.select(
        *[F.col(f"p.{k}") for k in key], F.col("p.point").alias("point"), F.col("q.y1").alias("y1"), F.col("q.y2").alias("y2"),
        turn(*[f"q.{e}" for e in _ENDS], "p.x", "p.y").alias("t"), (_low("x", "q.") <= x).alias("within"), y.alias("y"))
    crosses = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("t") * F.signum(F.col("y2") - F.col("y1")) > 0)
    return seen.groupBy(*key, "point").agg(
        (F.count_if(crosses) % 2 == 1).alias("inside"), F.coalesce(F.bool_or((F.col("t") == 0) & F.col("within")), F.lit(False)).alias("on"))


def _first_points(rings: DataFrame, keep: list[str]) -> DataFrame:
    return rings.where("size(points) > 0").select(*keep, (F.col("points")[0]["x"] + 0.0).alias("x"), (F.col("points")[0]["y"] + 0.0).alias("y"))


def with_flag(rows: DataFrame, key: list[str], found: DataFrame, flag: str, known: Column) -> DataFrame:
    """``rows`` with ``flag``: whether the key is one of ``found``; null where ``known`` is false."""
    marked = found.select(*[F.col(k).alias(f"_{k}") for k in key], F.lit(True).alias("_marked"))
    joined = rows.join(marked, reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_{k}") for k in key]), "left")
    return joined.withColumn(flag, F.when(known, F.coalesce("_marked", F.lit(False)))).drop("_marked", *[f"_{k}" for k in key])


def intersecting(pairs: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """Keys of the pairs whose geometries ``a`` and ``b`` share any point, boundaries included.

    ``key`` is unique and not null. Missing and empty geometries share nothing.
    """
    rings = written(_sides(pairs, key, a, b), "rings")
    edges = written(ring_edges(rings, [*key, "side"]), "edges")
    hits = written(_touching(edges, key).select(*[F.col(f"p.{k}").alias(k) for k in key]).distinct(), "hits")
    # boundaries apart: then two parts meet only if one lies within the other
    shells = _first_points(rings.where("ring = 0"), [*key, "side", "part"]).join(hits, key, "left_anti")
    points = shells.select(*key, (1 - F.col("side")).alias("side"), F.col("part").alias("point"), "x", "y")
    inside = _located(points, edges, [*key, "side"]).where("inside").select(*key)
    return hits.unionByName(inside).distinct()


def _signed_area(points: Column) -> Column:
    """Twice the area of a ring, positive if it runs counter-clockwise; relative to its first point."""
    first = points[0]
    steps = F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points)), lambda a, b: (
        (a["x"] - first["x"]) * (b["y"] - first["y"]) - (b["x"] - first["x"]) * (a["y"] - first["y"])))
    return F.aggregate(steps, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))


def containing(pairs: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """Keys of the pairs in which every point of ``b`` lies in ``a`` (boundaries may coincide).

    That fails where edges cross inside both, where they share a stretch with the interiors on opposite sides,
    where a point of the boundary of ``b`` lies outside ``a``, and where one of a hole of ``a`` lies
    inside ``b``. ``key`` is unique and not null. Missing and empty geometries neither contain nor are contained.
    """
    sided = [*key, "side"]
    rings = written(_sides(pairs, key, a, b).withColumn("area", F.when(F.size("points") > 1, _signed_area(F.col("points")))), "rings")
    left = F.col("ring_left")
    marked = rings.withColumn("ring_left", (F.col("area") > 0) == (F.col("ring") == 0))
    edges = written(ring_edges(marked, sided).join(marked.select(*sided, "part", "ring", left), [*sided, "part", "ring"]), "edges")
    met = _touching(edges, key)
    px, py, qx, qy = (F.col(f"{s}.{v}2") - F.col(f"{s}.{v}1") for s in "pq" for v in "xy")
    ahead = px * qx + py * qy > 0
    apart = F.col("stretch") & (ahead != (F.col("p.ring_left") == F.col("q.ring_left")))
    place = ["part", "ring", "no"]
    met = written(met.select(
        *[F.col(f"p.{k}").alias(k) for k in key], *[F.col(f"q.{n}").alias(n) for n in place],
        (F.col("cross") | apart).alias("wrong"), "stretch"), "touching")
    wrong = met.where("wrong").select(*key).distinct()
    # boundary points of b: the start of each edge, and the middle of touched edges that run along none
    middles = met.groupBy(*key, *place).agg(F.bool_or("stretch").alias("along")).where("NOT along").drop("along")
    of_b = edges.where("side = 1")
    number = lambda kind: F.struct(F.lit(kind).alias("kind"), *_c(*place))
    points = of_b.select(*key, number(0).alias("point"), F.col("x1").alias("x"), F.col("y1").alias("y")).unionByName(
        of_b.join(middles, [*key, *place], "left_semi").select(
            *key, number(1).alias("point"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")))
    alone = _first_points(rings.where("side = 1"), [*key, *place[:2]]).join(of_b, [*key, *place[:2]], "left_anti")
    points = points.unionByName(alone.withColumn("no", F.lit(-1)).select(*key, number(2).alias("point"), "x", "y"))
    points = points.join(wrong, key, "left_anti")
    covered = _located(points, edges.where("side = 0").drop("side"), key).where("inside OR on")
    outside = points.join(covered.select(*key, "point"), [*key, "point"], "left_anti").select(*key)
    holes = edges.where("side = 0 AND ring > 0").select(*key, number(3).alias("point"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    filled = _located(holes.join(wrong, key, "left_anti"), of_b.drop("side"), key).where("inside AND NOT on").select(*key)
    failing = wrong.unionByName(outside).unionByName(filled).distinct()
    both = edges.groupBy(*key).agg(F.count_distinct("side").alias("n")).where("n = 2").drop("n")
    return both.join(failing, key, "left_anti")


# one geometry


def _broken(rings: DataFrame, key: list[str]) -> DataFrame:
    """Keys of rings that are not closed, not finite or have fewer than four points or three edges."""
    points = F.col("points")
    last = F.try_element_at(points, F.lit(-1))
    infinite = F.exists(points, lambda p: ~(_finite(p["x"]) & _finite(p["y"])))
    moves = F.zip_with(F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, F.lit(2), F.size(points)), lambda a, b: (
        (a["x"] != b["x"]) | (a["y"] != b["y"])))
    few = (F.size(points) < 4) | (F.size(F.filter(moves, lambda m: m)) < 3)
    closed = (points[0]["x"] == last["x"]) & (points[0]["y"] == last["y"])
    return rings.where("size(points) > 0").where(few | ~F.coalesce(closed, F.lit(False)) | infinite).select(*key).distinct()


def _cycles(touches: DataFrame, key: list[str]) -> DataFrame:
    """Keys in whose polygons rings and the points they touch in form a cycle, which cuts the interior.

    Rings and points with one touch left are taken away until nothing changes; what stays lies on a cycle.
    Each round is a stored table; touching rings are rare, and most tables need no round at all.
    """
    part = [*key, "part"]
    left = written(touches, "touches")
    count = left.count()
    while count:
        rings = left.groupBy(*part, "ring").count().where("count > 1").drop("count")
        points = left.groupBy(*part, "x", "y").count().where("count > 1").drop("count")
        left = written(left.join(rings, [*part, "ring"], "left_semi").join(points, [*part, "x", "y"], "left_semi"), "touches")
        count, before = left.count(), count
        if count == before:
            break
    return left.select(*key).distinct()


def invalid(shapes: DataFrame, key: list[str], geom: str) -> DataFrame:
    """Keys of the geometries that are not valid. Valid means: rings closed, finite and simple; rings of a polygon
    touch in single points and form no cycle with them; holes lie inside their shell and outside each
    other; polygons of one geometry lie apart. ``key`` is unique and not null. Empty and missing geometries are valid.
    """
    rings = written(ring_points(shapes.select(*key, geom), key, geom), "rings")
    broken = written(_broken(rings, key), "broken")
    points = F.col("points")  # without repeats of a point, so that edges are numbered without gaps
    rings = rings.join(broken, key, "left_anti").withColumn(
        "points", F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1))))
    numbered = ring_edges(rings, key)
    last = numbered.groupBy(*key, "part", "ring").agg(F.max("no").alias("last"))
    edges = written(numbered.join(last, [*key, "part", "ring"]), "edges")
    box = {"left": F.min(_low("x")), "bottom": F.min(_low("y")), "right": F.max(_high("x")), "top": F.max(_high("y"))}
    cells = _in_cells(edges.join(written(_grid(edges, key, box), "grid"), key))
    cells = cells.drop("left", "bottom", "right", "top", "columns", "rows")
    place = ["part", "ring", "no"]
    order = F.struct(*[F.col(f"p.{n}") for n in place]) < F.struct(*[F.col(f"q.{n}") for n in place])
    met = cells.alias("p").join(cells.alias("q"), _same("p", "q", [*key, "row", "column"]) & order).where(_meet("p", "q"))
    found = _with_turns(met).where("share")
    same_ring = _same("p", "q", ["part", "ring"])
    follows = (F.col("q.no") == F.col("p.no") + 1) | ((F.col("p.no") == 0) & (F.col("q.no") == F.col("q.last")))
    wrong = F.col("cross") | F.col("stretch") | (same_ring & ~follows)
    # a common point of two touching edges is an end of one of them
    options = [
        (F.col("q1") == 0, "p", "q", "1"), (F.col("q2") == 0, "p", "q", "2"), (F.col("p1") == 0, "q", "p", "1"), (F.col("p2") == 0, "q", "p", "2")]
    at = F.coalesce(*[
        F.when(in_line & _box_holds(other, own, n), F.struct(F.col(f"{own}.x{n}").alias("x"), F.col(f"{own}.y{n}").alias("y")))
        for in_line, other, own, n in options])
    found = written(found.select(
        *[F.col(f"p.{k}").alias(k) for k in key], wrong.alias("wrong"), same_ring.alias("same"), F.col("p.part").alias("part"),
        F.col("q.part").alias("part2"), F.col("p.ring").alias("ring"), F.col("q.ring").alias("ring2"), at.alias("at")), "meeting")
    crossing = found.where("wrong").select(*key).distinct()
    touches = found.where("NOT wrong AND NOT same AND part = part2").join(crossing, key, "left_anti")
    ends = F.explode(F.array("ring", "ring2"))
    cut = _cycles(touches.select(*key, "part", ends.alias("ring"), F.col("at.x").alias("x"), F.col("at.y").alias("y")).distinct(), key)
    misplaced = _misplaced(rings.join(crossing, key, "left_anti"), edges.join(crossing, key, "left_anti"), key)
    return broken.unionByName(crossing).unionByName(cut).unionByName(misplaced).distinct()


def _box_holds(edge: str, own: str, n: str) -> Column:
    x, y = F.col(f"{own}.x{n}"), F.col(f"{own}.y{n}")
    return (_low("x", f"{edge}.") <= x) & (x <= _high("x", f"{edge}.")) & (_low("y", f"{edge}.") <= y) & (y <= _high("y", f"{edge}."))


def _misplaced(rings: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """Keys with a shell inside another part, or a hole outside its shell or inside another hole.

    Rings do not cross here. A ring is judged by its points and edge middles that lie on no other ring: they are
    all on one side of any other ring.
    """
    several = rings.where("size(points) > 0").groupBy(*key).count().where("count > 1").select(*key)
    edges = written(edges.join(several, key, "left_semi"), "edges")
    shell = (F.col("ring") == 0).alias("shell")
    start = edges.select(*key, F.struct("part", "ring", "no", F.lit(0).alias("middle"), shell).alias("point"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    middle = edges.select(
        *key, F.struct("part", "ring", "no", F.lit(1).alias("middle"), shell).alias("point"),
        ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    points = start.unionByName(middle)
    own_part, own_ring = F.col("p.point.part") == F.col("q.part"), F.col("p.point.ring") == F.col("q.ring")
    counts = F.when(F.col("p.point.shell"), ~own_part).otherwise(own_part & ~own_ring)
    placed = _located(points, edges, key, counts)
    verdict = points.join(placed, [*key, "point"], "left").select(
        *key, "point", F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("on", F.lit(False)).alias("on"))
    # even-odd over the other rings of the part: a hole inside its shell only is inside, one also inside a hole is not
    return verdict.where((F.col("inside") == F.col("point.shell")) & ~F.col("on")).select(*key)
