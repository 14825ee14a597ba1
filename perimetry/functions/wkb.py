"""Well-known binary, the interchange form of geometries at the table boundary."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perimetry.schema import GEOM_TYPE
from perimetry.sources.shapefile import geometry_array

# Fixed values of the format.
_LITTLE = b"\x01"
_POLYGON, _MULTIPOLYGON = 3, 6


def encode(polygons: list[list[np.ndarray]]) -> bytes:
    """One polygon as POLYGON, several as MULTIPOLYGON, none as an empty POLYGON."""
    pieces = [
        b"".join(
            [_LITTLE, struct.pack("<II", _POLYGON, len(rings))]
            + [struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings]
        )
        for rings in polygons or [[]]
    ]
    if len(pieces) == 1:
        return pieces[0]
    return _LITTLE + struct.pack("<II", _MULTIPOLYGON, len(pieces)) + b"".join(pieces)


def decode(data: bytes) -> list[list[np.ndarray]]:
    """Polygons of a POLYGON or MULTIPOLYGON in either byte order."""

    def header(at: int) -> tuple[str, int, int]:
        order = "<" if data[at] == 1 else ">"
        return (order, *struct.unpack_from(order + "II", data, at + 1))

    def polygon(at: int) -> tuple[list[np.ndarray], int]:
        order, kind, number = header(at)
        if kind != _POLYGON:
            raise ValueError(f"geometry type {kind} is no polygon")
        rings, at = [], at + 9
        for _ in range(number):
            points = struct.unpack_from(order + "I", data, at)[0]
            rings.append(np.frombuffer(data, order + "f8", 2 * points, at + 4).reshape(points, 2).astype(float))
            at += 4 + 16 * points
        return rings, at

    _, kind, number = header(0)
    if kind != _MULTIPOLYGON:
        rings, _ = polygon(0)
        return [rings] if rings else []
    polygons, at = [], 9
    for _ in range(number):
        rings, at = polygon(at)
        polygons.append(rings)
    return polygons


def decode_array(data: pa.Array) -> pa.Array:
    """Nested geometry array of an array of WKB."""
    return geometry_array([None if d is None else decode(d) for d in data.to_pylist()])


@F.arrow_udf(T.BinaryType())
def to_wkb(geom: pa.Array) -> pa.Array:
    """WKB of a polygon geometry."""
    parts = geom.flatten()
    rings = parts.flatten()
    points = rings.flatten()
    xy = np.column_stack([c.to_numpy(zero_copy_only=False) for c in points.flatten()])

    def bounds(lists: pa.Array) -> list[int]:
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return [0, *np.cumsum(sizes).tolist()]

    of_row, of_part, of_ring = bounds(geom), bounds(parts), bounds(rings)
    all_rings = [xy[a:b] for a, b in zip(of_ring, of_ring[1:])]
    all_parts = [all_rings[a:b] for a, b in zip(of_part, of_part[1:])]
    missing = geom.is_null().to_pylist()
    out = [None if m else encode(all_parts[a:b]) for m, a, b in zip(missing, of_row, of_row[1:])]
    return pa.array(out, pa.binary())


@F.arrow_udf(GEOM_TYPE)
def from_wkb(data: pa.Array) -> pa.Array:
    """Polygon geometry of WKB."""
    return decode_array(data)
