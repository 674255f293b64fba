"""Areas of interest: boxes, polygons and multipolygons as row filters."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from atlasmill.operators.proximity import _rings

#: A point whose cross product with an edge is smaller lies on the edge.
ON_EDGE = 1e-12


def box_area(south: float, west: float, north: float, east: float) -> dict:
    """A closed box; raises where bounds are out of range or out of order."""
    if not (-90 <= south <= north <= 90 and -180 <= west <= east <= 180):
        raise ValueError("box bounds must be ordered and within ±90 and ±180")
    return {"bounds": (south, west, north, east), "parts": None}


def polygon_area(geojson: str | dict) -> dict:
    """A Polygon or MultiPolygon (also as Feature or as a collection of exactly one); raises where a ring is open, short or out of range."""
    g = json.loads(geojson) if isinstance(geojson, str) else geojson
    if g.get("type") == "FeatureCollection":
        if len(g.get("features", [])) != 1:
            raise ValueError("a collection must hold exactly one feature")
        g = g["features"][0]
    g = g.get("geometry") if g.get("type") == "Feature" else g
    if not g or g.get("type") not in ("Polygon", "MultiPolygon"):
        raise ValueError("only Polygon and MultiPolygon are areas")
    for part in [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]:
        for ring in part:
            if len(ring) < 4 or ring[0] != ring[-1]:
                raise ValueError("a ring must be closed and have at least four points")
            if not all(-180 <= x <= 180 and -90 <= y <= 90 for x, y, *_ in ring):
                raise ValueError("a ring must lie within ±180 and ±90")
    parts = _rings(json.dumps(g))
    outer = np.vstack([rings[0] for rings in parts])
    (w, s), (e, n) = outer.min(axis=0), outer.max(axis=0)
    if w == e or s == n:
        raise ValueError("an area must have an extent")
    return {"bounds": (float(s), float(w), float(n), float(e)), "parts": parts}


def near_box(lat: float, lon: float, metres: float) -> dict:
    """The box around a point that holds everything within so many metres."""
    dy = metres / 111_320
    dx = dy / max(0.01, math.cos(math.radians(lat)))
    return box_area(max(-90, lat - dy), max(-180, lon - dx), min(90, lat + dy), min(180, lon + dx))


def _edges(ring: np.ndarray) -> Column:
    return F.array(*(F.struct(*(F.lit(float(v)).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), e))) for e in np.hstack([ring[:-1], ring[1:]])))


def _on(x: Column, y: Column, edges: Column) -> Column:
    def touch(e: Column) -> Column:
        cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
        return (F.abs(cross) < ON_EDGE) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return F.exists(edges, touch)


def _in(x: Column, y: Column, edges: Column) -> Column:
    def crossed(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"]) + e["x1"])

    return F.size(F.filter(edges, crossed)) % 2 == 1


def inside(area: dict, lat: Column, lon: Column) -> Column:
    """Whether a position lies in the area. Borders belong to it, and so do the borders of holes' outsides: a point on a hole's ring is out.

    The box is tested first as plain comparisons, which reach the Parquet scan. Null positions are outside.
    """
    s, w, n, e = area["bounds"]
    box = lat.between(s, n) & lon.between(w, e)
    if area["parts"] is None:
        return F.coalesce(box, F.lit(False))
    found = F.lit(False)
    for rings in area["parts"]:
        shell, holes = _edges(rings[0]), [_edges(r) for r in rings[1:]]
        hit = _on(lon, lat, shell) | _in(lon, lat, shell)
        for h in holes:
            hit = hit & ~(_on(lon, lat, h) | _in(lon, lat, h))
        found = found | hit
    return F.coalesce(box & found, F.lit(False))
