"""Points near other points, and the regions that contain them: cells of a space-filling curve, then exact refinement."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.geo import disc_codes, haversine_m, home_code, lonlat_cell, morton, ray_parity, usable

#: Cells by which one part of a region is covered, at most. More cells make fewer exact tests and more rows.
COVER_CELLS = 256


def near_pairs(points: DataFrame, key: str, lat: str, lon: str, radius_m: float) -> DataFrame:
    """key_a < key_b, distance_m of all pairs of points at most radius_m apart on the sphere.

    Every point has one home cell; its disc is covered by the few cells it touches, and the two are joined on the sorted cell
    codes. Two points in different cells see each other from both sides, so only the cover cells at or above the home code are kept.
    Rows whose position is null, out of range or 0/0 take no part; nor do null keys. Points at one place pair with each other. A key
    that occurs at several positions gives one row per pair of keys and distance. Empty input gives an empty result. Other columns
    are not looked at. The result is as large as the pairs are many: a place that holds m points has m(m-1)/2 of them.
    """
    own = points.select(F.col(key).alias("k"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    own = own.filter(F.col("k").isNotNull() & usable(F.col("y"), F.col("x")))
    home = own.withColumn("code", home_code(F.col("y"), F.col("x"), radius_m))
    a = home.withColumn("cell", F.explode(F.filter(disc_codes(F.col("y"), F.col("x"), radius_m), lambda c: c >= F.col("code"))))
    a = a.select("cell", F.col("code").alias("home_a"), F.col("k").alias("ka"), F.col("y").alias("ya"), F.col("x").alias("xa"))
    b = home.select(F.col("code").alias("cell"), F.col("k").alias("kb"), F.col("y").alias("yb"), F.col("x").alias("xb"))
    dlat = math.degrees(radius_m / 6371008.8) * 1.0001
    near = (
        a.join(b, "cell")
        .filter((F.col("home_a") < F.col("cell")) | (F.col("ka") < F.col("kb")))
        .filter(F.abs(F.col("ya") - F.col("yb")) <= dlat)
        .withColumn("distance_m", haversine_m(F.col("ya"), F.col("xa"), F.col("yb"), F.col("xb")))
        .filter((F.col("distance_m") <= radius_m) & (F.col("ka") != F.col("kb")))
    )
    return near.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"), "distance_m")


def _rings(geometry: str | None) -> list[list[np.ndarray]]:
    """Parts of a GeoJSON Polygon or MultiPolygon, each a list of closed rings (n x 2, lon/lat). Anything else has none."""
    try:
        g = json.loads(geometry or "null") or {}
        if g.get("type") == "Feature":
            g = g.get("geometry") or {}
        parts = {"Polygon": lambda c: [c], "MultiPolygon": list}.get(g.get("type"), lambda c: [])(g.get("coordinates") or [])
        out = []
        for part in parts:
            rings = [np.asarray([p[:2] for p in r], dtype=float) for r in part if len(r) >= 3]
            rings = [r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]]) for r in rings]
            if rings:
                out.append(rings)
        return out
    except (ValueError, TypeError, AttributeError, IndexError):
        return []


def _cover(rings: list[np.ndarray], cells: int) -> tuple[int, list[tuple[int, int, bool, list[dict]]]]:
    """Level and (x, y, whole, edges) of the cells of one part; edges are those an eastward ray from the cell can meet."""
    every = np.vstack([np.hstack([r[:-1], r[1:]]) for r in rings])
    segs = every[every[:, 1] != every[:, 3]]  # a ray to the east never crosses a level edge
    x0, y0, x1, y1 = *rings[0].min(axis=0), *rings[0].max(axis=0)
    level = 24
    while level > 0 and (math.floor((x1 - x0) / (360 / 2**level)) + 2) * (math.floor((y1 - y0) / (180 / 2**level)) + 2) > cells:
        level -= 2
    n, w, h = 2**level, 360 / 2**level, 180 / 2**level
    out = []
    lox, hix = np.minimum(every[:, 0], every[:, 2]), np.maximum(every[:, 0], every[:, 2])
    loy, hiy = np.minimum(every[:, 1], every[:, 3]), np.maximum(every[:, 1], every[:, 3])
    slox, shix = np.minimum(segs[:, 0], segs[:, 2]), np.maximum(segs[:, 0], segs[:, 2])
    sloy, shiy = np.minimum(segs[:, 1], segs[:, 3]), np.maximum(segs[:, 1], segs[:, 3])
    for cy in range(max(0, math.floor((y0 + 90) / h)), min(n - 1, math.floor((y1 + 90) / h)) + 1):
        b, t = -90 + cy * h, -90 + (cy + 1) * h
        row = (sloy <= t) & (shiy >= b)
        for cx in range(max(0, math.floor((x0 + 180) / w)), min(n - 1, math.floor((x1 + 180) / w)) + 1):
            left, right = -180 + cx * w, -180 + (cx + 1) * w
            touched = ((lox <= right) & (hix >= left) & (loy <= t) & (hiy >= b)).any()
            if touched:
                e = segs[row & (shix >= left)]
                out.append((cx, cy, False, [dict(zip(("x1", "y1", "x2", "y2"), map(float, s))) for s in e]))
            else:
                px, py = (left + right) / 2, (b + t) / 2
                up = (segs[:, 1] > py) != (segs[:, 3] > py)
                s = segs[up]
                if (px < s[:, 0] + (py - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1])).sum() % 2:
                    out.append((cx, cy, True, []))
    return level, out


def region_cover(regions: DataFrame, key: str, geometry: str, cells: int = COVER_CELLS) -> DataFrame:
    """region, level, cell (Z-order code), whole, edges: each part of each region as cells that are inside it or meet its border.

    Regions without a readable Polygon or MultiPolygon give no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, g in zip(batch["k"], batch["g"]):
                for rings in _rings(g):
                    level, found = _cover(rings, cells)
                    rows += [(k, level, x, y, whole, edges) for x, y, whole, edges in found]
            yield pd.DataFrame(rows, columns=["region", "level", "cx", "cy", "whole", "edges"])

    edge = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
    kind = regions.schema[key].dataType.simpleString()
    flat = regions.select(F.col(key).alias("k"), F.col(geometry).cast("string").alias("g")).filter("k is not null")
    out = flat.mapInPandas(run, f"region {kind}, level int, cx long, cy long, whole boolean, edges {edge}")
    return out.select("region", "level", morton(F.col("cx"), F.col("cy")).alias("cell"), "whole", "edges")


def containing_regions(points: DataFrame, key: str, lat: str, lon: str, cover: DataFrame) -> DataFrame:
    """key, region of the points inside regions covered by region_cover(); holes are outside, every part counts.

    The point's code at each level that the cover uses is merge-joined to the covering cells, which grow with the regions; points in border cells are then tested
    exactly by ray casting (half-open, so a point on a shared border is in one of the two). The levels, 13 at most, are the only
    thing brought to the driver. Unusable positions and null keys take no part.
    """
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())
    own = points.select(F.col(key).alias("key"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    own = own.filter(F.col("key").isNotNull() & usable(F.col("y"), F.col("x")))
    at = F.array(*(F.struct(F.lit(v).alias("level"), morton(*lonlat_cell(F.col("y"), F.col("x"), v)).alias("cell")) for v in levels)) if levels else F.lit(None).cast("array<struct<level:int,cell:bigint>>")
    own = own.select("key", "x", "y", F.inline(at))
    inside = own.join(cover.hint("merge"), ["level", "cell"]).filter(F.col("whole") | ray_parity(F.col("x"), F.col("y"), F.col("edges")))
    return inside.select("key", "region").distinct()
