"""Distances, space-filling-curve cells and polygon tests as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Radius of the sphere in metres.
RADIUS_M = 6371008.8
#: Beyond this latitude points are indexed on a plane around the pole, where meridians do not crowd.
CAP_DEG = 85.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2)
    )
    return F.lit(2 * RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def usable(lat: Column, lon: Column) -> Column:
    """Both set, within ±90 and ±180, not both 0. NaN is greater than any number and so falls out."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)), F.lit(False))


def _spread(x: Column) -> Column:
    """Put a zero bit between neighbouring bits of a number below 2^26: its binary digits read as digits to base 4.

    One reference to x, so nested codes stay small enough to be compiled.
    """
    return F.conv(F.bin(x.cast("long")), 4, 10).cast("long")


def morton(x: Column, y: Column) -> Column:
    """Z-order code of two cell numbers below 2^26."""
    return _spread(x) + _spread(y) * 2


def lonlat_cell(lat: Column, lon: Column, level: int | Column) -> tuple[Column, Column]:
    """Column and row of the 2^level x 2^level grid over ±180, ±90."""
    n = F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)
    top = n.cast("long") - 1
    x = F.least(F.greatest(F.floor((lon + 180) / 360 * n), F.lit(0)), top)
    y = F.least(F.greatest(F.floor((lat + 90) / 180 * n), F.lit(0)), top)
    return x.cast("long"), y.cast("long")


def disc_level(radius_m: float) -> int:
    """The finest level whose rows are at least two radii high, so that a disc touches at most two of them."""
    return max(1, min(25, math.floor(math.log2(math.pi * RADIUS_M / (2.0 * radius_m * 1.001)))))


def _cap_xy(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Metres on the plane around the nearer pole (azimuthal equidistant)."""
    r = F.lit(RADIUS_M) * F.radians(F.lit(90.0) - F.abs(lat))
    return r * F.cos(F.radians(lon)), r * F.sin(F.radians(lon))


def _cap_cells(v: Column, side: float) -> Column:
    return (F.floor(v / side) + 8192 * 512).cast("long")


def home_code(lat: Column, lon: Column, radius_m: float) -> Column:
    """Code of the cell that holds a point: chart (0 lon/lat grid, 1 north cap, 2 south cap) above the Z-order code."""
    level = disc_level(radius_m)
    x, y = lonlat_cell(lat, lon, level)
    px, py = _cap_xy(lat, lon)
    side = 2.0 * radius_m * 1.01
    cap = morton(_cap_cells(px, side), _cap_cells(py, side)) + F.when(lat > 0, F.lit(1)).otherwise(F.lit(2)) * F.lit(1 << 56)
    return F.when(F.abs(lat) > CAP_DEG, cap).otherwise(morton(x, y))


def disc_codes(lat: Column, lon: Column, radius_m: float) -> Column:
    """Codes of all cells that the disc of radius_m around a point can touch (array).

    On the lon/lat grid the half-width in longitude is that of the disc's bounding box, and columns wrap at ±180; next to a cap
    the cells of both charts are given. The planes of the caps stretch distances by less than 0.2 %, which the margin covers.
    """
    level = disc_level(radius_m)
    n = 1 << level
    dlat = math.degrees(radius_m / RADIUS_M) * 1.0001
    top = F.least(F.abs(lat) + dlat, F.lit(CAP_DEG + 2 * dlat))
    dlon = F.lit(dlat) / F.cos(F.radians(top)) * 1.001
    x0 = F.floor((lon - dlon + 180) / 360 * n).cast("long")
    x1 = F.floor((lon + dlon + 180) / 360 * n).cast("long")
    y0 = lonlat_cell(F.greatest(lat - dlat, F.lit(-90.0)), lon, level)[1]
    y1 = lonlat_cell(F.least(lat + dlat, F.lit(90.0)), lon, level)[1]
    grid = F.flatten(F.transform(F.sequence(y0, y1), lambda y: F.transform(F.sequence(x0, x1), lambda x: morton(F.pmod(x, F.lit(n)), y))))
    side, reach = 2.0 * radius_m * 1.01, radius_m * 1.005
    px, py = _cap_xy(lat, lon)
    chart = F.when(lat > 0, F.lit(1)).otherwise(F.lit(2)) * F.lit(1 << 56)
    cap = F.flatten(
        F.transform(
            F.sequence(_cap_cells(py - reach, side), _cap_cells(py + reach, side)),
            lambda y: F.transform(F.sequence(_cap_cells(px - reach, side), _cap_cells(px + reach, side)), lambda x: morton(x, y) + chart),
        )
    )
    return (
        F.when(F.abs(lat) < CAP_DEG - 2 * dlat, grid)
        .when(F.abs(lat) > CAP_DEG + 2 * dlat, cap)
        .otherwise(F.array_distinct(F.concat(grid, cap)))
    )


def ray_parity(lon: Column, lat: Column, edges: Column) -> Column:
    """True where an eastward ray from the point crosses an odd number of edges (array of x1, y1, x2, y2)."""
    crossed = F.filter(
        edges,
        lambda e: ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < e["x1"] + (lat - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])),
    )
    return F.size(crossed) % 2 == 1
