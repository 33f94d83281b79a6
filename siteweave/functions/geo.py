"""Coordinates and geographic cells as column expressions.

The default cells are a hexagonal grid of this engine: axial coordinates on a local projection whose longitude scale is that
of the whole degree of latitude. Their ids and borders are not those of other grids, so candidates near borders differ from
theirs. ``cell`` may be replaced by any function of (latitude, longitude, level) to a string column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edge of a hexagon in km by level.
EDGE_KM = {"fine": 0.2008, "coarse": 0.5314}
KM_PER_DEGREE = 111.32
CellFunction = Callable[[Column, Column, str], Column]


def to_float(value: Column) -> Column:
    """A finite double, or null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def truncate3(value: Column) -> Column:
    """Cut to three decimals, toward zero."""
    return (value * 1000).cast("bigint") / 1000


def round_half_even(value: Column, digits: int) -> Column:
    """rint on the scaled value; decimal near-ties may differ by one unit from rounding the exact binary value."""
    return F.rint(value * float(10**digits)) / float(10**digits)


def coordinate_key(lat3: Column, lon3: Column) -> Column:
    """Both truncated coordinates with three decimals; empty unless both are there."""
    return F.when(lat3.isNotNull() & lon3.isNotNull(), F.format_string("%.3f,%.3f", lat3, lon3)).otherwise("")


def hex_cell(lat: Column, lon: Column, level: str) -> Column:
    """The id of the hexagon around the truncated point; null unless both coordinates are there."""
    lat3, lon3 = truncate3(lat), truncate3(lon)
    edge = EDGE_KM[level]
    band = F.floor(lat3)
    x = lon3 * F.cos(F.radians(band + 0.5)) * KM_PER_DEGREE
    y = lat3 * KM_PER_DEGREE
    q, r = (x * 0.5773502691896257 - y / 3.0) / edge, y * (2.0 / 3.0) / edge
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    cell_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    cell_r = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    parts = [F.lit(level[0]), band.cast("string"), cell_q.cast("bigint").cast("string"), cell_r.cast("bigint").cast("string")]
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws(":", *parts))
