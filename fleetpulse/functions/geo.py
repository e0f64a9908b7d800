"""Planar point-in-area predicates on longitude/latitude columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]

def ring_from_wkt(wkt: str) -> Ring:
    """Outer ring of a 'POLYGON((lon lat, ...))' text as a closed list of (lon, lat)."""
    inner = re.fullmatch(r"\s*POLYGON\s*\(\(([^()]*)\)\)\s*", wkt, re.IGNORECASE)
    if inner is None:
        raise ValueError("expected POLYGON((lon lat, ...)) with one ring")
    ring = [(float(lon), float(lat)) for lon, lat in (pair.split() for pair in inner.group(1).split(","))]
    return ring if ring[0] == ring[-1] else [*ring, ring[0]]


def in_box(longitude: Column, latitude: Column, sw_lon: float, sw_lat: float, ne_lon: float, ne_lat: float) -> Column:
    """Inside or on the edge of a box; comparisons with literals, so a parquet scan can skip row groups by them."""
    return (longitude >= sw_lon) & (longitude <= ne_lon) & (latitude >= sw_lat) & (latitude <= ne_lat)


def in_ring(longitude: Column, latitude: Column, ring: Ring) -> Column:
    """Inside a polygon: an eastward ray crosses its edges an odd number of times. Cheap box test first.

    The edges are a literal array, so that the generated code does not grow with the ring.
    """
    lons, lats = [lon for lon, _ in ring], [lat for _, lat in ring]
    edges = list(zip(ring, ring[1:]))
    box = in_box(longitude, latitude, min(lons), min(lats), max(lons), max(lats))
    table = F.array(*[F.array(*map(F.lit, (*a, *b))) for a, b in edges])
    return box & crosses_odd(longitude, latitude, table)


def crosses_odd(longitude: Column, latitude: Column, edges: Column) -> Column:
    """Whether an eastward ray crosses an odd number of edges, given as an array of (lon, lat, lon, lat)."""
    crossings = F.aggregate(edges, F.lit(0), lambda n, e: n + _crosses(longitude, latitude, *[e[i] for i in range(4)]))
    return crossings % 2 == 1


def _crosses(lon: Column, lat: Column, lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    at = (lon_b - lon_a) * (lat - lat_a) / F.nullif(lat_b - lat_a, F.lit(0.0)) + lon_a
    return F.when(((lat_a > lat) != (lat_b > lat)) & (lon < at), 1).otherwise(0)
