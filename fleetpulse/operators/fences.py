"""Many areas and many positions at once, by a grid of cells.

Positions and areas meet in an equal join on the cell, not in a comparison of each with each: an area is covered by the
cells it touches, and only in cells that its border runs through is a position tested exactly, against the edges of that
stretch of latitude. Stored by cell, positions of one area lie in few files, and a reader of an area opens only those.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from fleetpulse.functions import geo

#: Cells of all areas of one join, at most: what the driver works out and hands to the join.
MAX_CELLS = 100_000
#: Width of a cell, and of the folders of positions stored by cell, in degrees.
CELL, AREA = 0.1, 1.0
# How far a border is taken to reach, as a share of a cell: far more than rounding does.
_MARGIN = 0.001
_CELLS = "cell long, fence string, whole boolean, edges array<array<double>>"


def _number(x: float, low: float, size: float) -> int:
    return math.floor((x - low) / size)


def cell_of(longitude: Column, latitude: Column, size: float = CELL) -> Column:
    """The number of a position's cell: columns from west to east, in each the rows from south to north."""
    rows = math.ceil(180 / size) + 1
    column = F.floor((longitude + 180.0) / F.lit(size))
    return column * rows + F.floor((latitude + 90.0) / F.lit(size))


def cover(ring: geo.Ring, size: float = CELL) -> dict[tuple[int, int], list[tuple] | None]:
    """The cells (column, row) that an area touches: None for a cell that is inside as a whole, else the edges that can
    matter to a position in it."""
    rows = range(_number(min(y for _, y in ring), -90, size), _number(max(y for _, y in ring), -90, size) + 1)
    edges = [(*a, *b) for a, b in zip(ring, ring[1:])]
    margin, found = _MARGIN * size, {}
    for row in rows:
        south, north = row * size - 90 - margin, (row + 1) * size - 90 + margin
        band = [e for e in edges if min(e[1], e[3]) <= north and max(e[1], e[3]) >= south]
        border: set[int] = set()
        for x1, y1, x2, y2 in band:
            # The stretch of the edge within the band.
            ends = [0.0, 1.0]
            if y1 != y2:
                ends = sorted(min(1.0, max(0.0, (y - y1) / (y2 - y1))) for y in (south, north))
            west, east = sorted(x1 + t * (x2 - x1) for t in ends)
            border |= set(range(_number(west - margin, -180, size), _number(east + margin, -180, size) + 1))
        for column in range(min(border), max(border) + 1) if border else ():
            if column in border:
                east_of = column * size - 180 - margin
                found[column, row] = [e for e in band if max(e[0], e[2]) >= east_of]
            elif _inside((column + 0.5) * size - 180, (row + 0.5) * size - 90, band):
                found[column, row] = None
            if len(found) > MAX_CELLS:
                raise ValueError(f"more than {MAX_CELLS} cells; choose a larger size")
    return found


def _inside(x: float, y: float, edges: Iterable[tuple]) -> bool:
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for a, b, c, d in edges) % 2 == 1


def within_fences(located: DataFrame, fences: Mapping[str, geo.Ring], *, size: float = CELL) -> DataFrame:
    """One row for each position and area that it is in, with the area's name as `fence`; the same positions as
    positions.in_polygon gives for each area."""
    rows = math.ceil(180 / size) + 1
    table = []
    for name, ring in fences.items():
        table += [(c * rows + r, name, edges is None, edges) for (c, r), edges in cover(ring, size).items()]
        if len(table) > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells; choose a larger size")
    cells = located.sparkSession.createDataFrame(table, _CELLS)
    longitude, latitude = F.col("longitude"), F.col("latitude")
    met = located.withColumn("cell", cell_of(longitude, latitude, size)).join(cells, "cell")
    return met.filter(F.col("whole") | geo.crosses_odd(longitude, latitude, F.col("edges"))).select(*located.columns, "fence")


def _area(column: Column | int, row: Column | int) -> Column | str:
    return F.concat_ws("_", column, row) if isinstance(column, Column) else f"{column}_{row}"


def write_by_cell(located: DataFrame, path: str, *, size: float = CELL, area: float = AREA) -> None:
    """Positions in folders of `area` degrees, in order of their cells: rows are dealt by ranges, so that a busy place has
    as many files as its size asks for, and a file or row group holds neighbours."""
    longitude, latitude = F.col("longitude"), F.col("latitude")
    place = _area(F.floor((longitude + 180.0) / area), F.floor((latitude + 90.0) / area))
    placed = located.withColumns({"area": place, "cell": cell_of(longitude, latitude, size)})
    dealt = placed.repartitionByRange("area", "cell", longitude).sortWithinPartitions("area", "cell")
    dealt.drop("cell").write.mode("overwrite").partitionBy("area").parquet(path)


def read_fence(spark: SparkSession, path: str, schema: StructType, ring: geo.Ring, *, area: float = AREA) -> DataFrame:
    """Stored positions in one area, from the folders that it touches."""
    folders = [_area(c, r) for c, r in cover(ring, area)]
    stored = spark.read.schema(StructType([*schema.fields, StructField("area", StringType())])).parquet(path)
    near = stored.filter(F.col("area").isin(folders)).drop("area")
    return near.filter(geo.in_ring(F.col("longitude"), F.col("latitude"), ring))
