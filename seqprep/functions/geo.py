"""Map-tile cell ids in plain column arithmetic.

A cell is the Web-Mercator tile that holds the point. The id packs zoom, x and y into one bigint;
0 means "no usable coordinate". These ids stand in for hexagonal grid ids: stable, categorical, and
of about the same area, but not equal to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from seqprep.functions.cleaning import finite_double

_MAX_LATITUDE = 85.0511


def tile_cell(latitude: Column, longitude: Column, zoom: int) -> Column:
    lat, lon = finite_double(latitude), finite_double(longitude)
    tiles = float(2**zoom)
    angle = F.radians(F.greatest(F.least(lat, F.lit(_MAX_LATITUDE)), F.lit(-_MAX_LATITUDE)))
    x = F.floor((lon + 180.0) / 360.0 * tiles)
    y = F.floor((1.0 - F.asinh(F.tan(angle)) / math.pi) / 2.0 * tiles)

    def edge(tile: Column) -> Column:
        return F.greatest(F.least(tile, F.lit(2**zoom - 1)), F.lit(0)).cast("bigint")

    cell = F.lit(zoom << 56).bitwiseOR(F.shiftleft(edge(x), 28)).bitwiseOR(edge(y))
    unusable = lat.isNull() | lon.isNull() | ((lat == 0.0) & (lon == 0.0))
    outside = (F.abs(lat) > 90.0) | (F.abs(lon) > 180.0)
    return F.when(unusable | outside, F.lit(0).cast("bigint")).otherwise(cell)
