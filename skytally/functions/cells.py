"""Places as positions on a space-filling curve, so that an area is a few ranges of numbers.

The world is a grid of ``2**BITS`` by ``2**BITS`` cells of latitude and longitude. A cell's key
interleaves the bits of its row and its column (Z order): cells that share the first bits share
a square, and every square of the quadtree is one range of keys. A table whose files are ordered
by the key can then be searched by area: the scan skips what lies in no range.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytally.functions.geo import EARTH_RADIUS_M

BITS = 30
_SIDE = 1 << BITS
_MOST_CUT = 1024

# Shifts and masks that put a zero bit before each bit of a 32-bit number.
_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def _spread(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def _step(degrees: Column, low: float, width: float) -> Column:
    step = F.floor((degrees - low) / width * _SIDE).cast("bigint")
    return F.greatest(F.least(step, F.lit(_SIDE - 1)), F.lit(0))


def cell_of(lat, lon) -> Column:
    """The key of the cell a position lies in; null if it is no position on earth."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    row, column = _step(lat, -90.0, 180.0), _step(lon, -180.0, 360.0)
    key = F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column))
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), key)


def cell_of_point(location="location") -> Column:
    """The key of a GeoJSON point's cell."""
    coordinates = F.col(location)["coordinates"]
    return cell_of(F.get(coordinates, F.lit(1)), F.get(coordinates, F.lit(0)))


def _metres(lat1, lon1, lat2, lon2) -> float:
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((lat2 - lat1) / 2) ** 2
    h += math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


class _Square:
    """A square of the quadtree: its cells share the first ``2 * depth`` bits of their keys."""

    def __init__(self, key: int, depth: int):
        self.key, self.depth = key, depth

    def range(self) -> tuple[int, int]:
        free = 2 * (BITS - self.depth)
        return self.key << free, ((self.key + 1) << free) - 1

    def parts(self) -> list["_Square"]:
        return [_Square(4 * self.key + i, self.depth + 1) for i in range(4)]

    def reach(self, lat: float, lon: float) -> tuple[float, float]:
        """Bounds of the distances from a position to the points of the square."""
        row = column = 0
        for bit in range(self.depth):
            row |= (self.key >> (2 * bit + 1) & 1) << bit
            column |= (self.key >> (2 * bit) & 1) << bit
        height, width = 180 / (1 << self.depth), 360 / (1 << self.depth)
        south, west = row * height - 90, column * width - 180
        middle = _metres(lat, lon, south + height / 2, west + width / 2)
        # No point is farther from the middle than first along the meridian, then the parallel.
        widest = 0.0 if south < 0 < south + height else min(abs(south), abs(south + height))
        radius = EARTH_RADIUS_M * math.radians(height / 2 + width / 2 * math.cos(math.radians(widest)))
        return middle - radius, middle + radius


def cell_ranges(lat, lon, nearest: float, farthest: float, most=32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys that hold every position whose distance from a position
    is between ``nearest`` and ``farthest`` metres.

    Squares that may hold such positions and others are cut into four, all of one size at a
    time, until cutting would make too many ranges. Works across the date line and at the poles:
    distances to the squares are taken on the sphere.
    """
    if farthest < nearest or farthest < 0:
        return []
    slack = 1.0  # a metre, far above the rounding of the distances
    whole, edge = [], [_Square(0, 0)]
    while edge and edge[0].depth < BITS:
        inside, crossed = [], []
        for square in (part for one in edge for part in one.parts()):
            low, high = square.reach(lat, lon)
            if low >= nearest and high <= farthest:
                inside.append(square)
            elif low <= farthest + slack and high >= nearest - slack:
                crossed.append(square)
        if len(_joined([*whole, *inside, *crossed])) > most or len(crossed) > _MOST_CUT:
            break
        whole, edge = whole + inside, crossed
    return _joined([*whole, *edge])


def _joined(squares: list[_Square]) -> list[tuple[int, int]]:
    """The ranges of squares, with those that touch made one."""
    ranges = []
    for low, high in sorted(s.range() for s in squares):
        if ranges and ranges[-1][1] + 1 == low:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    return ranges


def in_ranges(ranges: list[tuple[int, int]], cell="cell") -> Column:
    """A condition that only compares the key with literals, so that it reaches the scan."""
    found = F.lit(False)
    for low, high in ranges:
        one = F.col(cell).between(low, high)
        found = one if low == ranges[0][0] else found | one
    return found
