from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """A longitude/latitude rectangle; its edges belong to it."""

    west: float
    south: float
    east: float
    north: float


def in_box(lon: str | Column, lat: str | Column, box: Box) -> Column:
    """True inside `box`, null when a coordinate is null (a filter then drops the row)."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    return lon.between(box.west, box.east) & lat.between(box.south, box.north)
