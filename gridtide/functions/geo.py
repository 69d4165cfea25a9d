"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius per unit; an unknown unit means kilometres.
EARTH_RADIUS = {"km": 6371.0, "mi": 3959.0}


def haversine(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "km", axis_order: str = "lat_lon"
) -> Column:
    """Distance between two points given in degrees.

    `axis_order="legacy"` swaps the axes, for results comparable with data made that way.
    """
    if axis_order == "legacy":
        lat1, lon1, lat2, lon2 = lon1, lat1, lon2, lat2
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((p2 - p1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    radius = EARTH_RADIUS.get(unit, EARTH_RADIUS["km"])
    return F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * F.lit(2 * radius)
