"""Coordinate rules."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _c

GOLDEN_ANGLE = math.pi * (3 - math.sqrt(5))


def spiral_point(
    lat: Column | str,
    lon: Column | str,
    index: Column | str,
    step: float = V.SPIRAL_STEP_METRES,
    decimals: int = V.COORDINATE_DECIMALS,
) -> tuple[Column, Column]:
    """Latitude and longitude of the ``index``-th point on a golden-angle spiral."""
    lat, lon, index = _c(lat), _c(lon), _c(index)
    radius = F.sqrt(index) * step
    angle = index * F.lit(GOLDEN_ANGLE)
    north = radius * F.cos(angle) / V.METRES_PER_DEGREE
    east = radius * F.sin(angle) / (F.cos(F.radians(lat)) * V.METRES_PER_DEGREE)
    return F.round(lat + north, decimals), F.round(lon + east, decimals)
