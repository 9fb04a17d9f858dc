"""Point-in-box test and centre distance (plain degrees, no latitude correction)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def in_box(lon, lat, min_lon, min_lat, max_lon, max_lat) -> Column:
    """Both ends inclusive. A box with min > max (one crossing the antimeridian) holds nothing."""
    lon, lat = as_col(lon), as_col(lat)
    return (
        (as_col(min_lat) <= lat)
        & (lat <= as_col(max_lat))
        & (as_col(min_lon) <= lon)
        & (lon <= as_col(max_lon))
    )


def centre_distance(lon, lat, c_lon, c_lat) -> Column:
    """Euclidean distance in degrees between a point and a box centre."""
    dlat = as_col(c_lat) - as_col(lat)
    dlon = as_col(c_lon) - as_col(lon)
    return F.sqrt(dlat * dlat + dlon * dlon)
