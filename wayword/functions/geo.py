"""Distance on the globe."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: radius of the earth in kilometres.
EARTH_RADIUS_KM = 6371


def haversine_m(lat1: Column, lat2: Column, lon1: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between two points at the same height."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding may carry the chord of two antipodes past 1, where the square root would have no value.
    chord = F.when(chord > 1, 1.0).otherwise(chord)
    return 2 * F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * EARTH_RADIUS_KM * 1000
