"""Distances and travel speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, default: float | None = None) -> Column:
    """Great-circle kilometres; a missing coordinate gives ``default``."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    present = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    km = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    return F.when(present, km).otherwise(F.lit(default).cast("double"))


def geo_velocity(km: Column, minutes: Column, default: float | None = None) -> Column:
    """km/h between two events; ``default`` for a first event or no elapsed time."""
    return F.when(minutes > 0, km / (minutes / 60)).otherwise(F.lit(default).cast("double"))


def impossible_coordinates(lat: Column, lon: Column) -> Column:
    return (F.abs(lat) > 90) | (F.abs(lon) > 180)
