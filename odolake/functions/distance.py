"""Distances between two points, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Degrees are scaled by 1000; mean Earth radius in km.
SCALE = 1000.0
EARTH_RADIUS_KM = 6371.0


def euclidean(lat1: Column, lon1: Column, lat2: Column, lon2: Column, scale: float = SCALE) -> Column:
    dlat, dlon = lat2 - lat1, lon2 - lon1
    return F.sqrt(dlon * dlon + dlat * dlat) * F.lit(scale)


def manhattan(lat1: Column, lon1: Column, lat2: Column, lon2: Column, scale: float = SCALE) -> Column:
    return (F.abs(lon2 - lon1) + F.abs(lat2 - lat1)) * F.lit(scale)


def minkowski(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, p: float = 3, scale: float = SCALE
) -> Column:
    """Distance of order ``p``; 1 is Manhattan and 2 is Euclidean."""
    if p == 1:
        return manhattan(lat1, lon1, lat2, lon2, scale)
    if p == 2:
        return euclidean(lat1, lon1, lat2, lon2, scale)
    order = F.lit(float(p))
    total = F.pow(F.abs(lon2 - lon1), order) + F.pow(F.abs(lat2 - lat1), order)
    return F.pow(total, F.lit(1.0 / p)) * F.lit(scale)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km of points given in degrees."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
