"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance between two points given in degrees."""

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians(a - b) / 2), F.lit(2.0))

    chord = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    # Rounding may lift the chord of opposite points just above 1, where asin has no value.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
