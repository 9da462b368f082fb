"""Great-circle helpers as column expressions (radians, no earth radius)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Central angle in radians, 2*asin(sqrt(hav)); the root argument is
    clamped to 1 against rounding just above it.  NULL in, NULL out."""
    a = (F.pow(F.sin((lat2 - lat1) / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return F.when(a.isNotNull(), F.lit(2.0) * F.asin(F.sqrt(F.least(a, F.lit(1.0)))))

