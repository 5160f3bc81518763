"""Great-circle distance as plain column arithmetic (stays in whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in nautical miles used by the distance rule.
EARTH_RADIUS_NM = 3440.065


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in nautical miles.

    The term under the square root is clamped to 1.0: for near-antipodal pairs
    rounding can push it a hair above 1, where ``asin`` returns NaN and NaN
    would compare greater than any threshold. This is a deliberate deviation
    that only changes such pairs (they become ~10,800 nm, which every
    downstream plausibility filter drops anyway).
    """
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = (F.pow(F.sin(half_dlat), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2))
    # not least(): it skips nulls, and a missing coordinate must stay a missing distance
    clamped = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(EARTH_RADIUS_NM) * 2 * F.asin(F.sqrt(clamped))
