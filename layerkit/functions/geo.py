"""Point geography as two double columns: WKT text in/out and great-circle distance.

Distance is the haversine formula on a sphere. Fixed value: mean earth radius R = 6371008.8 m.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
METRES_PER_MILE = 1609
METRES_PER_KM = 1000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def wkt_point(lon, lat) -> Column:
    """``'Point(' || lon || ' ' || lat || ')'`` - longitude first."""
    return F.concat(F.lit("Point("), _c(lon).cast("string"), F.lit(" "), _c(lat).cast("string"), F.lit(")"))


_NUM = r"\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"


def parse_wkt_point(wkt) -> tuple[Column, Column]:
    """``to_geography('Point(lon lat)')`` -> (lon, lat) doubles; malformed text gives NULLs."""
    pat = r"(?i)^\s*point\s*\(" + _NUM + r"\s+" + _NUM.strip(r"\s*") + r"\s*\)\s*$"
    lon = F.regexp_extract(_c(wkt), pat, 1)
    lat = F.regexp_extract(_c(wkt), pat, 2)
    return (F.when(lon != "", lon.cast("double")), F.when(lat != "", lat.cast("double")))


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """``st_distance`` between two points, in metres."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))   # rounding may pass 1
