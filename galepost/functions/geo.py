"""Geographic columns: points, distances and distance bounds in kilometres."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in kilometres.
EARTH_RADIUS_KM = 6371.0088


def make_point(lng: Column, lat: Column) -> Column:
    """Point struct, longitude first; NULL unless both coordinates are usable."""
    usable = lng.isNotNull() & lat.isNotNull() & lat.between(-90.0, 90.0) & ~F.isnan(lng)
    return F.when(usable, F.struct(lng.alias("lng"), lat.alias("lat")))


def haversine_sql(lat_a: str, lng_a: str, lat_b: str, lng_b: str) -> str:
    return f"""
        {2.0 * EARTH_RADIUS_KM}D * asin(least(1.0D, sqrt(
            power(sin(radians({lat_b} - {lat_a}) / 2), 2)
            + cos(radians({lat_a})) * cos(radians({lat_b}))
              * power(sin(radians({lng_b} - {lng_a}) / 2), 2))))
    """


def haversine_km(lat_a: str, lng_a: str, lat_b: str, lng_b: str) -> Column:
    """Great-circle distance on the sphere between two named pairs of columns."""
    return F.expr(haversine_sql(lat_a, lng_a, lat_b, lng_b))


def distance_sql(lat_a: str, lng_a: str, lat_b: str, lng_b: str) -> str:
    return f"round({haversine_sql(lat_a, lng_a, lat_b, lng_b)}, 6)"


def distance_km(lat_a: str, lng_a: str, lat_b: str, lng_b: str) -> Column:
    """Distance rounded to the millimetre, so that ranking does not hang on the last bit."""
    return F.expr(distance_sql(lat_a, lng_a, lat_b, lng_b))


def box_floor_sql(lat: str, lng: str, south: str, north: str, west: str, east: str) -> str:
    """A distance that no point of the latitude/longitude box can undercut.

    Going north or south costs at least the latitude gap. Reaching the box's nearer
    meridian costs at least the cross-track distance, which stops growing once the
    meridian is a quarter turn away (the way then leads over the pole).
    """
    inside = f"pmod({lng} - {west}, 360.0D) <= {east} - {west}"
    turn = f"least(pmod({west} - {lng}, 360.0D), pmod({lng} - {east}, 360.0D), 90.0D)"
    lng_gap = f"radians(if({inside}, 0.0D, {turn}))"
    return f"""
        {EARTH_RADIUS_KM}D * greatest(
            radians(greatest(0.0D, {south} - {lat}, {lat} - {north})),
            asin(least(1.0D, cos(radians({lat})) * sin({lng_gap}))))
    """


def box_distance_floor_km(
    lat: str, lng: str, south: str, north: str, west: str, east: str
) -> Column:
    """The same of named columns."""
    return F.expr(box_floor_sql(lat, lng, south, north, west, east))
