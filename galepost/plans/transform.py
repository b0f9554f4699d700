"""Transform models: prefix centroids and the bridge to the nearest weather station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.functions.geo import make_point
from galepost.operators.centroid import (
    group_median,
    group_median_sketch,
    group_mode,
)
from galepost.operators.nearest import nearest_join

# Default state of a prefix, and how far a station may be, inclusive.
UNKNOWN_STATE = "UNKNOWN"
TOLERANCE_KM = 50.0


def _pings(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("centroid_lat"),
        F.col("geolocation_lng").alias("centroid_lng"),
        F.col("geolocation_state").alias("state"),
    )


def zip_ping_count(geolocation: DataFrame) -> DataFrame:
    return _pings(geolocation).groupBy("zip_code_prefix").agg(
        F.count(F.lit(1)).alias("ping_count")
    )


def zip_state_mode(geolocation: DataFrame) -> DataFrame:
    return group_mode(_pings(geolocation), ["zip_code_prefix"], "state")


def zip_centroid(geolocation: DataFrame, exact: bool = True) -> DataFrame:
    """Median position, ping count and most frequent state of every prefix with pings."""
    pings = _pings(geolocation)
    axes = ["centroid_lat", "centroid_lng"]
    centres = (
        group_median(pings, "zip_code_prefix", axes)
        if exact
        else group_median_sketch(pings, "zip_code_prefix", axes)
    )
    states = group_mode(pings, ["zip_code_prefix"], "state")
    return centres.join(states, "zip_code_prefix", "left").select(
        "zip_code_prefix",
        *axes,
        make_point(F.col("centroid_lng"), F.col("centroid_lat")).alias("centroid_point"),
        F.col("row_count").alias("ping_count"),
        F.coalesce("state", F.lit(UNKNOWN_STATE)).alias("state"),
    )


def distinct_stations(weather: DataFrame) -> DataFrame:
    """Stations once each instead of once per day."""
    return weather.select("station_id", "station_point").distinct()


def weather_station_bridge(centroid: DataFrame, weather: DataFrame) -> DataFrame:
    """The closest station of every prefix, however far; tolerance is only a flag."""
    matched = nearest_join(
        centroid.select("zip_code_prefix", "centroid_point"),
        distinct_stations(weather),
        left_point="centroid_point",
        right_id="station_id",
        right_point="station_point",
        id_name="station_id",
        distance_name="distance_km",
    )
    return matched.select(
        "zip_code_prefix",
        "station_id",
        "distance_km",
        (F.col("distance_km") <= TOLERANCE_KM).alias("is_within_tolerance"),
    )
