"""Staging models: rename, cast and flag the raw tables. Nothing is stored or dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galepost.functions.geo import make_point

# A day is severe strictly above either limit.
SEVERE_PRECIPITATION_MM = 20.0
SEVERE_WIND_KMH = 40.0


def is_late(delivered: Column, estimated: Column) -> Column:
    """Two-valued: an order without a delivery is not late."""
    return F.when(delivered > estimated, True).otherwise(False)


def is_severe(precipitation_mm: Column, wind_kmh: Column) -> Column:
    """Two-valued: a day without measures is not severe."""
    beyond = (precipitation_mm > SEVERE_PRECIPITATION_MM) | (wind_kmh > SEVERE_WIND_KMH)
    return F.when(beyond, True).otherwise(False)


def _cast(column: str, to: str) -> Column:
    """Strict cast: a value that does not fit fails the query."""
    return F.col(column).cast(to).alias(column)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp())


def stg_orders(raw: DataFrame) -> DataFrame:
    moments = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    typed = raw.select(
        "order_id",
        "customer_id",
        "order_status",
        *(_cast(moment, "timestamp_ntz") for moment in moments),
    )
    late = is_late(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return _stamped(typed.withColumn("is_late_delivery", late))


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            "order_id",
            _cast("order_item_id", "int"),
            "product_id",
            "seller_id",
            _cast("shipping_limit_date", "timestamp_ntz"),
            _cast("price", "double"),
            _cast("freight_value", "double"),
        )
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            "customer_id",
            "customer_unique_id",
            _cast("customer_zip_code_prefix", "string"),
            "customer_city",
            "customer_state",
        )
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            "seller_id", _cast("seller_zip_code_prefix", "string"), "seller_city", "seller_state"
        )
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return _stamped(
        raw.select(
            _cast("geolocation_zip_code_prefix", "string"),
            _cast("geolocation_lat", "double"),
            _cast("geolocation_lng", "double"),
            "geolocation_city",
            "geolocation_state",
        )
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    warmest, coldest = (
        F.col(c).cast("double") for c in ("temp_max_celsius", "temp_min_celsius")
    )
    rain, wind = (
        F.col(c).cast("double") for c in ("precipitation_sum_mm", "wind_speed_max_kmh")
    )
    lat, lng = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    # The key is built from the untrimmed identifier; concat, unlike concat_ws, keeps NULL.
    row_key = F.concat(
        F.col("hub_identifier"), F.lit("_"), F.col("logistics_date").cast("string")
    )
    return _stamped(
        raw.select(
            F.md5(row_key).alias("staging_weather_id"),
            F.trim("hub_identifier").alias("station_id"),
            lat.alias("station_lat"),
            lng.alias("station_lng"),
            make_point(lng, lat).alias("station_point"),
            F.col("logistics_date").cast("date").alias("weather_date"),
            warmest.alias("max_temp_c"),
            coldest.alias("min_temp_c"),
            ((warmest + coldest) / 2.0).alias("avg_temp_c"),
            rain.alias("precipitation_mm"),
            wind.alias("wind_speed_kmh"),
            is_severe(rain, wind).alias("severe_weather_flag"),
        )
    )


MODELS = {
    "orders": stg_orders,
    "order_items": stg_order_items,
    "customers": stg_customers,
    "sellers": stg_sellers,
    "geolocation": stg_geolocation,
    "weather": stg_weather,
}
