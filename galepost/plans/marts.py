"""Mart models: the delivery fact and the customer address history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.operators.history import scd2_from_events, versioned_events
from galepost.operators.interval import aggregate_windows, attach_windows
from galepost.operators.rank import first_by
from galepost.session import stage

WEATHER_AGGS = {
    "max_precipitation_mm": ("max", "precipitation_mm"),
    "max_wind_speed_kmh": ("max", "wind_speed_kmh"),
    "had_severe_weather": ("any", "severe_weather_flag"),
}
ADDRESS = ["customer_zip_code_prefix", "customer_city", "customer_state"]
PERSON = "customer_unique_id"

# Columns of the fact in order.
FACT_COLUMNS = (
    "order_id",
    "customer_id",
    "seller_id",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "is_late_delivery",
    "destination_station_id",
    "destination_distance_km",
    "destination_is_within_tolerance",
    "destination_max_precipitation_mm",
    "destination_max_wind_speed_kmh",
    "destination_had_severe_weather",
    "origin_station_id",
    "origin_distance_km",
    "origin_is_within_tolerance",
    "origin_max_precipitation_mm",
    "origin_max_wind_speed_kmh",
    "origin_had_severe_weather",
)


def first_seller_per_order(order_items: DataFrame) -> DataFrame:
    """Seller of the lowest item number; equal numbers go to the smaller seller id."""
    return first_by(order_items, ["order_id"], ["order_item_id", "seller_id"], ["seller_id"])


def _located(df: DataFrame, key: str, prefix_column: str, bridge: DataFrame, role: str):
    """Each party's station columns, named for its role."""
    stations = bridge.select(
        F.col("zip_code_prefix").alias(prefix_column),
        F.col("station_id").alias(f"{role}_station_id"),
        F.col("distance_km").alias(f"{role}_distance_km"),
        F.col("is_within_tolerance").alias(f"{role}_is_within_tolerance"),
    )
    return df.select(key, prefix_column).join(stations, prefix_column, "left").drop(prefix_column)


def orders_with_stations(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    bridge: DataFrame,
) -> DataFrame:
    """Orders with first seller, both stations and the days their weather counts.

    Parties get their station before they meet the orders, so the orders move only for
    the order, seller and customer keys. One row per distinct combination: a customer
    or seller with two stations gives two rows, plain duplicates collapse.
    """
    purchased = F.to_date("order_purchase_timestamp")
    delivered = F.to_date("order_delivered_customer_date")
    return (
        orders.select(*FACT_COLUMNS[:2], *FACT_COLUMNS[3:7])
        .join(first_seller_per_order(order_items), "order_id", "left")
        .join(
            _located(sellers, "seller_id", "seller_zip_code_prefix", bridge, "origin"),
            "seller_id",
            "left",
        )
        .join(
            _located(customers, "customer_id", "customer_zip_code_prefix", bridge, "destination"),
            "customer_id",
            "left",
        )
        .distinct()
        .withColumns(
            {"window_from": purchased, "window_to": F.coalesce(delivered, purchased)}
        )
    )


def fact_delivery_weather(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    bridge: DataFrame,
    weather: DataFrame,
    strategy: str = "auto",
) -> DataFrame:
    """One row per order with the weather at both ends during its delivery window.

    Weather depends only on station and window, so both roles' windows are pooled and
    summarised once. The located orders and the summary are written once, because both are
    read more than once.
    """
    located = stage(
        orders_with_stations(orders, order_items, customers, sellers, bridge), "located-orders"
    )
    roles = ("destination", "origin")
    windows = located.select(
        F.explode(F.array(*(F.col(f"{role}_station_id") for role in roles))).alias("station_id"),
        "window_from",
        "window_to",
    )
    summary = stage(
        aggregate_windows(
            windows,
            weather,
            "station_id",
            "window_from",
            "window_to",
            "weather_date",
            WEATHER_AGGS,
            strategy,
        ),
        "window-summary",
    )
    for role in roles:
        located = attach_windows(
            located, summary, f"{role}_station_id", "window_from", "window_to", f"{role}_"
        )
    return located.select(*FACT_COLUMNS)


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Address events: one per order with a known customer."""
    return orders.select("order_id", "customer_id", "order_purchase_timestamp").join(
        customers.select("customer_id", PERSON, *ADDRESS), "customer_id"
    ).drop("customer_id")


def address_events(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Every order with the person's address before it and the address version."""
    return versioned_events(
        customer_orders(orders, customers),
        PERSON,
        ADDRESS,
        "order_purchase_timestamp",
        "order_id",
    )


def dim_customer_geography(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Address history of every person, one row per version."""
    return scd2_from_events(
        customer_orders(orders, customers),
        PERSON,
        ADDRESS,
        "order_purchase_timestamp",
        "order_id",
    )


def version_counts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Number of address versions per person."""
    return (
        address_events(orders, customers)
        .groupBy(PERSON)
        .agg(F.count_if("is_start").alias("version_count"))
    )


def change_rate(counts: DataFrame) -> DataFrame:
    """One row: people with several versions, all people, and the share in percent."""
    return counts.agg(
        F.count_if(F.col("version_count") > 1).alias("customers_with_address_changes"),
        F.count(F.lit(1)).alias("total_customers"),
    ).withColumn(
        "change_pct",
        F.coalesce(
            F.try_divide(
                F.lit(100.0) * F.col("customers_with_address_changes"), F.col("total_customers")
            ),
            F.lit(0.0),
        ),
    )
