"""The datasets the pipeline knows: columns, types and required fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    """One raw table."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _text(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(column, T.StringType()) for column in columns])


# Column names, types and required fields of the raw tables. Codes
# stay text, so that leading zeros of postal prefixes survive.
ORDERS = Dataset(
    "orders",
    _text(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    required=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
)
ORDER_ITEMS = Dataset(
    "order_items",
    _text(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
)
CUSTOMERS = Dataset(
    "customers",
    _text(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
)
SELLERS = Dataset(
    "sellers",
    _text("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
)
GEOLOCATION = Dataset(
    "geolocation",
    _text(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
)
WEATHER = Dataset(
    "weather",
    T.StructType(
        [
            T.StructField("hub_identifier", T.StringType()),
            T.StructField("latitude", T.DecimalType(10, 6)),
            T.StructField("longitude", T.DecimalType(10, 6)),
            T.StructField("logistics_date", T.DateType()),
            T.StructField("temp_max_celsius", T.DecimalType(10, 2)),
            T.StructField("temp_min_celsius", T.DecimalType(10, 2)),
            T.StructField("precipitation_sum_mm", T.DecimalType(10, 2)),
            T.StructField("wind_speed_max_kmh", T.DecimalType(10, 2)),
        ]
    ),
)

CSV_DATASETS = {d.name: d for d in (ORDERS, ORDER_ITEMS, CUSTOMERS, SELLERS, GEOLOCATION)}
DATASETS = {**CSV_DATASETS, WEATHER.name: WEATHER}
