"""The checks declared on the models, and the report over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.operators.checks import Check, run_checks

VERSION_KEY = "concat(customer_unique_id, '|', cast(version_number as string))"

# Which columns of which model are checked for what.
NOT_NULL = {
    "stg_orders": ("order_id", "customer_id"),
    "stg_order_items": ("order_id", "seller_id"),
    "stg_customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix"),
    "stg_sellers": ("seller_id", "seller_zip_code_prefix"),
    "stg_geolocation": ("geolocation_zip_code_prefix",),
    "stg_weather": ("staging_weather_id", "station_id", "weather_date"),
    "zip_centroid": (
        "zip_code_prefix",
        "centroid_lat",
        "centroid_lng",
        "centroid_point",
        "ping_count",
        "state",
    ),
    "weather_station_bridge": (
        "zip_code_prefix",
        "station_id",
        "distance_km",
        "is_within_tolerance",
    ),
    "dim_customer_geography": ("customer_unique_id", "valid_from", "is_current"),
    "fact_delivery_weather": ("order_id",),
}
UNIQUE = {
    "stg_orders": ("order_id",),
    "stg_customers": ("customer_id",),
    "stg_sellers": ("seller_id",),
    "stg_weather": ("staging_weather_id",),
    "zip_centroid": ("zip_code_prefix",),
    "weather_station_bridge": ("zip_code_prefix",),
    "dim_customer_geography": (VERSION_KEY,),
    "fact_delivery_weather": ("order_id",),
}
# Columns whose values are longer than a hash.
DIGESTS = ("staging_weather_id",)

CHECKS = [
    *(Check(table, "not_null", column) for table, cs in NOT_NULL.items() for column in cs),
    *(
        Check(table, "unique", column, long_values=column in DIGESTS)
        for table, cs in UNIQUE.items()
        for column in cs
    ),
    Check("zip_centroid", "greater_than_zero", "ping_count"),
    Check("weather_station_bridge", "coverage", "is_within_tolerance", severity="warn"),
]


def columns_of(table: str) -> tuple[str, ...]:
    """Columns of a table whose checks are all on plain columns, as far as they are checked."""
    return tuple(dict.fromkeys(check.target for check in CHECKS if check.table == table))


def quality_report(
    tables: dict[str, DataFrame] | Callable[[str], DataFrame],
    kinds: tuple[str, ...] = (),
    only: tuple[str, ...] = (),
) -> DataFrame:
    """Results of all checks, or of those of the given kinds and on the given tables.

    ``tables`` may be a function that gives a table by name; it is asked for those only that
    a chosen check is on.
    """
    given = only or (tuple(NOT_NULL) if callable(tables) else tuple(tables))
    chosen = [c for c in CHECKS if c.table in given and (not kinds or c.kind in kinds)]
    find = tables if callable(tables) else tables.__getitem__
    wanted = dict.fromkeys(check.table for check in chosen)
    return run_checks({name: find(name) for name in wanted}, chosen)


def fact_row_count(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Reconciliation: the fact must have as many rows as there are orders."""
    expected = orders.agg(F.count(F.lit(1))).scalar()
    return fact.agg(F.count(F.lit(1)).alias("fact_rows")).select(
        "fact_rows",
        expected.alias("order_rows"),
        (F.col("fact_rows") == expected).alias("matches"),
    )
