"""The pipeline end to end: load raw tables, build the models, run the checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from galepost.operators.checks import enforce
from galepost.operators.hubs import check_hubs, hub_reduction, relevant_prefixes, weather_hubs
from galepost.plans import marts, transform
from galepost.plans.quality import quality_report
from galepost.plans.staging import MODELS
from galepost.session import temporary_stages
from galepost.sources.csv_files import located_pings, pinged_prefixes, read_dataset
from galepost.sources.registry import CSV_DATASETS, DATASETS
from galepost.sources.tables import (
    append,
    create_raw_tables,
    create_requests,
    load_once,
    new_weather,
    pending_hubs,
    save_requests,
    save_table,
    save_view,
)
from galepost.sources.weather_json import (
    DEFAULT_END,
    DEFAULT_START,
    date_range,
    payload_days,
    weather_rows,
)


def load_csv(
    spark: SparkSession,
    database: str,
    paths: dict[str, str | list[str]],
    quoted_newlines: str = "join",
) -> dict[str, int]:
    """Fill the empty ones among the five CSV tables; returns rows loaded per table."""
    create_raw_tables(spark, database)
    loaded = {}
    with temporary_stages(spark):
        for name, dataset in CSV_DATASETS.items():
            valid, _ = read_dataset(spark, dataset, paths[name], quoted_newlines)
            loaded[name] = load_once(valid, f"{database}.{name}")
    return loaded


def plan_weather_requests(
    spark: SparkSession,
    database: str,
    start: date = DEFAULT_START,
    end: date = DEFAULT_END,
    granularity: str = "hub",
    batch_size: int = 100,
) -> DataFrame:
    """What is still to be fetched: batch_id, pos, latitude, longitude, first_day, last_day.

    The requests are stored, so that responses are matched with what was asked whatever has
    been loaded meanwhile. Batch ids are unique over all runs.
    """
    start, end = date_range(start, end)
    raw = {name: spark.table(f"{database}.{name}") for name in DATASETS}
    pings = located_pings(raw["geolocation"])
    relevant = relevant_prefixes(raw["customers"], raw["sellers"])
    hubs = weather_hubs(pings, relevant)
    check_hubs(hub_reduction(pinged_prefixes(raw["geolocation"]), relevant, hubs))
    with temporary_stages(spark):
        pending = pending_hubs(hubs, raw["weather"], start, end, granularity, batch_size)
        return save_requests(pending, start, end, database, batch_size)


def load_weather(spark: SparkSession, database: str, responses: DataFrame) -> int:
    """Append the usable days of landed responses; returns the rows loaded.

    ``responses`` has the batch_id of stored requests. A location and day that is stored, or
    comes twice, is loaded once, so responses may be loaded again.
    """
    days = payload_days(responses, spark.table(create_requests(spark, database)))
    weather = f"{database}.weather"
    return append(new_weather(weather_rows(days), spark.table(weather)), weather)


def build_models(spark: SparkSession, raw_database: str, database: str) -> dict[str, DataFrame]:
    """Staging views, then transform and mart tables, each rebuilt in full."""
    with temporary_stages(spark):
        return _build(spark, raw_database, database)


def _build(spark: SparkSession, raw_database: str, database: str) -> dict[str, DataFrame]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    models = {
        f"stg_{name}": save_view(model(spark.table(f"{raw_database}.{name}")), f"stg_{name}")
        for name, model in MODELS.items()
    }
    orders, customers = models["stg_orders"], models["stg_customers"]
    models["zip_centroid"] = save_table(
        transform.zip_centroid(models["stg_geolocation"]), f"{database}.zip_centroid"
    )
    models["weather_station_bridge"] = save_table(
        transform.weather_station_bridge(models["zip_centroid"], models["stg_weather"]),
        f"{database}.weather_station_bridge",
    )
    models["fact_delivery_weather"] = save_table(
        marts.fact_delivery_weather(
            orders,
            models["stg_order_items"],
            customers,
            models["stg_sellers"],
            models["weather_station_bridge"],
            models["stg_weather"],
        ),
        f"{database}.fact_delivery_weather",
    )
    models["dim_customer_geography"] = save_table(
        marts.dim_customer_geography(orders, customers),
        f"{database}.dim_customer_geography",
    )
    return models


def check_models(models: dict[str, DataFrame], raise_errors: bool = True) -> DataFrame:
    """The report over everything that was built; a failed check of severity error raises."""
    spark = next(iter(models.values())).sparkSession
    with temporary_stages(spark):
        found = quality_report(models)
        # One row per declared check.
        report = spark.createDataFrame(found.collect(), found.schema)
    return enforce(report) if raise_errors else report
