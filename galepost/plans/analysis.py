"""The analysis over the marts: is severe weather linked to late delivery?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galepost.functions.numeric import percent
from galepost.operators.metrics import (
    histogram,
    monthly_series,
    null_aware_rate,
    share_within,
)
from galepost.plans.transform import TOLERANCE_KM

LATE = "is_late_delivery"
# What the monthly series reads of the fact.
MONTHLY = ("order_purchase_timestamp", "order_id", LATE)


def read_model(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """A built model for analysis, under lower-case names; only ``columns`` are read if given.

    Two columns whose names differ only in case cannot both be kept, which is an error.
    """
    model = spark.table(table)
    names = [name.lower() for name in model.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names of {table} differ only in case")
    lower = model.toDF(*names)
    return lower if columns is None else lower.select(*(c.lower() for c in columns))


def late_rate_by_severe(fact: DataFrame, role: str) -> DataFrame:
    """Late rate with and without severe weather at one end, unknown weather apart."""
    return null_aware_rate(fact, f"{role}_had_severe_weather", LATE)


def headline_metrics(fact: DataFrame) -> DataFrame:
    """One row: orders, overall late rate, and per role the rates, ratio and excluded share."""

    def rows(condition: Column) -> Column:
        return F.count_if(condition)

    totals = [F.count(F.lit(1)).alias("orders"), rows(F.col(LATE)).alias("late_orders")]
    for role in ("destination", "origin"):
        severe = F.col(f"{role}_had_severe_weather")
        totals += [
            rows(severe).alias(f"{role}_severe"),
            rows(severe & F.col(LATE)).alias(f"{role}_severe_late"),
            rows(~severe).alias(f"{role}_calm"),
            rows(~severe & F.col(LATE)).alias(f"{role}_calm_late"),
            rows(severe.isNull()).alias(f"{role}_unknown"),
        ]
    columns = ["orders", percent(F.col("late_orders"), F.col("orders")).alias("late_rate_pct")]
    for role in ("destination", "origin"):
        severe = percent(F.col(f"{role}_severe_late"), F.col(f"{role}_severe"))
        calm = percent(F.col(f"{role}_calm_late"), F.col(f"{role}_calm"))
        columns += [
            calm.alias(f"{role}_calm_rate_pct"),
            severe.alias(f"{role}_severe_rate_pct"),
            F.try_divide(severe, calm).alias(f"{role}_ratio"),
            percent(F.col(f"{role}_unknown"), F.col("orders")).alias(f"{role}_excluded_pct"),
        ]
    return fact.agg(*totals).select(*columns)


def monthly_late_rate(fact: DataFrame) -> DataFrame:
    return monthly_series(fact, *MONTHLY)


def distance_histogram(bridge: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(bridge, "distance_km", bins)


def pct_within_tolerance(bridge: DataFrame) -> DataFrame:
    return share_within(bridge, "distance_km", TOLERANCE_KM, "pct_within_tolerance")
