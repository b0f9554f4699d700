"""Weather grid hubs: which locations to fetch weather for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.functions.numeric import percent, round_half_even
from galepost.operators.centroid import group_mean
from galepost.sources.weather_json import hub_identifier


class TooManyHubsError(ValueError):
    """More hubs than prefixes: the merging of equal positions went wrong."""


def relevant_prefixes(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct prefixes that occur as a customer's or a seller's."""
    prefix = "zip_code_prefix"
    both = customers.select(F.col("customer_zip_code_prefix").alias(prefix)).union(
        sellers.select(F.col("seller_zip_code_prefix").alias(prefix))
    )
    return both.filter(F.col(prefix).isNotNull()).distinct()


def relevant_pings(pings: DataFrame, relevant: DataFrame) -> DataFrame:
    """Pings of relevant prefixes."""
    return pings.join(relevant, "zip_code_prefix", "left_semi")


def prefix_means(pings: DataFrame, relevant: DataFrame) -> DataFrame:
    """Mean coordinate of each relevant prefix.

    Averaging first leaves one row per prefix to compare with the relevant ones.
    """
    means = group_mean(pings, "zip_code_prefix", ["lat", "lng"])
    return means.join(relevant, "zip_code_prefix", "left_semi")


def weather_hubs(pings: DataFrame, relevant: DataFrame) -> DataFrame:
    """One hub per distinct rounded mean position, named after its first prefix."""
    rounded = prefix_means(pings, relevant).select(
        "zip_code_prefix",
        round_half_even(F.col("lat"), 2).alias("lat"),
        round_half_even(F.col("lng"), 2).alias("lng"),
    )
    return (
        rounded.groupBy("lat", "lng")
        .agg(F.min("zip_code_prefix").alias("zip_code_prefix"))
        .select(
            "zip_code_prefix",
            "lat",
            "lng",
            hub_identifier(F.col("lat"), F.col("lng")).alias("hub_identifier"),
        )
    )


def hub_reduction(pinged: DataFrame, relevant: DataFrame, hubs: DataFrame) -> DataFrame:
    """One row: prefixes with pings, relevant prefixes, hubs and the saving in percent."""
    total = pinged.agg(F.count(F.lit(1)))
    return hubs.agg(F.count(F.lit(1)).alias("hubs")).select(
        total.scalar().alias("total_prefixes"),
        relevant.agg(F.count(F.lit(1))).scalar().alias("relevant_prefixes"),
        "hubs",
    ).withColumn(
        "reduction_pct",
        F.coalesce(
            percent(F.col("relevant_prefixes") - F.col("hubs"), F.col("relevant_prefixes")),
            F.lit(0.0),
        ),
    )


def check_hubs(reduction: DataFrame) -> DataFrame:
    """Stop if there are more hubs than relevant prefixes."""
    row = reduction.first()
    if row["hubs"] > row["relevant_prefixes"]:
        raise TooManyHubsError(
            f"{row['hubs']} hubs from {row['relevant_prefixes']} relevant prefixes"
        )
    return reduction
