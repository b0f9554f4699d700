"""Per-group centre of a cloud of points: exact median, approximate median, mode, mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galepost.session import stage


def group_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent non-NULL value per group; ties go to the smallest value.

    Counting by (group, value) first keeps the final buffer at one row per group,
    however many values a group has.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value))).alias(value)
    )


# Of the sketch that brackets a median; its rank error is this share of a group at most.
ACCURACY = 10_000
# How far the bracket reaches to both sides, in errors of the sketch.
REACH = 4


def group_median(
    df: DataFrame, key: str, values: list[str], accuracy: int = ACCURACY, reach: float = REACH
) -> DataFrame:
    """Row count and exact interpolated median of each value column per key.

    The built-in aggregate holds all values of a group in one buffer; here no task ever
    does, whatever the group's size. One pass merges a sketch of bounded size per key, which
    brackets the middle; the other counts what lies below the bracket, and the few different
    values inside. Should a bracket miss, that key's whole range is counted. NaN ranks above
    every number, NULL is no value.
    """
    near = reach / accuracy
    ends = [max(0.0, 0.5 - near), min(1.0, 0.5 + near)]
    bounds = stage(
        df.groupBy(F.struct(F.col(key).alias("key")).alias("_k")).agg(
            F.count(F.lit(1)).alias("row_count"),
            *(F.count(value).alias(f"_n{i}") for i, value in enumerate(values)),
            *(
                F.percentile_approx(_number(F.col(value)), ends, accuracy).alias(f"_b{i}")
                for i, value in enumerate(values)
            ),
        ),
        "median-bounds",
    )
    found = stage(_middle(df, key, values, bounds), "medians")
    missed = F.lit(False)
    for i in range(len(values)):
        missed = missed | ((F.col(f"_n{i}") > 0) & F.col(f"_m{i}").isNull())
    if not found.filter(missed).isEmpty():
        everything = F.array(F.lit(float("-inf")), F.lit(float("inf")))
        open_bounds = found.filter(missed).select(
            "_k",
            "row_count",
            *(f"_n{i}" for i in range(len(values))),
            *(everything.alias(f"_b{i}") for i in range(len(values))),
        )
        again = _middle(df, key, values, stage(open_bounds, "median-misses"))
        found = found.filter(~missed).unionByName(again)
    return found.select(
        F.col("_k.key").alias(key),
        "row_count",
        *(F.col(f"_m{i}").alias(value) for i, value in enumerate(values)),
    )


def _number(value: Column) -> Column:
    """A double that orders as the value does; sketches do not order NaN."""
    number = value.cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def _middle(df: DataFrame, key: str, values: list[str], bounds: DataFrame) -> DataFrame:
    """``bounds`` with the medians ``_m0``, ...; NULL where a bracket does not hold it."""
    measures = F.array(
        *(
            F.struct(
                F.lit(i).alias("measure"),
                F.col(value).cast("double").alias("v"),
                F.col(f"_n{i}").alias("n"),
                F.col(f"_b{i}")[0].alias("low"),
                F.col(f"_b{i}")[1].alias("high"),
            )
            for i, value in enumerate(values)
        )
    )
    counted = (
        df.select(F.struct(F.col(key).alias("key")).alias("_k"), *values)
        .join(bounds.drop("row_count"), "_k")
        .select("_k", F.inline(measures))
        .filter(F.col("v").isNotNull() & (_number(F.col("v")) <= F.col("high")))
        # NULL stands for all that lies below.
        .withColumn("v", F.when(_number(F.col("v")) >= F.col("low"), F.col("v")))
        .groupBy("_k", "measure", "n", "v")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    so_far = (
        Window.partitionBy("_k", "measure")
        .orderBy(F.asc_nulls_first("v"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.withColumn("end", F.sum("rows").over(so_far))

    def at(rank: str, measure: int) -> Column:
        holds = f"measure = {measure} and {rank} < end and {rank} >= end - rows"
        return F.max(F.when(F.expr(holds), F.col("v")))

    medians = ranked.groupBy("_k").agg(
        *(
            (at("(n - 1) div 2", i) * 0.5 + at("n div 2", i) * 0.5).alias(f"_m{i}")
            for i in range(len(values))
        )
    )
    return bounds.join(medians, "_k", "left").drop(*(f"_b{i}" for i in range(len(values))))


def group_median_sketch(df: DataFrame, key: str, values: list[str], accuracy: int = 10_000):
    """Row count and approximate median per key from mergeable sketches of bounded size."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.percentile_approx(value, 0.5, accuracy).alias(value) for value in values),
    )


def group_mean(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Mean of each value column per key."""
    return df.groupBy(key).agg(*(F.avg(value).alias(value) for value in values))
