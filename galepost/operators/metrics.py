"""Summary metrics: rates that respect unknowns, monthly series, histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galepost.functions.numeric import percent


def null_aware_rate(df: DataFrame, flag: str, outcome: str) -> DataFrame:
    """Outcome rate (percent) and row count for flag true, false and unknown.

    Three rows always: a class without rows has rate 0, the unknown class has no rate.
    """
    known = F.col(flag).isNotNull()
    totals = df.agg(
        *(
            aggregate
            for name, value in (("no", False), ("yes", True))
            for aggregate in (
                F.count_if(F.col(flag) == value).alias(f"{name}_rows"),
                F.count_if((F.col(flag) == value) & F.col(outcome).isNotNull()).alias(
                    f"{name}_known"
                ),
                F.count_if((F.col(flag) == value) & F.col(outcome)).alias(f"{name}_hits"),
            )
        ),
        F.count_if(~known).alias("unknown_rows"),
    )

    def line(value: bool | None, rate: Column, rows: str) -> Column:
        return F.struct(
            F.lit(value).cast("boolean").alias(flag),
            rate.alias("rate_pct"),
            F.col(rows).alias("row_count"),
        )

    def rate(name: str) -> Column:
        return F.coalesce(percent(F.col(f"{name}_hits"), F.col(f"{name}_known")), F.lit(0.0))

    return totals.select(
        F.inline(
            F.array(
                line(False, rate("no"), "no_rows"),
                line(True, rate("yes"), "yes_rows"),
                line(None, F.lit(None).cast("double"), "unknown_rows"),
            )
        )
    )


def monthly_series(df: DataFrame, ts: str, counted: str, outcome: str) -> DataFrame:
    """Per calendar month: rows and outcome rate in percent; empty months are kept."""
    months = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.trunc(ts, "MM").alias("month"))
        .agg(
            F.count(counted).alias("order_count"),
            (F.avg(F.col(outcome).cast("double")) * 100.0).alias("late_rate_pct"),
        )
    )
    calendar = (
        months.agg(F.min("month").alias("first"), F.max("month").alias("last"))
        .filter(F.col("first").isNotNull())
        .select(F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month"))
    )
    return calendar.join(months, "month", "left").select(
        "month", F.coalesce("order_count", F.lit(0)).alias("order_count"), "late_rate_pct"
    )


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin includes the maximum.

    All values equal: the range is widened by half a unit to both sides. A value whose
    computed bin disagrees with the bin's edges by rounding moves to the neighbour.
    """
    limits = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    widened = F.col("lo") == F.col("hi")
    limits = limits.filter(F.col("lo").isNotNull()).select(
        F.when(widened, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(widened, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def edge(index: Column) -> Column:
        return F.when(index == bins, F.col("hi")).otherwise(index * width + F.col("lo"))

    x = F.col(value)
    guess = F.least(
        F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))),
        F.lit(bins - 1),
    )
    counts = (
        df.filter(x.isNotNull())
        .withColumns({"lo": lo, "hi": hi})
        .withColumn("guess", guess)
        .withColumn(
            "bin",
            F.when(x < edge(F.col("guess")), F.col("guess") - 1)
            .when(
                (x >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1
            )
            .otherwise(F.col("guess")),
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))
    frame = limits.withColumn("bin", F.explode(numbers))
    return frame.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("bin_lo"),
        edge(F.col("bin") + 1).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def share_within(df: DataFrame, value: str, limit: float, name: str) -> DataFrame:
    """Percent of rows with value at or below the limit; a missing value counts as beyond."""
    within = F.coalesce(F.col(value) <= limit, F.lit(False))
    return df.agg((F.avg(within.cast("double")) * 100.0).alias(name))
