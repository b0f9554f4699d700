"""Declarative data checks: what must hold, and how many rows break it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailedError(AssertionError):
    """At least one check of severity ``error`` found offending rows."""


@dataclass(frozen=True)
class Check:
    """One check on a table; ``target`` is a column or an SQL expression.

    ``long_values`` is for a uniqueness check on values much longer than a hash: they are
    grouped only where two rows share one. It costs a second read of the table.
    """

    table: str
    kind: str
    target: str
    severity: str = "error"
    long_values: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.target}"


def broken(kind: str, value: Column) -> Column:
    """Condition that marks an offending row of a row-wise check."""
    if kind == "not_null":
        return value.isNull()
    if kind == "greater_than_zero":
        return (value <= 0) | value.isNull()
    raise ValueError(f"{kind!r} is no row-wise check")


def duplicates(df: DataFrame, target: str, long_values: bool = False) -> DataFrame:
    """Values that occur more than once; NULLs are no duplicates.

    Equal values have equal hashes. So where there are as many hashes as rows, no long value
    is moved.
    """
    values = df.select(F.expr(target).alias("value")).filter(F.col("value").isNotNull())
    if long_values:
        hashes = values.select(F.xxhash64("value").alias("hash"))
        different = hashes.distinct().agg(F.count(F.lit(1))).scalar()
        values = values.filter(hashes.agg(F.count(F.lit(1)) > different).scalar())
    return (
        values.groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def out_of_tolerance(bridge: DataFrame, limit: float = 0.10) -> DataFrame:
    """One row if the share of rows beyond tolerance exceeds the limit, else none."""
    totals = bridge.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("is_within_tolerance")).alias("out_of_tolerance_rows"),
    )
    share = F.try_divide(
        F.col("out_of_tolerance_rows").cast("double"), F.col("total_rows").cast("double")
    )
    return totals.withColumn("pct_out_of_tolerance", share).filter(share > limit)


def _result(check: Check, failures: Column) -> Column:
    status = F.when(failures == 0, "pass").otherwise(
        "warn" if check.severity == "warn" else "fail"
    )
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        status.alias("status"),
    )


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One result row per check.

    All row-wise checks of a table share one pass over it. A uniqueness check needs a
    grouping of its own, a coverage check its two totals.
    """
    parts = []
    for table, df in tables.items():
        mine = [check for check in checks if check.table == table]
        row_wise = [check for check in mine if check.kind in ("not_null", "greater_than_zero")]
        if row_wise:
            counts = df.agg(
                *(
                    F.count_if(broken(check.kind, F.expr(check.target))).alias(f"c{i}")
                    for i, check in enumerate(row_wise)
                )
            )
            parts.append(
                counts.select(
                    F.inline(
                        F.array(
                            *(_result(check, F.col(f"c{i}")) for i, check in enumerate(row_wise))
                        )
                    )
                )
            )
        for check in mine:
            if check.kind == "unique":
                found = duplicates(df, check.target, check.long_values)
            elif check.kind == "coverage":
                found = out_of_tolerance(df)
            else:
                continue
            counted = found.agg(F.count(F.lit(1)).alias("n"))
            parts.append(counted.select(F.inline(F.array(_result(check, F.col("n"))))))
    return reduce(DataFrame.unionAll, parts)


def enforce(report: DataFrame) -> DataFrame:
    """Raise when a check of severity ``error`` failed; warnings only report."""
    failed = report.filter(F.col("status") == "fail").collect()
    if failed:
        raise CheckFailedError(
            "; ".join(f"{r['table_name']} {r['check_name']}: {r['failures']}" for r in failed)
        )
    return report
