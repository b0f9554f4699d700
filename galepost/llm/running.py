"""Order a table over all tasks and carry totals from one part to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def carried(parts: DataFrame, part: str, keys: list[str], totals: list[str]) -> DataFrame:
    """For each (part, keys) the sums of ``totals`` over the parts before, as ``before_*``.

    ``parts`` has one row per (part, keys), so a window sorts as many rows per key as there
    are parts, never the rows themselves.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    if keys:
        before = (
            Window.partitionBy(*keys)
            .orderBy(part)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
    return parts.select(
        part,
        *keys,
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in totals),
    )
