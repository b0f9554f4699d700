"""Row choice and positions by an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galepost.session import stage


def ordering_key(*columns: Column) -> Column:
    """Struct that compares like ``ORDER BY columns`` ascending with NULLs last."""
    fields = []
    for position, column in enumerate(columns):
        fields += [column.isNull().alias(f"null{position}"), column.alias(f"value{position}")]
    return F.struct(*fields)


def first_by(
    df: DataFrame, keys: list[str], order: list[str], keep: list[str]
) -> DataFrame:
    """Each group's first row by ``order`` (ascending, NULLs last).

    An aggregate rather than a ranked window: every task reduces its rows to one per
    group before the shuffle, so a group of any size is cheap. What is kept and ordered by
    moves once: it is read back from the least ordering key.
    """
    ordering = ordering_key(*(F.col(c) for c in order))
    if set(keep) <= set(order):
        kept = [F.col(f"winner.value{order.index(column)}").alias(column) for column in keep]
        return df.groupBy(*keys).agg(F.min(ordering).alias("winner")).select(*keys, *kept)
    winner = F.min_by(F.struct(*keep), ordering)
    return df.groupBy(*keys).agg(winner.alias("winner")).select(*keys, "winner.*")


def in_parts(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in parts that follow each other in ``order``; ``_part`` numbers them.

    Parts are cut by a sample of the rows, so they are about equally large whichever keys
    the rows have; a key with many rows spans several parts. Rows that agree in all of
    ``order`` share a part.
    """
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    return stage(dealt, label)


def ordered_position(df: DataFrame, code: str, position: str) -> DataFrame:
    """Number the rows from zero in order of a text code, without one task seeing them all.

    Rows are numbered inside each part of the order; the part sizes, one row each, are
    summed up to offsets.
    """
    order = F.asc_nulls_last(code)
    rows = in_parts(df, [order], "ordered-position")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy(order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside) - F.lit(1))
        .join(offsets, "_part")
        .withColumn(position, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_part", "_offset", "_inside")
    )
