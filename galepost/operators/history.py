"""Type-2 history from an event log: what changed, in which version, valid when.

Everything needs the events of one key in order. Events are dealt out once, by key. Where a
key has more events than a part should hold, it is cut at moments that a sample of the events
proposes, and dealt out by key and part; each part is worked on by itself, and a row for each
part of such a key carries the last state, the versions so far and the next version's start
across the borders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galepost.operators.rank import ordering_key
from galepost.session import stage

# Events that a part holds, about, and sampled events for each part.
PART_ROWS = 1 << 20
SAMPLED = 30


# How many of the sorted cuts a moment has passed, by halving what is left to search.
_CUTS_BEFORE = """
    aggregate(
        sequence(1, 32),
        named_struct('low', 0, 'high', size(_cuts)),
        (s, i) -> if(
            s.low = s.high, s,
            if(get(_cuts, int((s.low + s.high) div 2)) <= _moment,
               named_struct('low', int((s.low + s.high) div 2) + 1, 'high', s.high),
               named_struct('low', s.low, 'high', int((s.low + s.high) div 2)))),
        s -> s.low)
"""


def _changed(now: Column, before: Column, attrs: list[str]) -> Column:
    """NULL-safe: does any attribute differ between two state structs."""
    return reduce(
        Column.__or__, [~now[attr].eqNullSafe(before[attr]) for attr in attrs], F.lit(False)
    )


def versioned_events(
    events: DataFrame, key: str, attrs: list[str], ts: str, tie: str
) -> DataFrame:
    """Events with the state before them, whether they start a version, and its number.

    Adds ``previous`` (struct of key and attrs, NULL for a key's first event), ``is_start``
    and ``version_number``. The order is (ts, tie) ascending with NULLs last. Events
    without a key each start a version.
    """
    return _versioned(events, key, attrs, ts, tie).drop("_part", "_next_parts_start")


def _in_order(key: str, ts: str, tie: str):
    return Window.partitionBy(key, "_part").orderBy(F.asc_nulls_last(ts), F.asc_nulls_last(tie))


def _cut(events: DataFrame, key: str, ts: str, tie: str) -> tuple[DataFrame, DataFrame | None]:
    """``events`` with their ``_part``, and the cuts ``(_cut_key, _cuts)`` of the keys with
    several parts; None where there are so few events that none is cut.

    The sample is sorted by key and time; every part's share of it ends in a cut, so there is
    one for each part at most, whichever keys the events have.
    """
    rows = events.count()
    parts = -(-rows // PART_ROWS)
    if parts < 2:
        return events.withColumn("_part", F.lit(0)), None
    share = min(1.0, SAMPLED * parts / rows)
    moment = ordering_key(F.col(ts), F.col(tie)).alias("moment")
    sample = events.sample(share, seed=1).select(F.col(key).alias("_cut_key"), moment)
    in_order = Window.orderBy(F.asc_nulls_last("_cut_key"), "moment")
    cuts = stage(
        sample.withColumn("_at", F.row_number().over(in_order))
        .filter(F.col("_at") % SAMPLED == 0)
        .groupBy("_cut_key")
        .agg(F.array_sort(F.collect_set("moment")).alias("_cuts")),
        "history-cuts",
    )
    # One row a part at most.
    placed = events.join(
        F.broadcast(cuts), F.col(key).eqNullSafe(F.col("_cut_key")), "left"
    ).withColumn("_moment", moment)
    part = F.when(F.col("_cuts").isNull(), 0).otherwise(F.expr(_CUTS_BEFORE))
    return placed.withColumn("_part", part).drop("_cut_key", "_cuts", "_moment"), cuts


def _versioned(events: DataFrame, key: str, attrs: list[str], ts: str, tie: str) -> DataFrame:
    in_order = _in_order(key, ts, tie)
    # Counted, sampled and read.
    parted, cuts = _cut(stage(events, "history-events"), key, ts, tie)
    rows = parted.withColumns(
        {"_state": F.struct(key, *attrs), "_in_part": F.row_number().over(in_order)}
    ).withColumn("previous", F.lag("_state").over(in_order))
    if cuts is None:
        linked = rows.withColumns(
            {
                "_versions_before": F.lit(0).cast("long"),
                "_next_parts_start": F.when(F.lit(False), F.struct(F.col(ts).alias("at"))),
            }
        )
    else:
        linked = _join_borders(rows, cuts, key, attrs, ts)
    is_start = F.col(f"previous.{key}").isNull() | _changed(
        F.col("_state"), F.col("previous"), attrs
    )
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = linked.withColumn("is_start", is_start).withColumn(
        "version_number",
        F.sum(F.col("is_start").cast("long")).over(up_to_here) + F.col("_versions_before"),
    )
    return numbered.drop("_state", "_in_part", "_versions_before")


def _join_borders(
    rows: DataFrame, cuts: DataFrame, key: str, attrs: list[str], ts: str
) -> DataFrame:
    """Complete the first event of each part of a cut key from the parts before it."""
    inner_change = (F.col("_in_part") > 1) & (
        F.col(f"previous.{key}").isNull() | _changed(F.col("_state"), F.col("previous"), attrs)
    )
    at = F.struct(F.col(ts).alias("at"))
    of_cut_keys = rows.join(
        F.broadcast(cuts.select("_cut_key")), F.col(key).eqNullSafe(F.col("_cut_key")), "left_semi"
    )
    parts = of_cut_keys.groupBy(key, "_part").agg(
        F.min_by("_state", "_in_part").alias("first_state"),
        F.max_by("_state", "_in_part").alias("last_state"),
        F.min_by(at, "_in_part").alias("first_at"),
        F.count_if(inner_change).alias("inner_starts"),
        F.min_by(F.when(inner_change, at), F.when(inner_change, F.col("_in_part"))).alias(
            "inner_at"
        ),
    )
    by_part = Window.partitionBy(key).orderBy("_part")
    # Frames grow from the front: one that shrinks towards the end is evaluated anew per row.
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy(key)
        .orderBy(F.desc("_part"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    linked = parts.withColumn("last_before", F.lag("last_state").over(by_part)).withColumn(
        "opens",
        F.col(f"last_before.{key}").isNull()
        | _changed(F.col("first_state"), F.col("last_before"), attrs),
    )
    borders = linked.withColumn(
        "start_at", F.when(F.col("opens"), F.col("first_at")).otherwise(F.col("inner_at"))
    ).select(
        F.col(key).alias("_b_key"),
        F.col("_part").alias("_b_part"),
        "last_before",
        F.coalesce(
            F.sum(F.col("inner_starts") + F.col("opens").cast("long")).over(before), F.lit(0)
        ).alias("_b_versions"),
        F.last("start_at", ignorenulls=True).over(after).alias("_next_parts_start"),
    )
    # A row for each cut, and one more for each key with any: two rows a part at most.
    return (
        rows.join(
            F.broadcast(borders),
            F.col(key).eqNullSafe(F.col("_b_key")) & (F.col("_part") == F.col("_b_part")),
            "left",
        )
        .withColumn(
            "previous",
            F.when(F.col("_in_part") == 1, F.col("last_before")).otherwise(F.col("previous")),
        )
        .withColumn("_versions_before", F.coalesce(F.col("_b_versions"), F.lit(0)))
        .drop("_b_key", "_b_part", "last_before", "_b_versions")
    )


def scd2_from_events(
    events: DataFrame, key: str, attrs: list[str], ts: str, tie: str
) -> DataFrame:
    """One row per version: key, attrs, valid_from, valid_to, is_current, version_number.

    Validity is half open. Going back to an earlier state opens a new version.
    """
    starts = _versioned(events, key, attrs, ts, tie).filter("is_start")
    # Wrapped, so that a next version without a timestamp still counts as one.
    next_start = F.lead(F.struct(F.col(ts).alias("at"))).over(_in_order(key, ts, tie))
    return starts.withColumn(
        "valid_to", F.coalesce(next_start, F.col("_next_parts_start"))["at"]
    ).select(
        key,
        *attrs,
        F.col(ts).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        "version_number",
    )
