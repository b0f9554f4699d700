"""Left join of rows to the daily facts inside each row's date window, aggregated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galepost.session import stage

# Aggregates for which a repeated day changes nothing.
IDEMPOTENT: dict[str, Callable[[str], Column]] = {
    "max": F.max,
    "min": F.min,
    "any": F.bool_or,
}


# A span of 2^LEVELS days is the longest that is summarised; longer windows take several.
LEVELS = 8
VALUE_COST = 4
# Days that a window's row in the join stands for.
BLOCK_DAYS = 32

_DAYS = "datediff(_last, _first) + 1"


def aggregate_windows(
    windows: DataFrame,
    facts: DataFrame,
    on: str,
    lo: str,
    hi: str,
    day: str,
    aggs: dict[str, tuple[str, str]],
    strategy: str = "auto",
) -> DataFrame:
    """Aggregates per distinct (on, lo, hi) window; one that meets no fact is absent or NULL.

    ``aggs`` maps an output name to (max | min | any, fact column). Windows repeat from
    row to row, so they are made distinct before the join; a hot key then costs
    as much as its different windows, not as its rows. Facts are reduced to one row per
    key and day. They are read once for their number and days, and once by the join.

    Windows are first cut to the days that facts cover, so a stray far-off date costs no
    more than the calendar. ``doubling`` looks a window up in a table of spans: of the
    largest power of two of days that fits, the span that starts with the window and the one
    that ends with it cover it, and a day that is in both changes nothing. ``explode`` turns
    a window into the blocks of ``BLOCK_DAYS`` days that it touches, and joins on key and
    block; its days are looked through where a block's facts are, so that few rows move.
    ``range`` does so with the months it touches. ``auto`` takes the table of spans where the
    windows have more days than it has values, and their blocks otherwise; a value of the
    table costs about as much as ``VALUE_COST`` days in the join.
    """
    columns = [on, lo, hi]
    known = windows.select(*columns).filter(F.col(on).isNotNull() & (F.col(lo) <= F.col(hi)))
    daily_values = [IDEMPOTENT[kind](source).alias(name) for name, (kind, source) in aggs.items()]
    daily = facts.groupBy(on, day).agg(*daily_values)
    size, first, last = facts.agg(F.count(F.lit(1)), F.min(day), F.max(day)).first()
    kinds = {name: kind for name, (kind, _) in aggs.items()}
    again = [IDEMPOTENT[kind](name).alias(name) for name, kind in kinds.items()]
    cut = (
        known.withColumns(
            {
                "_first": F.greatest(F.col(lo), F.lit(first).cast("date")),
                "_last": F.least(F.col(hi), F.lit(last).cast("date")),
            }
        )
        # sequence() counts downwards from a first day that lies after the last.
        .filter(F.col("_first") <= F.col("_last"))
    )
    levels = LEVELS
    if strategy in ("auto", "doubling"):
        longest, mean, different = cut.agg(
            F.expr(f"max({_DAYS})"), F.expr(f"avg({_DAYS})"), F.approx_count_distinct(F.struct(*columns))
        ).first()
        levels = min((longest or 1).bit_length() - 1, LEVELS)
        if strategy == "auto":
            values = (levels + 1) * size
            days = different * (mean or 0)
            strategy = "doubling" if days > VALUE_COST * values else "explode"
    if strategy == "doubling":
        matched = _look_up_spans(cut.distinct(), columns, daily, on, day, kinds, levels)
    elif strategy == "explode":
        block = f"floor(unix_date({{}}) / {BLOCK_DAYS})"
        ends = ", ".join(block.format(end) for end in ("_first", "_last"))
        # Both sides are dealt out by block once, and grouped and joined where they are.
        blocks = (
            cut.withColumn("_in", F.explode(F.expr(f"sequence({ends})")))
            .repartition(on, "_in")
            .distinct()
        )
        by_block = (
            facts.select(
                F.col(on).alias("_on"),
                F.expr(block.format(f"`{day}`")).alias("_block"),
                F.col(day).alias("_day"),
                *dict.fromkeys(source for _, source in aggs.values()),
            )
            .repartition("_on", "_block")
            .groupBy("_on", "_block", "_day")
            .agg(*daily_values)
        )
        matched = blocks.join(
            by_block,
            (F.col(on) == F.col("_on"))
            & (F.col("_in") == F.col("_block"))
            & F.col("_day").between(F.col("_first"), F.col("_last")),
        )
    elif strategy == "range":
        month = F.expr("sequence(trunc(_first, 'MM'), trunc(_last, 'MM'), interval 1 month)")
        months = cut.distinct().withColumn("_month", F.explode(month))
        by_month = daily.withColumn("_month", F.trunc(day, "MM")).withColumnRenamed(on, "_on")
        matched = months.withColumnRenamed("_month", "_in").join(
            by_month,
            (F.col(on) == F.col("_on"))
            & (F.col("_in") == F.col("_month"))
            & F.col(day).between(F.col("_first"), F.col("_last")),
        )
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return matched.groupBy(*columns).agg(*again)


def _look_up_spans(
    cut: DataFrame,
    columns: list[str],
    daily: DataFrame,
    on: str,
    day: str,
    kinds: dict[str, str],
    levels: int,
) -> DataFrame:
    """Each window with the spans that cover it: two, or one more for each 2^levels days."""
    starts = F.expr(
        "array_distinct(concat("
        "sequence(_lo, greatest(_lo, _hi + 1 - _days), _days), array(_hi + 1 - _days)))"
    )
    spans = (
        cut.withColumns(
            {
                "_level": F.least(F.floor(F.log2(F.expr(_DAYS))).cast("int"), F.lit(levels)),
                "_lo": F.unix_date("_first"),
                "_hi": F.unix_date("_last"),
            }
        )
        .withColumn("_days", F.expr("shiftleft(1, _level)"))
        .select(*columns, "_level", F.explode(starts).alias("_start"))
    )
    table = span_table(daily, on, day, kinds, levels)
    return spans.join(table, [on, "_start"]).select(
        *columns, F.inline(F.array(F.get("_spans", F.col("_level"))))
    )


def span_table(
    daily: DataFrame, on: str, day: str, kinds: dict[str, str], levels: int
) -> DataFrame:
    """For each key and day number ``_start`` with a fact less than 2^levels days ahead,
    ``_spans``: the aggregates of the spans of 1, 2, 4, ... days that start there.

    A span is made of two of half its length, so each level is one step over the same order;
    a key's rows are moved and sorted once. Days are filled in before a fact, not between far
    facts, so the table is bounded by the facts as well as by the calendar.
    """
    by_day = Window.partitionBy(on).orderBy("_start")
    known = daily.withColumn("_start", F.unix_date(day)).drop(day)
    earliest = F.col("_start") - (1 << levels) + 1
    empty_before = F.greatest(F.coalesce(F.lag("_start").over(by_day) + 1, earliest), earliest)
    table = (
        known.withColumn("_fact", F.col("_start"))
        .withColumn("_from", empty_before)
        .select(on, F.explode(F.sequence("_from", "_fact")).alias("_start"), "_fact", *kinds)
    )
    is_fact = F.col("_start") == F.col("_fact")
    values = F.struct(*(F.when(is_fact, F.col(name)).alias(name) for name in kinds))
    table = table.select(on, "_start", values.alias("_span0"))
    for level in range(levels):
        half = 1 << level
        # Rows that are not a day apart each have nothing between that a span could reach.
        is_there = F.lead("_start", half).over(by_day) == F.col("_start") + half
        table = table.withColumn(
            "_other", F.when(is_there, F.lead(f"_span{level}", half).over(by_day))
        )
        both = F.struct(
            *(
                (F.least if kind == "min" else F.greatest)(
                    F.col(f"_span{level}.{name}"), F.col(f"_other.{name}")
                ).alias(name)
                for name, kind in kinds.items()
            )
        )
        table = table.withColumn(f"_span{level + 1}", both).drop("_other")
    spans = F.array(*(f"_span{level}" for level in range(levels + 1)))
    return table.select(on, "_start", spans.alias("_spans"))


def attach_windows(
    left: DataFrame, summary: DataFrame, on: str, lo: str, hi: str, prefix: str = ""
) -> DataFrame:
    """Add window aggregates to every left row; NULL where no fact lies in the window.

    Rows that crowd on one window are split by the adaptive skew join.
    """
    keys = ["_on", "_lo", "_hi"]
    renamed = summary.toDF(*keys, *(prefix + name for name in summary.columns[3:]))
    same_window = (
        (F.col(on) == F.col("_on")) & (F.col(lo) == F.col("_lo")) & (F.col(hi) == F.col("_hi"))
    )
    return left.join(renamed, same_window, "left").drop(*keys)


def interval_agg_join(
    left: DataFrame,
    facts: DataFrame,
    on: str,
    lo: str,
    hi: str,
    day: str,
    aggs: dict[str, tuple[str, str]],
    strategy: str = "auto",
) -> DataFrame:
    """Left equi and date-interval join with aggregates; every left row stays."""
    summary = aggregate_windows(left, facts, on, lo, hi, day, aggs, strategy)
    return attach_windows(left, summary, on, lo, hi)
