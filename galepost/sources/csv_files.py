"""Tolerant reading of landed CSV files."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from galepost.functions.text import clean_text, column_name, parse_number
from galepost.session import stage
from galepost.sources.registry import Dataset


class MissingColumnsError(ValueError):
    """A file lacks a header row or columns its dataset needs."""


class QuotedNewlineError(ValueError):
    """A file has a field that runs over several lines, and those are not to be read."""


# A field as the rest of a line: quoted to its end, plain, or empty. Quantifiers keep what they
# took, so a line is gone through once.
_QUOTED = '[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = f'(?:"{_QUOTED}|[^",][^,]*+|)'
_ENDS_OUTSIDE = f"^{_FIELD}(?:,{_FIELD})*+$"
_CLOSES = f"^{_QUOTED}(?:,{_FIELD})*+$"


def _landed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with its file, block and place, and whether it ends inside a quoted field:
    if it starts outside one, and if it starts inside. A quote opens a field only at its start.
    """
    has_quote = F.contains("value", F.lit('"'))
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Grows along a block.
        F.monotonically_increasing_id().alias("place"),
        "value",
    ).withColumns(
        {
            "from_outside": F.when(has_quote, ~F.rlike("value", F.lit(_ENDS_OUTSIDE))).otherwise(False),
            "from_inside": F.when(has_quote, ~F.rlike("value", F.lit(_CLOSES))).otherwise(True),
        }
    )


def _with_state(rows: DataFrame, fixed: Column, flips: Column, window: WindowSpec) -> DataFrame:
    """``rows`` with ``flipped``, the flips up to each, and ``known``, the state after it.

    A row fixes the state (to ``fixed``, if that is not NULL), flips it or keeps it. Up to the
    first that fixes it, the state depends on the start, and ``known`` is NULL.
    """
    last = F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("to"), "flipped")), True)
    return (
        rows.withColumn("flipped", F.sum(flips.cast("int")).over(window))
        .withColumn("last", last.over(window))
        .withColumn(
            "known", F.col("last.to") != ((F.col("flipped") - F.col("last.flipped")) % 2 == 1)
        )
        .drop("last")
    )


def _joined_records(lines: DataFrame) -> DataFrame:
    """``(file, block, place, value)``: the records of files with fields over several lines.

    Each block of a file is gone through by itself. What it does to the state it starts in is
    one row, and those rows, in order, give every block's start; so a file is read in as many
    tasks as it has blocks, and only lines of records that are cut are brought together.
    """
    in_block = Window.partitionBy("file", "block").orderBy("place")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    flips = F.col("from_outside") & ~F.col("from_inside")
    is_odd = F.col("flipped") % 2 == 1
    marked = _with_state(lines, fixed, flips, so_far)
    blocks = marked.groupBy("file", "block").agg(
        F.max_by("known", "place").alias("fixed"), F.max_by(is_odd, "place").alias("odd")
    )
    by_block = Window.partitionBy("file").orderBy("block")
    up_to_here = by_block.rowsBetween(Window.unboundedPreceding, 0)
    flips_block = F.col("odd") & F.col("fixed").isNull()
    # A file starts outside.
    ends = _with_state(blocks, F.col("fixed"), flips_block, up_to_here).select(
        "file", "block", F.coalesce("known", is_odd).alias("end")
    )
    starts = ends.select("file", "block", F.lag("end", 1, False).over(by_block).alias("start"))
    end = F.coalesce("known", F.col("start") != is_odd)
    states = stage(
        marked.join(starts, ["file", "block"])
        .withColumn("ends_inside", end)
        .withColumn(
            "goes_on", F.coalesce(F.lag("ends_inside").over(in_block), F.col("start"))
        )
        .select("file", "block", "place", "value", "goes_on", "ends_inside"),
        "csv-lines-with-states",
    )
    whole = states.filter(~F.col("goes_on") & ~F.col("ends_inside"))
    cut = states.filter(F.col("goes_on") | F.col("ends_inside"))
    at = F.struct("block", "place")
    # A record is named by its first line, which may lie in an earlier block.
    first = F.last(F.when(~F.col("goes_on"), at), True)
    latest = cut.groupBy("file", "block").agg(
        F.max(F.when(~F.col("goes_on"), at)).alias("latest")
    )
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("file", "block", F.last("latest", True).over(before).alias("carried"))
    joined = (
        cut.join(carried, ["file", "block"])
        .withColumn("first", F.coalesce(first.over(so_far), F.col("carried")))
        .groupBy("file", "first")
        .agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("parts"))
        .select("file", "first.*", F.array_join("parts.value", "\n").alias("value"))
    )
    return whole.select("file", "block", "place", "value").unionByName(joined)


def landed_groups(
    spark: SparkSession, paths: str | list[str], quoted_newlines: str = "join"
) -> list[DataFrame]:
    """The files by header, each group as text columns under its own normalised names.

    For equal names the last column wins. Files are read once, as lines and in splits.
    ``quoted_newlines="join"`` puts the lines of a field with line breaks together again;
    ``"refuse"`` raises if there is one. What reaches the driver is the different headers, not
    the files.
    """
    if quoted_newlines not in ("join", "refuse"):
        raise ValueError(f"unknown way with quoted newlines {quoted_newlines!r}")
    lines = stage(_landed_lines(spark, paths), "csv-lines")
    opened = lines.filter("from_outside").select("file").distinct()
    columns = ["file", "block", "place", "value"]
    if opened.isEmpty():
        records = lines.select(*columns)
    elif quoted_newlines == "refuse":
        raise QuotedNewlineError(f"a quoted field runs over several lines in {paths}")
    else:
        opened = stage(opened, "csv-files-with-breaks")
        records = lines.select(*columns).join(opened, "file", "left_anti").unionByName(
            stage(_joined_records(lines.join(opened, "file", "left_semi")), "csv-records")
        )
    records = records.filter(F.trim("value") != "")
    headers = stage(
        records.groupBy("file").agg(F.min(F.struct("block", "place", "value")).alias("header")),
        "csv-headers",
    )
    # An empty file has no line; only Spark's listing knows it, which stays where it is.
    listed = len(spark.read.text(paths)._jdf.inputFiles())
    if headers.count() < listed:
        raise MissingColumnsError(f"no header row in {paths}")
    texts = sorted(row[0] for row in headers.select("header.value").distinct().collect())
    return [_read_group(records, headers, len(texts), text) for text in texts]


def _read_group(records: DataFrame, headers: DataFrame, groups: int, header: str) -> DataFrame:
    lines = header.removeprefix("\ufeff").splitlines(keepends=True)
    names = next(csv.reader(lines))
    schema = ", ".join(f"c{position} string" for position in range(len(names)))
    own = headers.filter(F.col("header.value") == header) if groups > 1 else headers
    is_header = (F.col("block") == F.col("header.block")) & (F.col("place") == F.col("header.place"))
    rows = (
        records.join(own, "file")
        .filter(~is_header)
        .select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("row"))
    )
    position_of = {column_name(name): position for position, name in enumerate(names)}
    return rows.select(
        *(F.col(f"row.c{position}").alias(name) for name, position in position_of.items())
    )


def read_landed_csv(
    spark: SparkSession, paths: str | list[str], quoted_newlines: str = "join"
) -> DataFrame:
    """All groups together; a column that a group lacks is NULL in its rows."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        landed_groups(spark, paths, quoted_newlines),
    )


def select_expected(landed: DataFrame, expected: list[str]) -> DataFrame:
    """Pick the dataset's columns by name; extra columns are ignored."""
    missing = [column for column in expected if column not in landed.columns]
    if missing:
        raise MissingColumnsError("missing expected columns: " + ", ".join(missing))
    return landed.select(*expected)


def clean_columns(df: DataFrame) -> DataFrame:
    """Null tokens to NULL in every column."""
    return df.select(*(clean_text(F.col(column)).alias(column) for column in df.columns))


def split_required(df: DataFrame, required: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rejected rest."""
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    return df.filter(complete), df.filter(~complete)


def reject_counts(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """One row: how many rows are kept and how many lack which required field."""
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    return df.agg(
        F.count_if(complete).alias("loaded_rows"),
        F.count_if(~complete).alias("skipped_rows"),
        *(F.count_if(F.col(column).isNull()).alias(f"null_{column}") for column in required),
    )


def read_dataset(
    spark: SparkSession,
    dataset: Dataset,
    paths: str | list[str],
    quoted_newlines: str = "join",
) -> tuple[DataFrame, DataFrame]:
    """Cleaned (valid, rejected) rows of one CSV dataset; every file must have its columns."""
    landed = reduce(
        DataFrame.unionByName,
        [
            select_expected(group, dataset.columns)
            for group in landed_groups(spark, paths, quoted_newlines)
        ],
    )
    return split_required(clean_columns(landed), dataset.required)


def pinged_prefixes(geolocation: DataFrame) -> DataFrame:
    """Prefixes with a ping whose fields are all filled, readable as numbers or not."""
    fields = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")
    filled = geolocation.select(*(clean_text(F.col(f)).alias(f) for f in fields)).dropna()
    return filled.select(F.col(fields[0]).alias("zip_code_prefix")).distinct()


def located_pings(geolocation: DataFrame) -> DataFrame:
    """Pings whose prefix and coordinates are present and readable as numbers."""
    return geolocation.select(
        clean_text(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        parse_number(clean_text(F.col("geolocation_lat"))).alias("lat"),
        parse_number(clean_text(F.col("geolocation_lng"))).alias("lng"),
    ).dropna()
