"""Raw and model tables: creation, load-once and resumable appends."""

from __future__ import annotations

import re
import time
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from galepost.operators.rank import first_by, ordered_position
from galepost.sources.registry import DATASETS

# What is asked of the weather source: one row per batch, place in it and range of days.
REQUESTS = (
    "batch_id string, pos int, latitude double, longitude double, first_day date, last_day date"
)
# The state of each load of a raw table: started, then done.
LOADS = "table_name string, attempt string, state string"
# How long a replaced build of a model stays for those who read it.
RETENTION = timedelta(days=1)


def create_raw_tables(spark: SparkSession, database: str) -> None:
    """Create the database and its raw tables where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for dataset in DATASETS.values():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dataset.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{dataset.name} ({columns}) USING parquet"
        )


def append(df: DataFrame, table: str, overwrite: bool = False) -> int:
    """Write by column name in one job; returns the rows written."""
    counted = Observation()
    target = df.sparkSession.table(table).columns
    rows = df.select(*target).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.insertInto(table, overwrite=overwrite)
    return counted.get["n"]


def _record(spark: SparkSession, log: str, table: str, attempt: str, state: str) -> None:
    row = spark.createDataFrame([(table, attempt, state)], LOADS)
    row.write.insertInto(log)


def load_once(df: DataFrame, table: str) -> int:
    """Fill an empty table; a filled one is left alone and 0 returned.

    A load is recorded when it starts and when it is complete. If one started and never
    completed, what it left is replaced by the next; rows that no load accounts for were put
    there by someone else and stay.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    log = f"{database}.load_log" if database else "load_log"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {log} ({LOADS}) USING parquet")
    states = {
        row["state"]
        for row in spark.table(log).filter(F.col("table_name") == name).select("state").distinct().collect()
    }
    if "done" in states or not states and not spark.table(table).isEmpty():
        return 0
    attempt = uuid.uuid4().hex
    _record(spark, log, name, attempt, "started")
    loaded = append(df, table, overwrite=True)
    _record(spark, log, name, attempt, "done")
    return loaded


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Staging models stay views: nothing is stored."""
    df.createOrReplaceTempView(name)
    return df


def save_table(df: DataFrame, table: str, retention: timedelta = RETENTION) -> DataFrame:
    """Rebuild a transform or mart model in full and publish it when it is complete.

    Each build is a table of its own, named by its start; readers go through a view that is
    moved to the new one in one step. A build goes when the one after it is older than
    ``retention``: until then a reader that started before may still be at it, and so may
    another rebuild whose view is not moved yet.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    build = f"{name}__{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    prefix = f"{database}." if database else ""
    df.write.saveAsTable(prefix + build)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {prefix}{build}")
    oldest = time.time_ns() - int(retention.total_seconds() * 1e9)
    builds = _builds(spark, table)
    for old, next_start in zip(builds, list(builds.values())[1:], strict=False):
        if next_start < oldest and old != build:
            spark.sql(f"DROP TABLE IF EXISTS {prefix}{old}")
    return spark.table(table)


def _builds(spark: SparkSession, table: str) -> dict[str, int]:
    """The builds of a model that are still there, and when they started, in order."""
    database, _, name = table.rpartition(".")
    within = f" IN {database}" if database else ""
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES{within} LIKE '{name}__*'").collect()]
    found = [re.fullmatch(f"{name}__([0-9]{{20}})_[0-9a-f]{{8}}", n) for n in names]
    return dict(sorted((m[0], int(m[1])) for m in found if m))


def create_requests(spark: SparkSession, database: str) -> str:
    """The table of weather requests, made where it does not exist yet."""
    table = f"{database}.weather_requests"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({REQUESTS}) USING parquet")
    return table


def save_requests(
    pending: DataFrame, start: date, end: date, database: str, batch_size: int
) -> DataFrame:
    """Number what is pending, store it under batch ids of this run, and return it as stored.

    ``pending`` has zip_code_prefix, lat and lng, and logistics_date where single days are
    missing; each unbroken range of missing days is a request of its own.
    """
    spark = pending.sparkSession
    table = create_requests(spark, database)
    if "logistics_date" in pending.columns:
        order = Window.partitionBy("zip_code_prefix", "lat", "lng").orderBy("logistics_date")
        ranged = (
            pending.withColumn(
                "run", F.date_sub("logistics_date", F.row_number().over(order))
            )
            .groupBy("zip_code_prefix", "lat", "lng", "run")
            .agg(
                F.min("logistics_date").alias("first_day"),
                F.max("logistics_date").alias("last_day"),
            )
        )
    else:
        ranged = (
            pending.select("zip_code_prefix", "lat", "lng")
            .distinct()
            .withColumns({"first_day": F.lit(start), "last_day": F.lit(end)})
        )
    run = uuid.uuid4().hex
    coded = ranged.withColumn(
        "code", F.concat_ws("/", "zip_code_prefix", F.col("first_day").cast("string"))
    )
    numbered = ordered_position(coded, "code", "place").select(
        F.concat(
            F.lit(f"{run}-"), F.floor(F.col("place") / F.lit(batch_size)).cast("string")
        ).alias("batch_id"),
        (F.col("place") % batch_size).cast("int").alias("pos"),
        F.col("lat").alias("latitude"),
        F.col("lng").alias("longitude"),
        "first_day",
        "last_day",
    )
    append(numbered, table)
    return spark.table(table).filter(F.col("batch_id").startswith(f"{run}-"))


def new_weather(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per rounded location and day of ``rows``, without what is stored already."""
    cells = {"lat_cell": _grid(F.col("latitude")), "lng_cell": _grid(F.col("longitude"))}
    keys = [*cells, "logistics_date"]
    columns = rows.columns
    values = columns_without(columns, keys)
    each = first_by(rows.withColumns(cells), keys, values, values)
    known = stored.withColumns(cells).select(*keys)
    return each.join(known, keys, "left_anti").select(*columns)


def columns_without(columns: list[str], left_out: list[str]) -> list[str]:
    return [column for column in columns if column not in left_out]


def _grid(value: Column) -> Column:
    """Coordinate rounded to hundredths of a degree, the identity of a weather location."""
    return F.round(value.cast("decimal(10,6)"), 2).cast("decimal(10,2)")


def loaded_locations(weather: DataFrame, start: date, end: date) -> DataFrame:
    """Grid locations that have any stored day in the range."""
    return (
        weather.filter(F.col("logistics_date").between(F.lit(start), F.lit(end)))
        .select(
            _grid(F.col("latitude")).alias("lat_cell"),
            _grid(F.col("longitude")).alias("lng_cell"),
        )
        .distinct()
    )


def hub_batches(hubs: DataFrame, batch_size: int = 100) -> DataFrame:
    """Number the batches of hubs taken in prefix order."""
    return ordered_position(hubs, "zip_code_prefix", "hub_position").withColumn(
        "batch_id", F.floor(F.col("hub_position") / F.lit(batch_size)).cast("long")
    )


def pending_hubs(
    hubs: DataFrame,
    weather: DataFrame,
    start: date,
    end: date,
    granularity: str = "hub",
    batch_size: int = 100,
) -> DataFrame:
    """What is still to be fetched for the day range.

    Locations are matched on rounded coordinates, never on the identifier text.
    ``hub`` keeps every hub without a stored day. ``batch`` leaves out a whole batch as
    soon as one of its hubs has a stored day. ``hub_day`` gives each hub's missing days.
    """
    keyed = (hub_batches(hubs, batch_size) if granularity == "batch" else hubs).withColumns(
        {"lat_cell": _grid(F.col("lat")), "lng_cell": _grid(F.col("lng"))}
    )
    cells = ["lat_cell", "lng_cell"]
    if granularity == "hub":
        return keyed.join(loaded_locations(weather, start, end), cells, "left_anti").drop(*cells)
    if granularity == "batch":
        loaded = loaded_locations(weather, start, end)
        touched = keyed.join(loaded, cells, "left_semi").select("batch_id").distinct()
        return keyed.join(touched, "batch_id", "left_anti").drop(*cells)
    if granularity == "hub_day":
        days = keyed.withColumn(
            "logistics_date", F.explode(F.sequence(F.lit(start), F.lit(end)))
        )
        stored = weather.filter(
            F.col("logistics_date").between(F.lit(start), F.lit(end))
        ).select(
            _grid(F.col("latitude")).alias("lat_cell"),
            _grid(F.col("longitude")).alias("lng_cell"),
            "logistics_date",
        )
        return days.join(stored, [*cells, "logistics_date"], "left_anti").drop(*cells)
    raise ValueError(f"unknown granularity {granularity!r}")
