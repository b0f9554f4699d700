"""Daily weather rows from landed archive responses.

A response covers one batch of locations. It is an array with one object per
requested location in request order, or a bare object for the first location. Each
object holds ``daily`` with parallel arrays.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galepost.functions.text import parse_iso_date, parse_number
from galepost.sources.registry import WEATHER

# Field names of the response and default day range of a request.
DAILY_FIELDS = {
    "temperature_2m_max": "temp_max_celsius",
    "temperature_2m_min": "temp_min_celsius",
    "precipitation_sum": "precipitation_sum_mm",
    "wind_speed_10m_max": "wind_speed_max_kmh",
}
DEFAULT_START = date(2016, 9, 1)
DEFAULT_END = date(2018, 10, 31)

_DAILY_TYPE = ", ".join(f"{name}: array<string>" for name in ("time", *DAILY_FIELDS))
# A bare object is read as an array of one.
PAYLOAD_TYPE = f"array<struct<daily: struct<{_DAILY_TYPE}>>>"


def date_range(start: date = DEFAULT_START, end: date = DEFAULT_END) -> tuple[date, date]:
    """The day range of a request, checked."""
    if end < start:
        raise ValueError(f"the end date {end} must be on or after the start date {start}")
    return start, end


def hub_identifier(lat, lng):
    """``hub_<lat>_<lng>`` with the shortest text of each number."""
    return F.concat(F.lit("hub_"), lat.cast("string"), F.lit("_"), lng.cast("string"))


def payload_days(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per location and day with a reject reason where the day is unusable.

    ``responses``: batch_id, payload. ``requests``: batch_id, pos, latitude, longitude,
    one row per requested location; the requested coordinates are the ones kept. Days of
    a location that no request names are unusable, and where requests have a ``first_day`` and
    ``last_day`` so are days outside. A response
    that is no readable JSON of the expected form is one row with the reason ``bad_payload``.
    """
    parsed = responses.select("batch_id", F.from_json("payload", PAYLOAD_TYPE).alias("answer"))
    locations = parsed.select(
        "batch_id", F.posexplode("answer").alias("pos", "location")
    ).select("batch_id", "pos", "location.daily")
    located = locations.join(requests, ["batch_id", "pos"], "left")
    # Arrays shorter than ``time`` are padded with NULL; whatever lies beyond it is no day.
    days = located.withColumn(
        "day",
        F.explode(
            F.slice(
                F.arrays_zip(
                    F.col("daily.time").alias("time"),
                    *(
                        F.coalesce(F.col(f"daily.{name}"), F.array().cast("array<string>")).alias(
                            name
                        )
                        for name in DAILY_FIELDS
                    ),
                ),
                F.lit(1),
                F.size("daily.time"),
            )
        ),
    )
    texts = [F.col(f"day.{name}") for name in DAILY_FIELDS]
    numbers = [parse_number(text) for text in texts]
    unreadable = F.lit(False)
    absent = F.lit(False)
    for text, number in zip(texts, numbers):
        unreadable = unreadable | (text.isNotNull() & number.isNull())
        absent = absent | text.isNull()
    logistics_date = parse_iso_date(F.col("day.time"))
    asked = F.col("latitude").isNotNull()
    if "first_day" in requests.columns:
        asked = asked & logistics_date.between(F.col("first_day"), F.col("last_day"))
    readable = days.select(
        hub_identifier(F.col("latitude"), F.col("longitude")).alias("hub_identifier"),
        "latitude",
        "longitude",
        logistics_date.alias("logistics_date"),
        *(number.alias(name) for number, name in zip(numbers, DAILY_FIELDS.values())),
        F.when(logistics_date.isNull(), F.lit("bad_date"))
        .when(unreadable, F.lit("bad_number"))
        .when(absent, F.lit("missing_measure"))
        .when(~asked, F.lit("not_requested"))
        .alias("reject_reason"),
    )
    broken = parsed.filter(F.col("answer").isNull()).select(
        F.lit("bad_payload").alias("reject_reason")
    )
    return readable.unionByName(broken, allowMissingColumns=True)


def weather_rows(days: DataFrame) -> DataFrame:
    """The usable days in the types of the raw weather table."""
    return days.filter(F.col("reject_reason").isNull()).select(
        *(F.col(field.name).cast(field.dataType).alias(field.name) for field in WEATHER.schema)
    )


def weather_reject_counts(days: DataFrame) -> DataFrame:
    """One row: loaded days, skipped days and the reasons."""
    reason = F.col("reject_reason")
    return days.agg(
        F.count_if(reason.isNull()).alias("loaded_rows"),
        F.count_if(reason.isNotNull()).alias("skipped_rows"),
        F.count_if(reason == "bad_date").alias("bad_date"),
        F.count_if(reason == "bad_number").alias("bad_number"),
        F.count_if(reason == "missing_measure").alias("missing_measure"),
        F.count_if(reason == "not_requested").alias("not_requested"),
        F.count_if(reason == "bad_payload").alias("bad_payload"),
    )
