import random

import pytest
from pyspark.sql import functions as F

from galepost.functions.geo import box_distance_floor_km, distance_km, make_point
from galepost.functions.numeric import percent, round_half_even
from galepost.functions.text import clean_text, column_name, parse_iso_date, parse_number
from galepost.session import shared_folder, stage


def apply(spark, values, kind, function):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["out"] for r in rows.withColumn("out", function(F.col("v"))).sort("i").collect()]


def test_null_tokens_and_blanks(spark):
    tokens = ["", "nan", "NaN", "null", "NULL", "None", "N/A", "   ", " null\t", None]
    kept = ["NAN", "n/a", "\tx ", " y\x1f", "01037"]
    assert apply(spark, tokens, "string", clean_text) == [None] * len(tokens)
    assert apply(spark, kept, "string", clean_text) == ["NAN", "n/a", "x", "y", "01037"]


def test_header_names():
    assert column_name(" Zip Code ") == "zip_code"
    assert column_name(None) == ""


def test_numbers_parse_as_the_usual_text_forms(spark):
    texts = ["1", "-2.5", " +.5 ", "1e3", "1_000.5", "inf", "-Infinity", "1.", "1e-400"]
    assert apply(spark, texts, "string", parse_number) == [float(t) for t in texts]
    bad = ["1.0d", "2f", "0x10", "1__0", "_1", "abc", "", "1,5", None, "1 2", "."]
    assert apply(spark, bad, "string", parse_number) == [None] * len(bad)


def test_iso_dates(spark):
    got = apply(
        spark,
        ["2017-01-31", "20170131", "2017-02-30", "2017-1-1", "31.01.2017", "", None],
        "string",
        parse_iso_date,
    )
    assert [str(d) if d else None for d in got] == ["2017-01-31"] * 2 + [None] * 5


def test_rounding_matches_exact_binary_half_even(spark):
    chance = random.Random(7)
    values = [2.675, -2.675, 0.125, 0.375, -0.125, 1.005, -0.001, 0.0, 0.025, 179.995, -23.545]
    values += [chance.uniform(-180, 180) for _ in range(2000)]
    values += [chance.randrange(-18000, 18000) / 100 + 0.005 for _ in range(5000)]
    values += [chance.randrange(-18000, 18000) / 64 for _ in range(1000)]
    got = apply(spark, values, "double", lambda c: round_half_even(c, 2))
    assert got == [round(v, 2) + 0.0 for v in values]
    assert "-0.0" not in {str(v) for v in got}


def test_percent_without_rows_is_null(spark):
    assert spark.range(1).select(percent(F.lit(0), F.lit(0))).first()[0] is None
    assert spark.range(1).select(percent(F.lit(1), F.lit(4))).first()[0] == 25.0


def test_point_needs_both_coordinates(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0), (None, 2.0), (1.0, None), (1.0, 91.0), (1.0, float("nan"))],
        "lng double, lat double",
    )
    points = [r[0] for r in rows.select(make_point(F.col("lng"), F.col("lat"))).collect()]
    assert points[0].asDict() == {"lng": 1.0, "lat": 2.0}
    assert points[1:] == [None] * 4


def test_known_distance(spark):
    row = spark.sql("select 0D a, 0D b, 0D c, 90D d").select(distance_km("a", "b", "c", "d"))
    assert row.first()[0] == pytest.approx(6371.0088 * 3.141592653589793 / 2, abs=1e-6)


def test_box_floor_never_exceeds_a_distance_into_the_box(spark):
    chance = random.Random(3)
    rows = []
    for _ in range(4000):
        south, west = chance.uniform(-90, 82), chance.uniform(-180, 172)
        north, east = south + chance.uniform(0, 8), west + chance.uniform(0, 8)
        rows.append(
            (
                chance.uniform(-90, 90), chance.uniform(-180, 180), south, north, west, east,
                chance.uniform(south, north), chance.uniform(west, east),
            )
        )
    names = ["lat", "lng", "south", "north", "west", "east", "in_lat", "in_lng"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    scored = df.select(
        box_distance_floor_km(*names[:6]).alias("least"),
        distance_km("lat", "lng", "in_lat", "in_lng").alias("km"),
    )
    assert scored.filter("least > km + 0.001").count() == 0


class FakeSession:
    """A session with or without a shared folder setting."""

    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"
        self.conf, self.sparkContext = self, self

    def get(self, name, default):
        return self.folder or default


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(FakeSession("cluster", "store://shared/")) == "store://shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("cluster"))
    local = shared_folder(FakeSession("local[2]"))
    assert local == shared_folder(FakeSession("local[2]"))
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3 and staged.inputFiles()[0].count(shared_folder(spark)) == 1
