"""What several readers share is written once, and joins move few and narrow rows."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from galepost import samples
from galepost.operators import checks, interval
from galepost.operators.rank import first_by
from galepost.plans import analysis, marts, quality
from galepost.sources import tables

SF_DIR = registry.SMOKE_DIR
AGGS = {"top": ("max", "rain"), "any_bad": ("any", "bad")}


@pytest.fixture
def written(monkeypatch):
    """Label and columns of every copy that is written."""
    found = []

    def noted(stage):
        def noting(df, label):
            found.append((label, df.columns))
            return stage(df, label)

        return noting

    for module in (registry, samples, interval, marts):
        if hasattr(module, "stage"):
            monkeypatch.setattr(module, "stage", noted(module.stage))
    return found


def of_label(written, label):
    return [columns for name, columns in written if name == label]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_report_reads_one_copy_of_the_weather_and_the_checked_columns_of_the_fact(spark, written):
    models = registry.Models(spark, SF_DIR)
    report = quality.quality_report(models.checked)
    assert len(of_label(written, "raw-weather")) == 1
    assert of_label(written, "fact") == [["order_id"]]
    assert report.filter("status = 'fail'").isEmpty()


def test_monthly_rate_keeps_only_what_it_reads_of_the_fact(spark, written):
    registry.queries()["monthly_late_rate"](spark, SF_DIR)
    assert of_label(written, "fact") == [list(analysis.MONTHLY)]


def test_fact_and_bridge_read_the_written_weather(spark):
    models = registry.Models(spark, SF_DIR)
    models.fact_plan()
    assert all("raw-weather" in path for path in models.weather().inputFiles())


def test_responses_and_requests_read_one_copy(spark):
    for part in samples.weather_responses(spark, SF_DIR):
        assert all("landed-batches" in path for path in part.inputFiles())


def test_windows_move_as_blocks_not_as_days(spark):
    start = date(2020, 1, 1)
    facts = [(s, start + timedelta(d), float(d % 7), d % 5 == 0) for s in "ab" for d in range(0, 300, 3)] * 2
    facts += [(None, start, 9.0, True), ("a", None, 9.0, True)]
    windows = [(s, start + timedelta(a), start + timedelta(a + n)) for s in "abc" for a in range(0, 280, 9) for n in (0, 40)] * 2
    windows += [(None, start, start), ("a", None, start), ("a", start, None), ("a", start, start - timedelta(1))]
    summary = interval.aggregate_windows(
        spark.createDataFrame(windows, "s string, lo date, hi date"),
        spark.createDataFrame(facts, "s string, d date, rain double, bad boolean"),
        "s", "lo", "hi", "d", AGGS, "explode",
    )
    assert plan_of(summary).count("RepartitionByExpression") == 2
    assert "explode(sequence(_first" not in plan_of(summary)
    expected = {}
    for s, lo, hi in windows:
        hits = [f for f in facts if s and f[0] == s and lo and hi and f[1] and lo <= f[1] <= hi]
        if hits:
            expected[s, lo, hi] = (max(f[2] for f in hits), any(f[3] for f in hits))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in summary.collect()} == expected


def test_long_values_are_grouped_only_where_hashes_repeat(spark):
    for rows, found in (
        ([("a" * 32,), ("b" * 32,), (None,), (None,)], set()),
        ([("a" * 32,), ("b" * 32,), ("a" * 32,), ("a" * 32,), (None,)], {("a" * 32, 3)}),
        ([], set()),
    ):
        df = spark.createDataFrame(rows, "v string")
        assert {tuple(r) for r in checks.duplicates(df, "v", long_values=True).collect()} == found
        assert {tuple(r) for r in checks.duplicates(df, "v").collect()} == found


def test_what_is_kept_is_not_moved_beside_its_order(spark):
    rows = [("o", 2, "x"), ("o", 1, "z"), ("o", 1, "y"), ("n", None, "w"), ("n", 3, None), (None, None, None)]
    df = spark.createDataFrame(rows, "o string, i int, s string")
    first = first_by(df, ["o"], ["i", "s"], ["s"])
    assert "min_by" not in plan_of(first)
    assert Counter(map(tuple, first.collect())) == Counter([("o", "y"), ("n", None), (None, None)])


def test_new_weather_orders_by_what_its_keys_leave_open(spark):
    rows = spark.createDataFrame(
        [("b", 1.001, 2.0, date(2020, 1, 1), 5.0), ("a", 1.0, 2.0, date(2020, 1, 1), 6.0)],
        "hub string, latitude double, longitude double, logistics_date date, rain double",
    )
    got = tables.new_weather(rows, rows.filter(F.lit(False)))
    assert [tuple(r) for r in got.collect()] == [("a", 1.0, 2.0, date(2020, 1, 1), 6.0)]
    assert plan_of(got).count("isnull(logistics_date") == 0
