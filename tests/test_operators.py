import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from galepost.functions.geo import EARTH_RADIUS_KM, make_point
from galepost.operators import centroid, checks, history, hubs, interval, metrics, nearest, rank


def rows(df):
    return [tuple(r) for r in df.collect()]


# Choice and position


def test_first_by_is_numeric_with_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", 10, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 7, "m"), ("c", 1, "q"), ("c", 1, "p")],
        "k string, i int, v string",
    )
    assert sorted(rows(rank.first_by(df, ["k"], ["i", "v"], ["v"]))) == [
        ("a", "y"), ("b", "m"), ("c", "p"),
    ]


def test_ordered_position_equals_sorting(spark):
    codes = [f"{n:05d}" for n in random.Random(1).sample(range(100_000), 500)]
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(7)
    got = dict(rows(rank.ordered_position(df, "code", "p").select("code", "p")))
    assert got == {c: i for i, c in enumerate(sorted(codes))}


# Centres


def ping_frame(spark, groups):
    data = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(0).shuffle(data)
    return spark.createDataFrame(data, "k string, v double")


def test_median_agrees_with_brute_force(spark):
    chance = random.Random(5)
    groups = {
        "even": [1.0, 2.0, 3.0, 10.0],
        "odd": [5.0, -1.0, 3.0],
        "one": [4.25],
        "nulls": [None, None],
        "some": [None, 1.0, 2.0, None],
        "repeated": [7.5] * 30 + [1.0] * 10,
        "crowd": [chance.gauss(-23.5, 0.01) for _ in range(3001)],
        "wide": [chance.uniform(-180, 180) for _ in range(2000)],
        "tight": [-46.6 + chance.random() * 1e-9 for _ in range(2000)],
        None: [chance.uniform(0, 1) for _ in range(100)],
        "endless": [float("-inf")] * 5 + [1.0] * 3 + [float("inf")] * 2,
    }
    expected = {}
    for key, values in groups.items():
        known = sorted(v for v in values if v is not None)
        middle = [known[(len(known) - 1) // 2], known[len(known) // 2]] if known else None
        expected[key] = (len(values), 0.5 * middle[0] + 0.5 * middle[1] if known else None)
    df = ping_frame(spark, groups)
    # The last two sketches are so coarse, and their brackets so narrow, that some miss.
    for accuracy, reach in ((centroid.ACCURACY, centroid.REACH), (50, 1), (10, 0.1), (2, 0.0)):
        medians = centroid.group_median(df, "k", ["v"], accuracy, reach)
        assert {k: (n, v) for k, n, v in rows(medians)} == expected, accuracy


def test_median_ranks_nan_last(spark):
    nan, inf = float("nan"), float("inf")
    df = ping_frame(spark, {"a": [1.0, nan, nan, inf], "b": [nan, 2.0, 1.0], "c": [inf, nan]})
    for reach in (centroid.REACH, 0.0):
        got = {k: v for k, _, v in rows(centroid.group_median(df, "k", ["v"], 10, reach))}
        assert math.isnan(got["a"]) and got["b"] == 2.0 and math.isnan(got["c"])
    two = df.selectExpr("k", "v", "case when k = 'b' then v end as w")
    got = {k: (n, w) for k, n, _, w in rows(centroid.group_median(two, "k", ["v", "w"]))}
    assert got == {"a": (4, None), "b": (3, 2.0), "c": (2, None)}


def test_sketch_median_returns_an_element(spark):
    df = ping_frame(spark, {"a": [1.0, 2.0, 3.0, 10.0]})
    assert rows(centroid.group_median_sketch(df, "k", ["v"])) == [("a", 4, 2.0)]


def test_mode_prefers_the_smaller_value_and_ignores_null(spark):
    data = [("p", s) for s in ["b", "b", "a", "a", None, None, None]] + [("q", None)]
    df = spark.createDataFrame(data, "k string, v string")
    assert rows(centroid.group_mode(df, ["k"], "v")) == [("p", "a")]


# Nearest


def brute_km(a, b):
    la, oa, lb, ob = map(math.radians, (*a, *b))
    chord = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(chord)))


def frames(spark, left, right):
    def frame(data):
        df = spark.createDataFrame(
            [(k, *(p or (None, None))) for k, p in data], "k string, lat double, lng double"
        )
        return df.select("k", make_point(F.col("lng"), F.col("lat")).alias("point"))

    return nearest.nearest_join(
        frame(left),
        frame(right).withColumnRenamed("k", "id").withColumnRenamed("point", "at"),
        "point", "id", "at", "nearest_id", "km",
    ).select("k", "nearest_id", "km")


def spread(chance, kind):
    if kind == "world":
        return (math.degrees(math.asin(chance.uniform(-1, 1))), chance.uniform(-180, 180))
    if kind == "pole":
        return (chance.choice([-1, 1]) * chance.uniform(84, 90), chance.uniform(-180, 180))
    if kind == "seam":
        return (chance.uniform(-5, 5), chance.choice([179.9, -179.9]) + chance.uniform(-0.1, 0.1))
    return (chance.gauss(-23.5, 0.05), chance.gauss(-46.6, 0.05))


@pytest.mark.parametrize("left_kind", ["world", "pole", "seam", "town"])
@pytest.mark.parametrize("right_kind", ["world", "pole", "seam", "town"])
def test_nearest_equals_brute_force(spark, left_kind, right_kind):
    chance = random.Random(f"{left_kind}{right_kind}")
    left = [(f"l{i}", spread(chance, left_kind)) for i in range(60)]
    right = [(f"r{i:03d}", spread(chance, right_kind)) for i in range(300)]
    got = {k: (i, km) for k, i, km in rows(frames(spark, left, right))}
    assert len(got) == len(left)
    for key, position in left:
        km, best = min((brute_km(position, p), i) for i, p in right)
        found, found_km = got[key]
        assert found_km == pytest.approx(km, abs=1e-4)
        assert brute_km(position, dict(right)[found]) <= km + 2e-4


def test_a_crowd_does_not_deepen_the_other_cells(spark):
    """Two targets a metre apart among many others; elsewhere cells stay as they are."""
    chance = random.Random(3)
    town = [(f"t{i}", (-46.6 + chance.random() * 1e-3, -23.5 + chance.random() * 1e-3)) for i in range(80)]
    town += [("m0", (-46.6, -23.5)), ("m1", (-46.6, -23.50001))]
    plain = [(f"p{i}", (chance.uniform(-60, -30), chance.uniform(-30, 5))) for i in range(60)]
    targets = spark.createDataFrame(
        [(*at[::-1],) for _, at in town + plain], "t_lat double, t_lng double"
    )
    tree = nearest._search_tree(targets, nearest.CELL_DEGREES, 8).collect()
    deep = [c for c in tree if c.level > 2]
    assert deep and all(-23.51 < c.south and c.north < -23.49 for c in deep)
    assert sum(c.is_leaf for c in tree if c.level < 2) > 8
    left = [(i, (chance.uniform(-60, -30), chance.uniform(-30, 5))) for i in range(60)]
    left += [(100 + i, (-46.6 + chance.random() * 1e-3, -23.5 + chance.random() * 1e-3)) for i in range(60)]
    schema = "id string, at struct<lng:double, lat:double>"
    got = nearest.nearest_join(
        spark.createDataFrame(left, "k int, point struct<lng:double, lat:double>"),
        spark.createDataFrame(town + plain, schema),
        "point", "id", "at", "nearest_id", "km", leaf_points=8,
    )
    other = nearest.nearest_join(
        spark.createDataFrame(left, "k int, point struct<lng:double, lat:double>"),
        spark.createDataFrame(town + plain, schema),
        "point", "id", "at", "nearest_id", "km", leaf_points=1000,
    )
    assert len(rows(got)) == 120 and Counter(rows(got)) == Counter(rows(other))


def test_nearest_ties_nulls_and_far_away(spark):
    right = [("b", (0.0, 1.0)), ("a", (0.0, -1.0)), ("c", (0.0, -1.0)), ("z", None)]
    left = [("tie", (0.0, 0.0)), ("void", None), ("far", (40.0, 100.0)), ("twin", (0.0, 0.0))]
    got = {k: (i, km) for k, i, km in rows(frames(spark, left, right))}
    assert got["tie"][0] == got["twin"][0] == "a"
    assert got["void"] == ("a", None)
    assert got["far"][0] == "b" and got["far"][1] > 50
    assert rows(frames(spark, left, [])) == []
    assert rows(frames(spark, left[:1], [("z", None), ("y", None)])) == [("tie", "y", None)]


# Intervals


AGGS = {"top": ("max", "rain"), "low": ("min", "rain"), "any_bad": ("any", "bad")}


@pytest.mark.parametrize("strategy", ["auto", "doubling", "explode", "range"])
def test_interval_join_equals_brute_force(spark, strategy):
    chance = random.Random(11)
    start = date(2018, 1, 1)
    facts = [
        (f"s{chance.randrange(4)}", start + timedelta(chance.randrange(60)),
         chance.choice([None, float(chance.randrange(50))]), chance.choice([None, True, False]))
        for _ in range(150)
    ]
    # Long gaps, one a day shorter and one a day longer than the longest span.
    for later in (315, 571, 828, 1700):
        facts.append((chance.choice(["s0", "s1"]), start + timedelta(later), 60.0 + later, later < 800))
    left = [
        (i, chance.choice(["s0", "s1", "s2", "s3", "none", None]),
         start + timedelta(chance.randrange(-5, 65)), chance.randrange(-3, 20))
        for i in range(200)
    ]
    left = [(i, s, lo, lo + timedelta(n)) for i, s, lo, n in left]
    left += [(900, "s1", start, date(9999, 12, 31)), (901, "s1", start, None)]
    left += [
        (1000 + i, chance.choice(["s0", "s1", "s2"]), start + timedelta(a), start + timedelta(a + n))
        for i, (a, n) in enumerate(
            (chance.randrange(1700), chance.choice([0, 1, 3, 7, 127, 254, 255, 256, 257, 511, 900]))
            for _ in range(150)
        )
    ]
    got = {
        r[0]: tuple(r)[4:]
        for r in interval.interval_agg_join(
            spark.createDataFrame(left, "i int, s string, lo date, hi date"),
            spark.createDataFrame(facts, "s string, d date, rain double, bad boolean"),
            "s", "lo", "hi", "d", AGGS, strategy,
        ).collect()
    }
    assert len(got) == len(left)
    for i, s, lo, hi in left:
        hits = [f for f in facts if f[0] == s and hi and lo <= f[1] <= hi]
        rain = [f[2] for f in hits if f[2] is not None]
        bad = [f[3] for f in hits if f[3] is not None]
        assert got[i] == (
            max(rain, default=None), min(rain, default=None), any(bad) if bad else None
        )


# History


def brute_versions(events):
    by_key, out = defaultdict(list), []
    for event in events:
        by_key[event[1]].append(event)
    last = datetime.max
    for key, mine in by_key.items():
        mine.sort(key=lambda e: (e[2] or last, e[0]))
        starts, before = [], None
        for event in mine:
            if before is None or key is None or event[3:] != before:
                starts.append(event)
            before = event[3:]
        for n, event in enumerate(starts):
            to = starts[n + 1][2] if n + 1 < len(starts) else None
            out.append((key, *event[3:], event[2], to, to is None, n + 1))
    return Counter(out)


def address_log(chance, size):
    start = datetime(2018, 1, 1)
    return [
        (
            f"o{i:05d}",
            chance.choice(["hot"] * 5 + [None, "p1", "p2", "p3", f"q{chance.randrange(40)}"]),
            chance.choice([start + timedelta(hours=chance.randrange(24 * 9)) for _ in range(9)] + [None]),
            chance.choice(["01", "02"]),
            chance.choice([None, "city"]),
        )
        for i in range(size)
    ]


@pytest.mark.parametrize("part_rows", [history.PART_ROWS, 300, 40, 7])
def test_history_equals_brute_force_however_it_is_parted(spark, part_rows, monkeypatch):
    monkeypatch.setattr(history, "PART_ROWS", part_rows)
    events = address_log(random.Random(23), 600)
    df = spark.createDataFrame(
        events, "order_id string, person string, ts timestamp_ntz, zip string, city string"
    )
    got = history.scd2_from_events(df, "person", ["zip", "city"], "ts", "order_id")
    assert Counter(rows(got)) == brute_versions(events)
    versioned = history.versioned_events(df, "person", ["zip", "city"], "ts", "order_id")
    assert versioned.count() == len(events)
    assert versioned.filter("is_start").count() == sum(brute_versions(events).values())


def test_history_cases(spark):
    day = [datetime(2018, 1, d) for d in range(1, 10)]
    events = [
        ("1", "aba", day[0], "A", "x"), ("2", "aba", day[1], "B", "x"), ("3", "aba", day[2], "A", "x"),
        ("1", "null", day[0], "A", None), ("2", "null", day[1], "A", None), ("3", "null", day[2], "A", "x"),
        ("1", "same", day[0], "A", "x"), ("2", "same", day[0], "B", "x"),
        ("1", "once", day[0], "A", "x"),
    ]
    df = spark.createDataFrame(
        events, "order_id string, person string, ts timestamp_ntz, zip string, city string"
    )
    got = defaultdict(list)
    for r in sorted(rows(history.scd2_from_events(df, "person", ["zip", "city"], "ts", "order_id")),
                    key=lambda r: (r[0], r[-1])):
        got[r[0]].append(r)
    assert [r[1] for r in got["aba"]] == ["A", "B", "A"]
    assert [r[5] for r in got["aba"]] == [False, False, True]
    assert [(r[3], r[4]) for r in got["null"]] == [(day[0], day[2]), (day[2], None)]
    assert [(r[3], r[4]) for r in got["same"]] == [(day[0], day[0]), (day[0], None)]
    assert len(got["once"]) == 1 and got["once"][0][5]


# Hubs


def test_hubs_merge_equal_rounded_positions(spark):
    pings = spark.createDataFrame(
        [("02", 10.001, 20.0), ("01", 10.0, 20.004), ("03", -23.5, -46.0), ("03", -23.52, -46.2),
         ("99", 1.0, 1.0)],
        "zip_code_prefix string, lat double, lng double",
    )
    relevant = spark.createDataFrame([("01",), ("02",), ("03",), ("04",)], "zip_code_prefix string")
    found = hubs.weather_hubs(pings, relevant)
    assert sorted(rows(found)) == [
        ("01", 10.0, 20.0, "hub_10.0_20.0"), ("03", -23.51, -46.1, "hub_-23.51_-46.1"),
    ]
    pinged = pings.select("zip_code_prefix").distinct()
    saving = hubs.hub_reduction(pinged, relevant, found)
    assert rows(saving) == [(4, 4, 2, 50.0)]
    assert hubs.check_hubs(saving) is saving
    with pytest.raises(hubs.TooManyHubsError):
        hubs.check_hubs(saving.withColumn("hubs", F.lit(9).cast("long")))


# Metrics


def test_rates_keep_unknown_apart(spark):
    df = spark.createDataFrame(
        [(True, True), (True, False), (None, True), (None, True), (None, False)],
        "severe boolean, late boolean",
    )
    assert rows(metrics.null_aware_rate(df, "severe", "late")) == [
        (False, 0.0, 0), (True, 50.0, 2), (None, None, 3),
    ]


def test_months_without_rows_are_kept(spark):
    df = spark.createDataFrame(
        [(datetime(2018, 1, 5), "a", True), (datetime(2018, 3, 9), "b", False), (None, "c", True)],
        "ts timestamp_ntz, id string, late boolean",
    )
    got = sorted(rows(metrics.monthly_series(df, "ts", "id", "late")))
    assert got == [
        (date(2018, 1, 1), 1, 100.0), (date(2018, 2, 1), 0, None), (date(2018, 3, 1), 1, 0.0),
    ]


def test_histogram_edges(spark):
    chance = random.Random(2)
    values = [chance.uniform(0, 400) for _ in range(500)] + [0.0, 400.0, 10.0, 390.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    import numpy

    counts, edges = numpy.histogram([v for v in values if v is not None], bins=40)
    got = sorted(rows(metrics.histogram(df, "v", 40)))
    assert [r[3] for r in got] == list(counts)
    assert [r[1] for r in got] == pytest.approx(list(edges[:-1]))
    flat = sorted(rows(metrics.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 4)))
    assert [(r[1], r[2], r[3]) for r in flat] == [(2.5, 2.75, 0), (2.75, 3.0, 0), (3.0, 3.25, 4), (3.25, 3.5, 0)]
    assert metrics.histogram(spark.createDataFrame([], "v double"), "v").count() == 0


def test_share_counts_missing_as_beyond(spark):
    df = spark.createDataFrame([(50.0,), (50.1,), (None,), (1.0,)], "v double")
    assert rows(metrics.share_within(df, "v", 50.0, "pct")) == [(50.0,)]


# Checks


def test_checks_count_offenders(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 0), (None, None), (None, 5)], "k string, n int"
    )
    bridge = spark.createDataFrame([(True,), (False,), (None,)], "is_within_tolerance boolean")
    wanted = [
        checks.Check("t", "not_null", "k"),
        checks.Check("t", "unique", "k"),
        checks.Check("t", "unique", "concat(k, '|', n)"),
        checks.Check("t", "greater_than_zero", "n"),
        checks.Check("b", "coverage", "is_within_tolerance", "warn"),
    ]
    report = checks.run_checks({"t": df, "b": bridge}, wanted)
    got = {r["check_name"]: (r["failures"], r["status"]) for r in report.collect()}
    assert got == {
        "not_null:k": (2, "fail"),
        "unique:k": (1, "fail"),
        "unique:concat(k, '|', n)": (0, "pass"),
        "greater_than_zero:n": (2, "fail"),
        "coverage:is_within_tolerance": (1, "warn"),
    }
    with pytest.raises(checks.CheckFailedError, match="t unique:k: 1"):
        checks.enforce(report)
    warned = report.filter("severity = 'warn'")
    assert checks.enforce(warned) is warned
    assert checks.out_of_tolerance(bridge.limit(0)).count() == 0
    assert df.filter(checks.broken("greater_than_zero", F.col("n"))).count() == 2
