import csv
import io
import json
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from galepost.operators.checks import CheckFailedError
from galepost.plans import analysis, pipeline
from galepost.sources import csv_files, registry, tables, weather_json


def landed(tmp_path, text, name="orders.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


SELLERS = (
    '﻿Seller_ID, Seller Zip Code Prefix ,seller_city,extra,seller_state\r\n'
    's1,01037,"Sao ""Big""\nPaulo",e,SP\r\n'
    "\r\n"
    "s2,N/A, nan ,e\r\n"
    "s3,20000,Rio,e,RJ,too,many\r\n"
)


def test_csv_is_read_by_name_and_tolerantly(spark, tmp_path):
    path = landed(tmp_path, SELLERS)
    valid, rejected = csv_files.read_dataset(spark, registry.SELLERS, path)
    assert sorted(tuple(r) for r in valid.collect()) == [
        ("s1", "01037", 'Sao "Big"\nPaulo', "SP"),
        ("s2", None, None, None),
        ("s3", "20000", "Rio", "RJ"),
    ]
    assert rejected.count() == 0


def test_files_are_read_by_their_own_header(spark, tmp_path):
    plain = landed(tmp_path, 'x,y\n1,"a ""b"""\n2,c d\n', "plain one.csv")
    swapped = landed(tmp_path, "y,x\nzip,5\n", "swapped.csv")
    broken = landed(tmp_path, 'y,x\n"line\nline",3\n', "broken.csv")
    expected = {("1", 'a "b"'), ("2", "c d"), ("5", "zip"), ("3", "line\nline")}
    got = csv_files.read_landed_csv(spark, [plain, swapped, broken]).select("x", "y").collect()
    assert {tuple(r) for r in got} == expected and len(got) == 4
    assert len(csv_files.landed_groups(spark, [plain, swapped, broken])) == 2
    assert csv_files.read_landed_csv(spark, [plain, swapped], "refuse").count() == 3
    with pytest.raises(csv_files.QuotedNewlineError):
        csv_files.read_landed_csv(spark, [plain, broken], "refuse")


@pytest.mark.parametrize("seed", range(4))
def test_fields_over_lines_are_joined_across_blocks(spark, tmp_path, seed):
    """Files cut into many blocks, inside and outside of fields, against a plain reader."""
    rng = random.Random(seed)
    cells = ["", "a", "b c", 'say ""x""', 'in "the" middle', "5\" pipe", "é", "x" * 40]
    quoted = ["one\ntwo", "\n", "a,b\nc", '""\n""', "line\nline\n,\nline" * 4, "q" * 300 + "\n", ""]

    def cell():
        if rng.random() < 0.15:
            return f'"{rng.choice(quoted)}"'
        value = rng.choice(cells)
        return f'"{value}"' if value.startswith("say") else value

    paths, expected = [], Counter()
    for number, header in enumerate(("x,y,z", '"x","y",z', "z,y,x")):
        names = next(csv.reader([header]))
        text = header + "\n" + "".join(
            f"{i}," + cell() + "," + cell() + "\n" + "\n" * (rng.random() < 0.1) for i in range(60)
        )
        paths.append(landed(tmp_path, text, f"f{number}.csv"))
        for row in list(csv.reader(io.StringIO(text)))[1:]:
            if row:
                expected[tuple(dict(zip(names, row, strict=True))[n] for n in "xyz")] += 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = csv_files._landed_lines(spark, paths)
        assert lines.rdd.getNumPartitions() > 20
        got = csv_files.read_landed_csv(spark, paths).select("x", "y", "z").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert Counter(tuple(v or "" for v in row) for row in got) == expected


def test_every_file_must_have_its_columns(spark, tmp_path):
    good = landed(tmp_path, ",".join(registry.SELLERS.columns) + "\ns1,01000,x,SP\n", "good.csv")
    short = landed(tmp_path, 'seller_id,seller_city,seller_state\n"s\n2",y,SP\n', "short.csv")
    with pytest.raises(csv_files.MissingColumnsError, match="seller_zip_code_prefix"):
        csv_files.read_dataset(spark, registry.SELLERS, [good, short])
    with pytest.raises(csv_files.MissingColumnsError, match="no header"):
        csv_files.read_dataset(spark, registry.SELLERS, [good, landed(tmp_path, "", "none.csv")])


def test_repeated_header_names_keep_the_last_column(spark, tmp_path):
    path = landed(tmp_path, "a,b,A,b1, B \n1,2,3,4,5\n")
    got = csv_files.read_landed_csv(spark, path)
    assert got.first().asDict() == {"a": "3", "b": "5", "b1": "4"}


def test_missing_columns_are_named(spark, tmp_path):
    path = landed(tmp_path, "seller_id,seller_city\n1,x\n")
    with pytest.raises(csv_files.MissingColumnsError, match="seller_zip_code_prefix, seller_state"):
        csv_files.read_dataset(spark, registry.SELLERS, path)
    with pytest.raises(csv_files.MissingColumnsError, match="no header"):
        csv_files.read_dataset(spark, registry.SELLERS, landed(tmp_path, "", "empty.csv"))


def order_csv():
    return (
        ",".join(registry.ORDERS.columns) + "\n"
        "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-03 09:00:00,2018-01-02 00:00:00\n"
        "o2,c2,,2018-01-02 10:00:00,,,,\n"
        "o3,c3,shipped,2018-01-02 11:00:00,,,null,2018-01-20 00:00:00\n"
    )


def test_required_fields_reject_and_count(spark, tmp_path):
    valid, rejected = csv_files.read_dataset(
        spark, registry.ORDERS, landed(tmp_path, order_csv())
    )
    assert [r["order_id"] for r in rejected.collect()] == ["o2"]
    counts = csv_files.reject_counts(valid.union(rejected), registry.ORDERS.required).first()
    assert (counts["loaded_rows"], counts["skipped_rows"], counts["null_order_status"]) == (2, 1, 1)


def test_pings_need_prefix_and_numbers(spark):
    raw = spark.createDataFrame(
        [(" 01037 ", "-23.5", "-46.6"), (None, "1", "1"), ("2", "x", "1"), ("3", "1", "nan")],
        registry.GEOLOCATION.columns[:3],
    )
    assert [tuple(r) for r in csv_files.located_pings(raw).collect()] == [("01037", -23.5, -46.6)]
    assert sorted(r[0] for r in csv_files.pinged_prefixes(raw).collect()) == ["01037", "2"]


def day(time, warm=(30.5,), cold=(20.0,), rain=(1.0,), wind=(9.0,)):
    return {
        "daily": {
            "time": time,
            "temperature_2m_max": list(warm),
            "temperature_2m_min": list(cold),
            "precipitation_sum": list(rain),
            "wind_speed_10m_max": list(wind),
        }
    }


def test_payload_days(spark):
    good = ["2017-01-01", "2017-01-02", "not a day", "2017-01-04"]
    first = day(good, [30.5] * 4, [20, 21, 22, 23], [20.004, "7.5", 1, "wet"], [9, None, 9, 9])
    short = day(["2017-02-01", "2017-02-02"])
    payloads = [
        ("a", json.dumps([first, short])),  # the third location got no object
        ("b", json.dumps(short)),  # one bare object
        ("c", json.dumps([{"daily": None}, {}, day([])])),
        ("d", "no json"),
    ]
    requests = [("a", p, -23.5 - p, -46.0) for p in range(3)] + [("b", 0, 1.25, 2.0), ("b", 1, 9.0, 9.0)]
    requests += [("c", p, 5.0, 5.0) for p in range(3)] + [("d", 0, 6.0, 6.0)]
    days = weather_json.payload_days(
        spark.createDataFrame(payloads, "batch_id string, payload string"),
        spark.createDataFrame(requests, "batch_id string, pos int, latitude double, longitude double"),
    )
    loaded = weather_json.weather_rows(days)
    assert loaded.schema == registry.WEATHER.schema
    assert sorted((r[0], str(r[3]), str(r[6])) for r in loaded.collect()) == [
        ("hub_-23.5_-46.0", "2017-01-01", "20.00"),
        ("hub_-24.5_-46.0", "2017-02-01", "1.00"),
        ("hub_1.25_2.0", "2017-02-01", "1.00"),
    ]
    counts = weather_json.weather_reject_counts(days).first().asDict()
    assert counts == {
        "loaded_rows": 3, "skipped_rows": 6, "bad_date": 1, "bad_number": 1, "missing_measure": 3,
        "not_requested": 0, "bad_payload": 1,
    }


def test_date_range_is_checked():
    assert weather_json.date_range() == (date(2016, 9, 1), date(2018, 10, 31))
    with pytest.raises(ValueError, match="on or after"):
        weather_json.date_range(date(2018, 1, 2), date(2018, 1, 1))


def test_resume_granularities(spark):
    hubs = spark.createDataFrame(
        [("01", 1.0, 1.0), ("02", 2.0, 2.0), ("03", 3.0, 3.0)],
        "zip_code_prefix string, lat double, lng double",
    )
    # Stored under an old identifier; only the coordinates tell.
    weather = spark.createDataFrame([("legacy-2", 2.004, 2.0, date(2018, 1, 1))],
        "hub_identifier string, latitude double, longitude double, logistics_date date")

    def pending(granularity, last=date(2018, 1, 2), size=2):
        found = tables.pending_hubs(hubs, weather, date(2018, 1, 1), last, granularity, size)
        return sorted(r["zip_code_prefix"] for r in found.collect())

    assert pending("hub") == ["01", "03"]
    assert pending("batch") == ["03"]
    assert pending("hub_day") == ["01", "01", "02", "03", "03"]
    later = tables.pending_hubs(hubs, weather, date(2019, 1, 1), date(2019, 1, 2))
    assert later.count() == 3
    with pytest.raises(ValueError, match="granularity"):
        pending("week")


def test_pipeline_end_to_end(spark, tmp_path):
    csv = {
        "orders": order_csv(),
        "order_items": ",".join(registry.ORDER_ITEMS.columns) + "\no1,10,p,s2,,5,1\no1,2,p,s1,,5,1\n",
        "customers": ",".join(registry.CUSTOMERS.columns)
        + "\nc1,u1,01000,town,SP\nc2,u1,01000,town,SP\nc3,u1,02000,city,SP\n",
        "sellers": ",".join(registry.SELLERS.columns) + "\ns1,02000,x,SP\ns2,01000,x,SP\n",
        "geolocation": ",".join(registry.GEOLOCATION.columns)
        + "\n01000,-23.5,-46.5,a,SP\n01000,-23.5,-46.5,a,SP\n02000,-24,-47,b,\n",
    }
    paths = {name: landed(tmp_path, text, f"{name}.csv") for name, text in csv.items()}
    loaded = pipeline.load_csv(spark, "raw_e2e", paths)
    assert loaded == {"orders": 2, "order_items": 2, "customers": 3, "sellers": 2, "geolocation": 3}
    # A second run finds the tables filled.
    assert set(pipeline.load_csv(spark, "raw_e2e", paths).values()) == {0}

    start, end = date(2018, 1, 1), date(2018, 1, 3)
    requests = pipeline.plan_weather_requests(spark, "raw_e2e", start, end)
    wanted = sorted(tuple(r) for r in requests.collect())
    batch = wanted[0][0]
    assert wanted == [(batch, 0, -23.5, -46.5, start, end), (batch, 1, -24.0, -47.0, start, end)]
    days = ["2018-01-01", "2018-01-02", "2018-01-03"]
    payload = [
        day(days, [30] * 3, [20] * 3, [1, 25, 2], [10] * 3),
        day(days, [30] * 3, [20] * 3, [1, 2, 3], [41, 10, None]),
    ]
    responses = spark.createDataFrame([(batch, json.dumps(payload))], "batch_id string, payload string")
    assert pipeline.load_weather(spark, "raw_e2e", responses) == 5
    assert pipeline.load_weather(spark, "raw_e2e", responses) == 0
    assert pipeline.plan_weather_requests(spark, "raw_e2e", start, end).count() == 0

    models = pipeline.build_models(spark, "raw_e2e", "models_e2e")
    fact = {r["order_id"]: r for r in models["fact_delivery_weather"].collect()}
    assert set(fact) == {"o1", "o3"}
    first = fact["o1"]
    assert (first["seller_id"], first["is_late_delivery"]) == ("s1", True)
    assert first["destination_station_id"] == "hub_-23.5_-46.5"
    assert first["destination_max_precipitation_mm"] == 25.0
    assert first["destination_had_severe_weather"] and first["origin_had_severe_weather"]
    assert first["origin_max_wind_speed_kmh"] == 41.0
    other = fact["o3"]
    assert (other["seller_id"], other["origin_station_id"]) == (None, None)
    assert other["origin_had_severe_weather"] is None
    assert other["destination_max_precipitation_mm"] == 2.0  # undelivered: purchase day only
    assert other["destination_had_severe_weather"] is False
    history = models["dim_customer_geography"].sort("version_number").collect()
    assert [(r["customer_zip_code_prefix"], r["is_current"]) for r in history] == [
        ("01000", False), ("02000", True),
    ]
    centroid = {r["zip_code_prefix"]: r["state"] for r in models["zip_centroid"].collect()}
    assert centroid == {"01000": "SP", "02000": "UNKNOWN"}
    assert pipeline.check_models(models).count() == 37
    bad = {**models, "fact_delivery_weather": models["fact_delivery_weather"].union(
        models["fact_delivery_weather"])}
    with pytest.raises(CheckFailedError, match="unique:order_id"):
        pipeline.check_models(bad)
    assert pipeline.check_models(bad, raise_errors=False).filter("status = 'fail'").count() == 1
    # The models are rebuilt in full; nothing piles up.
    again = pipeline.build_models(spark, "raw_e2e", "models_e2e")
    assert again["fact_delivery_weather"].count() == 2
    builds = spark.sql("SHOW TABLES IN models_e2e LIKE 'fact_delivery_weather__*'").collect()
    assert len(builds) == 2  # the replaced one stays while someone may read it


def test_a_load_that_broke_off_is_replaced(spark):
    tables.create_raw_tables(spark, "raw_broken")
    rows = spark.createDataFrame([("s1", "1", "x", "SP"), ("s2", "2", "y", "SP")],
                                 registry.SELLERS.columns)
    table = "raw_broken.sellers"
    # What a crash in the middle leaves: a started load and some of its rows.
    spark.sql(f"CREATE TABLE raw_broken.load_log ({tables.LOADS}) USING parquet")
    tables._record(spark, "raw_broken.load_log", "sellers", "a", "started")
    tables.append(rows.limit(1), table)
    assert tables.load_once(rows, table) == 2
    assert spark.table(table).count() == 2
    assert tables.load_once(rows, table) == 0
    # Rows that someone else put there stay.
    other = spark.createDataFrame([("c", "u", "1", "t", "SP")], registry.CUSTOMERS.columns)
    tables.append(other, "raw_broken.customers")
    assert tables.load_once(other.union(other), "raw_broken.customers") == 0
    assert spark.table("raw_broken.customers").count() == 1


def four_hubs(spark, database):
    """Raw tables with four prefixes, each with pings of its own."""
    tables.create_raw_tables(spark, database)
    names = ["01", "02", "03", "04"]
    customers = [(f"c{n}", f"u{n}", n, "t", "SP") for n in names]
    pings = [(n, str(10 * int(n)), str(20 * int(n)), "t", "SP") for n in names]
    tables.load_once(spark.createDataFrame(customers, registry.CUSTOMERS.columns), f"{database}.customers")
    tables.load_once(spark.createDataFrame(pings, registry.GEOLOCATION.columns), f"{database}.geolocation")


def answer(spark, rows):
    """Responses to stored requests: every day asked for, its rain telling the place."""
    payloads = {}
    for r in sorted(rows, key=lambda r: (r["batch_id"], r["pos"])):
        days = [str(r["first_day"] + timedelta(n)) for n in range((r["last_day"] - r["first_day"]).days + 1)]
        size = len(days)
        payloads.setdefault(r["batch_id"], []).append(
            day(days, [30] * size, [20] * size, [r["latitude"]] * size, [9] * size)
        )
    return spark.createDataFrame(
        [(b, json.dumps(p)) for b, p in payloads.items()], "batch_id string, payload string"
    )


def stored(spark, database):
    return sorted(
        (r["hub_identifier"], float(r["latitude"]), str(r["logistics_date"]), float(r["precipitation_sum_mm"]))
        for r in spark.table(f"{database}.weather").collect()
    )


def test_batches_are_loaded_in_any_order_and_again(spark):
    four_hubs(spark, "raw_batches")
    start, end = date(2018, 1, 1), date(2018, 1, 2)
    asked = pipeline.plan_weather_requests(spark, "raw_batches", start, end, batch_size=2).collect()
    ids = sorted({r["batch_id"] for r in asked})
    assert len(ids) == 2 and len(asked) == 4
    parts = [answer(spark, [r for r in asked if r["batch_id"] == b]) for b in ids]
    assert pipeline.load_weather(spark, "raw_batches", parts[0]) == 4
    # Another plan meanwhile has ids of its own.
    later = pipeline.plan_weather_requests(spark, "raw_batches", start, end, batch_size=2).collect()
    assert not {r["batch_id"] for r in later} & set(ids) and len(later) == 2
    assert pipeline.load_weather(spark, "raw_batches", parts[1]) == 4
    assert pipeline.load_weather(spark, "raw_batches", parts[0].union(parts[0])) == 0
    assert pipeline.load_weather(spark, "raw_batches", answer(spark, later)) == 0
    assert stored(spark, "raw_batches") == sorted(
        (f"hub_{10.0 * n}_{20.0 * n}", 10.0 * n, f"2018-01-0{d}", 10.0 * n)
        for n in (1, 2, 3, 4) for d in (1, 2)
    )


def test_missing_days_are_asked_for_alone(spark):
    four_hubs(spark, "raw_days")
    start, end = date(2018, 1, 1), date(2018, 1, 5)
    first = pipeline.plan_weather_requests(spark, "raw_days", date(2018, 1, 3), date(2018, 1, 3))
    first = first.sort("pos").collect()
    pipeline.load_weather(spark, "raw_days", answer(spark, first[:1]))
    asked = pipeline.plan_weather_requests(spark, "raw_days", start, end, "hub_day").collect()
    known = first[0]["latitude"]
    ranges = sorted((str(r["first_day"]), str(r["last_day"])) for r in asked if r["latitude"] == known)
    assert ranges == [("2018-01-01", "2018-01-02"), ("2018-01-04", "2018-01-05")]
    assert len(asked) == 5
    # A response with a day too many: that day is not loaded.
    wide = [r.asDict() | {"last_day": end} for r in asked]
    loaded = pipeline.load_weather(spark, "raw_days", answer(spark, wide))
    assert loaded == 4 * 5 - 1
    assert len({row[1:3] for row in stored(spark, "raw_days")}) == len(stored(spark, "raw_days")) == 20


def test_a_reader_of_an_older_build_finishes(spark):
    spark.sql("create database if not exists models_kept")
    table = "models_kept.model"
    first = tables.save_table(spark.range(5).withColumnRenamed("id", "Value"), table)
    second = tables.save_table(spark.range(7).withColumnRenamed("id", "Value"), table)
    # The first still reads what it was planned on, while new readers get the new build.
    assert first.count() == 5 and second.count() == 7 and spark.table(table).count() == 7
    assert analysis.read_model(spark, table, ["VALUE"]).columns == ["value"]
    tables.save_table(spark.range(9), table)
    assert len(tables._builds(spark, table)) == 3
    last = tables.save_table(spark.range(11), table, timedelta(0))
    assert len(tables._builds(spark, table)) == 1 and last.count() == 11
