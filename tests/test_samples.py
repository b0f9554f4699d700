"""The sample inputs keep growing with the tables they are derived from."""

from pyspark.sql import functions as F

from galepost import samples


def test_codes_and_positions_of_many_keys_differ(spark):
    keys = spark.range(0, 300_000)
    keys.selectExpr("id s_suppkey", "'n' s_name", "1 s_nationkey").createOrReplaceTempView("supplier")
    hubs = samples.sample(spark, "supplier_hubs")
    assert hubs.select("zip_code_prefix").distinct().count() == 300_000
    assert hubs.select("lat", "lng").distinct().count() == 300_000
    assert hubs.filter("abs(lat) > 90 or abs(lng) > 180").isEmpty()
    assert samples.sample(spark, "raw_sellers").select("seller_zip_code_prefix").distinct().count() == 300_000


def test_one_person_and_one_prefix_are_hot(spark):
    spark.range(0, 100_000).selectExpr(
        "id o_orderkey", "id div 3 o_custkey", "'O' o_orderstatus",
        "timestamp_ntz'1995-01-01' o_orderdate", "'5-LOW' o_orderpriority",
    ).createOrReplaceTempView("orders")
    spark.range(0, 100_000).selectExpr(
        "id event_id", "id div 2 user_id", "'view' event_type"
    ).createOrReplaceTempView("events")

    def most(name, column):
        counted = samples.sample(spark, name).groupBy(column).count()
        return counted.agg(F.max("count")).first()[0]

    assert most("raw_customers", "customer_unique_id") > 20_000
    assert most("raw_geolocation", "geolocation_zip_code_prefix") >= 25_000
