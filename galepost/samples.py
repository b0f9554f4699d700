"""Raw input tables derived from the order-and-supplier test tables.

Each view is one SQL text that Spark and DuckDB both run (``{text}`` is the engine's
text type), over whole tables. Numbers are integers or exact binary fractions, so that
both engines agree to the last bit.

- A person is a customer key; every order has a customer row of its own. Urgent orders go
  to another prefix, so people move and come back.
- A ping is an event; its user is the prefix, ten customers live in one, and urgent
  orders reach beyond the last prefix with pings.
- A weather station is a supplier; it has readings for the days on which it shipped a line.
- One person has a fifth of all orders, one prefix a quarter of all pings; the first lives in
  the second, so one station has a fifth of all windows.
- Codes are padded, never cut. Positions differ for the first 50 million keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from galepost.session import stage

# Columns of the test tables in use; given, so that opening them reads no file.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "events": "event_id bigint, user_id bigint, event_type string",
}

RAW_SQL = {
    "raw_orders": """
        select cast(o_orderkey as {text}) order_id,
               cast(o_orderkey as {text}) customer_id,
               o_orderstatus order_status,
               cast(o_orderdate as {text}) order_purchase_timestamp,
               cast(null as {text}) order_approved_at,
               cast(null as {text}) order_delivered_carrier_date,
               case when o_orderstatus = 'P' then cast(null as {text})
                    when o_orderkey % 97 = 0
                        then cast(o_orderdate - interval '1' day * 2 as {text})
                    else cast(o_orderdate + interval '1' day * cast((o_orderkey * 7) % 25 as int)
                              as {text})
               end order_delivered_customer_date,
               cast(o_orderdate + interval '1' day * cast(10 + o_custkey % 12 as int) as {text})
                   order_estimated_delivery_date
        from orders""",
    "raw_order_items": """
        select cast(l_orderkey as {text}) order_id,
               cast(l_linenumber as {text}) order_item_id,
               cast(l_partkey as {text}) product_id,
               cast(l_suppkey as {text}) seller_id,
               cast(l_shipdate as {text}) shipping_limit_date,
               cast(l_extendedprice as {text}) price,
               cast(l_tax as {text}) freight_value
        from lineitem""",
    "raw_customers": """
        select cast(o_orderkey as {text}) customer_id,
               cast(person as {text}) customer_unique_id,
               {code5:z} customer_zip_code_prefix,
               case when o_orderpriority = '2-HIGH' then cast(null as {text})
                    else concat('city_', cast(z % 50 as {text})) end customer_city,
               concat('S', cast(z % 27 as {text})) customer_state
        from (select *, cast(floor(person / cast(10 as double)) as bigint)
                        + case when o_orderpriority = '1-URGENT' then 7 else 0 end z
              from (select *, case when o_orderkey % 5 = 0 then 1 else o_custkey end person
                    from orders) o) t""",
    "raw_sellers": """
        select cast(s_suppkey as {text}) seller_id,
               {code5:seller_prefix} seller_zip_code_prefix,
               s_name seller_city,
               concat('S', cast(s_nationkey as {text})) seller_state
        from (select *, s_suppkey + cast(floor(s_suppkey / cast(2 as double)) as bigint)
                        seller_prefix
              from supplier) t""",
    "raw_geolocation": """
        select {code5:u} geolocation_zip_code_prefix,
               case when event_type = 'error' then cast(null as {text})
                    else cast(cast(-33 as double) + {lat:u:331}
                              + ((event_id * 31) % 64) / cast(64 as double) as {text})
               end geolocation_lat,
               case when event_type = 'error' then cast(null as {text})
                    else cast(cast(-70 as double) + {lng:u:457}
                              + ((event_id * 17) % 64) / cast(64 as double) as {text})
               end geolocation_lng,
               event_type geolocation_city,
               case when u % 50 = 7 or event_type = 'signup' then cast(null as {text})
                    else concat('S', cast((event_id * 7) % 5 as {text})) end geolocation_state
        from {events}""",
    "raw_weather": """
        select concat(' hub_', cast(s as {text}), ' ') hub_identifier,
               cast(cast(-33 as double) + {lat:s:1237}
                    as decimal(10,6)) latitude,
               cast(cast(-70 as double) + {lng:s:719}
                    as decimal(10,6)) longitude,
               d logistics_date,
               cast(20 + p % 15 as decimal(10,2)) temp_max_celsius,
               cast(10 + p % 7 as decimal(10,2)) temp_min_celsius,
               cast(((p * 37 + q) % 250) / cast(10 as double) as decimal(10,2))
                   precipitation_sum_mm,
               cast(((p * 11 + q * 29) % 450) / cast(10 as double) as decimal(10,2))
                   wind_speed_max_kmh
        from (select l_suppkey s, cast(l_shipdate as date) d,
                     min(l_partkey) p, max(l_orderkey) q
              from lineitem group by l_suppkey, cast(l_shipdate as date)) t""",
    # Order and ping files as they might land: padded, with null tokens and stray text.
    "landed_orders": """
        select concat('  ', cast(o_orderkey as {text})) order_id,
               concat(cast(o_custkey as {text}), chr(9)) customer_id,
               case o_orderpriority when '1-URGENT' then ' N/A '
                    when '2-HIGH' then 'NAN' when '3-MEDIUM' then concat(chr(9), o_orderstatus, ' ')
                    else o_orderstatus end order_status,
               case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'null'
                    else cast(o_orderdate as {text}) end order_purchase_timestamp,
               'nan' order_approved_at, 'None' order_delivered_carrier_date,
               '' order_delivered_customer_date, 'NULL' order_estimated_delivery_date
        from orders""",
    "landed_geolocation": """
        select concat(' ', {code5:u}) geolocation_zip_code_prefix,
               case event_type when 'error' then 'N/A' when 'signup' then '12.5 S'
                    else concat(' ', cast(cast(-33 as double)
                         + {lat:u:331}
                         + ((event_id * 31) % 64) / cast(64 as double) as {text})) end
                   geolocation_lat,
               cast(cast(-70 as double) + {lng:u:457}
                    + ((event_id * 17) % 64) / cast(64 as double) as {text}) geolocation_lng
        from {events}""",
    # Every supplier as a location to fetch weather for, at its rounded position.
    "supplier_hubs": """
        select {code7:s} zip_code_prefix,
               cast(round(cast(cast(-33 as double) + {lat:s:1237} as decimal(10,6)), 2) as double) lat,
               cast(round(cast(cast(-70 as double) + {lng:s:719} as decimal(10,6)), 2) as double) lng
        from (select s_suppkey s from supplier) t""",
    # Weather days as a response would carry them, before they are packed into payloads.
    "response_days": """
        select s, cast(floor(s / cast(100 as double)) as bigint) batch,
               cast(cast(-33 as double) + {lat:s:1237} as double)
                   latitude,
               cast(cast(-70 as double) + {lng:s:719} as double)
                   longitude,
               d, cast(date_trunc('month', d) as date) month_start,
               case when tax = 0 then 'no date' else cast(d as {text}) end day_text,
               cast(20 + p % 15 as {text}) warmest,
               cast(10 + p % 7 as {text}) coldest,
               case when line = 7 then 'trace'
                    else cast(((p * 37 + q) % 250) / cast(4 as double) as {text}) end rain,
               case when discount = 0 then cast(null as {text})
                    else cast(((p * 11 + q * 29) % 450) / cast(4 as double) as {text}) end wind
        from (select l_suppkey s, cast(l_shipdate as date) d, min(l_partkey) p,
                     max(l_orderkey) q, max(l_tax) tax, min(l_linenumber) line,
                     max(l_discount) discount
              from lineitem group by l_suppkey, cast(l_shipdate as date)) t""",
}


# Responses that arrived cut off, in both engines' SQL.
BROKEN = "(month(month_start) = 3 and (batch + year(month_start)) % 4 = 0)"

_EVENTS = "(select *, case when event_id % 4 = 0 then 0 else user_id end u from events) e"


def _padded(match: re.Match, text: str) -> str:
    code = f"cast({match[2]} as {text})"
    return f"lpad({code}, cast(greatest({match[1]}, length({code})) as int), '0')"


def _latitude(match: re.Match) -> str:
    """Offset of a key on a grid of 1/64 degree; two keys 2048 apart share it."""
    key, factor = match[1], match[2]
    far = f"cast(floor({key} / cast(16777216 as double)) as bigint) % 3"
    return f"((({key} * {factor}) % 2048 + 2048 * ({far})) / cast(64 as double))"


def _longitude(match: re.Match) -> str:
    """Offset that tells keys of the same latitude apart."""
    key, factor = match[1], match[2]
    turn = f"1031 * cast(floor({key} / cast(2048 as double)) as bigint)"
    return f"((({key} * {factor}) % 2048 + {turn}) % 8192 / cast(64 as double))"


def raw_sql(name: str, text: str) -> str:
    """One raw table in SQL, for an engine that calls its text type ``text``."""
    sql = RAW_SQL[name].replace("{events}", _EVENTS)
    sql = re.sub(r"\{code(\d+):(\w+)\}", lambda m: _padded(m, text), sql)
    sql = re.sub(r"\{lat:(\w+):(\d+)\}", _latitude, sql)
    sql = re.sub(r"\{lng:(\w+):(\d+)\}", _longitude, sql)
    return sql.replace("{text}", text)


def open_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the test tables the samples read as temporary views."""
    for table, schema in TABLES.items():
        rows = spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")
        rows.createOrReplaceTempView(table)


def sample(spark: SparkSession, name: str) -> DataFrame:
    """One raw table as a lazy DataFrame."""
    return spark.sql(raw_sql(name, "string"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six raw tables by dataset name."""
    open_tables(spark, sf_dir)
    return {
        name: sample(spark, f"raw_{name}")
        for name in ("orders", "order_items", "customers", "sellers", "geolocation", "weather")
    }


def weather_responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(responses, requests): JSON payloads of up to 100 locations and a month each.

    A location's month holds at most 31 days, so every group that is packed is small. The
    packed batches are written once, for both results.
    """
    open_tables(spark, sf_dir)
    sample(spark, "response_days").createOrReplaceTempView("response_days")
    spark.sql(f"""
        select concat(batch, '/', month_start) batch_id, {BROKEN} broken, s, latitude, longitude,
               sort_array(collect_list(struct(d, day_text, warmest, coldest, rain, wind))) days
        from response_days group by batch, month_start, s, latitude, longitude
    """).createOrReplaceTempView("location_months")
    landed = spark.sql("""
        select batch_id, broken,
               sort_array(collect_list(struct(s, latitude, longitude, days))) locations
        from location_months group by batch_id, broken
    """)
    stage(landed, "landed-batches").createOrReplaceTempView("landed_batches")
    responses = spark.sql("""
        select batch_id, if(broken, '[{"daily": {"time"', to_json(transform(locations, l -> named_struct('daily', named_struct(
            'time', l.days.day_text,
            'temperature_2m_max', l.days.warmest,
            'temperature_2m_min', l.days.coldest,
            'precipitation_sum', l.days.rain,
            'wind_speed_10m_max', l.days.wind))))) payload
        from landed_batches
    """)
    requests = spark.sql("""
        select batch_id, pos, l.latitude, l.longitude
        from landed_batches lateral view posexplode(locations) p as pos, l
    """)
    return responses, requests
