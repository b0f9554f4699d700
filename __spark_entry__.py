
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from galepost import samples  # noqa: E402
from galepost.operators import hubs as hub_ops  # noqa: E402
from galepost.operators.checks import out_of_tolerance  # noqa: E402
from galepost.operators.interval import interval_agg_join  # noqa: E402
from galepost.plans import analysis, marts, quality, staging, transform  # noqa: E402
from galepost.session import stage, tune  # noqa: E402
from galepost.sources import csv_files, tables, weather_json  # noqa: E402
from galepost.sources.registry import ORDERS  # noqa: E402

from oracle_queries import ORACLE_SQL  # noqa: E402

try:  # these folders, and the libraries that only they need, may be left out
    import corpus_pipeline  # noqa: E402
    from galepost.llm import queries as llm_queries  # noqa: E402
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
RESUME_DAYS = (date(1998, 1, 5), date(1998, 1, 6))
LOADED_BEFORE = date(1995, 1, 1)


class Staged(dict):
    """Staging models by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark = spark

    def __missing__(self, name: str) -> DataFrame:
        raw = samples.sample(self.spark, f"raw_{name}")
        self[name] = staging.MODELS[name](raw)
        return self[name]


class Models:
    """The models over one set of input tables; each is built when first asked for.

    Models that the pipeline keeps as tables are written once and read from there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        samples.open_tables(spark, sf_dir)
        self.stg = Staged(spark)
        self._built: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = stage(build(), name)
        return self._built[name]

    def centroid_plan(self, exact: bool = True) -> DataFrame:
        return transform.zip_centroid(self.stg["geolocation"], exact)

    def centroid(self) -> DataFrame:
        return self._once("zip-centroid", self.centroid_plan)

    def weather(self) -> DataFrame:
        """Staged weather for plans that read it several times: the raw days are written once,
        a station's together."""
        if "weather" not in self._built:
            raw = samples.sample(self.spark, "raw_weather")
            days = raw.sortWithinPartitions("hub_identifier", "logistics_date")
            self._built["weather"] = staging.MODELS["weather"](stage(days, "raw-weather"))
        return self._built["weather"]

    def bridge_plan(self) -> DataFrame:
        weather = self._built.get("weather", self.stg["weather"])
        return transform.weather_station_bridge(self.centroid(), weather)

    def bridge(self) -> DataFrame:
        return self._once("bridge", self.bridge_plan)

    def located(self) -> DataFrame:
        return marts.orders_with_stations(
            self.stg["orders"],
            self.stg["order_items"],
            self.stg["customers"],
            self.stg["sellers"],
            self.bridge(),
        )

    def fact_plan(self) -> DataFrame:
        weather = self.weather()
        return marts.fact_delivery_weather(
            self.stg["orders"],
            self.stg["order_items"],
            self.stg["customers"],
            self.stg["sellers"],
            self.bridge(),
            weather,
        )

    def fact(self, *columns: str) -> DataFrame:
        """The columns of the fact that are read, written once for several readers."""
        return self._once("fact", lambda: self.fact_plan().select(*columns))

    def dim_plan(self) -> DataFrame:
        return marts.dim_customer_geography(self.stg["orders"], self.stg["customers"])

    def dim(self) -> DataFrame:
        return self._once("dim", self.dim_plan)

    def events(self) -> DataFrame:
        return marts.address_events(self.stg["orders"], self.stg["customers"])

    def checked(self, name: str) -> DataFrame:
        """A model that checks look at, built when first asked for."""
        if name == "stg_weather":
            return self.weather()
        if name.startswith("stg_"):
            return self.stg[name.removeprefix("stg_")]
        return {
            "zip_centroid": self.centroid,
            "weather_station_bridge": self.bridge,
            "dim_customer_geography": self.dim,
            "fact_delivery_weather": lambda: self.fact(*quality.columns_of("fact_delivery_weather")),
        }[name]()


def _staging(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: Models(spark, sf_dir).stg[name].drop(
        "_loaded_at", "station_point"
    )


def _landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples.open_tables(tune(spark), sf_dir)
    landed = samples.sample(spark, "landed_orders")
    return csv_files.clean_columns(csv_files.select_expected(landed, ORDERS.columns))


def required_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.split_required(_landed_orders(spark, sf_dir), ORDERS.required)[0]


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.reject_counts(_landed_orders(spark, sf_dir), ORDERS.required)


def hub_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples.open_tables(tune(spark), sf_dir)
    return csv_files.located_pings(samples.sample(spark, "landed_geolocation"))


def relevant_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples.open_tables(tune(spark), sf_dir)
    return hub_ops.relevant_prefixes(
        samples.sample(spark, "raw_customers"), samples.sample(spark, "raw_sellers")
    )


def relevant_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub_ops.relevant_pings(hub_pings(spark, sf_dir), relevant_prefixes(spark, sf_dir))


def zip_mean_coord(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub_ops.prefix_means(hub_pings(spark, sf_dir), relevant_prefixes(spark, sf_dir))


def weather_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hub_ops.weather_hubs(hub_pings(spark, sf_dir), relevant_prefixes(spark, sf_dir))


def hub_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples.open_tables(tune(spark), sf_dir)
    pinged = csv_files.pinged_prefixes(samples.sample(spark, "landed_geolocation"))
    return hub_ops.hub_reduction(
        pinged, relevant_prefixes(spark, sf_dir), weather_hubs(spark, sf_dir)
    )


def _payload_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_json.payload_days(*samples.weather_responses(tune(spark), sf_dir))


def weather_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_json.weather_rows(_payload_days(spark, sf_dir))


def weather_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_json.weather_reject_counts(_payload_days(spark, sf_dir))


def _supplier_hubs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every supplier as a wanted hub, and the stored weather."""
    samples.open_tables(tune(spark), sf_dir)
    return samples.sample(spark, "supplier_hubs"), samples.sample(spark, "raw_weather")


def loaded_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.loaded_locations(_supplier_hubs(spark, sf_dir)[1], *RESUME_DAYS)


def pending_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.pending_hubs(*_supplier_hubs(spark, sf_dir), *RESUME_DAYS, "hub")


def pending_hub_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    hubs, weather = _supplier_hubs(spark, sf_dir)
    return tables.pending_hubs(hubs, weather, *RESUME_DAYS, "batch", batch_size=5).drop(
        "hub_position"
    )


def pending_hub_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.pending_hubs(*_supplier_hubs(spark, sf_dir), *RESUME_DAYS, "hub_day")


def weather_resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second load of all responses, twice each, adds to an earlier load cut short."""
    # Read three times.
    rows = stage(weather_payload_rows(spark, sf_dir), "payload-rows")
    stored = rows.filter(F.col("logistics_date") < F.lit(LOADED_BEFORE))
    return tables.new_weather(rows.unionByName(rows), stored)


def zip_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Models(spark, sf_dir).centroid_plan().drop("centroid_point")


def zip_centroid_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Models(spark, sf_dir).centroid_plan(exact=False).drop("centroid_point")


def distinct_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = transform.distinct_stations(Models(spark, sf_dir).stg["weather"])
    return stations.select(
        "station_id",
        F.col("station_point.lat").alias("station_lat"),
        F.col("station_point.lng").alias("station_lng"),
    )


def order_origin_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Models(spark, sf_dir).located().select(
        "order_id",
        "customer_id",
        "seller_id",
        *(
            f"{role}_{column}"
            for role in ("destination", "origin")
            for column in ("station_id", "distance_km", "is_within_tolerance")
        ),
    )


def _interval_join(strategy: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = Models(spark, sf_dir)
        weather = models.weather()
        # Read by the windows and by the final join.
        located = stage(
            models.located().select(
                "order_id", "destination_station_id", "window_from", "window_to"
            ),
            "located-destinations",
        )
        return interval_agg_join(
            located,
            weather.withColumnRenamed("station_id", "destination_station_id"),
            "destination_station_id",
            "window_from",
            "window_to",
            "weather_date",
            marts.WEATHER_AGGS,
            strategy,
        )

    return query


def customer_address_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "customer_unique_id": "person_before",
        "customer_zip_code_prefix": "zip_before",
        "customer_city": "city_before",
        "customer_state": "state_before",
    }
    return Models(spark, sf_dir).events().select(
        "order_id",
        "order_purchase_timestamp",
        *names,
        *(F.col(f"previous.{column}").alias(name) for column, name in names.items()),
    )


def address_version_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Models(spark, sf_dir).events().select(
        "order_id", marts.PERSON, "order_purchase_timestamp", "version_number"
    )


def scd2_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = Models(spark, sf_dir)
    return marts.version_counts(models.stg["orders"], models.stg["customers"])


def _model(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Models(spark, sf_dir))


def _report(*kinds: str) -> Callable[[Models], DataFrame]:
    return lambda models: quality.quality_report(models.checked, kinds)


def dq_unique(models: Models) -> DataFrame:
    others = tuple(name for name in quality.UNIQUE if name != "dim_customer_geography")
    return quality.quality_report(models.checked, ("unique",), others)


def dq_unique_expr(models: Models) -> DataFrame:
    return quality.quality_report({"dim_customer_geography": models.dim_plan()}, ("unique",))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every order with the weather at both ends of its way."""
    return Models(spark, SMOKE_DIR).fact_plan()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or named output."""
    return {
        "clean_null_tokens": _landed_orders,
        "required_rows": required_rows,
        "reject_counts": reject_counts,
        "hub_pings": hub_pings,
        "relevant_prefixes": relevant_prefixes,
        "relevant_pings": relevant_pings,
        "zip_mean_coord": zip_mean_coord,
        "weather_hubs": weather_hubs,
        "hub_reduction": hub_reduction,
        "weather_payload_rows": weather_payload_rows,
        "weather_reject_counts": weather_reject_counts,
        "loaded_hubs": loaded_hubs,
        "pending_hubs": pending_hubs,
        "pending_hub_batches": pending_hub_batches,
        "pending_hub_days": pending_hub_days,
        "weather_resume_rows": weather_resume_rows,
        **{f"stg_{name}": _staging(name) for name in staging.MODELS},
        "zip_ping_count": _model(lambda m: transform.zip_ping_count(m.stg["geolocation"])),
        "zip_state_mode": _model(lambda m: transform.zip_state_mode(m.stg["geolocation"])),
        "zip_centroid": zip_centroid,
        "zip_centroid_approx": zip_centroid_approx,
        "distinct_stations": distinct_stations,
        "zip_station_bridge": _model(Models.bridge_plan),
        "first_seller_per_order": _model(
            lambda m: marts.first_seller_per_order(m.stg["order_items"])
        ),
        "orders_customers_inner": _model(
            lambda m: marts.customer_orders(m.stg["orders"], m.stg["customers"])
        ),
        "order_origin_dest": order_origin_dest,
        "interval_join_explode": _interval_join("auto"),
        "interval_join_range": _interval_join("range"),
        "fact_delivery_weather": _model(Models.fact_plan),
        "customer_address_lag": customer_address_lag,
        "address_version_number": address_version_number,
        "dim_customer_geography": _model(Models.dim_plan),
        "scd2_version_counts": scd2_version_counts,
        "scd2_change_rate": lambda spark, d: marts.change_rate(scd2_version_counts(spark, d)),
        "late_rate_by_severe_dest": _model(
            lambda m: analysis.late_rate_by_severe(m.fact_plan(), "destination")
        ),
        "late_rate_by_severe_origin": _model(
            lambda m: analysis.late_rate_by_severe(m.fact_plan(), "origin")
        ),
        "headline_metrics": _model(lambda m: analysis.headline_metrics(m.fact_plan())),
        "monthly_late_rate": _model(lambda m: analysis.monthly_late_rate(m.fact(*analysis.MONTHLY))),
        "distance_histogram": _model(lambda m: analysis.distance_histogram(m.bridge())),
        "pct_within_tolerance": _model(lambda m: analysis.pct_within_tolerance(m.bridge_plan())),
        "dq_not_null": _model(_report("not_null")),
        "dq_unique": _model(dq_unique),
        "dq_unique_expr": _model(dq_unique_expr),
        "dq_greater_than_zero": _model(
            lambda m: quality.quality_report(
                {"zip_centroid": m.centroid_plan()}, ("greater_than_zero",)
            )
        ),
        "dq_bridge_coverage": _model(lambda m: out_of_tolerance(m.bridge_plan())),
        "dq_report": _model(_report()),
        "dq_fact_rowcount": _model(
            lambda m: quality.fact_row_count(m.fact_plan(), m.stg["orders"])
        ),
        **(llm_queries.QUERIES if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    """For each query, SQL that DuckDB runs on the same tables."""
    return {
        **ORACLE_SQL,
        **(llm_queries.ORACLE_SQL if llm_queries else {}),
        **(
            {"pipeline": corpus_pipeline.ORACLE_SQL}
            if corpus_pipeline and corpus_pipeline.ORACLE_SQL
            else {}
        ),
    }
