"""The layers' tables, built from the `events` table by the library's own refresh jobs.

Tables are written once per application under the shared folder and only when a query first
needs them. `Layers` gives the same tables as plans.
"""

from __future__ import annotations

import hashlib
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import fixtures as fx
from wattloom.operators import dims
from wattloom.operators.keys import latest_per_key
from wattloom.operators.quality import split_valid
from wattloom.operators.slices import Day, clustered
from wattloom.plans import facts, features, forecast, integrate, refresh
from wattloom.session import shared_folder
from wattloom.sources import bronze
from wattloom.sources.feeds import CARBON, FEEDS, GENERATION, WEATHER, Feed
from wattloom.sources.tables import Tables

RUN = "run-1"
GENERATED_AT = "2024-02-01 00:00:00"


def bronze_rows(events: DataFrame, feed: Feed) -> DataFrame:
    return bronze.enrich(
        fx.feed_frame(events, feed), date_from="measurement", ingested_at=F.col("timestamp")
    )


def forecast_fixture(feature_rows: DataFrame) -> DataFrame:
    """Forecast rows with deterministic scores over the last seven days."""
    scored = fx.persistence(forecast.inference_window(feature_rows, days=7))
    return forecast.forecast_rows(
        scored,
        model_name="persistence",
        model_version="3",
        generated_at=F.lit(GENERATED_AT).cast("timestamp"),
    )


class Layers:
    """Every table as a plan over `events`; nothing is written."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return fx.events(self.spark, self.sf_dir)

    def bronze(self, feed: Feed) -> DataFrame:
        return bronze_rows(self.events, feed)

    def silver(self, feed: Feed) -> DataFrame:
        valid, _ = split_valid(feed.checked(self.bronze(feed)))
        return latest_per_key(valid, feed.key)

    def quarantine(self, feed: Feed) -> DataFrame:
        return split_valid(feed.checked(self.bronze(feed)))[1]

    def country_dim(self) -> DataFrame:
        return dims.country_bridge(self.spark)

    def dim_country(self) -> DataFrame:
        return dims.dim_country(self.spark)

    def dim_fuel_type(self) -> DataFrame:
        return dims.dim_fuel_type(self.spark)

    def dim_uk_region(self) -> DataFrame:
        return dims.dim_uk_region(self.spark)

    def dim_time(self) -> DataFrame:
        return dims.dim_time_spanning(self.events, "ts")

    def grid_state(self) -> DataFrame:
        return integrate.grid_state(
            self.silver(GENERATION), self.silver(WEATHER), self.silver(CARBON), self.country_dim()
        )

    def fact_fuel(self) -> DataFrame:
        return facts.fact_generation_fuel(self.silver(GENERATION), self.dim_fuel_type())[0]

    def fact_carbon(self) -> DataFrame:
        return facts.fact_carbon_30min(self.silver(CARBON), self.dim_uk_region())[0]

    def fact_grid(self) -> DataFrame:
        return facts.fact_grid_hourly(self.grid_state(), self.dim_fuel_type())

    def features(self) -> DataFrame:
        return features.training_features(self.fact_grid())

    def forecast(self) -> DataFrame:
        return forecast_fixture(self.features())


class Lake(Layers):
    """The same tables written to the shared folder, partitioned by the date of their key."""

    DATED = {
        "grid_state": "silver.grid_state",
        "fact_grid": "gold.fact_grid_hourly",
        "fact_fuel": "gold.fact_generation_fuel_hourly",
        "fact_carbon": "gold.fact_carbon_intensity_30min",
        "features": "gold.feature_carbon_forecast",
    }

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        self.tables = Tables(spark, root)
        self._done: set[str] = set()
        self._building = threading.RLock()

    def _table(self, name: str, build) -> DataFrame:
        with self._building:
            if name not in self._done:
                build()
                self._done.add(name)
        return self.tables.read(name)

    def day(self, table: str) -> Day:
        """The date column of one of DATED, with the newest day of the table."""
        getattr(self, table)()
        return self.tables.day(self.DATED[table], refresh.DAY)

    def bronze(self, feed: Feed) -> DataFrame:
        name = f"bronze.{feed.topic}"

        def build() -> None:
            # Generation is a row per country and hour by then, the others a row per event.
            wide = feed is not GENERATION
            events = clustered(self.events, "ts", "event_id") if wide else self.events
            self.tables.overwrite(name, bronze_rows(events, feed), "event_date", clustered=wide)

        return self._table(name, build)

    def _refresh_silver(self, feed: Feed) -> None:
        refresh.refresh_silver(self.tables, feed, self.bronze(feed), RUN)

    def silver(self, feed: Feed) -> DataFrame:
        return self._table(f"silver.{feed.table}", lambda: self._refresh_silver(feed))

    def quarantine(self, feed: Feed) -> DataFrame:
        self.silver(feed)
        return self.tables.read(f"quarantine.{feed.table}")

    def _dimension(self, name: str) -> DataFrame:
        self._table(name, lambda: refresh.refresh_dimensions(self.tables, self.events, "ts"))
        self._done.update(
            ["silver.country_dim", "gold.dim_country", "gold.dim_fuel_type"]
            + ["gold.dim_uk_region", "gold.dim_time"]
        )
        return self.tables.read(name)

    def country_dim(self) -> DataFrame:
        return self._dimension("silver.country_dim")

    def dim_country(self) -> DataFrame:
        return self._dimension("gold.dim_country")

    def dim_fuel_type(self) -> DataFrame:
        return self._dimension("gold.dim_fuel_type")

    def dim_uk_region(self) -> DataFrame:
        return self._dimension("gold.dim_uk_region")

    def dim_time(self) -> DataFrame:
        return self._dimension("gold.dim_time")

    def grid_state(self) -> DataFrame:
        def build() -> None:
            for feed in FEEDS:
                self.silver(feed)
            self.country_dim()
            refresh.refresh_grid_state(self.tables)

        return self._table("silver.grid_state", build)

    def fact_fuel(self) -> DataFrame:
        def build() -> None:
            self.silver(GENERATION), self.dim_fuel_type()
            refresh.refresh_fact_fuel(self.tables, RUN)

        return self._table("gold.fact_generation_fuel_hourly", build)

    def fact_carbon(self) -> DataFrame:
        def build() -> None:
            self.silver(CARBON), self.dim_uk_region()
            refresh.refresh_fact_carbon(self.tables, RUN)

        return self._table("gold.fact_carbon_intensity_30min", build)

    def fact_grid(self) -> DataFrame:
        def build() -> None:
            self.grid_state(), self.dim_fuel_type()
            refresh.refresh_fact_grid(self.tables)

        return self._table("gold.fact_grid_hourly", build)

    def features(self) -> DataFrame:
        def build() -> None:
            self.fact_grid()
            refresh.refresh_features(self.tables)

        return self._table("gold.feature_carbon_forecast", build)

    def forecast(self) -> DataFrame:
        return self._table(
            "gold.fact_carbon_forecast",
            lambda: refresh.refresh_forecast(self.tables, forecast_fixture(self.features())),
        )


_lakes: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The application's lake over a data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        folder = shared_folder(spark)
        if folder is None:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{folder.rstrip('/')}/wattloom/{key[0]}-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
        _lakes[key] = Lake(spark, sf_dir, root)
    return _lakes[key]
