"""Times the refresh jobs and the headline queries; prints one JSON line.

Refresh steps are timed once, in the order a manual refresh runs them, each from tables already
built by the steps before it; so is the training of the model. Operators and queries are then timed over those tables, best of three runs, into
the no-op sink, so every row and column is computed and nothing is sent to the driver.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from verification import registry
from verification.lake import GENERATED_AT, Lake, lake
from wattloom.operators.keys import latest_per_key
from wattloom.operators.quality import split_valid
from wattloom.plans import facts, features, forecast
from wattloom.session import local_session
from wattloom.sources.feeds import CARBON, GENERATION, WEATHER

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

REFRESH: dict[str, Callable[[Lake], object]] = {
    "refresh_bronze_carbon": lambda lk: lk.bronze(CARBON),
    "refresh_bronze_weather": lambda lk: lk.bronze(WEATHER),
    "refresh_bronze_generation": lambda lk: lk.bronze(GENERATION),
    "refresh_silver_carbon": lambda lk: lk.silver(CARBON),
    "refresh_silver_weather": lambda lk: lk.silver(WEATHER),
    "refresh_silver_generation": lambda lk: lk.silver(GENERATION),
    "refresh_dimensions": lambda lk: lk.dim_time(),
    "refresh_grid_state": lambda lk: lk.grid_state(),
    "refresh_fact_carbon": lambda lk: lk.fact_carbon(),
    "refresh_fact_fuel": lambda lk: lk.fact_fuel(),
    "refresh_fact_grid": lambda lk: lk.fact_grid(),
    "refresh_features": lambda lk: lk.features(),
    "refresh_forecast": lambda lk: lk.forecast(),
}

# Operators on the tables they read, where the query of the name only scans what a step has built.
OPERATORS: dict[str, Callable[[Lake], DataFrame]] = {
    "op_dedup_latest": lambda lk: latest_per_key(split_valid(CARBON.checked(lk.bronze(CARBON)))[0], CARBON.key),
    "op_fact_fuel": lambda lk: facts.fact_generation_fuel(lk.silver(GENERATION), lk.dim_fuel_type())[0],
    "op_fact_carbon": lambda lk: facts.fact_carbon_30min(lk.silver(CARBON), lk.dim_uk_region())[0],
    "op_fact_grid": lambda lk: facts.fact_grid_hourly(lk.grid_state(), lk.dim_fuel_type()),
    "op_features": lambda lk: features.training_features(lk.fact_grid()),
}

QUERIES = [
    "envelope_build",
    "flatten_regions",
    "flatten_hourly_arrays",
    "flatten_generation_xml",
    "hourly_sum_of_series_means",
    "nest_mix",
    "parse_carbon",
    "validate_weather",
    "quality_counts",
    "dedup_latest",
    "upsert",
    "fact_generation_fuel",
    "fact_grid_hourly",
    "eu_rankings",
    "uk_rankings",
    "uk_kpis",
    "country_fuel_mix",
    "fuel_mix_latest",
    "eu_kpis",
    "trend_24h",
    "cleanest_window",
    "latest_forecast",
    "layer_row_counts",
    "freshness",
    "orphan_check",
    "calendar_gaps",
    "features",
    "features_time_true",
    "feature_correlation",
    "regression_metrics",
]


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/events.parquet").write.format("noop").mode("overwrite").save()
    tables = lake(spark, SF_DIR)
    seconds: dict[str, float] = {}

    for name, step in REFRESH.items():
        start = time.perf_counter()
        step(tables)
        seconds[name] = round(time.perf_counter() - start, 3)

    def best(build: Callable[[], DataFrame]) -> float:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        return round(min(runs), 3)

    for name, operator in OPERATORS.items():
        seconds[name] = best(lambda build=operator: build(tables))

    start = time.perf_counter()
    parts = features.temporal_split(tables.features(), registry.SPLIT, validation_days=2)
    model = forecast.train(parts["train"], parts["validation"])
    seconds["model_train"] = round(time.perf_counter() - start, 3)
    seconds["model_score"] = best(
        lambda: forecast.forecast_rows(
            forecast.predict(model, forecast.inference_window(tables.features())), generated_at=registry.at(GENERATED_AT)
        )
    )

    registered = registry.queries()
    for name in QUERIES:
        seconds[name] = best(lambda query=registered[name]: query(spark, SF_DIR))

    start = time.perf_counter()
    registry.flagship(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds["flagship_from_raw_events"] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "total seconds, full layer refresh and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
