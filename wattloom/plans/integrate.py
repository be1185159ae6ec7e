"""Silver grid state: generation with the capital's weather and, for GB, measured carbon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.instants import hour_of
from wattloom.operators.dims import NATIONAL_REGION_CODE


def carbon_hourly(carbon: DataFrame, region_code: str = NATIONAL_REGION_CODE) -> DataFrame:
    """Half-hours of one region to hours: mean forecast, and the earliest label of the hour."""
    labelled = F.col("intensity_index").isNotNull()
    return (
        carbon.filter(F.col("region_code") == region_code)
        .groupBy(hour_of(F.col("period_start")).alias("hour_utc"))
        .agg(
            F.avg("intensity_forecast").alias("uk_carbon_intensity_forecast"),
            F.min_by("intensity_index", F.when(labelled, F.col("period_start"))).alias(
                "uk_carbon_intensity_index"
            ),
        )
    )


def grid_state(
    generation: DataFrame, weather: DataFrame, carbon: DataFrame, countries: DataFrame
) -> DataFrame:
    """One row per (country, hour). Weather and carbon are optional for every row.

    Broadcast is the six-row bridge. Weather grows with its cities and carbon with its history;
    how they are joined is left to their size.
    """
    g = generation.select(
        F.col("period_start").alias("hour_utc"),
        "country_code",
        "country_name",
        "total_generation_mw",
        "generation_mix",
        "ingested_at",
    )
    bridge = countries.select("country_code", "capital_city")
    w = weather.select(
        F.col("city").alias("capital_city"),
        F.col("time_utc").alias("hour_utc"),
        "temperature_c",
        "wind_speed_kmh",
        "cloud_cover_pct",
        "solar_radiation_wm2",
    )
    c = carbon_hourly(carbon).withColumnRenamed("hour_utc", "carbon_hour")
    # The country test belongs to the join: as a filter it would drop the other countries.
    gb_hour = (F.col("country_code") == "GB") & (F.col("hour_utc") == F.col("carbon_hour"))
    return (
        g.join(F.broadcast(bridge), "country_code", "left")
        .join(w, ["capital_city", "hour_utc"], "left")
        .join(c, gb_hour, "left")
        .select(
            "hour_utc",
            "country_code",
            "country_name",
            "temperature_c",
            "wind_speed_kmh",
            "cloud_cover_pct",
            "solar_radiation_wm2",
            "total_generation_mw",
            "generation_mix",
            "uk_carbon_intensity_forecast",
            "uk_carbon_intensity_index",
            "ingested_at",
        )
    )
