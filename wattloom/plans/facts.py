"""Gold facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.instants import time_key
from wattloom.functions.measures import array_total, grams_per_hour, intensity, share_pct
from wattloom.operators.keys import match_dimension
from wattloom.operators.quality import half_hour

GENERATION_TAXONOMY = "entsoe"


def fact_generation_fuel(
    generation: DataFrame, fuels: DataFrame, on_orphan: str = "quarantine"
) -> tuple[DataFrame, DataFrame | None]:
    """(fact rows per country, hour and fuel; rows whose code the fuel dimension lacks)."""
    exploded = generation.select(
        F.col("period_start").alias("hour_utc"),
        "country_code",
        "ingested_at",
        F.explode("generation_mix").alias("_fuel"),
    ).select(
        "hour_utc",
        "country_code",
        "ingested_at",
        F.col("_fuel.psr_type").alias("source_psr_type"),
        F.col("_fuel.value_mw").alias("value_mw"),
    )
    dim = fuels.filter(F.col("source_taxonomy") == GENERATION_TAXONOMY).select(
        "source_code",
        "fuel_key",
        F.col("display_name").alias("fuel_display_name"),
        "fuel_category",
        "is_renewable",
        "is_low_carbon",
        "typical_gco2_per_kwh",
    )
    matched, orphans = match_dimension(
        exploded, dim, "source_psr_type", "source_code", on_orphan
    )
    fact = matched.select(
        time_key(F.col("hour_utc")).alias("time_key"),
        F.col("country_code").alias("country_key"),
        "fuel_key",
        "hour_utc",
        "country_code",
        "source_psr_type",
        "fuel_display_name",
        "fuel_category",
        "is_renewable",
        "is_low_carbon",
        "value_mw",
        "typical_gco2_per_kwh",
        grams_per_hour(F.col("value_mw"), F.col("typical_gco2_per_kwh")).alias(
            "estimated_gco2_per_hour"
        ),
        "ingested_at",
    )
    return fact, orphans


def fact_grid_hourly(grid_state: DataFrame, fuels: DataFrame) -> DataFrame:
    """One row per (country, hour) with generation shares and lifecycle carbon.

    The mix is summed inside its row: the fuel attributes (twenty rows) become one map literal,
    so there is no explode, no shuffle and no join back to the row the mix came from. Codes the
    dimension lacks add nothing to the sums but stay in total_generation_mw, the denominator; a
    row with no known code has NULL measures.
    """
    attributes = F.struct("is_renewable", "is_low_carbon", "typical_gco2_per_kwh")
    by_code = (
        fuels.filter(F.col("source_taxonomy") == GENERATION_TAXONOMY)
        .agg(F.map_from_entries(F.collect_list(F.struct("source_code", attributes))))
        .scalar()
    )
    known = F.filter(
        F.transform(
            "generation_mix",
            lambda x: F.struct(
                x["value_mw"].alias("mw"), F.try_element_at(F.col("_fuels"), x["psr_type"]).alias("fuel")
            ),
        ),
        lambda x: x["fuel"].isNotNull(),
    )

    def flagged(flag: str) -> Column:
        return array_total(
            F.transform("_known", lambda x: F.when(x["fuel"][flag], x["mw"]).otherwise(0.0))
        )

    grams = array_total(
        F.transform("_known", lambda x: grams_per_hour(x["mw"], x["fuel"]["typical_gco2_per_kwh"]))
    )
    total = F.col("total_generation_mw")
    return (
        grid_state.withColumn("_fuels", by_code)
        .withColumn("_known", known)
        .withColumns(
            {
                "renewable_generation_mw": flagged("is_renewable"),
                "low_carbon_generation_mw": flagged("is_low_carbon"),
                "estimated_lifecycle_gco2_per_hour": grams,
            }
        )
        .select(
            time_key(F.col("hour_utc")).alias("time_key"),
            F.col("country_code").alias("country_key"),
            "hour_utc",
            "country_code",
            "temperature_c",
            "wind_speed_kmh",
            "cloud_cover_pct",
            "solar_radiation_wm2",
            "total_generation_mw",
            "renewable_generation_mw",
            "low_carbon_generation_mw",
            share_pct(F.col("renewable_generation_mw"), total).alias("renewable_share_pct"),
            share_pct(F.col("low_carbon_generation_mw"), total).alias("low_carbon_share_pct"),
            intensity(F.col("estimated_lifecycle_gco2_per_hour"), total).alias(
                "estimated_lifecycle_gco2_per_kwh"
            ),
            "estimated_lifecycle_gco2_per_hour",
            "uk_carbon_intensity_forecast",
            "ingested_at",
        )
    )


def fact_carbon_30min(
    carbon: DataFrame, regions: DataFrame, on_orphan: str = "quarantine"
) -> tuple[DataFrame, DataFrame | None]:
    """(fact rows per region and half hour; rows of regions the dimension lacks)."""
    dim = regions.select(
        F.col("region_id").alias("dim_region_id"),
        F.col("region_code").alias("dim_region_code"),
        F.col("region_name").alias("dim_region_name"),
        "region_type",
        F.col("country_code").alias("country_key"),
    )
    matched, orphans = match_dimension(carbon, dim, "region_id", "dim_region_id", on_orphan)
    actual = F.col("intensity_actual")
    fact = matched.select(
        time_key(F.col("period_start")).alias("time_key"),
        "region_id",
        "country_key",
        "period_start",
        "period_end",
        half_hour(F.col("period_start")).alias("half_hour"),
        F.col("dim_region_code").alias("region_code"),
        F.col("dim_region_name").alias("region_name"),
        "region_type",
        "intensity_forecast",
        "intensity_actual",
        "intensity_index",
        F.when(actual.isNotNull(), "actual").otherwise("forecast").alias("source_type"),
        actual.isNotNull().alias("has_actual"),
        (F.col("intensity_forecast") - actual).alias("forecast_minus_actual"),
        "generation_mix",
        "source",
        "ingested_at",
        F.col("event_id").alias("source_event_id"),
    )
    return fact, orphans
