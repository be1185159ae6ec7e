"""Dashboard and question-answering reports over the gold facts.

Arguments are column literals, never spliced into SQL text. Pass `day` where the fact is
partitioned by a date column, so that only the partitions a report needs are read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.measures import stable_sum, tons
from wattloom.operators.dims import NATIONAL_REGION_ID
from wattloom.operators.quantiles import quantile_by_group
from wattloom.operators.slices import latest_slice, trailing_slice

# Countries the per-country reports answer for.
REPORT_COUNTRIES = ["DE", "ES", "FR", "IT", "NL"]


def checked_country(country: str) -> str:
    code = country.upper()
    if code not in REPORT_COUNTRIES:
        raise ValueError(f"country must be one of {REPORT_COUNTRIES}, got {country!r}")
    return code


def _sum_mw(digits: int = 0) -> Column:
    return F.round(stable_sum("value_mw"), digits)


def _sum_tons(digits: int) -> Column:
    return F.round(tons(stable_sum("estimated_gco2_per_hour")), digits)


# --- grid fact --------------------------------------------------------------------------------


def _grid_columns(detail: bool) -> list[Column]:
    columns = [F.col("country_code"), F.col("hour_utc"), F.round("total_generation_mw", 0).alias("total_mw")]
    if detail:
        columns += [
            F.round("renewable_generation_mw", 0).alias("renewable_mw"),
            F.round("low_carbon_generation_mw", 0).alias("low_carbon_mw"),
        ]
    columns += [
        F.col("renewable_share_pct"),
        F.col("low_carbon_share_pct"),
        F.col("estimated_lifecycle_gco2_per_kwh").alias("gco2_per_kwh"),
        F.round(tons(F.col("estimated_lifecycle_gco2_per_hour")), 0).alias("tons_co2_per_hour"),
    ]
    return columns + ([F.col("uk_carbon_intensity_forecast")] if detail else [])


def eu_rankings(grid: DataFrame, day: str | None = None) -> DataFrame:
    """Countries from cleanest to dirtiest at the newest hour."""
    return (
        latest_slice(grid, "hour_utc", day)
        .select(*_grid_columns(detail=False))
        .orderBy("gco2_per_kwh", "country_code")
    )


def grid_latest(grid: DataFrame, day: str | None = None) -> DataFrame:
    """The newest hour in full, dirtiest first."""
    return (
        latest_slice(grid, "hour_utc", day)
        .select(*_grid_columns(detail=True))
        .orderBy(F.desc("gco2_per_kwh"), "country_code")
    )


def grid_state_latest(state: DataFrame, day: str | None = None) -> DataFrame:
    return (
        latest_slice(state, "hour_utc", day)
        .select(
            "hour_utc",
            "country_code",
            F.round("temperature_c", 1).alias("temp_c"),
            F.round("wind_speed_kmh", 1).alias("wind_kmh"),
            "cloud_cover_pct",
            F.round("solar_radiation_wm2", 0).alias("solar_wm2"),
            F.round("total_generation_mw", 0).alias("gen_mw"),
            F.col("uk_carbon_intensity_forecast").alias("uk_co2_gpkwh"),
        )
        .orderBy("country_code")
    )


def trend_24h(grid: DataFrame, country: str, day: str | None = None) -> DataFrame:
    """One country over the 24 hours before the newest hour of the whole table."""
    return (
        trailing_slice(grid, "hour_utc", 24, day)
        .filter(F.col("country_code") == checked_country(country))
        .select(
            "hour_utc",
            F.round("total_generation_mw", 0).alias("total_mw"),
            "renewable_share_pct",
            "low_carbon_share_pct",
            F.col("estimated_lifecycle_gco2_per_kwh").alias("gco2_per_kwh"),
        )
        .orderBy("hour_utc")
    )


# --- fuel fact --------------------------------------------------------------------------------


def fuel_mix_latest(fuel: DataFrame, day: str | None = None) -> DataFrame:
    """MW and CO2 per country and category at the newest hour."""
    return (
        latest_slice(fuel, "hour_utc", day)
        .groupBy("country_code", "fuel_category")
        .agg(
            _sum_mw().alias("total_mw"),
            _sum_tons(0).alias("tons_co2_per_hour"),
            F.bool_or("is_renewable").alias("is_renewable_category"),
            F.max("hour_utc").alias("hour_utc"),
        )
        .orderBy("country_code", F.desc("total_mw"), "fuel_category")
    )


def eu_kpis(fuel: DataFrame, day: str | None = None) -> DataFrame:
    """Headline figures of the newest hour over all countries, one row."""
    mw = stable_sum("value_mw")
    renewable = stable_sum(F.when(F.col("is_renewable"), F.col("value_mw")).otherwise(0.0))
    weighted = stable_sum(F.col("value_mw") * F.col("typical_gco2_per_kwh"))
    return latest_slice(fuel, "hour_utc", day).agg(
        _sum_mw().alias("total_mw"),
        _sum_tons(0).alias("total_tons_co2_per_hour"),
        F.when(mw != 0, F.round(100.0 * renewable / mw, 1)).alias("renewable_pct"),
        F.when(mw != 0, F.round(weighted / mw, 0)).alias("eu_avg_gco2_per_kwh"),
        F.count_distinct("country_code").alias("countries_reporting"),
    )


def co2_24h_by_country(fuel: DataFrame, day: str | None = None) -> DataFrame:
    return (
        trailing_slice(fuel, "hour_utc", 24, day)
        .groupBy("country_code", "hour_utc")
        .agg(_sum_tons(0).alias("tons_co2_per_hour"), _sum_mw().alias("total_mw"))
        .orderBy("country_code", "hour_utc")
    )


def country_fuel_mix(fuel: DataFrame, country: str, day: str | None = None) -> DataFrame:
    """One country's fuels at its own newest hour, biggest emitter first."""
    own = fuel.filter(F.col("country_code") == checked_country(country))
    return (
        latest_slice(own, "hour_utc", day and str(day))
        .groupBy("fuel_category", "fuel_display_name")
        .agg(
            _sum_mw().alias("mw"),
            _sum_tons(1).alias("tons_co2_per_hour"),
            F.max("typical_gco2_per_kwh").alias("gco2_per_kwh_factor"),
        )
        .orderBy(F.desc("tons_co2_per_hour"), "fuel_display_name")
    )


def country_lifecycle_mix(fuel: DataFrame, country: str, day: str | None = None) -> DataFrame:
    """One country's fuel rows at its newest hour, by MW."""
    own = fuel.filter(F.col("country_code") == checked_country(country))
    return (
        latest_slice(own, "hour_utc", day and str(day))
        .select(
            "country_code",
            "fuel_category",
            "fuel_display_name",
            "hour_utc",
            F.round("value_mw", 1).alias("mw"),
            "typical_gco2_per_kwh",
            F.round(tons(F.col("estimated_gco2_per_hour")), 1).alias("estimated_tco2_per_hour"),
        )
        .orderBy(F.desc("mw"), "fuel_display_name")
    )


def fuel_category_summary(fuels: DataFrame, fuel: DataFrame) -> DataFrame:
    """Per category: dimension counts and mean factor, and what the fact has seen of it.

    The fact is reduced to one row per category before it meets the dimension.
    """
    seen = fuel.groupBy("fuel_category").agg(
        F.count(F.lit(1)).alias("fact_rows"), _sum_mw().alias("observed_mw")
    )
    listed = fuels.groupBy("fuel_category").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("is_renewable").alias("renewables"),
        F.count_if("is_low_carbon").alias("low_carbon"),
        F.round(F.avg("typical_gco2_per_kwh"), 0).alias("avg_gco2_per_kwh"),
    )
    return listed.join(seen, "fuel_category", "left").orderBy(F.desc("avg_gco2_per_kwh"), "fuel_category")


def fuel_coverage(generation: DataFrame, min_hours: int = 100) -> DataFrame:
    """Fuels reported by each country for more than `min_hours` hours."""
    return (
        generation.select("country_code", F.explode("generation_mix").alias("_fuel"))
        .groupBy(
            "country_code",
            F.col("_fuel.psr_type").alias("psr_type"),
            F.col("_fuel.name").alias("psr_name"),
        )
        .agg(
            F.count(F.lit(1)).alias("hours_with_data"),
            F.round(F.avg("_fuel.value_mw"), 0).alias("avg_mw"),
        )
        .filter(F.col("hours_with_data") > min_hours)
        .orderBy("country_code", F.desc("avg_mw"), "psr_type")
    )


# --- carbon fact ------------------------------------------------------------------------------


def _region_columns(*more: str) -> list[Column]:
    return [
        F.col("region_name"),
        F.col("region_type"),
        F.col("period_start"),
        F.col("intensity_forecast").alias("gco2_per_kwh"),
        F.col("intensity_index"),
        *[F.col(c) for c in more],
    ]


def uk_rankings(carbon: DataFrame, day: str | None = None) -> DataFrame:
    """Regions from cleanest to dirtiest at the newest half hour."""
    return (
        latest_slice(carbon, "period_start", day)
        .select(*_region_columns("source_type"))
        .orderBy("gco2_per_kwh", "region_name")
    )


def uk_spread(carbon: DataFrame, day: str | None = None) -> DataFrame:
    """Dirtiest first, with how far the actual came out above the forecast."""
    return (
        latest_slice(carbon, "period_start", day)
        .select(
            *_region_columns("source_type"),
            (F.col("intensity_actual") - F.col("intensity_forecast")).alias("actual_minus_forecast"),
        )
        .orderBy(F.desc("gco2_per_kwh"), "region_name")
    )


def uk_latest_map(carbon: DataFrame, regions: DataFrame, day: str | None = None) -> DataFrame:
    """Newest half hour with the regions' coordinates (eighteen-row dimension, broadcast)."""
    places = F.broadcast(regions.select("region_id", "approx_lat", "approx_lon"))
    return (
        latest_slice(carbon, "period_start", day)
        .select("region_id", *_region_columns("source_type"))
        .join(places, "region_id", "left")
    )


def uk_kpis(carbon: DataFrame, day: str | None = None) -> DataFrame:
    """Range and mean over regions at the newest half hour, and the national value; one row."""
    forecast = F.col("intensity_forecast")
    return latest_slice(carbon, "period_start", day).agg(
        F.max("period_start").alias("latest_period"),
        F.max(forecast).alias("dirtiest_gco2_per_kwh"),
        F.min(forecast).alias("cleanest_gco2_per_kwh"),
        F.avg(forecast).alias("avg_gco2_per_kwh"),
        F.max(F.when(F.col("region_id") == NATIONAL_REGION_ID, forecast)).alias(
            "gb_national_gco2_per_kwh"
        ),
    )


def regional_24h(carbon: DataFrame, region_type: str | None = None, day: str | None = None) -> DataFrame:
    """The last 24 hours of every region, or of one type of region."""
    rows = trailing_slice(carbon, "period_start", 24, day)
    if region_type is not None:
        rows = rows.filter(F.col("region_type") == region_type)
    return rows.select(*_region_columns()).orderBy("region_name", "period_start")


def cleanest_window(
    carbon: DataFrame, as_of: Column | datetime, region: str = "GB", slots: int = 5, day: str | None = None
) -> DataFrame:
    """The `slots` cleanest forecast half hours from `as_of` on; region by code or by name."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    rows = carbon.filter(
        ((F.col("region_name") == region) | (F.col("region_code") == region))
        & (F.col("period_start") >= moment)
        & (F.col("source_type") == "forecast")
    )
    if day:
        rows = rows.filter(F.col(day) >= F.to_date(moment))
    return (
        rows.select(
            "region_name",
            "period_start",
            F.col("intensity_forecast").alias("gco2_per_kwh"),
            "intensity_index",
        )
        .orderBy("gco2_per_kwh", "period_start")
        .limit(slots)
    )


# --- several tables ---------------------------------------------------------------------------


def coverage_by_year(
    df: DataFrame, ts: str, by: list[str], measures: dict[str, Column]
) -> DataFrame:
    """Per entity and year: row count and the given aggregates."""
    return df.groupBy(*by, F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), *[m.alias(name) for name, m in measures.items()]
    )


def source_split(bronze: DataFrame) -> DataFrame:
    """Live against backfilled rows, told apart by the envelope's source tag."""
    return bronze.groupBy(
        F.get_json_object("envelope_json", "$.source").alias("source")
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("event_date").alias("earliest_date"),
        F.max("event_date").alias("latest_date"),
        F.count_distinct("kafka_key").alias("distinct_keys"),
    )


def distribution(df: DataFrame, by: str, value: str, names: dict[str, str]) -> DataFrame:
    """Rounded min, approximate median, max and standard deviation per entity.

    `names` maps min / median / max / stddev to output names.
    """
    return df.groupBy(by).agg(
        F.round(F.min(value), 0).alias(names["min"]),
        F.round(F.percentile_approx(value, 0.5), 0).alias(names["median"]),
        F.round(F.max(value), 0).alias(names["max"]),
        F.round(F.stddev(value), 0).alias(names["stddev"]),
    )


def distribution_selected(df: DataFrame, by: str, value: str, names: dict[str, str]) -> DataFrame:
    """`distribution` with the exact median (the lower of two middle values), selected by rank."""
    median = quantile_by_group(df, by, value, 0.5, "_median")
    others = df.groupBy(by).agg(
        F.round(F.min(value), 0).alias(names["min"]),
        F.round(F.max(value), 0).alias(names["max"]),
        F.round(F.stddev(value), 0).alias(names["stddev"]),
    )
    same = F.col(by).eqNullSafe(F.col("_by"))
    found = others.join(median.withColumnRenamed(by, "_by"), same)
    return found.select(by, names["min"], F.round("_median", 0).alias(names["median"]), names["max"], names["stddev"])


def feature_correlation(features: DataFrame) -> DataFrame:
    def corr(a: str, b: str) -> Column:
        return F.round(F.corr(a, b), 3)

    return features.groupBy("country_code").agg(
        corr("renewable_share_pct", "carbon_current").alias("corr_renewable_carbon"),
        corr("low_carbon_share_pct", "carbon_current").alias("corr_low_carbon_carbon"),
        corr("carbon_lag_24h", "carbon_current").alias("corr_lag24_current"),
        corr("carbon_current", "target_t24h").alias("corr_current_t24h"),
    )


def rows_per_entity(df: DataFrame, entity: str, ts: str) -> DataFrame:
    return (
        df.groupBy(entity)
        .agg(F.count(F.lit(1)).alias("row_count"), F.max(ts).alias("latest"))
        .orderBy(entity)
    )


def newest_rows(df: DataFrame, ts: str, tie: list[str], limit: int = 15) -> DataFrame:
    """The report's newest rows: a top-k, planned without a full sort."""
    return df.orderBy(F.desc(ts), *tie).limit(limit)
