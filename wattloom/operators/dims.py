"""Dimensions: three literal tables and the hourly calendar."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.instants import iso_weekday, time_key

# The six countries and their capitals, bidding zones and UTC offsets.
COUNTRIES = [
    ("GB", "Great Britain", "London", "10YGB----------A", "GBR", 0, 1),
    ("FR", "France", "Paris", "10YFR-RTE------C", "FRA", 1, 2),
    ("DE", "Germany", "Berlin", "10Y1001A1001A83F", "DEU", 1, 2),
    ("ES", "Spain", "Madrid", "10YES-REE------0", "ESP", 1, 2),
    ("IT", "Italy", "Rome", "10YIT-GRTN-----B", "ITA", 1, 2),
    ("NL", "Netherlands", "Amsterdam", "10YNL----------L", "NLD", 1, 2),
]
COUNTRY_SCHEMA = (
    "country_code STRING NOT NULL, country_name STRING NOT NULL, capital_city STRING NOT NULL, "
    "eic_bidding_zone STRING NOT NULL, iso_alpha3 STRING NOT NULL, "
    "timezone_offset_winter_hours INT NOT NULL, timezone_offset_summer_hours INT NOT NULL"
)

# Fuel codes of both taxonomies with category, flags (renewable, low-carbon) and
# lifecycle gCO2 per kWh (published IPCC AR5 medians and near equivalents).
FUELS = [
    ("entsoe_b01_biomass", "entsoe", "B01", "Biomass", "renewable", True, False, 230),
    ("entsoe_b02_lignite", "entsoe", "B02", "Fossil Brown coal/Lignite", "fossil", False, False, 1054),
    ("entsoe_b03_coal_gas", "entsoe", "B03", "Fossil Coal-derived gas", "fossil", False, False, 700),
    ("entsoe_b04_gas", "entsoe", "B04", "Fossil Gas", "fossil", False, False, 490),
    ("entsoe_b05_hard_coal", "entsoe", "B05", "Fossil Hard coal", "fossil", False, False, 820),
    ("entsoe_b06_oil", "entsoe", "B06", "Fossil Oil", "fossil", False, False, 650),
    ("entsoe_b07_oil_shale", "entsoe", "B07", "Fossil Oil shale", "fossil", False, False, 1000),
    ("entsoe_b08_peat", "entsoe", "B08", "Fossil Peat", "fossil", False, False, 950),
    ("entsoe_b09_geothermal", "entsoe", "B09", "Geothermal", "renewable", True, True, 38),
    ("entsoe_b10_hydro_pumped", "entsoe", "B10", "Hydro Pumped Storage", "storage", True, True, 24),
    ("entsoe_b11_hydro_ror", "entsoe", "B11", "Hydro Run-of-river and poundage", "renewable", True, True, 24),
    ("entsoe_b12_hydro_reservoir", "entsoe", "B12", "Hydro Water Reservoir", "renewable", True, True, 24),
    ("entsoe_b13_marine", "entsoe", "B13", "Marine", "renewable", True, True, 20),
    ("entsoe_b14_nuclear", "entsoe", "B14", "Nuclear", "nuclear", False, True, 12),
    ("entsoe_b15_other_renewable", "entsoe", "B15", "Other renewable", "renewable", True, True, 50),
    ("entsoe_b16_solar", "entsoe", "B16", "Solar", "renewable", True, True, 48),
    ("entsoe_b17_waste", "entsoe", "B17", "Waste", "renewable", True, False, 230),
    ("entsoe_b18_wind_offshore", "entsoe", "B18", "Wind Offshore", "renewable", True, True, 12),
    ("entsoe_b19_wind_onshore", "entsoe", "B19", "Wind Onshore", "renewable", True, True, 11),
    ("entsoe_b20_other", "entsoe", "B20", "Other", "other", False, False, 500),
    ("uk_ci_biomass", "uk_ci", "biomass", "Biomass", "renewable", True, False, 230),
    ("uk_ci_coal", "uk_ci", "coal", "Coal", "fossil", False, False, 820),
    ("uk_ci_imports", "uk_ci", "imports", "Imports", "other", False, False, 350),
    ("uk_ci_gas", "uk_ci", "gas", "Gas", "fossil", False, False, 490),
    ("uk_ci_nuclear", "uk_ci", "nuclear", "Nuclear", "nuclear", False, True, 12),
    ("uk_ci_other", "uk_ci", "other", "Other", "other", False, False, 500),
    ("uk_ci_hydro", "uk_ci", "hydro", "Hydro", "renewable", True, True, 24),
    ("uk_ci_solar", "uk_ci", "solar", "Solar", "renewable", True, True, 48),
    ("uk_ci_wind", "uk_ci", "wind", "Wind", "renewable", True, True, 11),
]
FUEL_SCHEMA = (
    "fuel_key STRING NOT NULL, source_taxonomy STRING NOT NULL, source_code STRING NOT NULL, "
    "display_name STRING NOT NULL, fuel_category STRING NOT NULL, is_renewable BOOLEAN NOT NULL, "
    "is_low_carbon BOOLEAN NOT NULL, typical_gco2_per_kwh INT NOT NULL"
)

# The 14 distribution regions and 4 national rollups with approximate centres.
UK_REGIONS = [
    (1, "North Scotland", "SSEN North Scotland", "DNO", "GB", 57.5, -4.2),
    (2, "South Scotland", "SP Distribution", "DNO", "GB", 55.9, -3.9),
    (3, "North West England", "ENW North West", "DNO", "GB", 53.7, -2.5),
    (4, "North East England", "NPG North East", "DNO", "GB", 54.9, -1.6),
    (5, "Yorkshire", "NPG Yorkshire", "DNO", "GB", 53.8, -1.5),
    (6, "North Wales & Merseyside", "SP Manweb", "DNO", "GB", 53.2, -3.1),
    (7, "South Wales", "WPD South Wales", "DNO", "GB", 51.6, -3.5),
    (8, "West Midlands", "WPD West Midlands", "DNO", "GB", 52.5, -1.9),
    (9, "East Midlands", "WPD East Midlands", "DNO", "GB", 52.9, -1.2),
    (10, "East England", "UKPN East", "DNO", "GB", 52.2, 0.5),
    (11, "South West England", "WPD South West", "DNO", "GB", 50.7, -3.7),
    (12, "South England", "SSEN South", "DNO", "GB", 51.3, -1.2),
    (13, "London", "UKPN London", "DNO", "GB", 51.5, -0.1),
    (14, "South East England", "UKPN South East", "DNO", "GB", 51.1, 0.5),
    (15, "England", "England", "national", "GB", 52.5, -1.5),
    (16, "Scotland", "Scotland", "national", "GB", 56.5, -4.0),
    (17, "Wales", "Wales", "national", "GB", 52.1, -3.8),
    (18, "GB", "GB", "national", "GB", 54.5, -2.5),
]
UK_REGION_SCHEMA = (
    "region_id INT NOT NULL, region_code STRING NOT NULL, region_name STRING NOT NULL, "
    "region_type STRING NOT NULL, country_code STRING NOT NULL, approx_lat DOUBLE NOT NULL, "
    "approx_lon DOUBLE NOT NULL"
)
NATIONAL_REGION_ID = 18
NATIONAL_REGION_CODE = "GB"

# Labels of the generation feed's codes beyond the fuels above.
OTHER_CODE_LABELS = [
    ("B21", "AC Link"),
    ("B22", "DC Link"),
    ("B23", "Substation"),
    ("B24", "Transformer"),
    ("B25", "Energy storage"),
    ("A03", "Mixed"),
    ("A04", "Generation"),
    ("A05", "Load"),
]

# Zones whose wall clock the countries keep.
COUNTRY_ZONES = [
    ("GB", "Europe/London"),
    ("FR", "Europe/Paris"),
    ("DE", "Europe/Berlin"),
    ("ES", "Europe/Madrid"),
    ("IT", "Europe/Rome"),
    ("NL", "Europe/Amsterdam"),
]

# UTC hours counted as UK business hours and as daytime.
BUSINESS_HOURS = (7, 17)
DAYTIME_HOURS = (6, 17)
DEFAULT_CALENDAR = ("2026-01-01 00:00:00", "2028-01-01 00:00:00")


def _literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows as a local relation: its size is known to the planner and reading it starts no job."""
    names = [column.split()[0] for column in schema.split(", ")]
    columns = dict(zip(names, zip(*rows, strict=True), strict=True))
    return spark.createDataFrame(pa.table(columns), schema)


def dim_country(spark: SparkSession) -> DataFrame:
    return _literal(spark, COUNTRIES, COUNTRY_SCHEMA)


def country_bridge(spark: SparkSession) -> DataFrame:
    """Country to capital, which is the weather feed's city."""
    return dim_country(spark).select("country_code", "country_name", "capital_city")


def country_zones(spark: SparkSession) -> DataFrame:
    return _literal(spark, COUNTRY_ZONES, "country_code STRING, zone STRING")


def dim_fuel_type(spark: SparkSession) -> DataFrame:
    return _literal(spark, FUELS, FUEL_SCHEMA)


def dim_uk_region(spark: SparkSession) -> DataFrame:
    return _literal(spark, UK_REGIONS, UK_REGION_SCHEMA)


def fuel_labels(spark: SparkSession) -> DataFrame:
    """Every code the generation feed may send, with its label."""
    rows = [(code, name) for _, taxonomy, code, name, *_ in FUELS if taxonomy == "entsoe"]
    return _literal(spark, rows + OTHER_CODE_LABELS, "psr_type STRING, name STRING")


def _between(col: Column, bounds: tuple[int, int]) -> Column:
    return col.between(*bounds)


def calendar_columns(hours: DataFrame) -> DataFrame:
    """A frame of `hour_utc` to the calendar's sixteen columns."""
    ts = F.col("hour_utc")
    weekend = F.col("day_of_week_iso").isin(6, 7)
    return hours.select(
        time_key(ts).alias("time_key"),
        ts,
        F.to_date(ts).alias("date_utc"),
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        F.date_format(ts, "MMMM").alias("month_name"),
        F.weekofyear(ts).alias("week_of_year"),
        F.dayofmonth(ts).alias("day_of_month"),
        F.dayofyear(ts).alias("day_of_year"),
        iso_weekday(ts).alias("day_of_week_iso"),
        F.date_format(ts, "EEEE").alias("day_name"),
        F.hour(ts).alias("hour_of_day"),
    ).withColumns(
        {
            "is_weekend": weekend,
            "is_business_hour_uk": ~weekend & _between(F.col("hour_of_day"), BUSINESS_HOURS),
            "is_daytime_approx": _between(F.col("hour_of_day"), DAYTIME_HOURS),
        }
    )


def _hours(bounds: DataFrame) -> DataFrame:
    """Hours from `lo` to `hi`, both included: a row per day first, then its hours."""
    by_day = "sequence(date_trunc('day', lo), date_trunc('day', hi), INTERVAL 1 DAY)"
    by_hour = "sequence(day, day + INTERVAL 23 HOURS, INTERVAL 1 HOUR)"
    return (
        bounds.select("lo", "hi", F.explode(F.expr(by_day)).alias("day"))
        .select("lo", "hi", F.explode(F.expr(by_hour)).alias("hour_utc"))
        .filter("hour_utc BETWEEN lo AND hi")
        .select("hour_utc")
    )


def dim_time(
    spark: SparkSession, start: str = DEFAULT_CALENDAR[0], end: str = DEFAULT_CALENDAR[1]
) -> DataFrame:
    """Hourly calendar over [start, end]."""
    bounds = spark.range(1).select(
        F.lit(start).cast("timestamp").alias("lo"), F.lit(end).cast("timestamp").alias("hi")
    )
    return calendar_columns(_hours(bounds))


def dim_time_spanning(df: DataFrame, ts: str) -> DataFrame:
    """Hourly calendar over the hours a table spans, so no row of it can be an orphan."""
    bounds = df.agg(F.date_trunc("hour", F.min(ts)).alias("lo"), F.date_trunc("hour", F.max(ts)).alias("hi"))
    return calendar_columns(_hours(bounds.filter("lo IS NOT NULL")))


def calendar_gaps(
    calendar: DataFrame, fact: DataFrame, entities: DataFrame | None = None, entity: str = "country_code"
) -> DataFrame:
    """Calendar hours for which a fact has no row; per entity when a frame of entities is given.

    The fact is reduced to its distinct (entity, hour) pairs by the anti join's own aggregation;
    the expected grid is the calendar exploded over a collected literal of the few entities.
    """
    hours = calendar.select("time_key", "hour_utc")
    if entities is None:
        return hours.join(fact.select("time_key").distinct(), "time_key", "left_anti")
    names = entities.agg(F.array_sort(F.collect_set(entity))).scalar()
    expected = hours.withColumn(entity, F.explode(names))
    seen = fact.select(entity, "time_key").distinct()
    return expected.join(seen, [entity, "time_key"], "left_anti")
