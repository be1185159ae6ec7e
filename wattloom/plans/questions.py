"""The six questions an assistant or a user may ask of the gold tables, with checked arguments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.plans import forecast, reports
from wattloom.plans.refresh import DAY
from wattloom.sources.tables import Tables

GRID = "gold.fact_grid_hourly"
FUEL = "gold.fact_generation_fuel_hourly"
CARBON = "gold.fact_carbon_intensity_30min"
FORECAST = "gold.fact_carbon_forecast"


def eu_carbon_rankings(tables: Tables) -> DataFrame:
    return reports.eu_rankings(tables.read(GRID), tables.day(GRID, DAY))


def uk_regional_carbon(tables: Tables) -> DataFrame:
    return reports.uk_rankings(tables.read(CARBON), tables.day(CARBON, DAY))


def country_fuel_mix(tables: Tables, country_code: str) -> DataFrame:
    return reports.country_fuel_mix(tables.read(FUEL), country_code, DAY)


def carbon_trend_24h(tables: Tables, country_code: str) -> DataFrame:
    return reports.trend_24h(tables.read(GRID), country_code, tables.day(GRID, DAY))


def cleanest_window_uk(
    tables: Tables, region_name: str = "GB", as_of: datetime | Column | None = None
) -> DataFrame:
    """From `as_of` on, or from now."""
    moment = F.current_timestamp() if as_of is None else as_of
    return reports.cleanest_window(tables.read(CARBON), moment, region_name, day=DAY)


def carbon_forecast(tables: Tables, country_code: str) -> DataFrame:
    return forecast.latest_forecast(tables.read(FORECAST), reports.checked_country(country_code))


QUESTIONS = {
    question.__name__: question
    for question in (
        eu_carbon_rankings,
        uk_regional_carbon,
        country_fuel_mix,
        carbon_trend_24h,
        cleanest_window_uk,
        carbon_forecast,
    )
}


def ask(tables: Tables, question: str, **arguments) -> DataFrame:
    if question not in QUESTIONS:
        raise ValueError(f"question must be one of {sorted(QUESTIONS)}, got {question!r}")
    return QUESTIONS[question](tables, **arguments)
