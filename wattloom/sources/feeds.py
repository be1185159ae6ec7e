"""The three feeds: the single place for their names, keys, parsers and rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattloom import schemas
from wattloom.operators import parse, quality


@dataclass(frozen=True)
class Feed:
    table: str  # silver and quarantine table name
    topic: str  # topic and bronze table name
    source: str  # tag of live envelopes; backfills add "-backfill"
    key: list[str]
    ts: str
    payload: T.StructType
    parse: Callable[[DataFrame], DataFrame]
    rules: Callable[[], list[quality.Rule]]

    @property
    def backfill_source(self) -> str:
        return f"{self.source}-backfill"

    def checked(self, bronze: DataFrame, all_reasons: bool = False) -> DataFrame:
        """Bronze rows parsed, with their reject reason."""
        return quality.validate(self.parse(bronze), self.rules(), all_reasons)


CARBON = Feed(
    table="carbon_intensity",
    topic="carbon-intensity",
    source="uk-carbon-intensity",
    key=["region_code", "period_start"],
    ts="period_start",
    payload=schemas.CARBON_PAYLOAD,
    parse=parse.parse_carbon,
    rules=quality.carbon_rules,
)
WEATHER = Feed(
    table="weather",
    topic="open-meteo",
    source="open-meteo",
    key=["city", "time_utc"],
    ts="time_utc",
    payload=schemas.WEATHER_PAYLOAD,
    parse=parse.parse_weather,
    rules=quality.weather_rules,
)
GENERATION = Feed(
    table="generation",
    topic="entsoe",
    source="entsoe",
    key=["country_code", "period_start"],
    ts="period_start",
    payload=schemas.GENERATION_PAYLOAD,
    parse=parse.parse_generation,
    rules=quality.generation_rules,
)
FEEDS = [CARBON, WEATHER, GENERATION]
