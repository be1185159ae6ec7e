"""Bronze envelope JSON to typed silver columns, one parser per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom import schemas
from wattloom.functions.instants import iso_instant, settlement_instant, weather_instant


def _parse(bronze: DataFrame, payload: T.StructType, columns: dict[str, Column]) -> DataFrame:
    # Behind a generator the JSON is read once per row. As a plain column the optimizer would
    # copy the parse into every rule of a later filter on the reject reason.
    env = F.from_json(F.col("envelope_json"), schemas.envelope(payload))
    return bronze.select("*", F.explode(F.array(env)).alias("env")).select(
        F.col("env.event_id").alias("event_id"),
        F.col("env.source").alias("source"),
        F.col("env.source_version").alias("source_version"),
        iso_instant(F.col("env.ingested_at")).alias("ingested_at"),
        *[col.alias(name) for name, col in columns.items()],
        "envelope_json",
        "kafka_timestamp",
    )


def _field(path: str) -> Column:
    return F.col(f"env.payload.{path}")


def parse_carbon(bronze: DataFrame) -> DataFrame:
    return _parse(
        bronze,
        schemas.CARBON_PAYLOAD,
        {
            "region_id": _field("regionid"),
            "region_code": _field("shortname"),
            "region_name": _field("dnoregion"),
            "period_start": settlement_instant(_field("`from`")),
            "period_end": settlement_instant(_field("`to`")),
            "intensity_forecast": _field("intensity.forecast"),
            "intensity_actual": _field("intensity.actual"),
            "intensity_index": _field("intensity.`index`"),
            "generation_mix": _field("generationmix"),
        },
    )


def parse_weather(bronze: DataFrame) -> DataFrame:
    return _parse(
        bronze,
        schemas.WEATHER_PAYLOAD,
        {
            "city": _field("city"),
            "latitude": _field("latitude"),
            "longitude": _field("longitude"),
            "elevation": _field("elevation"),
            "time_utc": weather_instant(_field("time")),
            "temperature_c": _field("temperature_2m"),
            "wind_speed_kmh": _field("wind_speed_10m"),
            "cloud_cover_pct": _field("cloud_cover").try_cast("int"),
            "solar_radiation_wm2": _field("shortwave_radiation"),
        },
    )


def parse_generation(bronze: DataFrame) -> DataFrame:
    return _parse(
        bronze,
        schemas.GENERATION_PAYLOAD,
        {
            "country_code": _field("country_code"),
            "country_name": _field("country_name"),
            "eic_code": _field("eic_code"),
            "period_start": iso_instant(_field("period_start")),
            "period_end": iso_instant(_field("period_end")),
            "resolution": _field("resolution"),
            "total_generation_mw": _field("total_generation_mw"),
            "generation_mix": _field("generation_mix"),
        },
    )
