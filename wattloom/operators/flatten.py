"""Raw responses, landed one per row, to payload rows.

Every operator here is a per-row expansion (from_json / from_xml, arrays_zip, explode), so
none of them shuffles; only the hourly means do, and those combine map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.instants import (
    WEATHER_FORMAT,
    hour_of,
    point_instant,
    resolution_seconds,
    settlement_instant,
)
from wattloom.functions.measures import stable_sum

HOURLY_RESOLUTION = "PT60M"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
UNKNOWN_LABEL = "Unknown"


def regional_payloads(df: DataFrame, response: str = "response") -> DataFrame:
    """One row per (period, region) with columns region and payload; other columns are kept."""
    keep = [c for c in df.columns if c != response]
    period, area = F.col("_period"), F.col("_area")
    return (
        df.withColumn("_doc", F.from_json(response, schemas.REGIONAL_RESPONSE))
        .select(*keep, F.explode("_doc.data").alias("_period"))
        .filter(period["from"].isNotNull() & (period["from"] != ""))
        .select(*keep, "_period", F.explode("_period.regions").alias("_area"))
        .select(
            *keep,
            F.coalesce(
                F.nullif(area["shortname"], F.lit("")),
                F.concat(F.lit("region-"), area["regionid"].cast("string")),
            ).alias("region"),
            F.struct(
                period["from"].alias("from"),
                period["to"].alias("to"),
                *[
                    area[name].alias(name)
                    for name in ("regionid", "shortname", "dnoregion", "intensity", "generationmix")
                ],
            ).alias("payload"),
        )
    )


def _weather_payload(city: str, doc: Column, hour: Column) -> Column:
    return F.struct(
        F.col(city).alias("city"),
        doc["latitude"].alias("latitude"),
        doc["longitude"].alias("longitude"),
        doc["elevation"].alias("elevation"),
        hour["time"].alias("time"),
        hour["temperature_2m"].alias("temperature_2m"),
        hour["wind_speed_10m"].alias("wind_speed_10m"),
        hour["cloud_cover"].try_cast("int").alias("cloud_cover"),
        hour["shortwave_radiation"].alias("shortwave_radiation"),
        F.struct(*[doc["hourly_units"][u].alias(u) for u in schemas.READINGS]).alias("units"),
    )


def _zipped_hours(doc: str) -> Column:
    # arrays_zip pads short arrays with NULL; a missing array would make the whole zip NULL.
    empty = F.array().cast("array<double>")
    values = [
        F.coalesce(F.col(f"{doc}.hourly.{name}"), empty).alias(name) for name in schemas.READINGS
    ]
    zipped = F.arrays_zip(F.col(f"{doc}.hourly.time").alias("time"), *values)
    return F.slice(zipped, 1, F.greatest(F.size(f"{doc}.hourly.time"), F.lit(0)))


def hourly_payloads(df: DataFrame, response: str = "response", city: str = "city") -> DataFrame:
    """One row per hour of the parallel arrays; hours without a temperature are dropped."""
    keep = [c for c in df.columns if c != response]
    return (
        df.withColumn("_doc", F.from_json(response, schemas.HOURLY_RESPONSE))
        .withColumn("_hour", F.explode(_zipped_hours("_doc")))
        .filter(F.col("_hour.temperature_2m").isNotNull())
        .select(*keep, _weather_payload(city, F.col("_doc"), F.col("_hour")).alias("payload"))
    )


def current_hour_payloads(
    df: DataFrame,
    as_of: Column,
    response: str = "response",
    city: str = "city",
    on_empty: str = "fail",
) -> DataFrame:
    """One payload per response: the hour of `as_of`, else the last before it, else the first.

    A response without hours fails the job, or is left out with on_empty='drop'.
    """
    if on_empty not in ("fail", "drop"):
        raise ValueError("on_empty must be 'fail' or 'drop'")
    keep = [c for c in df.columns if c != response]
    now = F.date_format(hour_of(as_of), WEATHER_FORMAT)
    times = F.col("_doc.hourly.time")
    past = F.filter(F.transform(times, lambda t, i: F.when(t <= now, i + 1)), lambda i: i.isNotNull())
    position = F.coalesce(
        F.nullif(F.array_position(times, now), F.lit(0)).cast("int"), F.array_max(past), F.lit(1)
    )
    parsed = df.withColumn("_doc", F.from_json(response, schemas.HOURLY_RESPONSE))
    has_hours = F.coalesce(F.size(times), F.lit(0)) > 0
    if on_empty == "drop":
        parsed = parsed.filter(has_hours)
        hour = F.get(_zipped_hours("_doc"), position - 1)
    else:
        hour = F.when(has_hours, F.get(_zipped_hours("_doc"), position - 1)).otherwise(
            F.raise_error(F.concat(F.lit("empty hourly forecast for "), F.col(city)))
        )
    return parsed.withColumn("_hour", hour).select(
        *keep, _weather_payload(city, F.col("_doc"), F.col("_hour")).alias("payload")
    )


def generation_points(df: DataFrame, document: str = "document") -> DataFrame:
    """Generation XML to points: series_no, psr_type, period_start, step_seconds, position, quantity.

    Series without a fuel code, periods without a readable start and points that are not
    numbers are skipped; any of the three levels may hold one element or many.
    """
    keep = [c for c in df.columns if c != document]
    return (
        df.withColumn("_doc", F.from_xml(F.col(document), schemas.GENERATION_XML))
        .select(*keep, F.posexplode("_doc.TimeSeries").alias("series_no", "_series"))
        .withColumn("psr_type", F.col("_series.MktPSRType.psrType"))
        .filter(F.col("psr_type").isNotNull() & (F.col("psr_type") != ""))
        .select(*keep, "series_no", "psr_type", F.explode("_series.Period").alias("_period"))
        .select(
            *keep,
            "series_no",
            "psr_type",
            settlement_instant(F.col("_period.timeInterval.start")).alias("period_start"),
            resolution_seconds(F.col("_period.resolution")).alias("step_seconds"),
            F.explode("_period.Point").alias("_point"),
        )
        .select(
            *keep,
            "series_no",
            "psr_type",
            "period_start",
            "step_seconds",
            F.col("_point.position").try_cast("int").alias("position"),
            F.col("_point.quantity").try_cast("double").alias("quantity"),
        )
        .filter("period_start IS NOT NULL AND position IS NOT NULL AND quantity IS NOT NULL")
    )


def points_to_hours(points: DataFrame) -> DataFrame:
    """Adds the instant of every point and the hour that holds it."""
    instant = point_instant(F.col("period_start"), F.col("position"), F.col("step_seconds"))
    return points.withColumn("point_utc", instant).withColumn("hour_utc", hour_of(F.col("point_utc")))


def hourly_mean_by_fuel(points: DataFrame, entity: list[str], value: str = "quantity") -> DataFrame:
    """Mean of all points of a fuel in an hour."""
    return points.groupBy(*entity, "hour_utc", "psr_type").agg(F.avg(value).alias("mean_mw"))


def hourly_sum_of_series_means(
    points: DataFrame, entity: list[str], series: list[str], value: str = "quantity"
) -> DataFrame:
    """Mean within each series, then the sum over series: split zones add up."""
    per_series = points.groupBy(*entity, "hour_utc", "psr_type", *series).agg(
        F.avg(value).alias("_series_mean")
    )
    return per_series.groupBy(*entity, "hour_utc", "psr_type").agg(
        F.sum("_series_mean").alias("mean_mw")
    )


def label_fuels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds `name` for each psr_type. `labels` is the fixed code list (under thirty rows)."""
    return df.join(F.broadcast(labels), "psr_type", "left").withColumn(
        "name", F.coalesce("name", F.lit(UNKNOWN_LABEL))
    )


def nest_mix(hourly: DataFrame, entity: list[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """Fuel rows of an hour to one row with the mix array, sorted by code, and its total.

    A group holds at most one row per fuel code, so the collected array is bounded by the code
    list. `carry` adds further aggregates, such as the latest ingestion time.
    """
    item = F.struct(
        F.col("psr_type"), F.col("name"), F.round("mean_mw", 2).alias("value_mw")
    )
    extra = [agg.alias(name) for name, agg in (carry or {}).items()]
    return hourly.groupBy(*entity, "hour_utc").agg(
        F.sort_array(F.collect_list(item)).alias("generation_mix"),
        F.round(stable_sum("mean_mw"), 2).alias("total_generation_mw"),
        *extra,
    )


def generation_payloads(nested: DataFrame, countries: DataFrame) -> DataFrame:
    """Hourly mixes to generation payloads; `countries` is the six-row country dimension."""
    names = countries.select(
        "country_code", "country_name", F.col("eic_bidding_zone").alias("eic_code")
    )
    one_hour = F.timestamp_add("HOUR", F.lit(1), F.col("hour_utc"))
    return nested.join(F.broadcast(names), "country_code", "left").withColumn(
        "payload",
        F.struct(
            "country_code",
            "country_name",
            "eic_code",
            F.date_format("hour_utc", ISO_OFFSET_FORMAT).alias("period_start"),
            F.date_format(one_hour, ISO_OFFSET_FORMAT).alias("period_end"),
            F.lit(HOURLY_RESOLUTION).alias("resolution"),
            "total_generation_mw",
            "generation_mix",
        ),
    )
