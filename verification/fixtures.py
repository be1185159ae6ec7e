"""Inputs for every operator, derived by Spark from the `events` table.

`oracle.py` states the same derivations as SQL. Defects are injected by event_id, so that the
oracle can compute the expected rejects without parsing anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.envelopes import build_envelope, to_topic_frame
from wattloom.functions.instants import hour_of
from wattloom.operators import dims, flatten
from wattloom.sources.feeds import CARBON, GENERATION, WEATHER, Feed

def _id() -> Column:
    return F.col("event_id")

CITY_OF = {"GB": "London", "FR": "Paris", "DE": "Berlin", "ES": "Madrid", "IT": "Rome", "NL": "Amsterdam"}


def _every(n: int) -> Column:
    return _id() % n == 0


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def points(events: DataFrame) -> DataFrame:
    """One generation reading per event."""
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("user_id").alias("series_id"),
        F.col("ts").alias("ingested_at"),
        hour_of(F.col("ts")).alias("hour_utc"),
        _pick(F.col("user_id") % 6, list(CITY_OF)).alias("country_code"),
        F.when(kind == "click", "B16")
        .when(kind == "view", "B19")
        .when(kind == "purchase", "B04")
        .when(kind == "signup", "B14")
        .otherwise("B25")
        .alias("psr_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("value_mw"),
    )


def carbon_periods(events: DataFrame) -> DataFrame:
    """One half-hour carbon reading per event, with its region's names."""
    value = F.floor("value").cast("int")
    half = F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / 1800) * 1800)
    names = dims.dim_uk_region(events.sparkSession).select("region_id", "region_code", "region_name")
    return events.select(
        "event_id",
        F.col("ts").alias("ingested_at"),
        ((F.col("user_id") % 18).cast("int") + 1).alias("region_id"),
        half.alias("period_start"),
        value.alias("intensity_forecast"),
        F.when(_every(3), value + (_id() % 5).cast("int") - 2).alias("intensity_actual"),
        F.when(F.col("value") < 5, "very low")
        .when(F.col("value") < 15, "low")
        .when(F.col("value") < 30, "moderate")
        .otherwise("high")
        .alias("intensity_index"),
    ).join(F.broadcast(names), "region_id")


def weather_readings(events: DataFrame) -> DataFrame:
    """One hourly weather reading per event."""
    return events.select(
        "event_id",
        F.col("ts").alias("ingested_at"),
        hour_of(F.col("ts")).alias("time_utc"),
        _pick(F.col("user_id") % 6, list(CITY_OF.values())).alias("city"),
        (F.col("value") - 10).alias("temperature_c"),
        (F.col("value") * 2).alias("wind_speed_kmh"),
        (_id() % 101).cast("int").alias("cloud_cover_pct"),
        (_id() % 800).cast("double").alias("solar_radiation_wm2"),
    )


# --- envelopes --------------------------------------------------------------------------------


def _text(ts: Column, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def _settlement(ts: Column) -> Column:
    """Either of the two ways the carbon feed writes an instant."""
    return F.when(_every(2), _text(ts, "yyyy-MM-dd'T'HH:mm'Z'")).otherwise(
        _text(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )


def _iso(ts: Column) -> Column:
    return F.when(_every(2), _text(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        _text(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )


def _later(ts: str, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), F.col(ts))


def _enveloped(rows: DataFrame, feed: Feed, region: str, event_time: Column | None = None) -> DataFrame:
    return build_envelope(
        rows,
        region=F.col(region),
        source=F.when(_every(4), feed.backfill_source).otherwise(feed.source),
        event_time=event_time,
        event_id=F.concat(F.lit("evt-"), _id().cast("string")),
        ingested_at=F.col("ingested_at"),
    )


def carbon_enveloped(events: DataFrame, defects: bool = True) -> DataFrame:
    def broken(n: int, good: Column, bad: Column) -> Column:
        return F.when(_every(n), bad).otherwise(good) if defects else good

    null = F.lit(None)
    perc = (_id() % 101).cast("double")
    payload = F.struct(
        broken(83, _settlement(F.col("period_start")), F.lit("not-a-time")).alias("from"),
        broken(79, _settlement(_later("period_start", 30)), F.lit("soon")).alias("to"),
        F.col("region_id").alias("regionid"),
        broken(89, F.col("region_code"), null).alias("shortname"),
        F.col("region_name").alias("dnoregion"),
        F.struct(
            broken(73, F.col("intensity_forecast"), null).alias("forecast"),
            F.col("intensity_actual").alias("actual"),
            F.col("intensity_index").alias("index"),
        ).alias("intensity"),
        F.array(
            F.struct(F.lit("gas").alias("fuel"), perc.alias("perc")),
            F.struct(F.lit("wind").alias("fuel"), (100 - perc).alias("perc")),
        ).alias("generationmix"),
    )
    rows = carbon_periods(events).withColumn("payload", payload)
    return _enveloped(rows, CARBON, "region_code")


def weather_enveloped(events: DataFrame) -> DataFrame:
    payload = F.struct(
        F.when(~_every(89), F.col("city")).alias("city"),
        F.lit(50.5).alias("latitude"),
        F.lit(10.25).alias("longitude"),
        F.lit(35.0).alias("elevation"),
        F.when(_every(83), "yesterday")
        .otherwise(_text(F.col("time_utc"), "yyyy-MM-dd'T'HH:mm"))
        .alias("time"),
        F.when(_every(79), F.lit(None))
        .when(_every(73), -61.0)
        .otherwise(F.col("temperature_c"))
        .alias("temperature_2m"),
        F.col("wind_speed_kmh").alias("wind_speed_10m"),
        # Historical responses send fractions of a percent.
        (F.col("cloud_cover_pct") + F.when(_every(2), 0.0).otherwise(0.5)).alias("cloud_cover"),
        F.col("solar_radiation_wm2").alias("shortwave_radiation"),
        F.struct(F.lit("°C").alias("temperature_2m"), F.lit("km/h").alias("wind_speed_10m")).alias("units"),
    )
    return _enveloped(weather_readings(events).withColumn("payload", payload), WEATHER, "city")


def point_enveloped(events: DataFrame) -> DataFrame:
    """One generation envelope per event with a one-fuel mix; carries every generation defect."""
    total = (
        F.when(_every(71), F.lit(None))
        .when(_every(67), -1.0)
        .when(_every(61), 250000.0)
        .otherwise(F.col("value_mw").cast("double"))
    )
    item = F.struct(
        "psr_type", F.coalesce("name", F.lit("Unknown")).alias("name"), F.col("value_mw").cast("double").alias("value_mw")
    )
    mix = F.array(item)
    payload = F.struct(
        F.when(~_every(89), F.col("country_code")).alias("country_code"),
        "country_name",
        F.col("eic_bidding_zone").alias("eic_code"),
        F.when(_every(83), "not-a-time").otherwise(_iso(F.col("hour_utc"))).alias("period_start"),
        F.when(_every(59), "later").otherwise(_iso(_later("hour_utc", 60))).alias("period_end"),
        F.lit("PT60M").alias("resolution"),
        total.alias("total_generation_mw"),
        F.when(_every(79), F.lit(None)).when(_every(73), F.slice(mix, 1, 0)).otherwise(mix).alias("generation_mix"),
    )
    spark = events.sparkSession
    rows = (
        flatten.label_fuels(points(events), dims.fuel_labels(spark))
        .join(F.broadcast(dims.dim_country(spark)), "country_code")
        .withColumn("payload", payload)
    )
    return _enveloped(rows, GENERATION, "country_code", _text(F.col("hour_utc"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def generation_hours(events: DataFrame) -> DataFrame:
    """Per (country, hour): mean MW per fuel, nested; no defects."""
    spark = events.sparkSession
    pts = points(events)
    stamped = pts.groupBy("country_code", "hour_utc", "psr_type").agg(
        F.avg("value_mw").alias("mean_mw"),
        F.max("ingested_at").alias("_ingested_at"),
        F.max("event_id").alias("_event_id"),
    )
    return flatten.nest_mix(
        flatten.label_fuels(stamped, dims.fuel_labels(spark)),
        ["country_code"],
        carry={"ingested_at": F.max("_ingested_at"), "event_id": F.max("_event_id")},
    )


def generation_enveloped(events: DataFrame) -> DataFrame:
    rows = flatten.generation_payloads(generation_hours(events), dims.dim_country(events.sparkSession))
    return _enveloped(rows, GENERATION, "country_code", F.col("payload.period_start"))


def topic_frame(enveloped: DataFrame, feed: Feed, truncate: bool = True) -> DataFrame:
    """The envelopes as the topic delivers them; every 97th message is cut off."""
    frame = to_topic_frame(
        enveloped.withColumn("envelope", F.col("envelope")),
        feed.topic,
        partition=_id() % 4,
        offset=_id(),
        timestamp=F.col("ingested_at"),
    )
    if not truncate:
        return frame
    return frame.withColumn(
        "value", F.when(F.col("offset") % 97 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    )


ENVELOPED = {CARBON.topic: carbon_enveloped, WEATHER.topic: weather_enveloped, GENERATION.topic: generation_enveloped}


def feed_frame(events: DataFrame, feed: Feed) -> DataFrame:
    """Topic frame of a feed as the layers ingest it; generation arrives without defects."""
    return topic_frame(ENVELOPED[feed.topic](events), feed, truncate=feed is not GENERATION)


# --- raw responses ----------------------------------------------------------------------------


def regional_responses(events: DataFrame) -> DataFrame:
    """Per event a response of two periods with two regions each; every 11th event's second
    period has no start, every 7th event's second region has no short name."""
    rows = carbon_periods(events)

    def area(region_id: Column, name: Column, forecast: Column) -> Column:
        return F.struct(
            region_id.cast("int").alias("regionid"),
            name.alias("shortname"),
            F.lit("dno").alias("dnoregion"),
            F.struct(forecast.alias("forecast"), F.col("intensity_index").alias("index")).alias("intensity"),
            F.array(F.struct(F.lit("gas").alias("fuel"), (_id() % 101).cast("double").alias("perc"))).alias("generationmix"),
        )

    areas = F.array(
        area(F.col("region_id"), F.col("region_code"), F.col("intensity_forecast")),
        area(F.col("region_id") + 100, F.when(~_every(7), F.lit("Elsewhere")), F.col("intensity_forecast") + 1),
    )

    def period(start: Column, end: Column) -> Column:
        return F.struct(start.alias("from"), end.alias("to"), areas.alias("regions"))

    fmt = "yyyy-MM-dd'T'HH:mm'Z'"
    first, second, third = (_text(_later("period_start", m), fmt) for m in (0, 30, 60))
    body = F.struct(F.array(period(first, second), period(F.when(~_every(11), second), third)).alias("data"))
    return rows.select("event_id", F.to_json(body).alias("response"))


def hourly_responses(events: DataFrame) -> DataFrame:
    """Per event a response of three hours from parallel arrays: the second temperature is null
    on every 5th event and the cloud array is one short on every 3rd."""
    rows = weather_readings(events)
    hours = F.array(*[_text(_later("time_utc", 60 * i), "yyyy-MM-dd'T'HH:mm") for i in range(3)])
    t = F.col("temperature_c")
    clouds = F.array(*[(F.col("cloud_cover_pct") + i).cast("double") for i in range(3)])
    body = F.struct(
        F.lit(50.5).alias("latitude"),
        F.lit(10.25).alias("longitude"),
        F.lit(35.0).alias("elevation"),
        F.struct(F.lit("°C").alias("temperature_2m"), F.lit("km/h").alias("wind_speed_10m")).alias("hourly_units"),
        F.struct(
            hours.alias("time"),
            F.array(t, F.when(~_every(5), t + 1), t + 2).alias("temperature_2m"),
            F.array(*[F.col("wind_speed_kmh")] * 3).alias("wind_speed_10m"),
            F.slice(clouds, F.lit(1), F.when(_every(3), 2).otherwise(3)).alias("cloud_cover"),
            F.array(*[F.col("solar_radiation_wm2")] * 3).alias("shortwave_radiation"),
        ).alias("hourly"),
    )
    return rows.select("event_id", "city", F.to_json(body).alias("response"))


def generation_documents(events: DataFrame) -> DataFrame:
    """Per event an XML document. First series: four quarter-hour points from 45 minutes past the
    hour before, so they straddle two hours. Second series: one hourly point without a resolution.
    Every 13th event's first series has no fuel code, every 17th an unreadable start, every 19th a
    third point that is no number."""
    row = points(events)
    value = F.col("value_mw").cast("string")
    start = F.when(_every(17), "never").otherwise(_text(_later("hour_utc", -15), "yyyy-MM-dd'T'HH:mm'Z'"))

    def point(position: int, quantity: Column) -> list[Column]:
        return [F.lit(f"<Point><position>{position}</position><quantity>"), quantity, F.lit("</quantity></Point>")]

    code = F.when(_every(13), "").otherwise(F.concat(F.lit("<psrType>"), F.col("psr_type"), F.lit("</psrType>")))
    document = F.concat(
        F.lit('<GL_MarketDocument xmlns="urn:example:generation"><TimeSeries><MktPSRType>'),
        code,
        F.lit("</MktPSRType><Period><timeInterval><start>"),
        start,
        F.lit("</start></timeInterval><resolution>PT15M</resolution>"),
        *point(1, value),
        *point(2, (F.col("value_mw") + 1).cast("string")),
        *point(3, F.when(_every(19), "n/a").otherwise((F.col("value_mw") + 2).cast("string"))),
        *point(4, (F.col("value_mw") + 3).cast("string")),
        F.lit("</Period></TimeSeries><TimeSeries><MktPSRType><psrType>B20</psrType></MktPSRType><Period><timeInterval><start>"),
        _text(F.col("hour_utc"), "yyyy-MM-dd'T'HH:mm'Z'"),
        F.lit("</start></timeInterval>"),
        *point(1, value),
        F.lit("</Period></TimeSeries></GL_MarketDocument>"),
    )
    return row.select("event_id", "country_code", document.alias("document"))


def persistence(features: DataFrame) -> DataFrame:
    """Deterministic scores for the forecast fact: tomorrow repeats the hour a week ago."""
    return features.withColumn("prediction", F.col("carbon_lag_168h"))


