"""One query per operator, over the layers of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import fixtures as fx
from verification.lake import GENERATED_AT, RUN, Lake, Layers, lake
from wattloom.functions.envelopes import verify_checksum
from wattloom.functions.instants import local_time
from wattloom.functions.measures import age_minutes, freshness, stable_sum
from wattloom.operators import dims, flatten, keys, quality, slices
from wattloom.operators.quantiles import quantile_by_group
from wattloom.plans import facts, features, forecast, health, integrate, profiles, refresh, reports
from wattloom.session import configure
from wattloom.sources import bronze
from wattloom.sources.feeds import CARBON, FEEDS, GENERATION, WEATHER, Feed
from wattloom.sources.tables import Tables
from wattloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}

# Fixed moments inside and after the data's month; the clock is never read.
AS_OF = "2024-01-31 00:00:00"
UPCOMING_FROM = "2024-01-20 00:00:00"
SPLIT = "2024-01-26 00:00:00"
WEATHER_NOW = "2024-01-15 12:34:00"


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def query(name: str):
    def register(build: Callable[[Layers], DataFrame]):
        _queries[name] = lambda spark, sf_dir: build(lake(configure(spark), str(sf_dir)))
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def dates_as_timestamps(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.col(name).cast("timestamp") for name, kind in df.dtypes if kind == "date"}
    )


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Rounds measures whose last bits depend on the order of summation."""
    return df.withColumns({name: F.round(name, digits) for name in names})


# --- bronze -----------------------------------------------------------------------------------


_BRONZE = ["envelope_json", "kafka_key", "topic", "partition", "offset", "kafka_timestamp", "event_date"]


@query("bronze_enrich")
def _(lk: Layers) -> DataFrame:
    rows = bronze.enrich(fx.topic_frame(fx.weather_enveloped(lk.events), WEATHER))
    return dates_as_timestamps(rows.select(*_BRONZE))


@query("bronze_measurement_date")
def _(lk: Layers) -> DataFrame:
    rows = lk.bronze(CARBON)
    return dates_as_timestamps(rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count")))


@query("backfill_rows")
def _(lk: Layers) -> DataFrame:
    rows = bronze.backfill_rows(fx.carbon_enveloped(lk.events), CARBON.topic, at(GENERATED_AT))
    return dates_as_timestamps(
        rows.groupBy("event_date", "topic", "partition", "offset", "kafka_timestamp").agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct("kafka_key").alias("regions")
        )
    )


@query("backfill_dry_run")
def _(lk: Layers) -> DataFrame:
    return bronze.backfill_summary(
        bronze.backfill_rows(fx.weather_enveloped(lk.events), WEATHER.topic, at(GENERATED_AT))
    )


@query("envelope_build")
def _(lk: Layers) -> DataFrame:
    env = fx.carbon_enveloped(lk.events).select("envelope.*")
    return env.select(
        "event_id", "source", "source_version", "ingested_at", "event_time", "region", "checksum"
    )


@query("checksum_verify")
def _(lk: Layers) -> DataFrame:
    checked = verify_checksum(lk.bronze(CARBON), CARBON.payload)
    return checked.groupBy("checksum_ok").agg(F.count(F.lit(1)).alias("row_count"))


def _source_split(name: str, feed: Feed) -> None:
    query(name)(lambda lk: dates_as_timestamps(reports.source_split(lk.bronze(feed))))


_source_split("source_split_carbon", CARBON)
_source_split("source_split_weather", WEATHER)
_source_split("source_split_generation", GENERATION)


# --- raw responses ----------------------------------------------------------------------------


@query("flatten_regions")
def _(lk: Layers) -> DataFrame:
    rows = flatten.regional_payloads(fx.regional_responses(lk.events))
    return rows.select(
        "event_id",
        "region",
        F.col("payload.from").alias("period_from"),
        F.col("payload.to").alias("period_to"),
        F.col("payload.regionid").alias("region_id"),
        F.col("payload.shortname").alias("shortname"),
        F.col("payload.intensity.forecast").alias("forecast"),
        F.col("payload.intensity.index").alias("index_label"),
        F.size("payload.generationmix").alias("fuels"),
    )


@query("flatten_hourly_arrays")
def _(lk: Layers) -> DataFrame:
    rows = flatten.hourly_payloads(fx.hourly_responses(lk.events))
    return rows.select(
        "event_id",
        *[
            F.col(f"payload.{c}").alias(c)
            for c in ("city", "latitude", "time", "temperature_2m", "wind_speed_10m")
        ],
        F.col("payload.cloud_cover").alias("cloud_cover"),
        F.col("payload.shortwave_radiation").alias("shortwave_radiation"),
        F.col("payload.units.temperature_2m").alias("temperature_unit"),
    )


@query("current_hour")
def _(lk: Layers) -> DataFrame:
    rows = flatten.current_hour_payloads(fx.hourly_responses(lk.events), at(WEATHER_NOW))
    return rows.select(
        "event_id",
        F.col("payload.city").alias("city"),
        F.col("payload.time").alias("time"),
        F.col("payload.temperature_2m").alias("temperature_2m"),
        F.col("payload.cloud_cover").alias("cloud_cover"),
    )


@query("flatten_generation_xml")
def _(lk: Layers) -> DataFrame:
    return flatten.generation_points(fx.generation_documents(lk.events))


@query("points_to_hours")
def _(lk: Layers) -> DataFrame:
    points = flatten.points_to_hours(flatten.generation_points(fx.generation_documents(lk.events)))
    return points.select("event_id", "series_no", "position", "point_utc", "hour_utc")


@query("xml_hourly_mean")
def _(lk: Layers) -> DataFrame:
    points = flatten.points_to_hours(flatten.generation_points(fx.generation_documents(lk.events)))
    return rounded(flatten.hourly_mean_by_fuel(points, ["country_code"]), 6, "mean_mw")


@query("hourly_mean_by_fuel")
def _(lk: Layers) -> DataFrame:
    means = flatten.hourly_mean_by_fuel(fx.points(lk.events), ["country_code"], "value_mw")
    return rounded(means, 6, "mean_mw")


@query("hourly_sum_of_series_means")
def _(lk: Layers) -> DataFrame:
    sums = flatten.hourly_sum_of_series_means(
        fx.points(lk.events), ["country_code"], ["series_id"], "value_mw"
    )
    return rounded(sums, 6, "mean_mw")


@query("nest_mix")
def _(lk: Layers) -> DataFrame:
    mix = F.col("generation_mix")
    return fx.generation_hours(lk.events).select(
        "country_code",
        "hour_utc",
        F.array_join(F.transform(mix, lambda x: x["psr_type"]), ",").alias("codes"),
        F.array_join(F.transform(mix, lambda x: x["name"]), ",").alias("names"),
        F.array_join(
            F.transform(mix, lambda x: F.round(x["value_mw"] * 100, 0).cast("bigint").cast("string")), ","
        ).alias("centi_mw"),
        "total_generation_mw",
    )


@query("fuel_labels")
def _(lk: Layers) -> DataFrame:
    per_code = fx.points(lk.events).groupBy("psr_type").agg(F.count(F.lit(1)).alias("row_count"))
    # Uncoded readings keep the default label.
    uncoded = per_code.withColumn("psr_type", F.concat(F.lit("X"), F.substring("psr_type", 2, 2)))
    return flatten.label_fuels(per_code.unionByName(uncoded), dims.fuel_labels(lk.spark))


# --- parse and validate -----------------------------------------------------------------------


def _parsed_bronze(lk: Layers, feed: Feed) -> DataFrame:
    """Bronze rows with every defect: generation uses the one-envelope-per-event fixture."""
    if feed is GENERATION:
        frame = fx.topic_frame(fx.point_enveloped(lk.events), feed)
        return bronze.enrich(frame, ingested_at=F.col("timestamp"))
    return lk.bronze(feed)


def _carbon_mix() -> Column:
    """All items of a carbon row's mix as text."""
    perc = lambda x: x["perc"].cast("bigint").cast("string")
    return F.array_join(F.transform("generation_mix", lambda x: F.concat(x["fuel"], F.lit("="), perc(x))), ",")


@query("parse_carbon")
def _(lk: Layers) -> DataFrame:
    mix = F.col("generation_mix")
    return (
        CARBON.parse(lk.bronze(CARBON))
        .withColumn("mix_fuels", F.array_join(F.transform(mix, lambda x: x["fuel"]), ","))
        .withColumn("mix_items", _carbon_mix())
        .drop("generation_mix", "envelope_json")
    )


@query("parse_weather")
def _(lk: Layers) -> DataFrame:
    return WEATHER.parse(lk.bronze(WEATHER)).drop("envelope_json")


@query("parse_generation")
def _(lk: Layers) -> DataFrame:
    mix = F.col("generation_mix")
    return (
        GENERATION.parse(_parsed_bronze(lk, GENERATION))
        .withColumn("mix_size", F.size(mix))
        .withColumn(
            "mix_items",
            F.array_join(
                F.transform(
                    mix,
                    lambda x: F.concat(
                        x["psr_type"], F.lit(":"), x["name"], F.lit("="), x["value_mw"].cast("bigint").cast("string")
                    ),
                ),
                ",",
            ),
        )
        .drop("generation_mix", "envelope_json")
    )


def _validate(name: str, feed: Feed) -> None:
    query(name)(
        lambda lk: feed.checked(_parsed_bronze(lk, feed), all_reasons=True).select(
            "kafka_timestamp",
            "event_id",
            "reject_reason",
            F.array_join("reject_reasons", "; ").alias("reject_reasons"),
        )
    )


_validate("validate_carbon", CARBON)
_validate("validate_weather", WEATHER)
_validate("validate_generation", GENERATION)


def _quality_counts(name: str, feed: Feed) -> None:
    query(name)(lambda lk: quality.quality_counts(feed.checked(_parsed_bronze(lk, feed))))


_quality_counts("quality_counts", CARBON)
_quality_counts("quality_counts_weather", WEATHER)
_quality_counts("quality_counts_generation", GENERATION)


@query("quarantine_rows")
def _(lk: Layers) -> DataFrame:
    _, invalid = quality.split_valid(WEATHER.checked(lk.bronze(WEATHER)))
    rows = quality.quarantine_rows(invalid, RUN, at(GENERATED_AT))
    return rows.select("kafka_timestamp", "city", "time_utc", "reject_reason", "reject_at_ts", "run_id")


@query("quarantine_table")
def _(lk: Layers) -> DataFrame:
    return lk.quarantine(CARBON).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("half_hour_gate")
def _(lk: Layers) -> DataFrame:
    return lk.silver(CARBON).groupBy(
        quality.half_hour(F.col("period_start")).cast("int").alias("half_hour")
    ).agg(F.count(F.lit(1)).alias("row_count"))


# --- keys -------------------------------------------------------------------------------------

_CARBON_SCALARS = [
    "event_id",
    "source",
    "ingested_at",
    "region_id",
    "region_code",
    "region_name",
    "period_start",
    "period_end",
    "intensity_forecast",
    "intensity_actual",
    "intensity_index",
]


@query("dedup_latest")
def _(lk: Layers) -> DataFrame:
    return lk.silver(CARBON).select(*_CARBON_SCALARS, _carbon_mix().alias("mix_items"))


def _staged_carbon(lk: Lake) -> DataFrame:
    """Parsed carbon rows, written once for the batches that several upserts take from them."""
    name = "staging.deliveries"
    return lk._table(name, lambda: lk.tables.overwrite(name, CARBON.checked(lk.bronze(CARBON))))


def _deliveries(lk: Layers, checked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All valid carbon rows as two batches that share their keys: each half hour's first and
    second quarter of an hour."""
    valid, _ = quality.split_valid(CARBON.checked(lk.bronze(CARBON)) if checked is None else checked)
    second = F.minute("ingested_at") % 30 >= 15
    return valid.filter(~second), valid.filter(second)


@query("upsert")
def _(lk: Layers) -> DataFrame:
    older, newer = _deliveries(lk)
    target = keys.latest_per_key(newer, CARBON.key)
    merged = keys.upsert_frame(target, older, CARBON.key)
    return merged.select(*_CARBON_SCALARS, _carbon_mix().alias("mix_items"))


@query("upsert_table")
def _(lk: Lake) -> DataFrame:
    older, newer = _deliveries(lk, _staged_carbon(lk))
    name = "upserted.carbon"
    for batch in (newer, older, newer):
        dated = batch.withColumn("date_utc", F.to_date("period_start"))
        lk.tables.upsert(name, dated, CARBON.key, "date_utc")
    return lk.tables.read(name).select(*_CARBON_SCALARS, _carbon_mix().alias("mix_items"))


@query("upsert_null_day")
def _(lk: Lake) -> DataFrame:
    """The same deliveries, with half of the regions in the partition of rows without a day."""
    older, newer = _deliveries(lk, _staged_carbon(lk))
    name, day = "upserted.undated", F.when(F.col("region_id") % 2 == 0, F.to_date("period_start"))
    for batch in (newer, older, newer):
        lk.tables.upsert(name, batch.withColumn("date_utc", day), CARBON.key, "date_utc")
    return lk.tables.read(name).select(*_CARBON_SCALARS, _carbon_mix().alias("mix_items"))


@query("upsert_forecast")
def _(lk: Layers) -> DataFrame:
    target = lk.forecast()
    since = F.timestamp_add("DAY", F.lit(-3), slices.newest(target, "base_hour_utc"))
    retrained = target.filter(F.col("base_hour_utc") >= since).withColumns(
        {
            "model_version": F.lit("4"),
            "generated_at": F.timestamp_add("DAY", F.lit(1), F.col("generated_at")),
            "predicted_carbon_gco2_kwh": F.col("predicted_carbon_gco2_kwh") + 1,
        }
    )
    merged = keys.upsert_frame(target, retrained, forecast.FORECAST_KEY, ["generated_at"])
    return rounded(merged.drop("date_utc"), 4, "predicted_carbon_gco2_kwh")


# --- integrate and facts ----------------------------------------------------------------------


@query("carbon_hourly")
def _(lk: Layers) -> DataFrame:
    return rounded(integrate.carbon_hourly(lk.silver(CARBON)), 6, "uk_carbon_intensity_forecast")


@query("grid_state")
def _(lk: Layers) -> DataFrame:
    cents = lambda x: F.round(x["value_mw"] * 100, 0).cast("bigint").cast("string")
    items = F.transform("generation_mix", lambda x: F.concat(x["psr_type"], F.lit("="), cents(x)))
    rows = lk.grid_state().withColumn("mix_items", F.array_join(items, ","))
    return rounded(rows.drop("generation_mix", "date_utc"), 6, "uk_carbon_intensity_forecast")


@query("fact_generation_fuel")
def _(lk: Layers) -> DataFrame:
    return rounded(lk.fact_fuel().drop("date_utc"), 2, "estimated_gco2_per_hour")


def _small_gold(lk: Lake, name: str) -> Tables:
    """A root of its own with the silver feeds and dimensions of the lake, for jobs that change them."""
    tables = Tables(lk.spark, f"{lk.tables.root}/{name}")
    for feed in FEEDS:
        tables.overwrite(f"silver.{feed.table}", lk.silver(feed), refresh.DAY)
    tables.overwrite("silver.country_dim", lk.country_dim())
    tables.overwrite("gold.dim_fuel_type", lk.dim_fuel_type())
    return tables


@query("grid_state_late_weather")
def _(lk: Lake) -> DataFrame:
    """Grid state and its fact, refreshed before and after the weather and the carbon have come."""
    tables = _small_gold(lk, "late")
    for feed in (WEATHER, CARBON):
        tables.overwrite(f"silver.{feed.table}", lk.silver(feed).filter(F.lit(False)), refresh.DAY)
    for _ in range(2):
        refresh.refresh_grid_state(tables)
        refresh.refresh_fact_grid(tables)
        for feed in (WEATHER, CARBON):
            tables.overwrite(f"silver.{feed.table}", lk.silver(feed), refresh.DAY)
    fact = tables.read("gold.fact_grid_hourly").select("country_code", "hour_utc", F.col("temperature_c").alias("fact_temperature_c"))
    state = tables.read("silver.grid_state").select(
        "country_code", "hour_utc", "temperature_c", "cloud_cover_pct", "uk_carbon_intensity_forecast"
    )
    return rounded(state.join(fact, ["country_code", "hour_utc"], "full"), 6, "uk_carbon_intensity_forecast")


@query("fact_fuel_new_factor")
def _(lk: Lake) -> DataFrame:
    """The fuel fact, refreshed before and after one fuel's emission factor has changed."""
    tables = _small_gold(lk, "factor")
    refresh.refresh_fact_fuel(tables, RUN)
    factor = F.when(F.col("source_code") == "B04", 999).otherwise(F.col("typical_gco2_per_kwh"))
    changed = lk.dim_fuel_type().withColumn("typical_gco2_per_kwh", factor)
    tables.overwrite("gold.dim_fuel_type", changed)
    refresh.refresh_fact_fuel(tables, RUN)
    fact = tables.read("gold.fact_generation_fuel_hourly")
    return rounded(
        fact.select("country_code", "hour_utc", "fuel_key", "value_mw", "estimated_gco2_per_hour"), 2, "estimated_gco2_per_hour"
    )


@query("fact_days_emptied")
def _(lk: Lake) -> DataFrame:
    """The fuel fact before and after the generation of its middle day has been withdrawn."""
    tables = _small_gold(lk, "emptied")
    refresh.refresh_fact_fuel(tables, RUN)
    days = tables.changed_days("gold.fact_generation_fuel_hourly")[1]
    generation = f"silver.{GENERATION.table}"
    none = tables.read(generation).filter(F.lit(False))
    tables.replace_partitions(generation, none, refresh.DAY, days=[days[len(days) // 2]])
    refresh.refresh_fact_fuel(tables, RUN)
    fact = tables.read("gold.fact_generation_fuel_hourly")
    return rounded(fact.select("country_code", "hour_utc", "fuel_key", "value_mw"), 2, "value_mw")


@query("gold_from_ledger")
def _(lk: Lake) -> DataFrame:
    """The grid fact from two rounds of jobs that find out by themselves what has changed: first without the
    generation of the last days, and without the weather of every third day."""
    tables = _small_gold(lk, "ledger")
    day = F.col(refresh.DAY)
    missing = [(GENERATION, day >= F.to_date(at(SPLIT))), (WEATHER, F.dayofmonth(day) % 3 == 0)]
    for feed, lacks in missing:
        tables.overwrite(f"silver.{feed.table}", lk.silver(feed).filter(~lacks), refresh.DAY)
    for late in (None, *missing):
        if late:
            feed, lacks = late
            tables.replace_partitions(f"silver.{feed.table}", lk.silver(feed).filter(lacks), refresh.DAY)
        refresh.refresh_grid_state(tables)
        refresh.refresh_fact_grid(tables)
    return tables.read("gold.fact_grid_hourly").select(
        "country_code", "hour_utc", "temperature_c", F.round("total_generation_mw", 2).alias("total_generation_mw")
    )


@query("orphan_fuels")
def _(lk: Layers) -> DataFrame:
    _, orphans = facts.fact_generation_fuel(lk.silver(GENERATION), lk.dim_fuel_type())
    return orphans.select("country_code", "hour_utc", "source_psr_type", "value_mw")


@query("fact_carbon_30min")
def _(lk: Layers) -> DataFrame:
    rows = lk.fact_carbon().withColumn("half_hour", F.col("half_hour").cast("int"))
    return rows.withColumn("mix_items", _carbon_mix()).drop("generation_mix", "date_utc")


@query("fact_grid_hourly")
def _(lk: Layers) -> DataFrame:
    return rounded(
        lk.fact_grid().drop("date_utc"),
        2,
        "renewable_generation_mw",
        "low_carbon_generation_mw",
        "estimated_lifecycle_gco2_per_hour",
        "uk_carbon_intensity_forecast",
    )


@query("co2_cross_check")
def _(lk: Layers) -> DataFrame:
    """Lifecycle CO2 per (country, hour) from both facts; they must agree."""
    fuel = lk.fact_fuel().groupBy("country_code", "hour_utc").agg(
        F.round(F.sum("estimated_gco2_per_hour"), 0).alias("fuel_fact_g")
    )
    grid = lk.fact_grid().filter("estimated_lifecycle_gco2_per_hour IS NOT NULL").select(
        "country_code", "hour_utc", F.round("estimated_lifecycle_gco2_per_hour", 0).alias("grid_fact_g")
    )
    return fuel.join(grid, ["country_code", "hour_utc"], "full")


@query("orphan_check")
def _(lk: Layers) -> DataFrame:
    return keys.orphan_counts(
        lk.fact_carbon(),
        {
            "orphan_region": (lk.dim_uk_region(), "region_id", "region_id"),
            "orphan_country": (lk.dim_country(), "country_key", "country_code"),
            "orphan_time": (lk.dim_time(), "time_key", "time_key"),
        },
    )


# --- dimensions, each against the data it describes -------------------------------------------


@query("dim_time")
def _(lk: Layers) -> DataFrame:
    return dates_as_timestamps(lk.dim_time())


@query("dim_country")
def _(lk: Layers) -> DataFrame:
    seen = lk.fact_grid().groupBy("country_code").agg(F.count(F.lit(1)).alias("hours"))
    return lk.dim_country().join(seen, "country_code", "left")


@query("dim_fuel_type")
def _(lk: Layers) -> DataFrame:
    seen = lk.fact_fuel().groupBy("fuel_key").agg(F.count(F.lit(1)).alias("hours"))
    return lk.dim_fuel_type().join(seen, "fuel_key", "left")


@query("dim_uk_region")
def _(lk: Layers) -> DataFrame:
    seen = lk.fact_carbon().groupBy("region_id").agg(F.count(F.lit(1)).alias("periods"))
    return lk.dim_uk_region().join(seen, "region_id", "left")


@query("country_bridge")
def _(lk: Layers) -> DataFrame:
    readings = lk.silver(WEATHER).groupBy("city").agg(F.count(F.lit(1)).alias("readings"))
    return lk.country_dim().join(readings, F.col("capital_city") == F.col("city"), "left").drop("city")


@query("calendar_gaps")
def _(lk: Layers) -> DataFrame:
    return dims.calendar_gaps(lk.dim_time(), lk.fact_grid(), lk.dim_country())


@query("calendar_gaps_any")
def _(lk: Layers) -> DataFrame:
    german = lk.fact_grid().filter(F.col("country_code") == "DE")
    return dims.calendar_gaps(lk.dim_time(), german).select("time_key", "hour_utc")


@query("local_time")
def _(lk: Layers) -> DataFrame:
    zones = F.broadcast(dims.country_zones(lk.spark))
    return lk.fact_grid().join(zones, "country_code").select(
        "country_code", "hour_utc", local_time(F.col("hour_utc"), F.col("zone")).alias("hour_local")
    )


@query("fuel_category_summary")
def _(lk: Layers) -> DataFrame:
    return reports.fuel_category_summary(lk.dim_fuel_type(), lk.fact_fuel())


# --- reports ----------------------------------------------------------------------------------


def _report(name: str, table: str, report, *args, **kwargs) -> None:
    query(name)(lambda lk: report(getattr(lk, table)(), *args, day=lk.day(table), **kwargs))


_report("eu_rankings", "fact_grid", reports.eu_rankings)
_report("grid_latest", "fact_grid", reports.grid_latest)
_report("grid_state_latest", "grid_state", reports.grid_state_latest)
_report("trend_24h", "fact_grid", reports.trend_24h, "FR")
_report("fuel_mix_latest", "fact_fuel", reports.fuel_mix_latest)
_report("eu_kpis", "fact_fuel", reports.eu_kpis)
_report("co2_24h_by_country", "fact_fuel", reports.co2_24h_by_country)
_report("country_fuel_mix", "fact_fuel", reports.country_fuel_mix, "it")
_report("germany_mix", "fact_fuel", reports.country_lifecycle_mix, "DE")
_report("uk_rankings", "fact_carbon", reports.uk_rankings)
_report("uk_spread", "fact_carbon", reports.uk_spread)
_report("uk_kpis", "fact_carbon", reports.uk_kpis)
_report("regional_24h", "fact_carbon", reports.regional_24h)
_report("regional_24h_dno", "fact_carbon", reports.regional_24h, region_type="DNO")
query("cleanest_window")(
    lambda lk: reports.cleanest_window(lk.fact_carbon(), at(UPCOMING_FROM), day=lk.day("fact_carbon"))
)
query("cleanest_window_by_code")(
    lambda lk: reports.cleanest_window(
        lk.fact_carbon(), at(UPCOMING_FROM), region="West Midlands", day=lk.day("fact_carbon")
    )
)


@query("uk_latest_map")
def _(lk: Layers) -> DataFrame:
    return reports.uk_latest_map(lk.fact_carbon(), lk.dim_uk_region(), lk.day("fact_carbon"))


@query("fuel_coverage")
def _(lk: Layers) -> DataFrame:
    return reports.fuel_coverage(lk.silver(GENERATION))


@query("coverage_by_year_carbon")
def _(lk: Layers) -> DataFrame:
    return reports.coverage_by_year(
        lk.silver(CARBON),
        "period_start",
        [],
        {
            "regions": F.count_distinct("region_code"),
            "first_period": F.min("period_start"),
            "last_period": F.max("period_start"),
        },
    )


def _rounded_stats(prefix: dict[str, tuple[Callable, str]], digits: int) -> dict[str, Column]:
    return {name: F.round(agg(column), digits) for name, (agg, column) in prefix.items()}


@query("coverage_by_year")
def _(lk: Layers) -> DataFrame:
    total = "total_generation_mw"
    return reports.coverage_by_year(
        lk.silver(GENERATION),
        "period_start",
        ["country_code"],
        _rounded_stats(
            {"avg_total_mw": (F.avg, total), "peak_mw": (F.max, total), "min_mw": (F.min, total)}, 0
        ),
    )


@query("coverage_by_year_weather")
def _(lk: Layers) -> DataFrame:
    t = "temperature_c"
    return reports.coverage_by_year(
        lk.silver(WEATHER),
        "time_utc",
        ["city"],
        _rounded_stats({"avg_temp_c": (F.avg, t), "peak_temp_c": (F.max, t), "min_temp_c": (F.min, t)}, 1),
    )


@query("coverage_by_year_features")
def _(lk: Layers) -> DataFrame:
    return reports.coverage_by_year(
        lk.features(),
        "hour_utc",
        ["country_code"],
        {
            "avg_carbon": F.round(F.avg("carbon_current"), 0),
            "avg_target": F.round(F.avg("target_t24h"), 0),
            "avg_temp_c": F.round(F.avg("temperature_c"), 1),
        },
    )


# --- profiles and checks ----------------------------------------------------------------------


def _bronze_profile(name: str, feed: Feed) -> None:
    query(name)(
        lambda lk: quality.profile(
            lk.bronze(feed), ts="kafka_timestamp", distinct={"distinct_keys": "kafka_key", "partitions": "partition"}
        )
    )


_bronze_profile("profile_bronze_carbon", CARBON)
_bronze_profile("profile_bronze_weather", WEATHER)
_bronze_profile("profile_bronze_generation", GENERATION)


@query("profile_carbon")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.silver(CARBON),
        ts="period_start",
        keys=CARBON.key,
        distinct={"distinct_regions": "region_code"},
        not_null={"rows_with_actual": "intensity_actual"},
        span_days=True,
    )


@query("profile_sketched")
def _(lk: Lake) -> DataFrame:
    """Two deliveries of silver carbon, the sketches brought up to date after each: counts and times of the merged
    profile, the exact distinct counts, and whether the estimates are within 3 % of them."""
    tables, name = Tables(lk.spark, f"{lk.tables.root}/profiles"), f"silver.{CARBON.table}"
    late = F.dayofmonth(refresh.DAY) % 3 == 0
    distinct = {"keys": CARBON.key, "regions": ["region_code"], "events": ["event_id"]}
    tables.overwrite(name, lk.silver(CARBON).filter(~late), refresh.DAY)
    profiles.refresh_profile(tables, name, CARBON.ts, distinct)
    tables.replace_partitions(name, lk.silver(CARBON).filter(late), refresh.DAY)
    profiles.refresh_profile(tables, name, CARBON.ts, distinct)
    merged = profiles.profile_sketched(tables, name)
    exact = quality.profile(
        lk.silver(CARBON), keys=CARBON.key, distinct={"exact_regions": "region_code", "exact_events": "event_id"}
    ).withColumnsRenamed({"distinct_natural_keys": "exact_keys", "row_count": "_rows"})
    both = merged.join(exact, F.col("row_count") == F.col("_rows"))
    near = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.03 * F.col(f"exact_{c}")).alias(f"{c}_near") for c in distinct]
    return both.select("row_count", "earliest", "latest", *[f"exact_{c}" for c in distinct], *near)


@query("profile_weather")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.silver(WEATHER), ts="time_utc", keys=WEATHER.key, distinct={"distinct_cities": "city"}, span_days=True
    )


@query("profile_generation")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.silver(GENERATION),
        ts="period_start",
        keys=GENERATION.key,
        distinct={"distinct_countries": "country_code"},
        measures={
            "avg_total_mw": F.round(F.avg("total_generation_mw"), 1),
            "peak_total_mw": F.round(F.max("total_generation_mw"), 1),
        },
        span_days=True,
    )


@query("profile_grid_state")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.grid_state(),
        ts="hour_utc",
        keys=["country_code", "hour_utc"],
        distinct={"countries": "country_code"},
        not_null={"rows_with_weather": "temperature_c", "rows_with_uk_carbon": "uk_carbon_intensity_forecast"},
    )


@query("profile_fact_fuel")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.fact_fuel(),
        ts="hour_utc",
        keys=["country_code", "hour_utc", "fuel_key"],
        distinct={"countries": "country_code", "fuels_seen": "fuel_key", "hours": "hour_utc"},
        measures={
            "total_mw_summed": F.round(stable_sum("value_mw"), 0),
            "total_megatons_co2_eq": F.round(stable_sum("estimated_gco2_per_hour") / 1e12, 2),
        },
    )


@query("profile_fact_grid")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.fact_grid(),
        ts="hour_utc",
        keys=["country_code", "hour_utc"],
        distinct={"countries": "country_code", "hours": "hour_utc"},
        not_null={"rows_with_uk_carbon": "uk_carbon_intensity_forecast"},
        measures={
            "avg_renewable_pct": F.round(F.avg("renewable_share_pct"), 1),
            "avg_low_carbon_pct": F.round(F.avg("low_carbon_share_pct"), 1),
            "avg_gco2_per_kwh": F.round(F.avg("estimated_lifecycle_gco2_per_kwh"), 0),
        },
    )


@query("profile_fact_carbon")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.fact_carbon(),
        ts="period_start",
        keys=["region_id", "period_start"],
        distinct={"regions": "region_id"},
        measures={
            "forecast_rows": F.count_if(F.col("source_type") == "forecast"),
            "actual_rows": F.count_if(F.col("source_type") == "actual"),
            "null_forecast": F.count_if(F.col("intensity_forecast").isNull()),
            "null_time_key": F.count_if(F.col("time_key").isNull()),
        },
    )


@query("profile_features")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.features(), ts="hour_utc", distinct={"distinct_countries": "country_code"}, span_days=True
    )


@query("profile_forecast")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.forecast(),
        distinct={"countries": "country_code", "distinct_model_versions": "model_version"},
        measures={
            "earliest_base": F.min("base_hour_utc"),
            "latest_base": F.max("base_hour_utc"),
            "earliest_target": F.min("target_hour_utc"),
            "latest_target": F.max("target_hour_utc"),
        },
    )


@query("profile_calendar")
def _(lk: Layers) -> DataFrame:
    return quality.profile(
        lk.dim_time(),
        ts="hour_utc",
        distinct={"distinct_days": "date_utc"},
        measures={
            "weekend_hours": F.count_if("is_weekend"),
            "uk_business_hours": F.count_if("is_business_hour_uk"),
            "daytime_hours": F.count_if("is_daytime_approx"),
        },
    )


@query("grain_check")
def _(lk: Layers) -> DataFrame:
    return quality.grain_check(lk.fact_fuel(), ["country_code", "hour_utc", "fuel_key"])


@query("measure_quality")
def _(lk: Layers) -> DataFrame:
    return quality.range_report(
        lk.fact_fuel(),
        {
            "null_country_fk": "country_key",
            "null_fuel_fk": "fuel_key",
            "null_time_fk": "time_key",
            "null_value_mw": "value_mw",
        },
        "value_mw",
    )


@query("feature_quality")
def _(lk: Layers) -> DataFrame:
    return quality.null_counts(
        lk.features(),
        {
            "null_target": "target_t24h",
            "null_lag_168h": "carbon_lag_168h",
            "null_rolling": "carbon_rolling_24h_mean",
            "null_temp": "temperature_c",
        },
    )


@query("rows_per_entity")
def _(lk: Layers) -> DataFrame:
    return reports.rows_per_entity(lk.features(), "country_code", "hour_utc")


# --- health -----------------------------------------------------------------------------------

_BUSINESS_TS = {
    ("silver", "carbon_intensity"): "period_start",
    ("silver", "generation"): "period_start",
    ("silver", "weather"): "time_utc",
    ("silver", "grid_state"): "hour_utc",
    ("gold", "fact_carbon_intensity_30min"): "period_start",
    ("gold", "fact_generation_fuel_hourly"): "hour_utc",
}


def _dated_tables(lk: Layers) -> health.Tables:
    frames = [lk.silver(CARBON), lk.silver(GENERATION), lk.silver(WEATHER), lk.grid_state(), lk.fact_carbon(), lk.fact_fuel()]
    return dict(zip(_BUSINESS_TS, frames, strict=True))


def _all_tables(lk: Layers) -> health.Tables:
    return {
        **{("bronze", feed.topic.replace("-", "_")): lk.bronze(feed) for feed in FEEDS},
        **_dated_tables(lk),
        ("silver", "country_dim"): lk.country_dim(),
        ("gold", "dim_country"): lk.dim_country(),
        ("gold", "dim_fuel_type"): lk.dim_fuel_type(),
        ("gold", "dim_time"): lk.dim_time(),
        ("gold", "dim_uk_region"): lk.dim_uk_region(),
    }


query("layer_row_counts")(lambda lk: health.layer_row_counts(_all_tables(lk)))
query("lakehouse_kpis")(lambda lk: health.lakehouse_kpis(_all_tables(lk)))
query("freshness")(lambda lk: health.freshness_report(_dated_tables(lk), _BUSINESS_TS, at(AS_OF)))
query("layer_freshness")(lambda lk: health.latest_timestamps(_dated_tables(lk), _BUSINESS_TS))


@query("gold_row_counts")
def _(lk: Layers) -> DataFrame:
    gold = {k: v for k, v in _all_tables(lk).items() if k[0] == "gold"}
    return health.layer_row_counts(gold).drop("layer")


@query("freshness_status")
def _(lk: Layers) -> DataFrame:
    age = age_minutes(F.col("latest"), at(AS_OF))
    latest = lk.fact_carbon().groupBy("region_id").agg(F.max("period_start").alias("latest"))
    return latest.select("region_id", F.round(age, 1).alias("age_minutes"), freshness(age).alias("status"))


@query("layer_parity")
def _(lk: Layers) -> DataFrame:
    return health.layer_parity(lk.silver(CARBON), lk.fact_carbon(), "period_start")


# --- features and forecast --------------------------------------------------------------------

_MEANS = ["carbon_rolling_24h_mean", "temp_rolling_24h_mean"]


@query("features")
def _(lk: Layers) -> DataFrame:
    return rounded(lk.features().drop("date_utc"), 6, *_MEANS)


@query("features_time_true")
def _(lk: Layers) -> DataFrame:
    return rounded(features.training_features(lk.fact_grid(), mode="hours"), 6, *_MEANS)


@query("scoring_features")
def _(lk: Layers) -> DataFrame:
    return rounded(features.scoring_features(lk.fact_grid()), 6, *_MEANS)


@query("features_incremental")
def _(lk: Lake) -> DataFrame:
    """The feature table in two runs, of which the first lacks the last days, and more of Germany's."""
    tables = Tables(lk.spark, f"{lk.tables.root}/incremental")
    grid = lk.fact_grid()
    reached = F.timestamp_add("DAY", F.when(F.col("country_code") == "DE", -3).otherwise(0), at(SPLIT))
    for part in (grid.filter(F.col("hour_utc") < reached), grid):
        tables.overwrite("gold.fact_grid_hourly", part, refresh.DAY)
        refresh.refresh_features(tables, "incremental", lags="hours")
    rows = tables.read("gold.feature_carbon_forecast").drop(refresh.DAY)
    return rounded(rows, 6, *_MEANS)


@query("features_corrected")
def _(lk: Lake) -> DataFrame:
    """The feature table from two runs: the grid fact of the first lacks a day and is wrong on another."""
    tables, name = Tables(lk.spark, f"{lk.tables.root}/corrected"), "gold.fact_grid_hourly"
    grid = lk.fact_grid()
    days = lk.tables.changed_days(name)[1]
    gap, wrong = F.lit(days[len(days) // 2]).cast("date"), F.lit(days[len(days) // 3]).cast("date")
    day, carbon = F.col(refresh.DAY), "estimated_lifecycle_gco2_per_kwh"
    off = F.when(day == wrong, F.col(carbon) + 50).otherwise(F.col(carbon))
    first = grid.filter(day != gap).withColumn(carbon, off.cast(grid.schema[carbon].dataType))
    tables.overwrite(name, first, refresh.DAY)
    refresh.refresh_features(tables, "incremental")
    tables.replace_partitions(name, grid.filter(day.isin(gap, wrong)), refresh.DAY)
    refresh.refresh_features(tables, "incremental")
    return rounded(tables.read("gold.feature_carbon_forecast").drop(refresh.DAY), 6, *_MEANS)


@query("features_newer")
def _(lk: Lake) -> DataFrame:
    rows = lk.features()
    reached = F.timestamp_add("DAY", F.when(F.col("country_code") == "DE", -3).otherwise(0), at(SPLIT))
    newer = features.newer_than(rows, rows.filter(F.col("hour_utc") < reached))
    return newer.select("country_code", "hour_utc", "carbon_current", "target_t24h")


@query("temporal_split")
def _(lk: Layers) -> DataFrame:
    parts = features.temporal_split(lk.features(), SPLIT, validation_days=2)
    out = None
    for name, part in parts.items():
        row = part.agg(
            F.count(F.lit(1)).alias("row_count"), F.min("hour_utc").alias("earliest"), F.max("hour_utc").alias("latest")
        ).select(F.lit(name).alias("part"), "row_count", "earliest", "latest")
        out = row if out is None else out.unionByName(row)
    return out


def _rounded_metrics(metrics: DataFrame) -> DataFrame:
    return rounded(metrics, 4, "mae", "rmse", "r2", "mape", "avg_target", "relative_error_pct")


@query("regression_metrics")
def _(lk: Layers) -> DataFrame:
    scored = fx.persistence(lk.features())
    return _rounded_metrics(forecast.regression_metrics(scored))


@query("persistence_metrics")
def _(lk: Layers) -> DataFrame:
    return _rounded_metrics(forecast.regression_metrics(lk.features(), prediction="carbon_current"))


@query("inference_window")
def _(lk: Layers) -> DataFrame:
    window = forecast.inference_window(lk.features(), day=lk.day("features"))
    return window.select("country_code", "hour_utc", "carbon_current")


@query("forecast_fact")
def _(lk: Layers) -> DataFrame:
    return lk.forecast().drop("date_utc")


@query("latest_forecast")
def _(lk: Layers) -> DataFrame:
    return forecast.latest_forecast(lk.forecast())


@query("latest_forecast_country")
def _(lk: Layers) -> DataFrame:
    return forecast.latest_forecast(lk.forecast(), "nl")


@query("forecast_delta")
def _(lk: Layers) -> DataFrame:
    return forecast.forecast_delta(lk.forecast())


@query("forecast_newest")
def _(lk: Layers) -> DataFrame:
    rows = reports.newest_rows(lk.forecast(), "base_hour_utc", ["country_code"])
    return rows.select("country_code", "base_hour_utc", "target_hour_utc")


@query("forecast_distribution")
def _(lk: Layers) -> DataFrame:
    names = {"min": "min_pred", "median": "median_pred", "max": "max_pred", "stddev": "stddev_pred"}
    return reports.distribution(lk.forecast(), "country_code", "predicted_carbon_gco2_kwh", names)


@query("model_latest_version")
def _(lk: Layers) -> DataFrame:
    runs = lk.forecast().select("model_name", F.col("model_version").alias("version")).distinct()
    older = runs.withColumn("version", (F.col("version").cast("int") - 1).cast("string"))
    version = forecast.latest_version(runs.unionByName(older), "persistence")
    return lk.spark.range(1).select(version.alias("latest_version"))


@query("distribution")
def _(lk: Layers) -> DataFrame:
    names = {"min": "min_gco2_kwh", "median": "median_gco2_kwh", "max": "max_gco2_kwh", "stddev": "stddev"}
    return reports.distribution(lk.features(), "country_code", "carbon_current", names)


@query("distribution_selected")
def _(lk: Layers) -> DataFrame:
    names = {"min": "min_gco2_kwh", "median": "median_gco2_kwh", "max": "max_gco2_kwh", "stddev": "stddev"}
    return reports.distribution_selected(lk.features(), "country_code", "carbon_current", names)


@query("quantiles_selected")
def _(lk: Layers) -> DataFrame:
    """Exact quantiles of all readings, where a group's middle holds more rows than are put in order at once."""
    out = None
    for p in (0.0, 0.1, 0.5, 0.95, 1.0):
        found = quantile_by_group(fx.points(lk.events), "country_code", "value_mw", p, "value_mw", accuracy=100, few=50)
        found = found.select(F.lit(p).alias("share"), "country_code", "value_mw")
        out = found if out is None else out.unionByName(found)
    return out


@query("feature_correlation")
def _(lk: Layers) -> DataFrame:
    return reports.feature_correlation(lk.features())


def _model(lk: Layers):
    """The booster with the library's own settings, trained once per lake."""
    if not hasattr(lk, "_booster"):
        parts = features.temporal_split(lk.features(), SPLIT, validation_days=2)
        lk._booster = forecast.train(parts["train"], parts["validation"])
    return lk._booster


@query("gbt_forecast")
def _(lk: Layers) -> DataFrame:
    """Scores vary with the trees; SQL knows the rows, and that a mean of targets lies among them."""
    rows = lk.features()
    scored = forecast.predict(_model(lk), forecast.inference_window(rows, day=lk.day("features")))
    fact = forecast.forecast_rows(scored, generated_at=at(GENERATED_AT))
    bounds = [rows.agg(f("target_t24h")).scalar() for f in (F.min, F.max)]
    slack = (bounds[1] - bounds[0]) / 2
    score = F.col("predicted_carbon_gco2_kwh")
    in_range = score.between(bounds[0] - slack, bounds[1] + slack).alias("in_range")
    return fact.select(*[c for c in fact.columns if c not in ("predicted_carbon_gco2_kwh", "generated_at")], in_range)


@query("gbt_metrics")
def _(lk: Layers) -> DataFrame:
    test = features.temporal_split(lk.features(), SPLIT)["test"]
    own = forecast.regression_metrics(forecast.predict(_model(lk), test))
    repeated = forecast.regression_metrics(fx.persistence(test)).select("country_code", F.col("mae").alias("persistence_mae"))
    beats = F.when(F.col("country_code") == "ALL", F.col("mae") < F.col("persistence_mae"))
    both = own.join(repeated, "country_code").withColumn("beats_persistence", beats)
    return rounded(both.select("country_code", "row_count", "avg_target", "beats_persistence"), 4, "avg_target")


@query("gbt_importance")
def _(lk: Layers) -> DataFrame:
    found = forecast.feature_importance(_model(lk), lk.features())
    total = found.agg(F.round(F.sum("importance"), 6)).scalar()
    return found.select("feature", F.col("importance").between(0, 1).alias("is_share"), total.alias("total"))


# --- streams ----------------------------------------------------------------------------------


def _event_stream(lk: Layers) -> DataFrame:
    """The events table as a stream; the glob admits a single file as well as a folder."""
    schema = lk.spark.read.parquet(f"{lk.sf_dir}/events.parquet").schema
    stream = lk.spark.readStream.schema(schema).parquet(f"{lk.sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _stream_tables(lk: Lake) -> Tables:
    return Tables(lk.spark, f"{lk.tables.root}/stream")


def _stream_bronze(lk: Lake) -> DataFrame:
    """Weather messages from the event stream into a bronze table; a second call adds nothing."""
    tables = _stream_tables(lk)
    rows = bronze.enrich(fx.topic_frame(fx.weather_enveloped(_event_stream(lk)), WEATHER))
    ingest.write_bronze(rows, tables, "weather", f"{tables.root}/checkpoints/bronze-weather")
    return tables.read("bronze.weather")


@query("stream_bronze")
def _(lk: Lake) -> DataFrame:
    return dates_as_timestamps(_stream_bronze(lk).select(*_BRONZE))


@query("bronze_live_and_backfill")
def _(lk: Lake) -> DataFrame:
    """A stream and a backfill in one bronze table, in either order, each run twice."""
    out = None
    for order in ("live_first", "backfill_first"):
        tables = Tables(lk.spark, f"{lk.tables.root}/shared-{order}")
        # A stream can't be divided into ranges; a day's events go to a few tasks.
        dealt = _event_stream(lk).repartition(slices.cluster_tasks(lk.events), F.to_date("ts"), F.col("event_id") % 8)
        live = bronze.enrich(fx.topic_frame(fx.weather_enveloped(dealt), WEATHER), date_from="measurement")
        events = slices.clustered(lk.events, "ts", "event_id")
        history = bronze.backfill_rows(fx.carbon_enveloped(events), WEATHER.topic, at(GENERATED_AT))
        steps = [
            lambda t=tables, r=live: ingest.write_bronze(r, t, WEATHER.topic, f"{t.root}/checkpoints/live", clustered=True),
            lambda t=tables, r=history: bronze.append_backfill(t, WEATHER.topic, r, write_id="history", clustered=True),
        ]
        for step in (steps if order == "live_first" else steps[::-1]) * 2:
            step()
        written_by = F.when(F.col(bronze.WRITE_ID) == "history", "backfill").otherwise("stream")
        rows = tables.read(f"bronze.{WEATHER.topic}").groupBy(written_by.alias("written_by")).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct("kafka_key").alias("kafka_keys")
        )
        rows = rows.select(F.lit(order).alias("write_order"), "written_by", "row_count", "kafka_keys")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stream_silver")
def _(lk: Lake) -> DataFrame:
    tables = _stream_tables(lk)
    _stream_bronze(lk)
    stream = ingest.read_bronze_stream(lk.spark, tables.path("bronze.weather"))
    ingest.silver_stream(stream, tables, WEATHER, f"{tables.root}/checkpoints/silver-weather")
    return tables.read(f"silver.{WEATHER.table}").select(
        "event_id", "city", "time_utc", "temperature_c", "wind_speed_kmh", "cloud_cover_pct", "solar_radiation_wm2"
    )


@query("stream_dedup")
def _(lk: Lake) -> DataFrame:
    """Half hours of the regions from rows in no order of time, cut into eight batches."""
    tables = _stream_tables(lk)
    keys_ = ["region_id", "period_start"]
    periods = fx.carbon_periods(lk.events).select(*keys_, "ingested_at", "event_id")
    landed = tables.path("landed.periods")
    periods.repartition(8, "event_id").write.mode("ignore").parquet(landed)
    stream = lk.spark.readStream.schema(periods.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    dated = stream.withColumn("date_utc", F.to_date("period_start"))
    checkpoint = f"{tables.root}/checkpoints/dedup-carbon"
    ingest.distinct_stream(dated, tables, "dedup.carbon", keys_, "date_utc", ["ingested_at", "event_id"], checkpoint)
    return tables.read("dedup.carbon").select(*keys_, "event_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which country is cleanest at the newest hour, from raw events in one lazy plan."""
    return reports.eu_rankings(Layers(configure(spark), sf_dir).fact_grid())


__all__ = ["flagship", "queries"]
