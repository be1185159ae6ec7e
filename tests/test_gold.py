from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wattloom.operators import dims, slices
from wattloom.plans import facts, features, forecast, health, integrate, reports

HOUR = datetime(2026, 5, 14, 10)


def test_literal_dimensions(spark):
    assert dims.dim_country(spark).count() == 6
    assert dims.dim_uk_region(spark).groupBy("region_type").count().orderBy("region_type").collect()[0][1] == 14
    fuels = dims.dim_fuel_type(spark)
    assert rows(fuels.groupBy("source_taxonomy").count()) == [("entsoe", 20), ("uk_ci", 9)]
    assert not any(f.nullable for f in fuels.schema)
    assert dims.fuel_labels(spark).count() == 28
    assert {len(r.eic_bidding_zone) for r in dims.dim_country(spark).collect()} == {16}


def test_default_calendar(spark):
    calendar = dims.dim_time(spark)
    assert calendar.count() == 17_521
    assert len(calendar.columns) == 16
    assert calendar.agg(F.count_distinct("time_key")).first()[0] == 17_521
    sunday = calendar.filter("time_key = 2026051707").first()
    assert (sunday.day_of_week_iso, sunday.is_weekend, sunday.is_business_hour_uk, sunday.is_daytime_approx) == (
        7, True, False, True,
    )
    assert (sunday.day_name, sunday.month_name, sunday.week_of_year) == ("Sunday", "May", 20)


def test_calendar_spans_its_table(spark):
    stamps = spark.createDataFrame([("2023-05-17 03:30:00",), ("2023-05-18 01:59:00",)], "t STRING")
    got = dims.dim_time_spanning(stamps.select(F.to_timestamp("t").alias("t")), "t")
    first, last = got.agg(F.min("time_key"), F.max("time_key")).first()
    assert (first, last, got.count()) == (2023051703, 2023051801, 23)
    assert dims.dim_time_spanning(stamps.select(F.to_timestamp("t").alias("t")).limit(0), "t").count() == 0


def test_gaps_per_entity_and_overall(spark):
    calendar = dims.dim_time(spark, "2026-05-14 00:00:00", "2026-05-14 02:00:00")
    fact = spark.createDataFrame([("DE", 2026051400), ("FR", 2026051402)], "country_code STRING, time_key BIGINT")
    entities = spark.createDataFrame([("DE",), ("FR",)], "country_code STRING")
    assert rows(dims.calendar_gaps(calendar, fact, entities), "country_code", "time_key") == [
        ("DE", 2026051401), ("DE", 2026051402), ("FR", 2026051400), ("FR", 2026051401),
    ]
    assert rows(dims.calendar_gaps(calendar, fact), "time_key") == [(2026051401,)]


MIX = "ARRAY<STRUCT<psr_type: STRING, name: STRING, value_mw: DOUBLE>>"


def generation(spark, *mixes):
    data = [("DE", HOUR, total, mix, HOUR) for total, mix in mixes]
    schema = f"country_code STRING, period_start TIMESTAMP, total_generation_mw DOUBLE, generation_mix {MIX}, ingested_at TIMESTAMP"
    return spark.createDataFrame(data, schema)


def state(spark, *mixes):
    empty = dict.fromkeys(["temperature_c", "wind_speed_kmh", "cloud_cover_pct", "solar_radiation_wm2"])
    df = generation(spark, *mixes).withColumnRenamed("period_start", "hour_utc")
    for name in [*empty, "uk_carbon_intensity_forecast"]:
        df = df.withColumn(name, F.lit(None).cast("double"))
    return df


def test_grid_fact_measures(spark):
    known = [("B16", "Solar", 60.0), ("B02", "Lignite", 40.0)]
    orphan = [("B25", "Energy storage", 100.0)]
    frame = state(spark, (100.0, known), (200.0, known + orphan), (100.0, orphan), (0.0, known), (5.0, None))
    fact = facts.fact_grid_hourly(frame, dims.dim_fuel_type(spark))
    grams = 60.0 * 1000 * 48 + 40.0 * 1000 * 1054
    got = fact.select(
        "renewable_generation_mw", "renewable_share_pct", "low_carbon_share_pct",
        "estimated_lifecycle_gco2_per_kwh", "estimated_lifecycle_gco2_per_hour", "time_key",
    ).collect()
    key = 2026051410
    assert [tuple(r) for r in got] == [
        (60.0, 60.0, 60.0, 450.4, grams, key),
        (60.0, 30.0, 30.0, 225.2, grams, key),  # the unknown code stays in the denominator
        (None, None, None, None, None, key),
        (60.0, None, None, None, grams, key),
        (None, None, None, None, None, key),
    ]


def test_both_facts_agree_on_co2_and_orphans_come_out(spark):
    mix = [("B16", "Solar", 60.0), ("B02", "Lignite", 40.5), ("B25", "Energy storage", 1.0)]
    fuel, orphans = facts.fact_generation_fuel(generation(spark, (101.5, mix)), dims.dim_fuel_type(spark))
    grid = facts.fact_grid_hourly(state(spark, (101.5, mix)), dims.dim_fuel_type(spark))
    assert fuel.agg(F.sum("estimated_gco2_per_hour")).first()[0] == grid.first().estimated_lifecycle_gco2_per_hour
    assert rows(orphans, "source_psr_type", "value_mw") == [("B25", 1.0)]


def test_grid_fact_needs_no_shuffle_of_the_state(spark):
    text = plan(facts.fact_grid_hourly(state(spark, (1.0, [])), dims.dim_fuel_type(spark)))
    assert "Exchange hashpartitioning" not in text
    assert "Generate" not in text


def carbon(spark, *data):
    schema = (
        "region_id INT, region_code STRING, period_start TIMESTAMP, intensity_forecast INT, intensity_actual INT, "
        "intensity_index STRING"
    )
    df = spark.createDataFrame(data, schema)
    return df.withColumns(
        {
            "period_end": F.timestamp_add("MINUTE", F.lit(30), F.col("period_start")),
            "generation_mix": F.array(),
            "source": F.lit("s"),
            "ingested_at": F.col("period_start"),
            "event_id": F.lit("e"),
        }
    )


def test_hourly_carbon_takes_the_first_label_there_is(spark):
    half = HOUR.replace(minute=30)
    got = integrate.carbon_hourly(
        carbon(spark, (18, "GB", HOUR, 10, None, None), (18, "GB", half, 21, None, "low"), (1, "N", HOUR, 99, None, "high"))
    )
    assert rows(got) == [(HOUR, 15.5, "low")]


def test_carbon_joins_gb_only_and_other_countries_stay(spark):
    gen = generation(spark, (1.0, []), (2.0, [])).withColumn("country_name", F.lit("x"))
    gen = gen.withColumn("country_code", F.when(F.col("total_generation_mw") == 1, "GB").otherwise("FR"))
    weather = spark.createDataFrame(
        [("Paris", HOUR, 1.5, 1.0, 1, 1.0)],
        "city STRING, time_utc TIMESTAMP, temperature_c DOUBLE, wind_speed_kmh DOUBLE, cloud_cover_pct INT, solar_radiation_wm2 DOUBLE",
    )
    got = integrate.grid_state(
        gen, weather, carbon(spark, (18, "GB", HOUR, 10, None, "low")), dims.country_bridge(spark)
    )
    assert rows(got, "country_code", "temperature_c", "uk_carbon_intensity_forecast") == [
        ("FR", 1.5, None), ("GB", None, 10.0),
    ]


def carbon_fact(spark):
    half = HOUR.replace(minute=30)
    silver = carbon(
        spark,
        (18, "GB", HOUR, 50, 52, "low"),
        (18, "GB", half, 40, None, "low"),
        (8, "West Midlands", half, 30, None, "low"),
        (99, "Atlantis", half, 1, None, "low"),
    )
    return facts.fact_carbon_30min(silver, dims.dim_uk_region(spark))


def test_carbon_fact(spark):
    fact, orphans = carbon_fact(spark)
    assert rows(fact, "region_name", "half_hour", "source_type", "has_actual", "forecast_minus_actual") == [
        ("GB", 0, "actual", True, -2),
        ("GB", 30, "forecast", False, None),
        ("WPD West Midlands", 30, "forecast", False, None),
    ]
    assert rows(orphans, "region_id") == [(99,)]


def test_cleanest_window_by_name_or_code_from_a_moment(spark):
    fact, _ = carbon_fact(spark)
    for region in ("West Midlands", "WPD West Midlands"):
        assert reports.cleanest_window(fact, HOUR, region).first().gco2_per_kwh == 30
    assert reports.cleanest_window(fact, datetime(2026, 6, 1)).count() == 0
    assert reports.cleanest_window(fact, HOUR, "' OR '1'='1").count() == 0


def test_countries_are_checked(spark):
    assert reports.checked_country("fr") == "FR"
    for bad in ("GB", "XX", "DE' OR 1=1"):
        with pytest.raises(ValueError):
            reports.checked_country(bad)


def test_slices_include_both_ends(spark):
    df = spark.createDataFrame([(f"2026-05-{d} {h}:00:00",) for d in (13, 14) for h in ("09", "10", "11")], "t STRING")
    df = df.select(F.to_timestamp("t").alias("t")).withColumn("day", F.to_date("t"))
    for day in (None, "day"):
        assert slices.latest_slice(df, "t", day).count() == 1
        assert slices.trailing_slice(df, "t", 24, day).count() == 4
    assert slices.latest_slice(df.limit(0), "t").count() == 0


def test_health_of_empty_tables(spark):
    empty = spark.range(0).select(F.lit(HOUR).alias("t"))
    tables = {("gold", "t"): empty}
    row = health.freshness_report(tables, {("gold", "t"): "t"}, F.lit(HOUR)).first()
    assert (row.latest_ts, row.age_minutes, row.freshness_status) == (None, None, "very stale")
    assert health.lakehouse_kpis(tables).first().total_rows == 0


def test_splits_do_not_overlap(spark):
    df = spark.createDataFrame([(datetime(2026, 1, d),) for d in range(1, 11)], "hour_utc TIMESTAMP")
    parts = features.temporal_split(df, "2026-01-08 00:00:00", validation_days=2)
    assert {k: v.count() for k, v in parts.items()} == {"train": 5, "validation": 2, "test": 3}


def test_metrics_against_plain_arithmetic(spark):
    data = [("DE", 10.0, 12.0), ("DE", 20.0, 17.0), ("FR", 0.5, 1.5), ("FR", 4.0, None)]
    scored = spark.createDataFrame(data, "country_code STRING, target_t24h DOUBLE, prediction DOUBLE")
    got = {r.country_code: r for r in forecast.regression_metrics(scored).collect()}
    assert got["DE"].mae == 2.5
    assert got["DE"].rmse == pytest.approx(6.5**0.5)
    assert got["DE"].r2 == pytest.approx(1 - 13 / 50)
    assert got["DE"].mape == pytest.approx((2 / 10 + 3 / 20) / 2 * 100)
    assert got["FR"].mape == pytest.approx(100.0)  # the denominator is never below 1
    assert got["FR"].r2 is None
    assert got["ALL"].row_count == 3


def test_newest_version_is_a_number_not_a_text(spark):
    runs = spark.createDataFrame([("m", "9"), ("m", "10"), ("x", "11")], "model_name STRING, version STRING")
    assert spark.range(1).select(forecast.latest_version(runs, "m")).first()[0] == 10
