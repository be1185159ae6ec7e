"""The refresh jobs over a small folder: full and incremental, models, questions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from verification import fixtures as fx
from verification.lake import Layers, bronze_rows, forecast_fixture
from wattloom.plans import features, forecast, questions, refresh
from wattloom.sources import bronze, models
from wattloom.sources.feeds import CARBON, FEEDS, WEATHER
from wattloom.sources.tables import Tables

CUT = "2024-01-28"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Silver and gold refreshed twice: all but the last days first, then the last days only."""
    from wattloom.session import shared_folder

    tables = Tables(spark, f"{shared_folder(spark)}/tests/{tmp_path_factory.mktemp('refresh').name}-{id(spark)}")
    events = fx.events(spark, SF)
    day = F.to_date(F.lit(CUT))
    for run, bound in (("first", F.col("event_date") < day), ("second", F.col("event_date") >= day)):
        for feed in FEEDS:
            refresh.refresh_silver(tables, feed, bronze_rows(events, feed).filter(bound), run)
        refresh.refresh_gold(tables, run, since=None if run == "first" else day)
    return tables


def test_incremental_refresh_ends_where_a_full_one_does(spark, lake):
    whole = Layers(spark, SF)
    grid = ["country_code", "hour_utc", "renewable_share_pct", "estimated_lifecycle_gco2_per_kwh", "temperature_c"]
    assert rows(lake.read("gold.fact_grid_hourly"), *grid) == rows(whole.fact_grid(), *grid)
    fuel = ["country_code", "hour_utc", "fuel_key", "value_mw"]
    assert rows(lake.read("gold.fact_generation_fuel_hourly"), *fuel) == rows(whole.fact_fuel(), *fuel)
    carbon = ["region_id", "period_start", "intensity_forecast", "source_event_id"]
    assert rows(lake.read("gold.fact_carbon_intensity_30min"), *carbon) == rows(whole.fact_carbon(), *carbon)


def test_incremental_features_append_past_the_newest_hour(spark, lake):
    got = lake.read("gold.feature_carbon_forecast")
    assert got.count() == got.select("country_code", "hour_utc").distinct().count()
    assert got.agg(F.max("hour_utc")).first() == Layers(spark, SF).features().agg(F.max("hour_utc")).first()


def test_incremental_features_keep_a_country_that_lags(spark, lake):
    store = Tables(spark, lake.root + "-hours")
    grid = lake.read("gold.fact_grid_hourly")
    german = F.col("country_code") == "DE"
    corrected = F.when(german & (F.col("date_utc") >= "2024-01-26"), F.col("temperature_c") + 1)
    whole = grid.withColumn("temperature_c", F.coalesce(corrected, F.col("temperature_c")))
    for part in (grid.filter(F.col("date_utc") < F.when(german, F.lit("2024-01-25")).otherwise(F.lit(CUT))), whole):
        store.overwrite("gold.fact_grid_hourly", part, "date_utc")
        refresh.refresh_features(store, "incremental", lags="hours")
    got = store.read("gold.feature_carbon_forecast")
    columns = ["country_code", "hour_utc", "temperature_c", "carbon_lag_168h", "carbon_rolling_24h_mean", "target_t24h"]
    assert rows(got, *columns) == rows(features.training_features(whole, "hours"), *columns)


def test_late_inputs_show_after_the_next_refresh(spark, lake):
    store = Tables(spark, lake.root + "-late")
    for name in ("silver.generation", "silver.carbon_intensity"):
        store.overwrite(name, lake.read(name), "date_utc")
    store.overwrite("silver.country_dim", lake.read("silver.country_dim"))
    weather = lake.read("silver.weather")
    for part in (weather.filter(F.lit(False)), weather):
        store.overwrite("silver.weather", part, "date_utc")
        refresh.refresh_grid_state(store)
    got = store.read("silver.grid_state")
    assert rows(got, "country_code", "hour_utc", "temperature_c") == rows(
        lake.read("silver.grid_state"), "country_code", "hour_utc", "temperature_c"
    )
    assert got.filter("temperature_c IS NOT NULL").count() > 0


def test_orphans_and_rejects_are_kept_per_run(lake):
    runs = lake.read("quarantine.orphan_fuel").groupBy("run_id").count()
    assert {r.run_id for r in runs.collect()} == {"first", "second"}
    reject = lake.read("quarantine.carbon_intensity")
    assert {"reject_reason", "reject_at_ts", "run_id", "envelope_json"} <= set(reject.columns)


def test_model_versions_and_scoring(spark, lake):
    rows_in = lake.read("gold.feature_carbon_forecast").drop("date_utc")
    parts = features.temporal_split(rows_in, "2024-01-26 00:00:00", validation_days=2)
    with pytest.raises(LookupError):
        models.resolve(lake)
    model = forecast.train(parts["train"], parts["validation"], max_iter=4, max_depth=3)
    metrics = forecast.regression_metrics(forecast.predict(model, parts["test"]))
    pooled = metrics.filter("country_code = 'ALL'").first()
    assert pooled.mae > 0 and pooled.row_count == parts["test"].count()
    assert [models.save(lake, model, metrics={"mae": pooled.mae}) for _ in range(2)] == [1, 2]
    assert models.resolve(lake) == 2
    loaded = models.load(lake)
    scored = forecast.predict(loaded, forecast.inference_window(rows_in, days=2))
    version = F.lit(models.resolve(lake))
    refresh.refresh_forecast(lake, forecast.forecast_rows(scored, model_version=version))
    refresh.refresh_forecast(lake, forecast.forecast_rows(scored, model_version=version))
    fact = lake.read("gold.fact_carbon_forecast")
    assert fact.count() == scored.count()
    assert fact.filter("target_hour_utc <> base_hour_utc + INTERVAL 24 HOURS").count() == 0
    importance = {r.feature: r.importance for r in forecast.feature_importance(loaded, rows_in).collect()}
    assert set(importance) == {features.CATEGORICAL, *features.NUMERIC}
    assert len(importance) == 18
    assert sum(importance.values()) == pytest.approx(1.0)


def test_questions(lake):
    refresh.refresh_forecast(lake, forecast_fixture(lake.read("gold.feature_carbon_forecast")), "overwrite")
    answers = {
        "eu_carbon_rankings": {},
        "uk_regional_carbon": {},
        "country_fuel_mix": {"country_code": "de"},
        "carbon_trend_24h": {"country_code": "FR"},
        "cleanest_window_uk": {"as_of": datetime(2024, 1, 20)},
        "carbon_forecast": {"country_code": "IT"},
    }
    assert answers.keys() == questions.QUESTIONS.keys()
    for name, arguments in answers.items():
        assert questions.ask(lake, name, **arguments).count() > 0, name
    assert questions.ask(lake, "cleanest_window_uk").count() == 0  # nothing lies ahead of today
    with pytest.raises(ValueError):
        questions.ask(lake, "carbon_forecast", country_code="GB")
    with pytest.raises(ValueError):
        questions.ask(lake, "drop_everything")


def test_backfill_counts_first_and_appends_when_told(tables):
    rows_in = bronze.backfill_rows(fx.carbon_enveloped(fx.events(tables.spark, SF)), CARBON.topic)
    counted = bronze.append_backfill(tables, CARBON.topic, rows_in, dry_run=True)
    assert not tables.exists(f"bronze.{CARBON.topic}")
    assert bronze.append_backfill(tables, CARBON.topic, rows_in) == counted
    table = tables.read(f"bronze.{CARBON.topic}")
    assert table.count() == counted["row_count"] == 10_000
    later = bronze.ingested_since(table, F.current_timestamp())
    assert later.count() == 0
    assert table.filter("event_date IS NULL").count() == 0
    recent = bronze.ingested_since(table, None, F.to_date(F.lit("2024-01-30")))
    assert 0 < recent.count() < table.count()


def test_weather_feed_has_one_name():
    assert (WEATHER.topic, WEATHER.backfill_source) == ("open-meteo", "open-meteo-backfill")
