"""What a change reaches, and features brought up to date by it."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from verification.lake import Layers
from wattloom.operators import reach
from wattloom.plans import features, refresh
from wattloom.sources.tables import Tables

GRID, FEATURES = "gold.fact_grid_hourly", "gold.feature_carbon_forecast"
COLUMNS = ["country_code", "hour_utc", "carbon_current", "carbon_lag_168h", "carbon_rolling_24h_mean", "target_t24h"]


def test_hours_reach_whole_days():
    assert reach.by_hours(["2026-03-01"], 24, 168) == [f"2026-0{m}-{d:02}" for m, d in (
        (2, 28), (3, 1), (3, 2), (3, 3), (3, 4), (3, 5), (3, 6), (3, 7), (3, 8))]
    assert reach.by_hours(["__HIVE_DEFAULT_PARTITION__"], 24, 24) == ["__HIVE_DEFAULT_PARTITION__"]
    assert reach.by_hours([], 24, 24) == []


@settings(max_examples=15, deadline=None)
@given(
    st.dictionaries(st.integers(0, 14), st.integers(1, 4), min_size=1),
    st.sets(st.integers(0, 14), min_size=1, max_size=3), st.integers(0, 6), st.integers(0, 6),
)
def test_rows_reach_by_position(spark, sizes, changed, back, ahead):
    """Against positions counted one by one."""
    day = lambda n: date(2026, 1, 1) + timedelta(n)
    frame = spark.createDataFrame([("x", day(d), n) for d, n in sizes.items()], "e string, d date, rows bigint")
    found = reach.by_rows(frame, "e", "d", [day(d).isoformat() for d in changed], back, ahead)
    series = [d for d in sorted(sizes) for _ in range(sizes[d])]
    expected = {day(d).isoformat() for d in changed}
    for c in changed:
        first, end = sum(d < c for d in series), sum(d <= c for d in series)
        expected |= {day(d).isoformat() for i, d in enumerate(series) if first - back <= i < end + ahead}
    assert found == sorted(expected)


@pytest.fixture(scope="module")
def grid(spark):
    """A long series, so that most of it is out of reach."""
    some = Layers(spark, SF).fact_grid().filter("country_code IN ('DE', 'FR')")
    some = some.withColumn("shift", F.explode(F.sequence(F.lit(0), F.lit(2))))
    hour = F.timestamp_add("DAY", F.col("shift") * 40, F.col("hour_utc"))
    return some.withColumn("hour_utc", hour).withColumn("date_utc", F.to_date("hour_utc")).drop("shift")


@pytest.mark.parametrize("lags", ["hours", "rows"])
def test_corrections_and_filled_gaps(spark, tables, grid, lags):
    gap, wrong = "2024-01-20", "2024-03-03"
    day, carbon = F.col("date_utc"), "estimated_lifecycle_gco2_per_kwh"
    off = F.when(day == wrong, F.col(carbon) + 50).otherwise(F.col(carbon)).cast(grid.schema[carbon].dataType)
    tables.overwrite(GRID, grid.filter(day != gap).withColumn(carbon, off), "date_utc")
    refresh.refresh_features(tables, "incremental", lags)
    before = tables.snapshots(FEATURES).current()
    tables.replace_partitions(GRID, grid.filter(day.isin(gap, wrong)), "date_utc")
    change = refresh.refresh_features(tables, "incremental", lags)
    assert rows(tables.read(FEATURES), *COLUMNS) == rows(features.training_features(grid, lags), *COLUMNS)
    # Other days are neither written anew nor read.
    after = tables.snapshots(FEATURES).current()
    same = [d for d, writes in after.parts.items() if before.parts.get(d) == writes]
    assert len(same) > 20 and not set(same) & set(change.days)
    needed = reach.by_hours(change.days, 168, 24) if lags == "hours" else change.days
    listed = tables.read(GRID, needed).inputFiles()
    assert listed and not any("date_utc=2024-04" in f for f in listed)
    again = refresh.refresh_features(tables, "incremental", lags)
    assert again.days == [] and tables.snapshots(FEATURES).current() == after, "nothing new, nothing done"


def test_a_day_that_loses_its_rows(tables, grid):
    tables.overwrite(GRID, grid, "date_utc")
    refresh.refresh_features(tables, "incremental", "rows")
    gone = "2024-03-05"
    tables.replace_partitions(GRID, grid.limit(0), "date_utc", days=[gone])
    refresh.refresh_features(tables, "incremental", "rows")
    left = grid.filter(F.col("date_utc") != gone)
    assert rows(tables.read(FEATURES), *COLUMNS) == rows(features.training_features(left), *COLUMNS)


def test_late_and_old_rows_by_ledger(spark, tables, grid):
    """A weather row of any date shows after the next run, which takes only its day."""
    lake = Layers(spark, SF)
    for feed in (refresh.GENERATION, refresh.CARBON):
        tables.overwrite(f"silver.{feed.table}", refresh.with_day(lake.silver(feed), feed.ts), "date_utc")
    weather = refresh.with_day(lake.silver(refresh.WEATHER), refresh.WEATHER.ts)
    tables.overwrite("silver.weather", weather, "date_utc")
    tables.overwrite("silver.country_dim", lake.country_dim())
    assert refresh.refresh_grid_state(tables).days is None
    assert refresh.refresh_grid_state(tables).days == []
    old = "2024-01-09"
    changed = weather.filter(F.col("date_utc") == old).withColumn("temperature_c", F.col("temperature_c") + 1)
    tables.replace_partitions("silver.weather", changed, "date_utc")
    assert refresh.refresh_grid_state(tables).days == [old]
    whole = Tables(spark, tables.root + "-whole")
    for name in ("generation", "carbon_intensity", "weather"):
        whole.overwrite(f"silver.{name}", tables.read(f"silver.{name}"), "date_utc")
    whole.overwrite("silver.country_dim", lake.country_dim())
    refresh.refresh_grid_state(whole)
    state = ["country_code", "hour_utc", "temperature_c"]
    assert rows(tables.read("silver.grid_state"), *state) == rows(whole.read("silver.grid_state"), *state)
    more = lake.country_dim().withColumn("extra", F.lit(1))
    tables.overwrite("silver.country_dim", more)
    assert refresh.refresh_grid_state(tables).days is None, "a changed dimension concerns all days"
