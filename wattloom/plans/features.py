"""Feature table of the 24-hour-ahead forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import series
from wattloom.operators.keys import past_newest
from wattloom.operators.series import Shift, TrailingMean

HORIZON_HOURS = 24
TARGET = "target_t24h"
REQUIRED = ["carbon_lag_168h", "carbon_rolling_24h_mean"]
CATEGORICAL = "country_code"
NUMERIC = [
    "temperature_c",
    "wind_speed_kmh",
    "cloud_cover_pct",
    "solar_radiation_wm2",
    "total_generation_mw",
    "renewable_share_pct",
    "low_carbon_share_pct",
    "carbon_current",
    "hour_of_day",
    "day_of_week",
    "month",
    "is_weekend",
    "carbon_lag_1h",
    "carbon_lag_24h",
    "carbon_lag_168h",
    "carbon_rolling_24h_mean",
    "temp_rolling_24h_mean",
]
STATE = NUMERIC[:7]

REACH_BACK = 168  # steps the longest lag looks back

SERIES = {
    "carbon_lag_1h": Shift("carbon_current", -1),
    "carbon_lag_24h": Shift("carbon_current", -24),
    "carbon_lag_168h": Shift("carbon_current", -REACH_BACK),
    "carbon_rolling_24h_mean": TrailingMean("carbon_current", 24),
    "temp_rolling_24h_mean": TrailingMean("temperature_c", 24),
    TARGET: Shift("carbon_current", HORIZON_HOURS),
}


def all_features(grid: DataFrame, mode: str = "rows", block: int = series.BLOCK) -> DataFrame:
    """Every grid row with its features, boundary rows included.

    mode 'rows' counts observed rows for lags and means; 'hours' counts hours, so that values
    behind a gap do not shift.
    """
    if mode not in ("rows", "hours"):
        raise ValueError("mode must be 'rows' or 'hours'")
    ts = F.col("hour_utc")
    base = grid.select(
        "hour_utc",
        "country_code",
        *STATE,
        F.col("estimated_lifecycle_gco2_per_kwh").alias("carbon_current"),
        F.hour(ts).alias("hour_of_day"),
        F.dayofweek(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
        F.dayofweek(ts).isin(1, 7).alias("is_weekend"),
    )
    window = series.by_rows if mode == "rows" else series.by_hours
    return window(base, "country_code", "hour_utc", SERIES, block).select(
        "hour_utc", "country_code", *NUMERIC, TARGET
    )


def scoring_features(
    grid: DataFrame, mode: str = "rows", required: list[str] | None = None, block: int = series.BLOCK
) -> DataFrame:
    """Rows a forecast can be made from; the target may lie in the future."""
    return all_features(grid, mode, block).dropna(subset=required or REQUIRED)


def training_features(
    grid: DataFrame, mode: str = "rows", required: list[str] | None = None, block: int = series.BLOCK
) -> DataFrame:
    """Rows a model can be trained on: history and target are both there."""
    return scoring_features(grid, mode, (required or REQUIRED) + [TARGET], block)


def newer_than(features: DataFrame, existing: DataFrame, ts: str = "hour_utc") -> DataFrame:
    """Each country's rows past the newest hour `existing` has of it; all where it has none."""
    return past_newest(features, existing, ts, "country_code")


def temporal_split(features: DataFrame, split: str, validation_days: int = 0) -> dict[str, DataFrame]:
    """Chronological train / validation / test. The validation slice ends where the test begins,
    so early stopping never sees test rows."""
    ts, at = F.col("hour_utc"), F.lit(split).cast("timestamp")
    cut = F.timestamp_add("DAY", F.lit(-validation_days), at)
    return {
        "train": features.filter(ts < cut),
        "validation": features.filter((ts >= cut) & (ts < at)),
        "test": features.filter(ts >= at),
    }
