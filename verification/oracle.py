"""The registered queries as SQL over the `events` view, written independently of the plans.

Each part below is one WITH member; a query names the members it reads and `_with` adds what
those need. Rounding keeps measures comparable whose last bits depend on summation order.
"""

from __future__ import annotations

import re

from wattloom.operators import dims


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"CAST({value} AS DOUBLE)" if isinstance(value, float) else str(value)


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


_LABELS = [(code, name) for _, tax, code, name, *_ in dims.FUELS if tax == "entsoe"] + dims.OTHER_CODE_LABELS

# Latest-wins order shared by the silver tables.
_LATEST = "ORDER BY ingested_at DESC NULLS LAST, kafka_timestamp DESC NULLS LAST, event_id DESC NULLS LAST"

_TOTAL = "CAST(round(sum(CAST(mean_mw AS DECIMAL(18, 6))), 2) AS DOUBLE)"
_SUM_MW = "CAST(round(sum(CAST(value_mw AS DECIMAL(18, 6))), 0) AS DOUBLE)"
_SUM_GRAMS = "CAST(sum(CAST(estimated_gco2_per_hour AS DECIMAL(28, 6))) AS DOUBLE)"


def _rounded(value: str, digits: int) -> str:
    """Half-up on the decimal digits a double prints as, which is how Spark rounds."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


PARTS = {
    "countries": _values(
        dims.COUNTRIES,
        "country_code, country_name, capital_city, eic_bidding_zone, iso_alpha3, "
        "timezone_offset_winter_hours, timezone_offset_summer_hours",
    ),
    "fuels": _values(
        dims.FUELS,
        "fuel_key, source_taxonomy, source_code, display_name, fuel_category, is_renewable, "
        "is_low_carbon, typical_gco2_per_kwh",
    ),
    "regions": _values(
        dims.UK_REGIONS,
        "region_id, region_code, region_name, region_type, country_code, approx_lat, approx_lon",
    ),
    "labels": _values(_LABELS, "psr_type, name"),
    "calendar": """
        SELECT CAST(strftime(h, '%Y%m%d%H') AS BIGINT) AS time_key, h AS hour_utc,
               date_trunc('day', h) AS date_utc, year(h) AS year, quarter(h) AS quarter, month(h) AS month,
               strftime(h, '%B') AS month_name, weekofyear(h) AS week_of_year, day(h) AS day_of_month,
               dayofyear(h) AS day_of_year, isodow(h) AS day_of_week_iso, strftime(h, '%A') AS day_name,
               hour(h) AS hour_of_day, isodow(h) IN (6, 7) AS is_weekend,
               isodow(h) NOT IN (6, 7) AND hour(h) BETWEEN 7 AND 17 AS is_business_hour_uk,
               hour(h) BETWEEN 6 AND 17 AS is_daytime_approx
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
              FROM (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events) b) s""",
    # --- readings ---
    "points": """
        SELECT event_id, user_id AS series_id, ts AS ingested_at, date_trunc('hour', ts) AS hour_utc,
               CASE user_id % 6 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE'
                                WHEN 3 THEN 'ES' WHEN 4 THEN 'IT' ELSE 'NL' END AS country_code,
               CASE event_type WHEN 'click' THEN 'B16' WHEN 'view' THEN 'B19' WHEN 'purchase' THEN 'B04'
                               WHEN 'signup' THEN 'B14' ELSE 'B25' END AS psr_type,
               CAST(round(value * 100) AS BIGINT) AS value_mw
        FROM events""",
    "carbon_raw": """
        SELECT e.event_id AS id, e.ts AS ingested_at, r.region_id, r.region_code, r.region_name,
               date_trunc('hour', e.ts)
                 + CASE WHEN minute(e.ts) >= 30 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS period_start,
               CAST(floor(e.value) AS INTEGER) AS intensity_forecast,
               CASE WHEN e.event_id % 3 = 0
                    THEN CAST(floor(e.value) AS INTEGER) + CAST(e.event_id % 5 AS INTEGER) - 2 END AS intensity_actual,
               CASE WHEN e.value < 5 THEN 'very low' WHEN e.value < 15 THEN 'low'
                    WHEN e.value < 30 THEN 'moderate' ELSE 'high' END AS intensity_index
        FROM events e JOIN regions r ON r.region_id = CAST(e.user_id % 18 AS INTEGER) + 1""",
    "weather_raw": """
        SELECT event_id AS id, ts AS ingested_at, date_trunc('hour', ts) AS time_utc,
               CASE user_id % 6 WHEN 0 THEN 'London' WHEN 1 THEN 'Paris' WHEN 2 THEN 'Berlin'
                                WHEN 3 THEN 'Madrid' WHEN 4 THEN 'Rome' ELSE 'Amsterdam' END AS city,
               value - 10 AS temperature_c, value * 2 AS wind_speed_kmh,
               CAST(event_id % 101 AS INTEGER) AS cloud_cover_pct, CAST(event_id % 800 AS DOUBLE) AS solar_radiation_wm2
        FROM events""",
    # --- parsed, with the injected defects ---
    "carbon_parsed": """
        SELECT id, ingested_at AS kafka_timestamp,
               CASE WHEN ok THEN 'evt-' || id END AS event_id,
               CASE WHEN ok THEN CASE WHEN id % 4 = 0 THEN 'uk-carbon-intensity-backfill'
                                      ELSE 'uk-carbon-intensity' END END AS source,
               CASE WHEN ok THEN 'v1' END AS source_version,
               CASE WHEN ok THEN ingested_at END AS ingested_at,
               CASE WHEN ok THEN region_id END AS region_id,
               CASE WHEN ok AND id % 89 <> 0 THEN region_code END AS region_code,
               CASE WHEN ok THEN region_name END AS region_name,
               CASE WHEN ok AND id % 83 <> 0 THEN period_start END AS period_start,
               CASE WHEN ok AND id % 79 <> 0 THEN period_start + INTERVAL 30 MINUTE END AS period_end,
               CASE WHEN ok AND id % 73 <> 0 THEN intensity_forecast END AS intensity_forecast,
               CASE WHEN ok THEN intensity_actual END AS intensity_actual,
               CASE WHEN ok THEN intensity_index END AS intensity_index,
               CASE WHEN ok THEN 'gas,wind' END AS mix_fuels,
               CASE WHEN ok THEN 'gas=' || (id % 101) || ',wind=' || (100 - id % 101) END AS mix_items
        FROM (SELECT *, id % 97 <> 0 AS ok FROM carbon_raw) t""",
    "carbon_reasons": """
        SELECT *, list_filter([
                 CASE WHEN region_code IS NULL THEN 'missing region_code' END,
                 CASE WHEN period_start IS NULL THEN 'invalid period_start timestamp' END,
                 CASE WHEN period_end IS NULL THEN 'invalid period_end timestamp' END,
                 CASE WHEN intensity_forecast IS NULL THEN 'missing intensity_forecast' END],
                 lambda x: x IS NOT NULL) AS reasons
        FROM carbon_parsed""",
    "weather_parsed": """
        SELECT id, ingested_at AS kafka_timestamp,
               CASE WHEN ok THEN 'evt-' || id END AS event_id,
               CASE WHEN ok THEN CASE WHEN id % 4 = 0 THEN 'open-meteo-backfill' ELSE 'open-meteo' END END AS source,
               CASE WHEN ok THEN 'v1' END AS source_version,
               CASE WHEN ok THEN ingested_at END AS ingested_at,
               CASE WHEN ok AND id % 89 <> 0 THEN city END AS city,
               CASE WHEN ok THEN CAST(50.5 AS DOUBLE) END AS latitude,
               CASE WHEN ok THEN CAST(10.25 AS DOUBLE) END AS longitude,
               CASE WHEN ok THEN CAST(35 AS DOUBLE) END AS elevation,
               CASE WHEN ok AND id % 83 <> 0 THEN time_utc END AS time_utc,
               CASE WHEN NOT ok OR id % 79 = 0 THEN NULL WHEN id % 73 = 0 THEN CAST(-61 AS DOUBLE)
                    ELSE temperature_c END AS temperature_c,
               CASE WHEN ok THEN wind_speed_kmh END AS wind_speed_kmh,
               CASE WHEN ok THEN cloud_cover_pct END AS cloud_cover_pct,
               CASE WHEN ok THEN solar_radiation_wm2 END AS solar_radiation_wm2
        FROM (SELECT *, id % 97 <> 0 AS ok FROM weather_raw) t""",
    "weather_reasons": """
        SELECT *, list_filter([
                 CASE WHEN city IS NULL THEN 'missing city' END,
                 CASE WHEN time_utc IS NULL THEN 'invalid time_utc' END,
                 CASE WHEN temperature_c IS NULL THEN 'missing temperature_2m' END,
                 CASE WHEN temperature_c < -60 THEN 'temperature below physical minimum' END,
                 CASE WHEN temperature_c > 60 THEN 'temperature above physical maximum' END],
                 lambda x: x IS NOT NULL) AS reasons
        FROM weather_parsed""",
    "point_parsed": """
        SELECT t.event_id AS id, ingested_at AS kafka_timestamp,
               CASE WHEN ok THEN 'evt-' || t.event_id END AS event_id,
               CASE WHEN ok THEN CASE WHEN t.event_id % 4 = 0 THEN 'entsoe-backfill' ELSE 'entsoe' END END AS source,
               CASE WHEN ok THEN 'v1' END AS source_version,
               CASE WHEN ok THEN ingested_at END AS ingested_at,
               CASE WHEN ok AND t.event_id % 89 <> 0 THEN t.country_code END AS country_code,
               CASE WHEN ok THEN c.country_name END AS country_name,
               CASE WHEN ok THEN c.eic_bidding_zone END AS eic_code,
               CASE WHEN ok AND t.event_id % 83 <> 0 THEN hour_utc END AS period_start,
               CASE WHEN ok AND t.event_id % 59 <> 0 THEN hour_utc + INTERVAL 1 HOUR END AS period_end,
               CASE WHEN ok THEN 'PT60M' END AS resolution,
               CASE WHEN NOT ok OR t.event_id % 71 = 0 THEN NULL
                    WHEN t.event_id % 67 = 0 THEN CAST(-1 AS DOUBLE)
                    WHEN t.event_id % 61 = 0 THEN CAST(250000 AS DOUBLE)
                    ELSE CAST(value_mw AS DOUBLE) END AS total_generation_mw,
               CASE WHEN NOT ok OR t.event_id % 79 = 0 THEN NULL WHEN t.event_id % 73 = 0 THEN 0 ELSE 1 END AS mix_size,
               CASE WHEN NOT ok OR t.event_id % 79 = 0 THEN NULL WHEN t.event_id % 73 = 0 THEN ''
                    ELSE psr_type || ':' || l.name || '=' || value_mw END AS mix_items
        FROM (SELECT *, event_id % 97 <> 0 AS ok FROM points) t
        JOIN countries c USING (country_code) JOIN labels l USING (psr_type)""",
    "point_reasons": """
        SELECT *, list_filter([
                 CASE WHEN country_code IS NULL THEN 'missing country_code' END,
                 CASE WHEN period_start IS NULL THEN 'invalid period_start' END,
                 CASE WHEN period_end IS NULL THEN 'invalid period_end' END,
                 CASE WHEN total_generation_mw IS NULL THEN 'missing total_generation_mw' END,
                 CASE WHEN total_generation_mw < 0 THEN 'negative total generation' END,
                 CASE WHEN total_generation_mw > 200000 THEN 'unrealistic generation magnitude' END,
                 CASE WHEN coalesce(mix_size, 0) = 0 THEN 'empty generation_mix array' END],
                 lambda x: x IS NOT NULL) AS reasons
        FROM point_parsed""",
    # --- silver ---
    "carbon": f"""
        SELECT * EXCLUDE (rn, reasons)
        FROM (SELECT *, row_number() OVER (PARTITION BY region_code, period_start {_LATEST}) AS rn
              FROM carbon_reasons WHERE len(reasons) = 0) t WHERE rn = 1""",
    "weather": f"""
        SELECT * EXCLUDE (rn, reasons)
        FROM (SELECT *, row_number() OVER (PARTITION BY city, time_utc {_LATEST}) AS rn
              FROM weather_reasons WHERE len(reasons) = 0) t WHERE rn = 1""",
    "hourly_means": """
        SELECT country_code, hour_utc, psr_type, avg(value_mw) AS mean_mw, max(ingested_at) AS ingested_at,
               max(event_id) AS event_id
        FROM points GROUP BY ALL""",
    "generation": f"""
        SELECT country_code, hour_utc, {_TOTAL} AS total_generation_mw,
               CAST(count(*) AS INTEGER) AS fuels, max(ingested_at) AS ingested_at, max(event_id) AS event_id
        FROM hourly_means GROUP BY ALL HAVING {_TOTAL} BETWEEN 0 AND 200000""",
    "mix": """
        SELECT h.country_code, h.hour_utc, h.psr_type, l.name, round(h.mean_mw, 2) AS value_mw, g.ingested_at
        FROM hourly_means h JOIN generation g USING (country_code, hour_utc) JOIN labels l USING (psr_type)""",
    "carbon_by_hour": """
        SELECT date_trunc('hour', period_start) AS hour_utc, avg(intensity_forecast) AS uk_carbon_intensity_forecast,
               arg_min(intensity_index, period_start) AS uk_carbon_intensity_index
        FROM carbon WHERE region_code = 'GB' GROUP BY ALL""",
    "state": """
        SELECT g.hour_utc, g.country_code, c.country_name, w.temperature_c, w.wind_speed_kmh, w.cloud_cover_pct,
               w.solar_radiation_wm2, g.total_generation_mw, g.fuels, u.uk_carbon_intensity_forecast,
               u.uk_carbon_intensity_index, g.ingested_at
        FROM generation g JOIN countries c USING (country_code)
        LEFT JOIN weather w ON w.city = c.capital_city AND w.time_utc = g.hour_utc
        LEFT JOIN carbon_by_hour u ON g.country_code = 'GB' AND u.hour_utc = g.hour_utc""",
    # --- gold ---
    "fuel_fact": """
        SELECT CAST(strftime(m.hour_utc, '%Y%m%d%H') AS BIGINT) AS time_key, m.country_code AS country_key,
               f.fuel_key, m.hour_utc, m.country_code, m.psr_type AS source_psr_type,
               f.display_name AS fuel_display_name, f.fuel_category, f.is_renewable, f.is_low_carbon, m.value_mw,
               f.typical_gco2_per_kwh, m.value_mw * 1000 * f.typical_gco2_per_kwh AS estimated_gco2_per_hour,
               m.ingested_at
        FROM mix m JOIN fuels f ON f.source_taxonomy = 'entsoe' AND f.source_code = m.psr_type""",
    "grid_sums": """
        SELECT country_code, hour_utc, sum(CASE WHEN is_renewable THEN value_mw ELSE 0 END) AS renewable,
               sum(CASE WHEN is_low_carbon THEN value_mw ELSE 0 END) AS low_carbon,
               sum(estimated_gco2_per_hour) AS grams
        FROM fuel_fact GROUP BY ALL""",
    "grid_fact": """
        SELECT CAST(strftime(s.hour_utc, '%Y%m%d%H') AS BIGINT) AS time_key, s.country_code AS country_key,
               s.hour_utc, s.country_code, s.temperature_c, s.wind_speed_kmh, s.cloud_cover_pct, s.solar_radiation_wm2,
               s.total_generation_mw, a.renewable AS renewable_generation_mw, a.low_carbon AS low_carbon_generation_mw,
               CASE WHEN s.total_generation_mw > 0
                    THEN round(100.0::DOUBLE * a.renewable / s.total_generation_mw, 2) END AS renewable_share_pct,
               CASE WHEN s.total_generation_mw > 0
                    THEN round(100.0::DOUBLE * a.low_carbon / s.total_generation_mw, 2) END AS low_carbon_share_pct,
               CASE WHEN s.total_generation_mw > 0
                    THEN round(a.grams / (s.total_generation_mw * 1000), 2) END AS estimated_lifecycle_gco2_per_kwh,
               a.grams AS estimated_lifecycle_gco2_per_hour, s.uk_carbon_intensity_forecast, s.ingested_at
        FROM state s LEFT JOIN grid_sums a USING (country_code, hour_utc)""",
    "carbon_fact": """
        SELECT CAST(strftime(c.period_start, '%Y%m%d%H') AS BIGINT) AS time_key, c.region_id,
               r.country_code AS country_key, c.period_start, c.period_end,
               CAST(minute(c.period_start) AS INTEGER) AS half_hour, r.region_code, r.region_name, r.region_type,
               c.intensity_forecast, c.intensity_actual, c.intensity_index,
               CASE WHEN c.intensity_actual IS NOT NULL THEN 'actual' ELSE 'forecast' END AS source_type,
               c.intensity_actual IS NOT NULL AS has_actual,
               c.intensity_forecast - c.intensity_actual AS forecast_minus_actual,
               c.source, c.ingested_at, c.event_id AS source_event_id, c.mix_items
        FROM carbon c JOIN regions r ON r.region_id = c.region_id""",
    "feature_base": """
        SELECT hour_utc, country_code, temperature_c, wind_speed_kmh, cloud_cover_pct, solar_radiation_wm2,
               total_generation_mw, renewable_share_pct, low_carbon_share_pct,
               estimated_lifecycle_gco2_per_kwh AS carbon_current, hour(hour_utc) AS hour_of_day,
               dayofweek(hour_utc) + 1 AS day_of_week, month(hour_utc) AS month,
               dayofweek(hour_utc) IN (0, 6) AS is_weekend
        FROM grid_fact""",
    "row_features": """
        SELECT *, lag(carbon_current, 1) OVER w AS carbon_lag_1h, lag(carbon_current, 24) OVER w AS carbon_lag_24h,
               lag(carbon_current, 168) OVER w AS carbon_lag_168h,
               avg(carbon_current) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS carbon_rolling_24h_mean,
               avg(temperature_c) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS temp_rolling_24h_mean,
               lead(carbon_current, 24) OVER w AS target_t24h
        FROM feature_base WINDOW w AS (PARTITION BY country_code ORDER BY hour_utc)""",
    "scoring": """
        SELECT * FROM row_features WHERE carbon_lag_168h IS NOT NULL AND carbon_rolling_24h_mean IS NOT NULL""",
    "feature_rows": "SELECT * FROM scoring WHERE target_t24h IS NOT NULL",
    "hour_features": """
        SELECT b.*, l1.carbon_current AS carbon_lag_1h, l24.carbon_current AS carbon_lag_24h,
               l168.carbon_current AS carbon_lag_168h,
               (SELECT avg(p.carbon_current) FROM feature_base p WHERE p.country_code = b.country_code
                  AND p.hour_utc BETWEEN b.hour_utc - INTERVAL 24 HOUR AND b.hour_utc - INTERVAL 1 HOUR)
                 AS carbon_rolling_24h_mean,
               (SELECT avg(p.temperature_c) FROM feature_base p WHERE p.country_code = b.country_code
                  AND p.hour_utc BETWEEN b.hour_utc - INTERVAL 24 HOUR AND b.hour_utc - INTERVAL 1 HOUR)
                 AS temp_rolling_24h_mean,
               t.carbon_current AS target_t24h
        FROM feature_base b
        LEFT JOIN feature_base l1 ON l1.country_code = b.country_code AND l1.hour_utc = b.hour_utc - INTERVAL 1 HOUR
        LEFT JOIN feature_base l24 ON l24.country_code = b.country_code AND l24.hour_utc = b.hour_utc - INTERVAL 24 HOUR
        LEFT JOIN feature_base l168 ON l168.country_code = b.country_code AND l168.hour_utc = b.hour_utc - INTERVAL 168 HOUR
        LEFT JOIN feature_base t ON t.country_code = b.country_code AND t.hour_utc = b.hour_utc + INTERVAL 24 HOUR""",
    "forecast": """
        SELECT country_code, hour_utc AS base_hour_utc, hour_utc + INTERVAL 24 HOUR AS target_hour_utc,
               24 AS horizon_h, carbon_lag_168h AS predicted_carbon_gco2_kwh, carbon_current AS carbon_current_at_base,
               '3' AS model_version, 'persistence' AS model_name, TIMESTAMP '2024-02-01 00:00:00' AS generated_at
        FROM feature_rows WHERE hour_utc >= (SELECT max(hour_utc) - INTERVAL 7 DAY FROM feature_rows)""",
    # --- responses ---
    "xml_points": """
        SELECT event_id, country_code, 0 AS series_no, psr_type, hour_utc - INTERVAL 15 MINUTE AS period_start,
               900 AS step_seconds, position, CAST(value_mw + position - 1 AS DOUBLE) AS quantity
        FROM (SELECT *, unnest([1, 2, 3, 4]) AS position FROM points) t
        WHERE event_id % 13 <> 0 AND event_id % 17 <> 0 AND NOT (position = 3 AND event_id % 19 = 0)
        UNION ALL
        SELECT event_id, country_code, 1, 'B20', hour_utc, 3600, 1, CAST(value_mw AS DOUBLE) FROM points""",
    "xml_hours": """
        SELECT *, period_start + to_seconds((position - 1) * step_seconds) AS point_utc,
               date_trunc('hour', period_start + to_seconds((position - 1) * step_seconds)) AS hour_utc
        FROM xml_points""",
    "table_counts": """
        SELECT 'bronze' AS layer, 'carbon_intensity' AS table_name, count(*) AS row_count FROM carbon_raw
        UNION ALL SELECT 'bronze', 'open_meteo', count(*) FROM weather_raw
        UNION ALL SELECT 'bronze', 'entsoe', count(*) FROM (SELECT DISTINCT country_code, hour_utc FROM points) b
        UNION ALL SELECT 'silver', 'carbon_intensity', count(*) FROM carbon
        UNION ALL SELECT 'silver', 'country_dim', count(*) FROM countries
        UNION ALL SELECT 'silver', 'generation', count(*) FROM generation
        UNION ALL SELECT 'silver', 'grid_state', count(*) FROM state
        UNION ALL SELECT 'silver', 'weather', count(*) FROM weather
        UNION ALL SELECT 'gold', 'dim_country', count(*) FROM countries
        UNION ALL SELECT 'gold', 'dim_fuel_type', count(*) FROM fuels
        UNION ALL SELECT 'gold', 'dim_time', count(*) FROM calendar
        UNION ALL SELECT 'gold', 'dim_uk_region', count(*) FROM regions
        UNION ALL SELECT 'gold', 'fact_carbon_intensity_30min', count(*) FROM carbon_fact
        UNION ALL SELECT 'gold', 'fact_generation_fuel_hourly', count(*) FROM fuel_fact""",
    "table_latest": """
        SELECT 'silver' AS layer, 'carbon_intensity' AS table_name, count(*) AS row_count, max(period_start) AS latest_ts FROM carbon
        UNION ALL SELECT 'silver', 'generation', count(*), max(hour_utc) FROM generation
        UNION ALL SELECT 'silver', 'weather', count(*), max(time_utc) FROM weather
        UNION ALL SELECT 'silver', 'grid_state', count(*), max(hour_utc) FROM state
        UNION ALL SELECT 'gold', 'fact_carbon_intensity_30min', count(*), max(period_start) FROM carbon_fact
        UNION ALL SELECT 'gold', 'fact_generation_fuel_hourly', count(*), max(hour_utc) FROM fuel_fact""",
}


def _needs(sql: str) -> list[str]:
    """Parts a statement reads, each after the parts it reads itself."""
    names: list[str] = []
    for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql):
        if name in PARTS:
            names += [n for n in _needs(PARTS[name]) + [name] if n not in names]
    return list(dict.fromkeys(names))


def _with(sql: str) -> str:
    members = ",\n".join(f"{name} AS ({PARTS[name]})" for name in _needs(sql))
    return f"WITH {members}\n{sql}" if members else sql


_SILVER_CARBON = """
    SELECT event_id, source, ingested_at, region_id, region_code, region_name, period_start, period_end,
           intensity_forecast, intensity_actual, intensity_index, mix_items FROM carbon"""
_PARSED_ENV = "event_id, source, source_version, ingested_at, kafka_timestamp"
_TONS = "CAST(estimated_lifecycle_gco2_per_hour AS DOUBLE) / 1e6"
_NEWEST_GRID = "hour_utc = (SELECT max(hour_utc) FROM grid_fact)"
_NEWEST_FUEL = "hour_utc = (SELECT max(hour_utc) FROM fuel_fact)"
_NEWEST_CARBON = "period_start = (SELECT max(period_start) FROM carbon_fact)"
_LAST_DAY_CARBON = "period_start >= (SELECT max(period_start) - INTERVAL 24 HOUR FROM carbon_fact)"
_FEATURES = """
    SELECT hour_utc, country_code, temperature_c, wind_speed_kmh, cloud_cover_pct, solar_radiation_wm2,
           total_generation_mw, renewable_share_pct, low_carbon_share_pct, carbon_current, hour_of_day, day_of_week,
           month, is_weekend, carbon_lag_1h, carbon_lag_24h, carbon_lag_168h,
           round(carbon_rolling_24h_mean, 6) AS carbon_rolling_24h_mean,
           round(temp_rolling_24h_mean, 6) AS temp_rolling_24h_mean, target_t24h"""
_LATEST_FORECAST = f"""
    SELECT country_code, base_hour_utc AS prediction_made_from, target_hour_utc AS forecast_for,
           {_rounded('carbon_current_at_base', 1)} AS current_gco2_per_kwh,
           {_rounded('predicted_carbon_gco2_kwh', 1)} AS forecast_gco2_per_kwh_t24h,
           {_rounded('predicted_carbon_gco2_kwh - carbon_current_at_base', 1)} AS expected_change_gco2,
           model_name, model_version
    FROM forecast
    QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY base_hour_utc DESC) = 1"""


def _validated(part: str) -> str:
    return f"""
        SELECT kafka_timestamp, event_id, CASE WHEN len(reasons) > 0 THEN reasons[1] END AS reject_reason,
               array_to_string(reasons, '; ') AS reject_reasons FROM {part}"""


def _counts(part: str) -> str:
    return f"""
        SELECT count(*) AS bronze_rows, count(*) AS parsed_rows, count(*) FILTER (len(reasons) = 0) AS valid_rows,
               count(*) FILTER (len(reasons) > 0) AS invalid_rows FROM {part}"""


def _split(source: str, parsed: str, key: str) -> str:
    return f"""
        SELECT {source} AS source, count(*) AS row_count,
               min(date_trunc('day', kafka_timestamp)) AS earliest_date,
               max(date_trunc('day', kafka_timestamp)) AS latest_date, count(DISTINCT {key}) AS distinct_keys
        FROM {parsed} GROUP BY ALL"""


def _bronze_profile(parsed: str, key: str, partition: str, ts: str) -> str:
    return f"""
        SELECT count(*) AS row_count, min({ts}) AS earliest, max({ts}) AS latest,
               count(DISTINCT {key}) AS distinct_keys, count(DISTINCT {partition}) AS partitions FROM {parsed}"""


def _span(ts: str) -> str:
    return f"date_diff('day', min({ts}), max({ts})) AS span_days"


def _metrics(prediction: str) -> str:
    def stats(by: str, group: str) -> str:
        return f"""
            SELECT {by} AS country_code, count(*) AS row_count, round(avg(abs(y - p)), 4) AS mae,
                   round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
                   round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2,
                   round(avg(abs(y - p) / greatest(y, 1.0)) * 100, 4) AS mape, round(avg(y), 4) AS avg_target,
                   round(avg(abs(y - p)) / avg(y) * 100, 4) AS relative_error_pct
            FROM (SELECT country_code, target_t24h AS y, {prediction} AS p FROM feature_rows
                  WHERE {prediction} IS NOT NULL) m {group}"""

    pooled = stats("'ALL'", "HAVING count(*) > 0")
    return f"{stats('country_code', 'GROUP BY country_code')} UNION ALL {pooled}"


def _distribution(part: str, value: str, low: str, median: str, high: str, spread: str) -> str:
    return f"""
        SELECT country_code, round(min({value})) AS {low}, round(quantile_disc({value}, 0.5)) AS {median},
               round(max({value})) AS {high}, round(stddev({value})) AS {spread} FROM {part} GROUP BY ALL"""


_CARBON_JSON = """
    '{"dnoregion":"' || region_name || '"'
    || CASE WHEN id % 83 = 0 THEN ',"from":"not-a-time"' ELSE ',"from":"' || %(start)s || '"' END
    || ',"generationmix":[{"fuel":"gas","perc":' || (id % 101) || '.0},{"fuel":"wind","perc":' || (100 - id % 101) || '.0}]'
    || ',"intensity":{' || CASE WHEN intensity_actual IS NULL THEN '' ELSE '"actual":' || intensity_actual || ',' END
    || CASE WHEN id % 73 = 0 THEN '' ELSE '"forecast":' || intensity_forecast || ',' END
    || '"index":"' || intensity_index || '"},"regionid":' || region_id
    || CASE WHEN id % 89 = 0 THEN '' ELSE ',"shortname":"' || region_code || '"' END
    || ',"to":"' || CASE WHEN id % 79 = 0 THEN 'soon' ELSE %(end)s END || '"}'"""


# The envelope as it stands in the topic, its payload in the sender's order; the checksum is of the payload in order
# of names. Doubles print alike in both engines from 0.001 to 10,000,000.
_WEATHER_FIELDS = {
    "city": """CASE WHEN id % 89 = 0 THEN '' ELSE '"city":"' || city || '",' END""",
    "latitude": """'"latitude":50.5,'""",
    "longitude": """'"longitude":10.25,'""",
    "elevation": """'"elevation":35.0,'""",
    "time": """'"time":"' || event_time || '",'""",
    "temperature_2m": """CASE WHEN id % 79 = 0 THEN '' WHEN id % 73 = 0 THEN '"temperature_2m":-61.0,'
        ELSE '"temperature_2m":' || temperature_c || ',' END""",
    "wind_speed_10m": """'"wind_speed_10m":' || wind_speed_kmh || ','""",
    "cloud_cover": """'"cloud_cover":' || cloud_cover_pct || CASE WHEN id % 2 = 0 THEN '.0,' ELSE '.5,' END""",
    "shortwave_radiation": """'"shortwave_radiation":' || solar_radiation_wm2 || ','""",
    "units": """'"units":{"temperature_2m":"°C","wind_speed_10m":"km/h"},'""",
}


def _object(fields: list[str]) -> str:
    return "'{' || rtrim(" + " || ".join(fields) + ", ',') || '}'"


_WEATHER_BRONZE = f"""
    SELECT CASE WHEN id % 97 = 0 THEN left(envelope, 20) ELSE envelope END AS envelope_json, city AS kafka_key,
           'open-meteo' AS topic, CAST(id % 4 AS INTEGER) AS partition, id AS offset,
           ingested_at AS kafka_timestamp, date_trunc('day', ingested_at) AS event_date
    FROM (SELECT *, '{{"event_id":"evt-' || id || '","source":"open-meteo' || CASE WHEN id % 4 = 0 THEN '-backfill' ELSE '' END
                 || '","source_version":"v1","ingested_at":"' || strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f+00:00')
                 || '","event_time":"' || event_time || '","region":"' || city || '","payload":'
                 || {_object(list(_WEATHER_FIELDS.values()))} || ',"checksum":"sha256:'
                 || sha256({_object([_WEATHER_FIELDS[n] for n in sorted(_WEATHER_FIELDS)])}) || '"}}' AS envelope
          FROM (SELECT *, CASE WHEN id % 83 = 0 THEN 'yesterday' ELSE strftime(time_utc, '%Y-%m-%dT%H:%M') END AS event_time
                FROM weather_raw) w) e"""


def _settlement(ts: str) -> str:
    return (
        f"CASE WHEN id % 2 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%MZ') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') END"
    )


def _carbon_json() -> str:
    return _CARBON_JSON.replace("%(start)s", _settlement("period_start")).replace(
        "%(end)s", _settlement("period_start + INTERVAL 30 MINUTE")
    )


def _coverage(part: str, ts: str, by: str, stats: str) -> str:
    return f"SELECT {by}{', ' if by else ''}year({ts}) AS year, count(*) AS row_count, {stats} FROM {part} GROUP BY ALL"


ORACLES = {
    "bronze_enrich": _WEATHER_BRONZE,
    "bronze_measurement_date": """
        SELECT date_trunc('day', ingested_at) AS event_date, count(*) AS row_count FROM carbon_raw GROUP BY ALL""",
    "backfill_rows": """
        SELECT CASE WHEN id % 83 <> 0 THEN date_trunc('day', period_start)
                    ELSE TIMESTAMP '2024-02-01 00:00:00' END AS event_date,
               'carbon-intensity' AS topic, 0 AS partition, CAST(0 AS BIGINT) AS offset,
               TIMESTAMP '2024-02-01 00:00:00' AS kafka_timestamp, count(*) AS row_count,
               count(DISTINCT region_code) AS regions FROM carbon_raw GROUP BY ALL""",
    "backfill_dry_run": """
        SELECT count(*) AS row_count,
               count(DISTINCT CASE WHEN id % 83 <> 0 THEN date_trunc('day', time_utc)
                                   ELSE TIMESTAMP '2024-02-01 00:00:00' END) AS event_dates,
               count(DISTINCT city) AS kafka_keys FROM weather_raw""",
    "envelope_build": f"""
        SELECT 'evt-' || id AS event_id,
               CASE WHEN id % 4 = 0 THEN 'uk-carbon-intensity-backfill' ELSE 'uk-carbon-intensity' END AS source,
               'v1' AS source_version, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingested_at,
               CASE WHEN id % 83 = 0 THEN 'not-a-time' ELSE {_settlement("period_start")} END AS event_time,
               region_code AS region, 'sha256:' || sha256({_carbon_json()}) AS checksum FROM carbon_raw""",
    "checksum_verify": "SELECT id % 97 <> 0 AS checksum_ok, count(*) AS row_count FROM carbon_raw GROUP BY ALL",
    "source_split_carbon": """
        SELECT source, count(*) AS row_count, min(date_trunc('day', kafka_timestamp)) AS earliest_date,
               max(date_trunc('day', kafka_timestamp)) AS latest_date, count(DISTINCT r.region_code) AS distinct_keys
        FROM carbon_parsed p JOIN carbon_raw r ON r.id = p.id GROUP BY ALL""",
    "source_split_weather": """
        SELECT source, count(*) AS row_count, min(date_trunc('day', kafka_timestamp)) AS earliest_date,
               max(date_trunc('day', kafka_timestamp)) AS latest_date, count(DISTINCT r.city) AS distinct_keys
        FROM weather_parsed p JOIN weather_raw r ON r.id = p.id GROUP BY ALL""",
    "source_split_generation": """
        SELECT CASE WHEN event_id % 4 = 0 THEN 'entsoe-backfill' ELSE 'entsoe' END AS source, count(*) AS row_count,
               min(date_trunc('day', hour_utc)) AS earliest_date, max(date_trunc('day', hour_utc)) AS latest_date,
               count(DISTINCT country_code) AS distinct_keys
        FROM (SELECT country_code, hour_utc, max(event_id) AS event_id FROM points GROUP BY ALL) g GROUP BY ALL""",
    "flatten_regions": """
        SELECT id AS event_id, CASE WHEN a = 0 THEN region_code WHEN id % 7 = 0 THEN 'region-' || (region_id + 100)
                                    ELSE 'Elsewhere' END AS region,
               strftime(period_start + to_minutes(30 * p), '%Y-%m-%dT%H:%MZ') AS period_from,
               strftime(period_start + to_minutes(30 * p + 30), '%Y-%m-%dT%H:%MZ') AS period_to,
               region_id + 100 * a AS region_id,
               CASE WHEN a = 0 THEN region_code WHEN id % 7 <> 0 THEN 'Elsewhere' END AS shortname,
               intensity_forecast + a AS forecast, intensity_index AS index_label, 1 AS fuels
        FROM (SELECT *, unnest([0, 1]) AS a FROM (SELECT *, unnest([0, 1]) AS p FROM carbon_raw) x) y
        WHERE p = 0 OR id % 11 <> 0""",
    "flatten_hourly_arrays": """
        SELECT id AS event_id, city, CAST(50.5 AS DOUBLE) AS latitude,
               strftime(time_utc + to_hours(i), '%Y-%m-%dT%H:%M') AS time, temperature_c + i AS temperature_2m,
               wind_speed_kmh AS wind_speed_10m,
               CASE WHEN i < 2 OR id % 3 <> 0 THEN cloud_cover_pct + i END AS cloud_cover,
               solar_radiation_wm2 AS shortwave_radiation, '°C' AS temperature_unit
        FROM (SELECT *, unnest([0, 1, 2]) AS i FROM weather_raw) t WHERE NOT (i = 1 AND id % 5 = 0)""",
    "current_hour": """
        SELECT id AS event_id, city, strftime(time_utc + to_hours(i), '%Y-%m-%dT%H:%M') AS time,
               CASE WHEN NOT (i = 1 AND id % 5 = 0) THEN temperature_c + i END AS temperature_2m,
               CASE WHEN i < 2 OR id % 3 <> 0 THEN cloud_cover_pct + i END AS cloud_cover
        FROM (SELECT *, least(2, greatest(0, date_diff('hour', time_utc, TIMESTAMP '2024-01-15 12:00:00'))) AS i
              FROM weather_raw) t""",
    "flatten_generation_xml": """
        SELECT event_id, country_code, series_no, psr_type, period_start, step_seconds, position, quantity FROM xml_points""",
    "points_to_hours": "SELECT event_id, series_no, position, point_utc, hour_utc FROM xml_hours",
    "xml_hourly_mean": """
        SELECT country_code, hour_utc, psr_type, round(avg(quantity), 6) AS mean_mw FROM xml_hours GROUP BY ALL""",
    "hourly_mean_by_fuel": "SELECT country_code, hour_utc, psr_type, round(mean_mw, 6) AS mean_mw FROM hourly_means",
    "hourly_sum_of_series_means": """
        SELECT country_code, hour_utc, psr_type, round(sum(m), 6) AS mean_mw
        FROM (SELECT country_code, hour_utc, psr_type, series_id, avg(value_mw) AS m FROM points GROUP BY ALL) s
        GROUP BY ALL""",
    "nest_mix": f"""
        SELECT country_code, hour_utc, string_agg(psr_type, ',' ORDER BY psr_type) AS codes,
               string_agg(name, ',' ORDER BY psr_type) AS names,
               string_agg(CAST(CAST(round(round(mean_mw, 2) * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY psr_type) AS centi_mw,
               {_TOTAL} AS total_generation_mw
        FROM hourly_means JOIN labels USING (psr_type) GROUP BY ALL""",
    "fuel_labels": """
        SELECT c.psr_type, row_count, coalesce(l.name, 'Unknown') AS name
        FROM (SELECT psr_type, count(*) AS row_count FROM points GROUP BY ALL
              UNION ALL SELECT 'X' || psr_type[2:], count(*) FROM points GROUP BY ALL) c
        LEFT JOIN labels l ON l.psr_type = c.psr_type""",
    "parse_carbon": f"""
        SELECT {_PARSED_ENV}, region_id, region_code, region_name, period_start, period_end, intensity_forecast,
               intensity_actual, intensity_index, mix_fuels, mix_items FROM carbon_parsed""",
    "parse_weather": f"""
        SELECT {_PARSED_ENV}, city, latitude, longitude, elevation, time_utc, temperature_c, wind_speed_kmh,
               cloud_cover_pct, solar_radiation_wm2 FROM weather_parsed""",
    "parse_generation": f"""
        SELECT {_PARSED_ENV}, country_code, country_name, eic_code, period_start, period_end, resolution,
               total_generation_mw, mix_size, mix_items FROM point_parsed""",
    "validate_carbon": _validated("carbon_reasons"),
    "validate_weather": _validated("weather_reasons"),
    "validate_generation": _validated("point_reasons"),
    "quality_counts": _counts("carbon_reasons"),
    "quality_counts_weather": _counts("weather_reasons"),
    "quality_counts_generation": _counts("point_reasons"),
    "quarantine_rows": """
        SELECT kafka_timestamp, city, time_utc, reasons[1] AS reject_reason,
               TIMESTAMP '2024-02-01 00:00:00' AS reject_at_ts, 'run-1' AS run_id
        FROM weather_reasons WHERE len(reasons) > 0""",
    "quarantine_table": """
        SELECT reasons[1] AS reject_reason, count(*) AS row_count FROM carbon_reasons WHERE len(reasons) > 0 GROUP BY ALL""",
    "half_hour_gate": """
        SELECT CAST(minute(period_start) AS INTEGER) AS half_hour, count(*) AS row_count FROM carbon GROUP BY ALL""",
    "dedup_latest": _SILVER_CARBON,
    "upsert": _SILVER_CARBON,
    "upsert_table": _SILVER_CARBON,
    "upsert_forecast": """
        SELECT country_code, base_hour_utc, target_hour_utc, horizon_h,
               round(predicted_carbon_gco2_kwh + CASE WHEN fresh THEN 1 ELSE 0 END, 4) AS predicted_carbon_gco2_kwh,
               carbon_current_at_base, CASE WHEN fresh THEN '4' ELSE model_version END AS model_version, model_name,
               generated_at + CASE WHEN fresh THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS generated_at
        FROM (SELECT *, base_hour_utc >= (SELECT max(base_hour_utc) - INTERVAL 3 DAY FROM forecast) AS fresh
              FROM forecast) t""",
    "carbon_hourly": """
        SELECT hour_utc, round(uk_carbon_intensity_forecast, 6) AS uk_carbon_intensity_forecast,
               uk_carbon_intensity_index FROM carbon_by_hour""",
    "grid_state": """
        SELECT s.* EXCLUDE (fuels) REPLACE (round(uk_carbon_intensity_forecast, 6) AS uk_carbon_intensity_forecast), m.mix_items
        FROM state s JOIN (SELECT country_code, hour_utc, string_agg(psr_type || '=' || CAST(round(value_mw * 100) AS BIGINT),
                                  ',' ORDER BY psr_type) AS mix_items FROM mix GROUP BY ALL) m USING (country_code, hour_utc)""",
    "fact_generation_fuel": """
        SELECT * REPLACE (round(estimated_gco2_per_hour, 2) AS estimated_gco2_per_hour) FROM fuel_fact""",
    "orphan_fuels": """
        SELECT country_code, hour_utc, psr_type AS source_psr_type, value_mw FROM mix
        WHERE psr_type NOT IN (SELECT source_code FROM fuels)""",
    "fact_carbon_30min": "SELECT * FROM carbon_fact",
    "fact_grid_hourly": """
        SELECT * REPLACE (round(renewable_generation_mw, 2) AS renewable_generation_mw,
                          round(low_carbon_generation_mw, 2) AS low_carbon_generation_mw,
                          round(estimated_lifecycle_gco2_per_hour, 2) AS estimated_lifecycle_gco2_per_hour,
                          round(uk_carbon_intensity_forecast, 2) AS uk_carbon_intensity_forecast) FROM grid_fact""",
    "co2_cross_check": """
        SELECT country_code, hour_utc, round(sum(estimated_gco2_per_hour)) AS fuel_fact_g,
               round(sum(estimated_gco2_per_hour)) AS grid_fact_g FROM fuel_fact GROUP BY ALL""",
    "orphan_check": """
        SELECT (SELECT count(*) FROM carbon_fact f LEFT JOIN regions r ON f.region_id = r.region_id
                WHERE r.region_id IS NULL) AS orphan_region,
               (SELECT count(*) FROM carbon_fact f LEFT JOIN countries c ON f.country_key = c.country_code
                WHERE c.country_code IS NULL) AS orphan_country,
               (SELECT count(*) FROM carbon_fact f LEFT JOIN calendar t ON f.time_key = t.time_key
                WHERE t.time_key IS NULL) AS orphan_time""",
    "dim_time": "SELECT * FROM calendar",
    "dim_country": """
        SELECT c.*, g.hours FROM countries c
        LEFT JOIN (SELECT country_code, count(*) AS hours FROM grid_fact GROUP BY ALL) g USING (country_code)""",
    "dim_fuel_type": """
        SELECT f.*, g.hours FROM fuels f
        LEFT JOIN (SELECT fuel_key, count(*) AS hours FROM fuel_fact GROUP BY ALL) g USING (fuel_key)""",
    "dim_uk_region": """
        SELECT r.*, g.periods FROM regions r
        LEFT JOIN (SELECT region_id, count(*) AS periods FROM carbon_fact GROUP BY ALL) g USING (region_id)""",
    "country_bridge": """
        SELECT c.country_code, c.country_name, c.capital_city, w.readings FROM countries c
        LEFT JOIN (SELECT city, count(*) AS readings FROM weather GROUP BY ALL) w ON w.city = c.capital_city""",
    "calendar_gaps": """
        SELECT c.country_code, t.time_key, t.hour_utc FROM calendar t CROSS JOIN countries c
        WHERE NOT EXISTS (SELECT 1 FROM grid_fact g WHERE g.country_code = c.country_code AND g.time_key = t.time_key)""",
    "calendar_gaps_any": """
        SELECT time_key, hour_utc FROM calendar
        WHERE time_key NOT IN (SELECT time_key FROM grid_fact WHERE country_code = 'DE')""",
    "local_time": """
        SELECT country_code, hour_utc, hour_utc + to_hours(timezone_offset_winter_hours) AS hour_local
        FROM grid_fact JOIN countries USING (country_code)""",
    "fuel_category_summary": f"""
        SELECT d.*, s.fact_rows, s.observed_mw
        FROM (SELECT fuel_category, count(*) AS row_count, count(*) FILTER (is_renewable) AS renewables,
                     count(*) FILTER (is_low_carbon) AS low_carbon,
                     round(avg(typical_gco2_per_kwh), 0) AS avg_gco2_per_kwh FROM fuels GROUP BY ALL) d
        LEFT JOIN (SELECT fuel_category, count(*) AS fact_rows, {_SUM_MW} AS observed_mw
                   FROM fuel_fact GROUP BY ALL) s USING (fuel_category)""",
    # --- reports ---
    "eu_rankings": f"""
        SELECT country_code, hour_utc, round(total_generation_mw, 0) AS total_mw, renewable_share_pct,
               low_carbon_share_pct, estimated_lifecycle_gco2_per_kwh AS gco2_per_kwh,
               round({_TONS}, 0) AS tons_co2_per_hour FROM grid_fact WHERE {_NEWEST_GRID}""",
    "grid_latest": f"""
        SELECT country_code, hour_utc, round(total_generation_mw, 0) AS total_mw,
               round(renewable_generation_mw, 0) AS renewable_mw, round(low_carbon_generation_mw, 0) AS low_carbon_mw,
               renewable_share_pct, low_carbon_share_pct, estimated_lifecycle_gco2_per_kwh AS gco2_per_kwh,
               round({_TONS}, 0) AS tons_co2_per_hour, uk_carbon_intensity_forecast FROM grid_fact WHERE {_NEWEST_GRID}""",
    "grid_state_latest": f"""
        SELECT hour_utc, country_code, {_rounded('temperature_c', 1)} AS temp_c, {_rounded('wind_speed_kmh', 1)} AS wind_kmh,
               cloud_cover_pct, {_rounded('solar_radiation_wm2', 0)} AS solar_wm2, round(total_generation_mw, 0) AS gen_mw,
               uk_carbon_intensity_forecast AS uk_co2_gpkwh
        FROM state WHERE hour_utc = (SELECT max(hour_utc) FROM state)""",
    "trend_24h": """
        SELECT hour_utc, round(total_generation_mw, 0) AS total_mw, renewable_share_pct, low_carbon_share_pct,
               estimated_lifecycle_gco2_per_kwh AS gco2_per_kwh FROM grid_fact
        WHERE country_code = 'FR' AND hour_utc >= (SELECT max(hour_utc) - INTERVAL 24 HOUR FROM grid_fact)""",
    "fuel_mix_latest": f"""
        SELECT country_code, fuel_category, {_SUM_MW} AS total_mw,
               round({_SUM_GRAMS} / 1e6, 0) AS tons_co2_per_hour,
               bool_or(is_renewable) AS is_renewable_category, max(hour_utc) AS hour_utc
        FROM fuel_fact WHERE {_NEWEST_FUEL} GROUP BY country_code, fuel_category""",
    "eu_kpis": f"""
        SELECT {_SUM_MW} AS total_mw, round({_SUM_GRAMS} / 1e6, 0) AS total_tons_co2_per_hour,
               round(100.0::DOUBLE * sum(CASE WHEN is_renewable THEN value_mw ELSE 0 END) / sum(value_mw), 1) AS renewable_pct,
               round(sum(value_mw * typical_gco2_per_kwh) / sum(value_mw), 0) AS eu_avg_gco2_per_kwh,
               count(DISTINCT country_code) AS countries_reporting FROM fuel_fact WHERE {_NEWEST_FUEL}""",
    "co2_24h_by_country": f"""
        SELECT country_code, hour_utc, round({_SUM_GRAMS} / 1e6, 0) AS tons_co2_per_hour,
               {_SUM_MW} AS total_mw FROM fuel_fact
        WHERE hour_utc >= (SELECT max(hour_utc) - INTERVAL 24 HOUR FROM fuel_fact) GROUP BY ALL""",
    "country_fuel_mix": f"""
        SELECT fuel_category, fuel_display_name, {_SUM_MW} AS mw,
               round({_SUM_GRAMS} / 1e6, 1) AS tons_co2_per_hour,
               max(typical_gco2_per_kwh) AS gco2_per_kwh_factor FROM fuel_fact
        WHERE country_code = 'IT' AND hour_utc = (SELECT max(hour_utc) FROM fuel_fact WHERE country_code = 'IT')
        GROUP BY ALL""",
    "germany_mix": f"""
        SELECT country_code, fuel_category, fuel_display_name, hour_utc, {_rounded('value_mw', 1)} AS mw, typical_gco2_per_kwh,
               round(estimated_gco2_per_hour / 1e6, 1) AS estimated_tco2_per_hour FROM fuel_fact
        WHERE country_code = 'DE' AND time_key = (SELECT max(time_key) FROM fuel_fact WHERE country_code = 'DE')""",
    "uk_rankings": f"""
        SELECT region_name, region_type, period_start, intensity_forecast AS gco2_per_kwh, intensity_index, source_type
        FROM carbon_fact WHERE {_NEWEST_CARBON}""",
    "uk_spread": f"""
        SELECT region_name, region_type, period_start, intensity_forecast AS gco2_per_kwh, intensity_index, source_type,
               intensity_actual - intensity_forecast AS actual_minus_forecast FROM carbon_fact WHERE {_NEWEST_CARBON}""",
    "uk_kpis": f"""
        SELECT max(period_start) AS latest_period, max(intensity_forecast) AS dirtiest_gco2_per_kwh,
               min(intensity_forecast) AS cleanest_gco2_per_kwh, avg(intensity_forecast) AS avg_gco2_per_kwh,
               (SELECT intensity_forecast FROM carbon_fact WHERE {_NEWEST_CARBON} AND region_id = 18) AS gb_national_gco2_per_kwh
        FROM carbon_fact WHERE {_NEWEST_CARBON}""",
    "uk_latest_map": f"""
        SELECT f.region_id, f.region_name, f.region_type, f.period_start, f.intensity_forecast AS gco2_per_kwh,
               f.intensity_index, f.source_type, r.approx_lat, r.approx_lon
        FROM carbon_fact f JOIN regions r ON r.region_id = f.region_id WHERE {_NEWEST_CARBON}""",
    "regional_24h": f"""
        SELECT region_name, region_type, period_start, intensity_forecast AS gco2_per_kwh, intensity_index
        FROM carbon_fact WHERE {_LAST_DAY_CARBON}""",
    "regional_24h_dno": f"""
        SELECT region_name, region_type, period_start, intensity_forecast AS gco2_per_kwh, intensity_index
        FROM carbon_fact WHERE {_LAST_DAY_CARBON} AND region_type = 'DNO'""",
    "cleanest_window": """
        SELECT region_name, period_start, intensity_forecast AS gco2_per_kwh, intensity_index FROM carbon_fact
        WHERE region_name = 'GB' AND period_start >= TIMESTAMP '2024-01-20 00:00:00' AND source_type = 'forecast'
        ORDER BY intensity_forecast, period_start LIMIT 5""",
    "cleanest_window_by_code": """
        SELECT region_name, period_start, intensity_forecast AS gco2_per_kwh, intensity_index FROM carbon_fact
        WHERE region_code = 'West Midlands' AND period_start >= TIMESTAMP '2024-01-20 00:00:00' AND source_type = 'forecast'
        ORDER BY intensity_forecast, period_start LIMIT 5""",
    "fuel_coverage": """
        SELECT country_code, psr_type, name AS psr_name, count(*) AS hours_with_data, round(avg(value_mw)) AS avg_mw
        FROM mix GROUP BY ALL HAVING count(*) > 100""",
    "coverage_by_year_carbon": _coverage(
        "carbon",
        "period_start",
        "",
        "count(DISTINCT region_code) AS regions, min(period_start) AS first_period, max(period_start) AS last_period",
    ),
    "coverage_by_year": _coverage(
        "generation",
        "hour_utc",
        "country_code",
        "round(avg(total_generation_mw)) AS avg_total_mw, round(max(total_generation_mw)) AS peak_mw, "
        "round(min(total_generation_mw)) AS min_mw",
    ),
    "coverage_by_year_weather": _coverage(
        "weather",
        "time_utc",
        "city",
        "round(avg(temperature_c), 1) AS avg_temp_c, "
        f"{_rounded('max(temperature_c)', 1)} AS peak_temp_c, {_rounded('min(temperature_c)', 1)} AS min_temp_c",
    ),
    "coverage_by_year_features": _coverage(
        "feature_rows",
        "hour_utc",
        "country_code",
        "round(avg(carbon_current)) AS avg_carbon, round(avg(target_t24h)) AS avg_target, "
        "round(avg(temperature_c), 1) AS avg_temp_c",
    ),
    # --- profiles ---
    "profile_bronze_carbon": _bronze_profile("carbon_raw", "region_code", "id % 4", "ingested_at"),
    "profile_bronze_weather": _bronze_profile("weather_raw", "city", "id % 4", "ingested_at"),
    "profile_bronze_generation": _bronze_profile(
        "(SELECT country_code, hour_utc, max(event_id) AS id, max(ingested_at) AS ts FROM points GROUP BY ALL) g",
        "country_code",
        "id % 4",
        "ts",
    ),
    "profile_carbon": f"""
        SELECT count(*) AS row_count, count(DISTINCT (region_code, period_start)) AS distinct_natural_keys,
               min(period_start) AS earliest, max(period_start) AS latest, {_span("period_start")},
               count(DISTINCT region_code) AS distinct_regions, count(intensity_actual) AS rows_with_actual FROM carbon""",
    "profile_weather": f"""
        SELECT count(*) AS row_count, count(DISTINCT (city, time_utc)) AS distinct_natural_keys, min(time_utc) AS earliest,
               max(time_utc) AS latest, {_span("time_utc")}, count(DISTINCT city) AS distinct_cities FROM weather""",
    "profile_generation": f"""
        SELECT count(*) AS row_count, count(DISTINCT (country_code, hour_utc)) AS distinct_natural_keys,
               min(hour_utc) AS earliest, max(hour_utc) AS latest, {_span("hour_utc")},
               count(DISTINCT country_code) AS distinct_countries, round(avg(total_generation_mw), 1) AS avg_total_mw,
               round(max(total_generation_mw), 1) AS peak_total_mw FROM generation""",
    "profile_grid_state": """
        SELECT count(*) AS row_count, count(DISTINCT (country_code, hour_utc)) AS distinct_natural_keys,
               min(hour_utc) AS earliest, max(hour_utc) AS latest, count(DISTINCT country_code) AS countries,
               count(temperature_c) AS rows_with_weather, count(uk_carbon_intensity_forecast) AS rows_with_uk_carbon FROM state""",
    "profile_fact_fuel": f"""
        SELECT count(*) AS row_count, count(DISTINCT (country_code, hour_utc, fuel_key)) AS distinct_natural_keys,
               min(hour_utc) AS earliest, max(hour_utc) AS latest, count(DISTINCT country_code) AS countries,
               count(DISTINCT fuel_key) AS fuels_seen, count(DISTINCT hour_utc) AS hours,
               {_SUM_MW} AS total_mw_summed,
               round({_SUM_GRAMS} / 1e12, 2) AS total_megatons_co2_eq FROM fuel_fact""",
    "profile_fact_grid": """
        SELECT count(*) AS row_count, count(DISTINCT (country_code, hour_utc)) AS distinct_natural_keys,
               min(hour_utc) AS earliest, max(hour_utc) AS latest, count(DISTINCT country_code) AS countries,
               count(DISTINCT hour_utc) AS hours, count(uk_carbon_intensity_forecast) AS rows_with_uk_carbon,
               round(avg(renewable_share_pct), 1) AS avg_renewable_pct, round(avg(low_carbon_share_pct), 1) AS avg_low_carbon_pct,
               round(avg(estimated_lifecycle_gco2_per_kwh), 0) AS avg_gco2_per_kwh FROM grid_fact""",
    "profile_fact_carbon": """
        SELECT count(*) AS row_count, count(DISTINCT (region_id, period_start)) AS distinct_natural_keys,
               min(period_start) AS earliest, max(period_start) AS latest, count(DISTINCT region_id) AS regions,
               count(*) FILTER (source_type = 'forecast') AS forecast_rows,
               count(*) FILTER (source_type = 'actual') AS actual_rows,
               count(*) FILTER (intensity_forecast IS NULL) AS null_forecast,
               count(*) FILTER (time_key IS NULL) AS null_time_key FROM carbon_fact""",
    "profile_features": f"""
        SELECT count(*) AS row_count, min(hour_utc) AS earliest, max(hour_utc) AS latest, {_span("hour_utc")},
               count(DISTINCT country_code) AS distinct_countries FROM feature_rows""",
    "profile_forecast": """
        SELECT count(*) AS row_count, count(DISTINCT country_code) AS countries,
               count(DISTINCT model_version) AS distinct_model_versions, min(base_hour_utc) AS earliest_base,
               max(base_hour_utc) AS latest_base, min(target_hour_utc) AS earliest_target,
               max(target_hour_utc) AS latest_target FROM forecast""",
    "profile_calendar": """
        SELECT count(*) AS row_count, min(hour_utc) AS earliest, max(hour_utc) AS latest,
               count(DISTINCT date_utc) AS distinct_days, count(*) FILTER (is_weekend) AS weekend_hours,
               count(*) FILTER (is_business_hour_uk) AS uk_business_hours,
               count(*) FILTER (is_daytime_approx) AS daytime_hours FROM calendar""",
    "grain_check": """
        SELECT count(*) AS row_count, count(DISTINCT (country_code, hour_utc, fuel_key)) AS distinct_natural_keys
        FROM fuel_fact""",
    "measure_quality": """
        SELECT count(*) FILTER (country_key IS NULL) AS null_country_fk, count(*) FILTER (fuel_key IS NULL) AS null_fuel_fk,
               count(*) FILTER (time_key IS NULL) AS null_time_fk, count(*) FILTER (value_mw IS NULL) AS null_value_mw,
               round(min(value_mw), 2) AS min_value, round(max(value_mw), 2) AS max_value,
               round(avg(value_mw), 2) AS avg_value FROM fuel_fact""",
    "feature_quality": """
        SELECT count(*) FILTER (target_t24h IS NULL) AS null_target, count(*) FILTER (carbon_lag_168h IS NULL) AS null_lag_168h,
               count(*) FILTER (carbon_rolling_24h_mean IS NULL) AS null_rolling,
               count(*) FILTER (temperature_c IS NULL) AS null_temp FROM feature_rows""",
    "rows_per_entity": """
        SELECT country_code, count(*) AS row_count, max(hour_utc) AS latest FROM feature_rows GROUP BY ALL""",
    # --- health ---
    "layer_row_counts": "SELECT * FROM table_counts",
    "gold_row_counts": "SELECT table_name, row_count FROM table_counts WHERE layer = 'gold'",
    "lakehouse_kpis": """
        SELECT CAST(sum(row_count) AS BIGINT) AS total_rows, count(*) AS tables_tracked,
               count(DISTINCT layer) AS layers_tracked FROM table_counts""",
    "layer_freshness": "SELECT * FROM table_latest",
    "freshness": """
        SELECT layer, table_name, latest_ts, round(age, 1) AS age_minutes,
               CASE WHEN age < 60 THEN 'fresh' WHEN age < 240 THEN 'recent' WHEN age < 1440 THEN 'stale'
                    ELSE 'very stale' END AS freshness_status
        FROM (SELECT *, date_diff('second', latest_ts, TIMESTAMP '2024-01-31 00:00:00') / CAST(60 AS DOUBLE) AS age
              FROM table_latest) t""",
    "freshness_status": """
        SELECT region_id, round(age, 1) AS age_minutes,
               CASE WHEN age < 60 THEN 'fresh' WHEN age < 240 THEN 'recent' WHEN age < 1440 THEN 'stale'
                    ELSE 'very stale' END AS status
        FROM (SELECT region_id, date_diff('second', max(period_start), TIMESTAMP '2024-01-31 00:00:00') / CAST(60 AS DOUBLE) AS age
              FROM carbon_fact GROUP BY region_id) t""",
    "layer_parity": """
        SELECT (SELECT count(*) FROM carbon) AS silver_rows, (SELECT count(*) FROM carbon_fact) AS gold_rows,
               (SELECT max(period_start) FROM carbon) AS silver_latest,
               (SELECT max(period_start) FROM carbon_fact) AS gold_latest""",
    # --- features and forecast ---
    "features": f"{_FEATURES} FROM feature_rows",
    "scoring_features": f"{_FEATURES} FROM scoring",
    "features_time_true": f"""{_FEATURES} FROM hour_features
        WHERE carbon_lag_168h IS NOT NULL AND target_t24h IS NOT NULL AND carbon_rolling_24h_mean IS NOT NULL""",
    "features_incremental": f"""{_FEATURES} FROM hour_features
        WHERE carbon_lag_168h IS NOT NULL AND target_t24h IS NOT NULL AND carbon_rolling_24h_mean IS NOT NULL""",
    "features_newer": """
        SELECT country_code, hour_utc, carbon_current, target_t24h
        FROM (SELECT *, max(hour_utc) FILTER (WHERE hour_utc < TIMESTAMP '2024-01-26 00:00:00'
                - CASE WHEN country_code = 'DE' THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END)
                OVER (PARTITION BY country_code) AS newest FROM feature_rows) f
        WHERE newest IS NULL OR hour_utc > newest""",
    "temporal_split": """
        SELECT p.part, count(f.hour_utc) AS row_count, min(f.hour_utc) AS earliest, max(f.hour_utc) AS latest
        FROM (VALUES ('train', TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2024-01-24 00:00:00'),
                     ('validation', TIMESTAMP '2024-01-24 00:00:00', TIMESTAMP '2024-01-26 00:00:00'),
                     ('test', TIMESTAMP '2024-01-26 00:00:00', TIMESTAMP '2100-01-01 00:00:00')) AS p(part, lo, hi)
        LEFT JOIN feature_rows f ON f.hour_utc >= p.lo AND f.hour_utc < p.hi GROUP BY p.part""",
    "regression_metrics": _metrics("carbon_lag_168h"),
    "persistence_metrics": _metrics("carbon_current"),
    "inference_window": """
        SELECT country_code, hour_utc, carbon_current FROM feature_rows
        WHERE hour_utc >= (SELECT max(hour_utc) - INTERVAL 7 DAY FROM feature_rows)""",
    "forecast_fact": "SELECT * FROM forecast",
    "latest_forecast": _LATEST_FORECAST,
    "latest_forecast_country": f"SELECT * FROM ({_LATEST_FORECAST}) t WHERE country_code = 'NL'",
    "forecast_delta": """
        SELECT country_code, round(avg(d), 1) AS avg_delta, round(avg(abs(d)), 1) AS avg_abs_delta,
               round(max(abs(d)), 1) AS max_abs_delta
        FROM (SELECT country_code, predicted_carbon_gco2_kwh - carbon_current_at_base AS d FROM forecast) t GROUP BY ALL""",
    "forecast_newest": """
        SELECT country_code, base_hour_utc, target_hour_utc FROM forecast
        ORDER BY base_hour_utc DESC, country_code LIMIT 15""",
    "forecast_distribution": _distribution(
        "forecast", "predicted_carbon_gco2_kwh", "min_pred", "median_pred", "max_pred", "stddev_pred"
    ),
    "model_latest_version": "SELECT CAST(max(CAST(model_version AS INTEGER)) AS INTEGER) AS latest_version FROM forecast",
    "distribution": _distribution(
        "feature_rows", "carbon_current", "min_gco2_kwh", "median_gco2_kwh", "max_gco2_kwh", "stddev"
    ),
    "feature_correlation": """
        SELECT country_code, round(corr(renewable_share_pct, carbon_current), 3) AS corr_renewable_carbon,
               round(corr(low_carbon_share_pct, carbon_current), 3) AS corr_low_carbon_carbon,
               round(corr(carbon_lag_24h, carbon_current), 3) AS corr_lag24_current,
               round(corr(carbon_current, target_t24h), 3) AS corr_current_t24h FROM feature_rows GROUP BY ALL""",
    # --- streams ---
    "stream_bronze": _WEATHER_BRONZE,
    "stream_silver": """
        SELECT event_id, city, time_utc, temperature_c, wind_speed_kmh, cloud_cover_pct, solar_radiation_wm2 FROM weather""",
    "stream_dedup": """
        SELECT region_id, period_start, id AS event_id FROM carbon_raw
        QUALIFY row_number() OVER (PARTITION BY region_id, period_start ORDER BY ingested_at DESC, id DESC) = 1""",
    "bronze_live_and_backfill": """
        SELECT o.write_order, w.*
        FROM (VALUES ('live_first'), ('backfill_first')) AS o(write_order),
             (SELECT 'stream' AS written_by, count(*) AS row_count, count(DISTINCT city) AS kafka_keys FROM weather_raw
              UNION ALL
              SELECT 'backfill', count(*), count(DISTINCT region_code) FROM carbon_raw) w""",
    "grid_state_late_weather": """
        SELECT country_code, hour_utc, s.temperature_c, s.cloud_cover_pct,
               round(s.uk_carbon_intensity_forecast, 6) AS uk_carbon_intensity_forecast,
               f.temperature_c AS fact_temperature_c
        FROM state s FULL JOIN grid_fact f USING (country_code, hour_utc)""",
    "fact_fuel_new_factor": """
        SELECT country_code, hour_utc, fuel_key, value_mw,
               round(CASE WHEN source_psr_type = 'B04' THEN value_mw * 1000 * 999 ELSE estimated_gco2_per_hour END, 2)
                 AS estimated_gco2_per_hour
        FROM fuel_fact""",
    "gbt_forecast": """
        SELECT country_code, hour_utc AS base_hour_utc, hour_utc + INTERVAL 24 HOUR AS target_hour_utc, 24 AS horizon_h,
               carbon_current AS carbon_current_at_base, '1' AS model_version, 'carbon_forecast_gbt' AS model_name,
               TRUE AS in_range
        FROM feature_rows WHERE hour_utc >= (SELECT max(hour_utc) - INTERVAL 7 DAY FROM feature_rows)""",
    "gbt_metrics": """
        SELECT coalesce(country_code, 'ALL') AS country_code, count(*) AS row_count, round(avg(target_t24h), 4) AS avg_target,
               CASE WHEN country_code IS NULL THEN TRUE END AS beats_persistence
        FROM feature_rows WHERE hour_utc >= TIMESTAMP '2024-01-26 00:00:00' GROUP BY ROLLUP (country_code)""",
    "gbt_importance": """
        SELECT unnest(['country_code', 'temperature_c', 'wind_speed_kmh', 'cloud_cover_pct', 'solar_radiation_wm2',
                       'total_generation_mw', 'renewable_share_pct', 'low_carbon_share_pct', 'carbon_current', 'hour_of_day',
                       'day_of_week', 'month', 'is_weekend', 'carbon_lag_1h', 'carbon_lag_24h', 'carbon_lag_168h',
                       'carbon_rolling_24h_mean', 'temp_rolling_24h_mean']) AS feature, TRUE AS is_share, 1.0 AS total
        FROM (SELECT 1 FROM feature_rows LIMIT 1)""",
}

# Other ways to the same rows.
ORACLES["upsert_null_day"] = ORACLES["upsert_table"]
ORACLES["features_corrected"] = ORACLES["features"]
ORACLES["distribution_selected"] = ORACLES["distribution"]
ORACLES["quantiles_selected"] = """
    SELECT CAST(share AS DOUBLE) AS share, country_code, v[greatest(1, CAST(ceil(len(v) * share) AS BIGINT))] AS value_mw FROM (
        SELECT country_code, list_sort(list(value_mw)) AS v FROM points GROUP BY ALL) g,
        (VALUES (0.0), (0.1), (0.5), (0.95), (1.0)) s(share)"""
ORACLES["profile_sketched"] = """
    SELECT count(*) AS row_count, min(period_start) AS earliest, max(period_start) AS latest,
           count(DISTINCT (region_code, period_start)) AS exact_keys, count(DISTINCT region_code) AS exact_regions,
           count(DISTINCT event_id) AS exact_events, TRUE AS keys_near, TRUE AS regions_near, TRUE AS events_near
    FROM carbon"""
ORACLES["gold_from_ledger"] = """
    SELECT country_code, hour_utc, temperature_c, round(total_generation_mw, 2) AS total_generation_mw FROM grid_fact"""
ORACLES["fact_days_emptied"] = """
    SELECT country_code, hour_utc, fuel_key, round(value_mw, 2) AS value_mw FROM fuel_fact
    WHERE CAST(hour_utc AS DATE) <> (
        SELECT d[len(d) // 2 + 1] FROM (SELECT list_sort(list(DISTINCT CAST(hour_utc AS DATE))) AS d FROM fuel_fact))"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in ORACLES.items()}
