import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from wattloom.operators import dims, flatten


def landed(spark, document, **extra):
    names = ["response", *extra]
    return spark.createDataFrame([(document, *extra.values())], names)


def test_regions_nested_and_named(spark):
    doc = {
        "data": [
            {"from": "a", "to": "b", "regions": [{"regionid": 1, "shortname": "N"}, {"regionid": 2}]},
            {"to": "c", "regions": [{"regionid": 3, "shortname": "S"}]},
            {"from": "d", "to": "e", "regions": []},
        ]
    }
    got = flatten.regional_payloads(landed(spark, json.dumps(doc)))
    assert rows(got, "region", "payload.from", "payload.regionid") == [("N", "a", 1), ("region-2", "a", 2)]


WEATHER = {
    "latitude": 1.0,
    "hourly_units": {"temperature_2m": "°C"},
    "hourly": {
        "time": ["2026-05-14T00:00", "2026-05-14T01:00", "2026-05-14T02:00"],
        "temperature_2m": [9.5, None, 11.0],
        "wind_speed_10m": [3.0],
        "cloud_cover": [59.5, 60, 61],
    },
}


def test_hours_from_short_null_and_missing_arrays(spark):
    got = flatten.hourly_payloads(landed(spark, json.dumps(WEATHER), city="Rome"))
    fields = ["city", "time", "temperature_2m", "wind_speed_10m", "cloud_cover", "shortwave_radiation"]
    assert rows(got, *[f"payload.{f}" for f in fields]) == [
        ("Rome", "2026-05-14T00:00", 9.5, 3.0, 59, None),
        ("Rome", "2026-05-14T02:00", 11.0, None, 61, None),
    ]


@pytest.mark.parametrize(
    ("now", "hour"),
    [
        ("2026-05-14 01:40:00", "2026-05-14T01:00"),
        ("2026-05-14 09:00:00", "2026-05-14T02:00"),
        ("2026-05-13 09:00:00", "2026-05-14T00:00"),
    ],
)
def test_current_hour_exact_last_or_first(spark, now, hour):
    df = landed(spark, json.dumps(WEATHER), city="Rome")
    got = flatten.current_hour_payloads(df, F.lit(now).cast("timestamp"))
    assert rows(got, "payload.time") == [(hour,)]


def test_current_hour_of_an_empty_response(spark):
    df = landed(spark, json.dumps({"hourly": {"time": []}}), city="Rome")
    now = F.lit("2026-05-14 01:40:00").cast("timestamp")
    assert flatten.current_hour_payloads(df, now, on_empty="drop").count() == 0
    with pytest.raises(PySparkException, match="empty hourly forecast for Rome"):
        flatten.current_hour_payloads(df, now).collect()


def series(code, *periods):
    kind = f"<MktPSRType><psrType>{code}</psrType></MktPSRType>" if code else ""
    return f"<TimeSeries>{kind}{''.join(periods)}</TimeSeries>"


def period(start, resolution, *points):
    inner = "".join(f"<Point><position>{p}</position><quantity>{q}</quantity></Point>" for p, q in points)
    step = f"<resolution>{resolution}</resolution>" if resolution else ""
    return f"<Period><timeInterval><start>{start}</start></timeInterval>{step}{inner}</Period>"


def documents(spark, *bodies):
    docs = [(i, f'<GL_MarketDocument xmlns="urn:x">{b}</GL_MarketDocument>') for i, b in enumerate(bodies)]
    return spark.createDataFrame(docs, "id INT, document STRING")


def test_xml_single_many_and_unusable_elements(spark):
    df = documents(
        spark,
        series("B16", period("2026-05-14T00:00Z", "PT60M", (1, 5))),
        series("B16", period("2026-05-14T00:00Z", "PT15M", (1, 1), (2, "n/a")), period("2026-05-14T01:00Z", None, (2, 7)))
        + series("", period("2026-05-14T00:00Z", "PT60M", (1, 5)))
        + series("B04", period("never", "PT60M", (1, 5))),
        "",
    )
    points = flatten.points_to_hours(flatten.generation_points(df))
    assert rows(points, "id", "psr_type", "step_seconds", "quantity", F.hour("point_utc")) == [
        (0, "B16", 3600, 5.0, 0),
        (1, "B16", 3600, 7.0, 2),
        (1, "B16", 900, 1.0, 0),
    ]


def test_means_over_points_and_over_series_differ(spark):
    hour = "2026-05-14 00:00:00"
    data = [("DE", hour, "B16", 1, 10.0), ("DE", hour, "B16", 1, 20.0), ("DE", hour, "B16", 2, 90.0)]
    points = spark.createDataFrame(data, "country_code STRING, hour_utc STRING, psr_type STRING, s INT, quantity DOUBLE")
    assert flatten.hourly_mean_by_fuel(points, ["country_code"]).first().mean_mw == 40.0
    assert flatten.hourly_sum_of_series_means(points, ["country_code"], ["s"]).first().mean_mw == 105.0


def test_mix_is_sorted_rounded_and_totalled_before_rounding(spark):
    hour = "2026-05-14 00:00:00"
    data = [("DE", hour, "B19", 1.004), ("DE", hour, "B04", 2.004), ("DE", hour, "Z99", 3.004)]
    means = spark.createDataFrame(data, "country_code STRING, hour_utc STRING, psr_type STRING, mean_mw DOUBLE")
    row = flatten.nest_mix(flatten.label_fuels(means, dims.fuel_labels(spark)), ["country_code"]).first()
    assert [tuple(x) for x in row.generation_mix] == [
        ("B04", "Fossil Gas", 2.0), ("B19", "Wind Onshore", 1.0), ("Z99", "Unknown", 3.0),
    ]
    assert row.total_generation_mw == 6.01
