import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from wattloom.operators import quality
from wattloom.sources.feeds import CARBON, FEEDS, GENERATION, WEATHER


def bronze(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "envelope_json STRING")
    return df.withColumn("kafka_timestamp", F.lit("2026-05-14 00:00:00").cast("timestamp"))


def envelope(**payload):
    return json.dumps({"event_id": "e", "ingested_at": "2026-05-14T00:00:00.1+00:00", "payload": payload})


GOOD_GENERATION = {
    "country_code": "DE",
    "period_start": "2026-05-14T00:00:00+00:00",
    "period_end": "2026-05-14T01:00:00+00:00",
    "total_generation_mw": 10.0,
    "generation_mix": [{"psr_type": "B16", "name": "Solar", "value_mw": 10.0}],
}


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"country_code": None}, "missing country_code"),
        ({"period_start": "x"}, "invalid period_start"),
        ({"period_end": None}, "invalid period_end"),
        ({"total_generation_mw": None}, "missing total_generation_mw"),
        ({"total_generation_mw": -1}, "negative total generation"),
        ({"total_generation_mw": 200000.5}, "unrealistic generation magnitude"),
        ({"total_generation_mw": 200000}, None),
        ({"generation_mix": []}, "empty generation_mix array"),
        ({"generation_mix": None}, "empty generation_mix array"),
    ],
)
def test_generation_rules(spark, change, reason):
    df = bronze(spark, envelope(**{**GOOD_GENERATION, **change}))
    assert GENERATION.checked(df).first().reject_reason == reason


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"city": None}, "missing city"),
        ({"time": "2026-05-14"}, "invalid time_utc"),
        ({"temperature_2m": None}, "missing temperature_2m"),
        ({"temperature_2m": -60}, None),
        ({"temperature_2m": -60.1}, "temperature below physical minimum"),
        ({"temperature_2m": 60.1}, "temperature above physical maximum"),
    ],
)
def test_weather_rules(spark, change, reason):
    good = {"city": "Rome", "time": "2026-05-14T00:00", "temperature_2m": 20.0, "cloud_cover": 59.5}
    row = WEATHER.checked(bronze(spark, envelope(**{**good, **change}))).first()
    assert row.reject_reason == reason
    assert row.cloud_cover_pct == 59


def test_unknown_fields_are_ignored_and_junk_is_rejected(spark):
    df = bronze(spark, envelope(city="Rome", time="2026-05-14T00:00", temperature_2m=1.0, units={"x": 1}), "junk", "")
    assert rows(WEATHER.checked(df), "reject_reason") == [("missing city",), ("missing city",), (None,)]


def test_all_reasons_in_rule_order(spark):
    row = CARBON.checked(bronze(spark, envelope(shortname="GB")), all_reasons=True).first()
    assert row.reject_reason == "invalid period_start timestamp"
    assert row.reject_reasons == [
        "invalid period_start timestamp", "invalid period_end timestamp", "missing intensity_forecast",
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([*[{**GOOD_GENERATION, "total_generation_mw": v} for v in (-1, 5, None, 3e5)], None])))
def test_valid_and_invalid_make_up_the_input(spark, payloads):
    df = bronze(spark, *[envelope(**p) if p else "junk" for p in payloads])
    for feed in FEEDS:
        checked = feed.checked(df)
        valid, invalid = quality.split_valid(checked)
        assert valid.count() + invalid.count() == len(payloads)
        assert "reject_reason" not in valid.columns


def test_counts_are_observed_in_the_pass_that_writes(spark):
    df = bronze(spark, envelope(**GOOD_GENERATION), "junk")
    frame, observed = quality.counted(GENERATION.checked(df), "t")
    frame.write.format("noop").mode("overwrite").save()
    assert observed.get == {"parsed": 2, "valid": 1, "invalid": 1}


def test_half_hour_gate_fails_the_job(spark):
    good = spark.createDataFrame([("2026-05-14 00:30:00",), ("2026-05-14 01:00:00",)], "t STRING")
    gate = quality.half_hour(F.col("t").cast("timestamp")).alias("h")
    assert rows(good.select(gate)) == [(0,), (30,)]
    assert good.select(gate).dtypes == [("h", "smallint")]
    bad = spark.createDataFrame([("2026-05-14 00:17:00",)], "t STRING")
    with pytest.raises(PySparkException, match="half_hour must be 0 or 30, got 17"):
        bad.select(gate).collect()


def test_grain_check_skips_keys_with_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None)], "a INT, b INT")
    assert tuple(quality.grain_check(df, ["a", "b"]).first()) == (3, 1)
