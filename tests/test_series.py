"""Blocked windows against plain Python, with gaps and with blocks far smaller than the series."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from wattloom.operators import series
from wattloom.operators.series import Shift, TrailingMean

START = datetime(2026, 1, 30)
SPECS = {"lag2": Shift("v", -2), "lead3": Shift("v", 3), "mean4": TrailingMean("v", 4)}


def frame(spark, hours):
    data = [("DE", START + timedelta(hours=h), float(h % 7)) for h in hours]
    data += [("FR", START + timedelta(hours=h), None if h % 3 == 0 else float(h)) for h in hours]
    return spark.createDataFrame(data, "country STRING, ts TIMESTAMP, v DOUBLE"), data


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def brute(data, by_hours):
    out = {}
    for country in ("DE", "FR"):
        own = sorted((t, v) for c, t, v in data if c == country)
        at = dict(own)
        for i, (t, _) in enumerate(own):
            if by_hours:
                def near(k, t=t, at=at):
                    return at.get(t + timedelta(hours=k))

                window = [near(-k) for k in range(1, 5)]
            else:
                def near(k, i=i, own=own):
                    return own[i + k][1] if 0 <= i + k < len(own) else None

                window = [v for _, v in own[max(0, i - 4) : i]]
            out[country, t] = (near(-2), near(3), mean(window))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(0, 80), max_size=50), st.integers(4, 20))
@pytest.mark.parametrize("by_hours", [False, True])
def test_blocks_give_the_plain_answer(spark, by_hours, hours, block):
    df, data = frame(spark, hours)
    operator = series.by_hours if by_hours else series.by_rows
    got = operator(df, "country", "ts", SPECS, block=block)
    assert got.columns == ["country", "ts", "v", *SPECS]
    answers = {(r.country, r.ts): (r.lag2, r.lead3, r.mean4) for r in got.collect()}
    want = brute(data, by_hours)
    assert answers.keys() == want.keys()
    for key, values in want.items():
        assert answers[key] == pytest.approx(values), key


def test_positions_run_on_across_months(spark):
    df, _ = frame(spark, range(0, 80, 2))
    got = series.row_numbered(df, "country", "ts").filter("country = 'DE'").orderBy("ts")
    assert [r._step for r in got.collect()] == list(range(40))


def test_block_shorter_than_a_frame_is_refused(spark):
    df, _ = frame(spark, [1])
    with pytest.raises(ValueError):
        series.by_rows(df, "country", "ts", SPECS, block=3)


def test_rows_without_entity_or_time_stay(spark):
    data = [("a", None, 1.0), ("a", "2026-01-01 00:00:00", 2.0), (None, "2026-01-01 00:00:00", 3.0), (None, None, 4.0)]
    df = spark.createDataFrame(data, "e STRING, t STRING, v DOUBLE").withColumn("t", F.col("t").cast("timestamp"))
    out = series.row_numbered(df, "e", "t")
    assert rows(out, "e", "v", "_step") == sorted([("a", 1.0, 0), ("a", 2.0, 1), (None, 4.0, 0), (None, 3.0, 1)], key=repr)
