from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from wattloom.functions import envelopes, instants, measures
from wattloom.schemas import CARBON_PAYLOAD


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_settlement_instant_takes_both_dialects_and_refuses_junk(spark):
    texts = ["2026-05-14T01:30Z", "2026-05-14T01:30:00Z", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(instants.settlement_instant(F.col("t"))).collect()]
    assert got == [datetime(2026, 5, 14, 1, 30)] * 2 + [None, None]


def test_weather_and_iso_instants(spark):
    assert one(spark, instants.weather_instant(F.lit("2026-05-14T00:00"))) == datetime(2026, 5, 14)
    assert one(spark, instants.iso_instant(F.lit("2026-05-14T22:00:00.5+02:00"))) == datetime(
        2026, 5, 14, 20, 0, 0, 500000
    )
    assert one(spark, instants.iso_instant(F.lit("x"))) is None


def test_resolution_seconds(spark):
    cases = {"PT15M": 900, "PT30M": 1800, "PT60M": 3600, "P1D": 3600, "": 3600, None: 3600}
    df = spark.createDataFrame([(k,) for k in cases], "r STRING")
    got = {r[0]: r[1] for r in df.select("r", instants.resolution_seconds(F.col("r"))).collect()}
    assert got == cases


def test_point_instant_is_one_based(spark):
    start = F.lit("2026-05-14 00:00:00").cast("timestamp")
    got = one(spark, instants.point_instant(start, F.lit(5), F.lit(900)))
    assert got == datetime(2026, 5, 14, 1, 0)


def test_absurd_points_do_not_fail_the_job(spark):
    start = F.lit("2026-05-14 00:00:00").cast("timestamp")
    far = instants.point_instant(start, F.lit(2_000_000_000), F.lit(3600))
    assert one(spark, far > start) is True
    assert one(spark, instants.resolution_seconds(F.lit("PT2000000000M"))) == 3600
    assert one(spark, instants.resolution_seconds(F.lit("PT99999999999999999999M"))) == 3600


def test_stable_sum_is_exact_and_survives_freak_values(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v DOUBLE")
    assert df.agg(measures.stable_sum("v")).first()[0] == 1.0
    assert df.limit(0).agg(measures.stable_sum("v")).first()[0] is None
    freak = df.union(spark.createDataFrame([(1e30,)], "v DOUBLE"))
    assert freak.agg(measures.stable_sum("v")).first()[0] == 1e30


def test_time_key_and_weekday(spark):
    sunday = F.lit("2026-05-17 07:10:00").cast("timestamp")
    assert one(spark, instants.time_key(sunday)) == 2026051707
    assert one(spark, instants.iso_weekday(sunday)) == 7


def test_local_time_follows_daylight_saving(spark):
    for day, hour in (("2026-01-15", 13), ("2026-07-15", 14)):
        noon = F.lit(f"{day} 12:00:00").cast("timestamp")
        assert one(spark, instants.local_time(noon, "Europe/Berlin")).hour == hour


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(50.0, 200.0), (1.0, 0.0), (1.0, None)], "part DOUBLE, whole DOUBLE")
    got = df.select(
        measures.share_pct(F.col("part"), F.col("whole")), measures.intensity(F.col("part"), F.col("whole"))
    ).collect()
    assert [tuple(r) for r in got] == [(25.0, 0.0), (None, None), (None, None)]


def test_freshness_limits(spark):
    ages = [0.0, 59.9, 60.0, 239.9, 240.0, 1439.9, 1440.0, None]
    df = spark.createDataFrame([(a,) for a in ages], "age DOUBLE")
    labels = [r[0] for r in df.select(measures.freshness(F.col("age"))).collect()]
    assert labels == ["fresh", "fresh", "recent", "recent", "stale", "stale", "very stale", "very stale"]


def test_array_total_treats_null_as_sum_does(spark):
    df = spark.createDataFrame([([1.0, None, 2.0],), ([None],), ([],), (None,)], "v ARRAY<DOUBLE>")
    got = [r[0] for r in df.select(measures.array_total(F.col("v"))).collect()]
    assert got == [3.0, None, None, None]


def test_envelope_times_ids_and_checksum(spark):
    payload = F.struct(F.lit("2026-05-14T01:30Z").alias("from"), F.lit(2).alias("b"), F.lit(1).alias("a"))
    swapped = F.struct(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit("2026-05-14T01:30Z").alias("from"))
    no_time = F.struct(F.lit(1).alias("a"))
    for body, event_time in ((payload, "2026-05-14T01:30Z"), (no_time, None)):
        df = spark.range(2).withColumn("payload", body)
        built = envelopes.build_envelope(df, region=F.lit("GB"), source="test").select("envelope.*")
        got = built.collect()
        assert built.columns == [
            "event_id", "source", "source_version", "ingested_at", "event_time", "region", "payload", "checksum",
        ]
        assert len({r.event_id for r in got}) == 2
        assert {r.event_time for r in got} == {event_time}
        assert all(len(r.checksum) == 71 and r.checksum.startswith("sha256:") for r in got)
    sums = set()
    for body in (payload, swapped):
        df = spark.range(1).withColumn("payload", body)
        sums.add(envelopes.build_envelope(df, region=F.lit("GB"), source="t").first().envelope.checksum)
    assert len(sums) == 1, "field order must not matter"


def test_weather_payload_time_is_the_second_choice(spark):
    df = spark.range(1).withColumn("payload", F.struct(F.lit("2026-05-14T00:00").alias("time")))
    assert envelopes.build_envelope(df, region=F.lit("x"), source="t").first().envelope.event_time == "2026-05-14T00:00"


def test_checksum_notices_tampering(spark):
    payload = F.from_json(
        F.lit('{"from":"2026-05-14T01:30Z","regionid":3,"intensity":{"forecast":100}}'), CARBON_PAYLOAD
    )
    df = envelopes.build_envelope(spark.range(1).withColumn("payload", payload), region=F.lit("r"), source="t")
    good = df.select(F.to_json("envelope").alias("envelope_json"))
    bad = good.withColumn("envelope_json", F.replace("envelope_json", F.lit(":100"), F.lit(":900")))
    junk = spark.createDataFrame([("not json",)], "envelope_json STRING")
    checked = envelopes.verify_checksum(good.union(bad).union(junk), CARBON_PAYLOAD)
    assert rows(checked, "checksum_ok") == [(False,), (False,), (True,)]
