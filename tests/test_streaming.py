"""Streams end with what the batch jobs give, and a restart adds nothing."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from verification import fixtures as fx
from verification.lake import Layers
from wattloom.operators.keys import latest_per_key
from wattloom.plans.refresh import refresh_silver
from wattloom.schemas import BRONZE, TOPIC_FRAME
from wattloom.sources import bronze
from wattloom.sources.feeds import WEATHER
from wattloom.sources.tables import Tables
from wattloom.streaming import ingest

COLUMNS = ["city", "time_utc", "event_id", "temperature_c"]


def messages(spark):
    return fx.feed_frame(fx.events(spark, SF_SMALL), WEATHER)


def landed_stream(tables):
    """A folder of messages standing in for the topic, read two files at a time."""
    path = tables.path("topic.weather")
    messages(tables.spark).repartition(6).write.mode("overwrite").parquet(path)
    return tables.spark.readStream.schema(TOPIC_FRAME).option("maxFilesPerTrigger", 2).parquet(path)


def test_topic_to_bronze_to_silver(tables):
    spark = tables.spark
    stream = landed_stream(tables)
    path = tables.path(f"bronze.{WEATHER.topic}")
    for _ in range(2):
        ingest.ingest_feed(stream, tables, WEATHER)
        table = tables.read(f"bronze.{WEATHER.topic}")
        assert table.count() == messages(spark).count()
        assert rows(table, *BRONZE.names[:6]) == rows(bronze.enrich(messages(spark)), *BRONZE.names[:6])

    batch = Layers(spark, SF_SMALL)
    for _ in range(2):
        ingest.silver_stream(
            ingest.read_bronze_stream(spark, path, 20_000), tables, WEATHER, tables.path("checkpoints.silver")
        )
        assert rows(tables.read("silver.weather"), *COLUMNS) == rows(batch.silver(WEATHER), *COLUMNS)
        assert tables.read("quarantine.weather").count() == batch.quarantine(WEATHER).count()
    runs = tables.read("quarantine.weather").select("run_id").distinct().count()
    assert runs > 1

    # Under another checkpoint batches are numbered anew; what the first one rejected stays.
    before = tables.read("quarantine.weather").count()
    again = ingest.read_bronze_stream(spark, path)
    ingest.silver_stream(again, tables, WEATHER, tables.path("checkpoints.silver-again"))
    assert tables.read("quarantine.weather").count() == before + batch.quarantine(WEATHER).count()
    assert tables.read("quarantine.weather").select("run_id").distinct().count() == runs + 1


def test_live_and_backfilled_rows_share_a_table(tables):
    spark, name = tables.spark, f"bronze.{WEATHER.topic}"
    live = messages(spark).count()
    history = bronze.backfill_rows(fx.weather_enveloped(fx.events(spark, SF_SMALL)), WEATHER.topic)
    stream = landed_stream(tables)
    ingest.ingest_feed(stream, tables, WEATHER)
    assert tables.read(name).count() == live
    bronze.append_backfill(tables, WEATHER.topic, history, write_id="history")
    for _ in range(2):
        ingest.ingest_feed(stream, tables, WEATHER)
        bronze.append_backfill(tables, WEATHER.topic, history, write_id="history")
        assert tables.read(name).count() == live + history.count()
    bronze.append_backfill(tables, WEATHER.topic, history)
    assert tables.read(name).count() == live + 2 * history.count()


def test_keys_survive_any_cut_and_order(tables):
    spark, keys = tables.spark, ["region_id", "period_start"]
    periods = fx.carbon_periods(fx.events(spark, SF_SMALL)).select(*keys, "ingested_at", "event_id")
    path = tables.path("landed.periods")
    periods.repartition(6, F.xxhash64("event_id")).write.parquet(path)
    stream = spark.readStream.schema(periods.schema).option("maxFilesPerTrigger", 1).parquet(path)
    dated = stream.withColumn("date_utc", F.to_date("period_start"))
    for _ in range(2):
        ingest.distinct_stream(
            dated, tables, "dedup.carbon", keys, "date_utc", ["ingested_at", "event_id"], tables.path("checkpoints.dedup")
        )
        want = latest_per_key(periods, keys, ["ingested_at", "event_id"])
        assert rows(tables.read("dedup.carbon"), *keys, "event_id") == rows(want, *keys, "event_id")


def test_a_batch_delivered_twice_changes_nothing(tables):
    rows_in = bronze.enrich(messages(tables.spark))
    counts = [refresh_silver(tables, WEATHER, rows_in, "batch-0") for _ in range(2)]
    assert counts[0] == counts[1]
    assert counts[0]["valid"] + counts[0]["invalid"] == counts[0]["parsed"] == rows_in.count()
    assert tables.read("quarantine.weather").count() == counts[0]["invalid"]


def test_batches_in_any_order_end_the_same(tables):
    rows_in = bronze.enrich(messages(tables.spark))
    halves = [rows_in.filter(F.col("offset") % 2 == i) for i in (0, 1)]
    other = Tables(tables.spark, tables.root + "-other")
    for store, order in ((tables, (0, 1)), (other, (1, 0))):
        for i in order:
            refresh_silver(store, WEATHER, halves[i], f"run-{i}")
    assert rows(tables.read("silver.weather"), *COLUMNS) == rows(other.read("silver.weather"), *COLUMNS)


def test_topic_options_carry_security_settings_through():
    options = bronze.topic_options("host:9093", "weather", extra={"kafka.security.protocol": "SASL_SSL"})
    assert options["subscribe"] == "weather"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["kafka.security.protocol"] == "SASL_SSL"


def test_broker_and_measurement_dates(spark):
    frame = spark.createDataFrame(
        [('{"event_time":"2026-05-01T00:00Z"}',), ('{"event_time":"x"}',), ("junk",)], "v STRING"
    ).select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("v", "UTF-8").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit("2026-05-14 00:00:00").cast("timestamp").alias("timestamp"),
    )
    broker, measured = (
        sorted(str(r[0]) for r in bronze.enrich(frame, d).select("event_date").collect()) for d in ("broker", "measurement")
    )
    assert broker == ["2026-05-14"] * 3
    assert measured == ["2026-05-01", "2026-05-14", "2026-05-14"]
    assert bronze.enrich(frame).columns == BRONZE.names
