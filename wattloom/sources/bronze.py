"""Bronze: topic scan, enrichment and batch backfill."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.envelopes import date_of_event_time, measurement_date
from wattloom.schemas import BRONZE
from wattloom.sources.tables import Tables

# Second partition column of bronze tables: which write a row came with.
WRITE_ID = "write_id"


def topic_options(
    bootstrap: str,
    topic: str,
    group: str = "bronze-ingest",
    starting_offsets: str = "earliest",
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a Kafka-compatible topic; `extra` carries security settings."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "kafka.group.id": group,
        "kafka.session.timeout.ms": "60000",
        "kafka.request.timeout.ms": "60000",
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **(extra or {}),
    }


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming scan of a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def enrich(frame: DataFrame, date_from: str = "broker", ingested_at: Column | None = None) -> DataFrame:
    """Topic frame to bronze rows; works on streams and on batches.

    `event_date` is the broker's date, or with date_from='measurement' the date the envelope's
    event_time gives (the broker's where it gives none), which keeps live and backfilled rows
    of one day in one partition.
    """
    broker_date = F.to_date("timestamp")
    json = F.col("value").cast("string")
    if date_from == "broker":
        event_date = broker_date
    elif date_from == "measurement":
        event_date = F.coalesce(measurement_date(json), broker_date)
    else:
        raise ValueError("date_from must be 'broker' or 'measurement'")
    return frame.select(
        json.alias("envelope_json"),
        F.col("key").cast("string").alias("kafka_key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at_ts"),
        event_date.alias("event_date"),
    )


def backfill_rows(enveloped: DataFrame, topic: str, written_at: Column | None = None) -> DataFrame:
    """Rows with an `envelope` struct as bronze rows that never went through a broker."""
    now = F.current_timestamp() if written_at is None else written_at
    return enveloped.select(
        F.to_json("envelope").alias("envelope_json"),
        F.col("envelope.region").alias("kafka_key"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        now.alias("kafka_timestamp"),
        now.alias("ingested_at_ts"),
        # As in `enrich`: a row without a readable time falls under the day it is written. Taken from the struct, so
        # that a summary of the rows makes no JSON.
        F.coalesce(date_of_event_time(F.col("envelope.event_time")), F.to_date(now)).alias("event_date"),
    ).select(*BRONZE.names)


def backfill_summary(rows: DataFrame) -> DataFrame:
    """What a backfill would write: rows, dates and keys, in one pass."""
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("event_date").alias("event_dates"),
        F.count_distinct("kafka_key").alias("kafka_keys"),
    )


def write_rows(tables: Tables, table: str, rows: DataFrame, write_id: str, clustered: bool = False) -> None:
    """Bronze rows into their table under the id of the write. Streams and backfills share the
    table; a write that is done again under its id replaces what it wrote. Rows made of `clustered`
    ones are not shuffled again."""
    marked = rows.withColumn(WRITE_ID, F.lit(write_id))
    tables.replace_partitions(f"bronze.{table}", marked, ["event_date", WRITE_ID], clustered=clustered)


def append_backfill(
    tables: Tables, table: str, rows: DataFrame, dry_run: bool = False, write_id: str | None = None,
    clustered: bool = False,
) -> dict[str, int]:
    """Appends backfilled rows to a bronze table, and says how many rows, dates and keys they
    are; with dry_run it only says so. A backfill that names its `write_id` can be run again."""
    summary = backfill_summary(rows).first().asDict()
    if not dry_run:
        write_rows(tables, table, rows, write_id or f"backfill-{uuid.uuid4().hex}", clustered)
    return summary


def ingested_since(bronze: DataFrame, high_water: Column | None, day: Column | None = None) -> DataFrame:
    """Bronze rows past a high-water mark of ingested_at_ts; `day` also bounds the partitions."""
    rows = bronze if high_water is None else bronze.filter(F.col("ingested_at_ts") > high_water)
    return rows if day is None else rows.filter(F.col("event_date") >= day)
