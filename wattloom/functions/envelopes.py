"""The event envelope every feed is wrapped in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom import schemas
from wattloom.functions.instants import iso_instant

INGESTED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
EVENT_TIME_FIELDS = ["from", "time"]


def _ordered(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        inner = [_ordered(col.getField(f.name), f.dataType).alias(f.name) for f in fields]
        return F.when(col.isNotNull(), F.struct(*inner))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return F.transform(col, lambda item: _ordered(item, dtype.elementType))
    return col


def canonical_json(col: Column, dtype: T.StructType) -> Column:
    """JSON with fields in name order and NULLs left out, so equal payloads give equal text."""
    return F.to_json(_ordered(col, dtype))


def checksum(payload: Column, dtype: T.StructType) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(payload, dtype), 256))


def build_envelope(
    df: DataFrame,
    *,
    region: Column,
    source: Column | str,
    payload: str = "payload",
    source_version: str = "v1",
    event_time: Column | None = None,
    event_id: Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Adds an `envelope` struct around the struct column `payload`.

    `event_time` falls back to the payload's `from`, then `time`. `event_id` is a random uuid
    and `ingested_at` the clock unless columns are given (a replayable job should give both).
    """
    dtype = df.schema[payload].dataType
    body = F.col(payload)
    own_times = [body.getField(name) for name in EVENT_TIME_FIELDS if name in dtype.names]
    candidates = ([] if event_time is None else [event_time]) + own_times
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumn(
        "envelope",
        F.struct(
            (F.uuid() if event_id is None else event_id).alias("event_id"),
            (F.lit(source) if isinstance(source, str) else source).alias("source"),
            F.lit(source_version).alias("source_version"),
            F.date_format(stamp, INGESTED_FORMAT).alias("ingested_at"),
            (F.coalesce(*candidates) if candidates else F.lit(None).cast("string")).alias(
                "event_time"
            ),
            region.alias("region"),
            body.alias("payload"),
            checksum(body, dtype).alias("checksum"),
        ),
    )


def verify_checksum(df: DataFrame, payload: T.StructType, json: str = "envelope_json") -> DataFrame:
    """Adds `checksum_ok`. `payload` must list every field the sender hashed."""
    parsed = F.from_json(F.col(json), schemas.envelope(payload))
    return (
        df.withColumn("_parsed", parsed)
        .withColumn(
            "checksum_ok",
            F.coalesce(
                F.col("_parsed.checksum") == checksum(F.col("_parsed.payload"), payload),
                F.lit(False),
            ),
        )
        .drop("_parsed")
    )


def to_topic_frame(
    df: DataFrame, topic: str, *, partition: Column, offset: Column, timestamp: Column
) -> DataFrame:
    """Rows with an `envelope` struct as the frame a keyed topic delivers."""
    return df.select(
        F.encode(F.col("envelope.region"), "UTF-8").alias("key"),
        F.encode(F.to_json("envelope"), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def date_of_event_time(event_time: Column) -> Column:
    """Calendar date of an envelope's event_time (all feeds write yyyy-MM-dd first)."""
    return F.to_date(iso_instant(F.substring(event_time, 1, 10)))


def measurement_date(envelope_json: Column) -> Column:
    """`date_of_event_time` of an envelope that is JSON."""
    return date_of_event_time(F.get_json_object(envelope_json, "$.event_time"))
