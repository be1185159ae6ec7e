"""Structured Streaming jobs: topic to bronze, bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattloom import schemas
from wattloom.plans.refresh import refresh_silver
from wattloom.sources import bronze
from wattloom.sources.bronze import write_rows
from wattloom.sources.feeds import Feed
from wattloom.sources.tables import Tables


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a stream's checkpoint: the same after a restart, another one under a
    new checkpoint."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def write_bronze(
    rows: DataFrame, tables: Tables, table: str, checkpoint: str, available_now: bool = True, await_end: bool = True,
    clustered: bool = False,
) -> StreamingQuery:
    """A stream of bronze rows into the table that backfills write to as well.

    Each micro-batch is a write of its own, so one that is delivered twice adds nothing. The
    checkpoint folder must belong to this stream alone. With available_now the query takes what is
    there and ends, which suits a schedule. `clustered` as in `write_rows`.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        write_rows(tables, table, batch, f"{query_id(tables.spark, checkpoint)}-{batch_id}", clustered)

    writer = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    if await_end:
        query.awaitTermination()
    return query


def ingest_feed(
    topic: DataFrame, tables: Tables, feed: Feed, available_now: bool = True, await_end: bool = True
) -> StreamingQuery:
    """One feed's topic stream into its bronze table, under its own checkpoint."""
    return write_bronze(
        bronze.enrich(topic, date_from="measurement"),
        tables,
        feed.topic,
        tables.path(f"checkpoints.bronze-{feed.topic}"),
        available_now,
        await_end,
    )


def read_bronze_stream(
    spark: SparkSession, path: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Bronze as a stream: each row is delivered once, so silver never re-reads old rows.

    `max_bytes_per_trigger` cuts a long backlog into several micro-batches.
    """
    reader = spark.readStream.schema(schemas.BRONZE)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.parquet(path)


def silver_stream(
    rows: DataFrame, tables: Tables, feed: Feed, checkpoint: str, await_end: bool = True
) -> StreamingQuery:
    """Parses, validates and upserts each micro-batch of bronze rows.

    A batch may be delivered twice after a failure. The upsert is ordered and quarantine is
    replaced per stream and batch, so the second delivery changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        refresh_silver(tables, feed, batch, f"{query_id(tables.spark, checkpoint)}-{batch_id}")

    query = (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if await_end:
        query.awaitTermination()
    return query


def distinct_stream(
    rows: DataFrame,
    tables: Tables,
    name: str,
    keys: list[str],
    day: str,
    order_by: list[str],
    checkpoint: str,
    await_end: bool = True,
) -> StreamingQuery:
    """One row per key of a stream, the greatest by `order_by`, in a table partitioned by `day`, a
    date that follows from the key.

    The table is the state: rows may come in any order, however late, and in any cut into batches.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        tables.upsert(name, batch, keys, day, order_by, days=batch.select(day))

    query = (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if await_end:
        query.awaitTermination()
    return query
