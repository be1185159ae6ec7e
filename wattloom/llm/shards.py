"""Contiguous shards of near-equal size, from global prefix sums of byte sizes.

Rows are ordered by id (then size and checksum) into partitions; each partition's total gives the
sum of all before it, and a running sum inside the partition the rest. A row belongs to the shard
in which the middle of its bytes falls, when the whole is cut at equal targets. So a shard is off
its target by no more than one row's size.

Texts that are null or empty have the fixed overhead as their size. Repeated rows are rows of their
own, and may be parted. A null id comes first. Without rows the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text, written

SHARDS = 40
OVERHEAD = 16


def shard_by_bytes(rows: DataFrame, order: list[str], size: str, shards: int = SHARDS) -> DataFrame:
    """`rows` (columns must not begin with an underscore) with `shard` and `slot`.

    `order` need not be unique: rows that are alike get their order from a number that only
    spreads them over the partitions.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*order, "_salt").sortWithinPartitions(*order, "_salt").drop("_salt")
    # The number keeps partition (upper bits) and place in it. Written, so that it stays.
    ranged = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    totals = ranged.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # One row a partition, so this window is as small as the list of partitions.
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(whole).alias("_all"),
    )
    running = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumns({"_upto": F.sum(size).over(running), "_nth": F.row_number().over(running)})
        .join(starts, "_part")
        .withColumn("_end", F.col("_bytes_before") + F.col("_upto"))
        .withColumn("_row", F.col("_rows_before") + F.col("_nth") - 1)
    )
    middle = (2 * F.col("_end") - F.col(size)).cast("decimal(38,0)")
    shard = F.least(F.floor(middle * shards / (2 * F.col("_all"))), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", F.greatest(shard, F.lit(0)))
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    # As many rows as shards.
    slotted = placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_row") - F.col("_first"))
    return slotted.select(*rows.columns, "shard", "slot")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; whole texts stay where they are."""
    content = whole_text(text)
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    return shard_by_bytes(sizes, ["doc_id", "size", "text_crc32"], "size", shards)
