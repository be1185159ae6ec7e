"""Groups of rows for per-group work in tasks, with large groups split over several."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_block_pairs(df: DataFrame, key: str, member: str, rows_a_block: int) -> DataFrame:
    """`df` with `_i` and `_j`: groups of up to `rows_a_block` rows stay whole (0, 0); a larger one
    is cut into blocks by its members' hash, and each pair of blocks is a group of its own, so that
    every pair of members still meets."""
    large = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_a_block)
    blocks = F.ceil(F.col("_n") / rows_a_block).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, own).alias("_i"), F.greatest(o, own).alias("_j"))
    )
    alone = F.array(F.struct(F.lit(0).alias("_i"), F.lit(0).alias("_j")))
    pairs = F.when(F.col("_n").isNull(), alone).otherwise(others)
    return df.join(large, key, "left").select(*df.columns, F.inline(pairs))


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: int, at_least: int = 100_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with each row's group number; rows come sorted by the first `keys`
    columns, which are whole numbers."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for c in range(keys):
            values = table.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return new

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= at_least:
            table = pa.Table.from_batches(held)
            new = starts(table)
            cuts = np.flatnonzero(new)
            if len(cuts):
                cut = int(cuts[-1])
                yield table.slice(0, cut), np.cumsum(new[:cut])
                held = table.slice(cut).to_batches()
                rows -= cut
    if rows:
        table = pa.Table.from_batches(held)
        yield table, np.cumsum(starts(table))
