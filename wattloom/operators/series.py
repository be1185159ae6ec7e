"""Lags, leads and trailing means over long hourly series.

A window partitioned by entity alone puts a whole series into one task. Here a series is cut
into blocks, each block is given a halo (the rows before and after it that its frames reach)
and the window runs per (entity, block): same values, any number of tasks.

Two meanings are offered. Row mode counts rows, as LAG does, so a gap in the series shifts
every lag behind it. Hour mode counts hours, so a lag over a gap is NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.instants import hour_index

BLOCK = 2016  # rows or hours per block: twelve weeks


@dataclass(frozen=True)
class Shift:
    """Value of `column` `offset` steps away: negative is back (lag), positive ahead (lead)."""

    column: str
    offset: int


@dataclass(frozen=True)
class TrailingMean:
    """Mean of `column` over the `length` steps before the current one, which is left out."""

    column: str
    length: int


def _reach(specs: dict[str, Shift | TrailingMean]) -> tuple[int, int]:
    back = ahead = 0
    for spec in specs.values():
        if isinstance(spec, TrailingMean):
            back = max(back, spec.length)
        elif spec.offset < 0:
            back = max(back, -spec.offset)
        else:
            ahead = max(ahead, spec.offset)
    return back, ahead


def _with_halo(df: DataFrame, step: Column, block: int, back: int, ahead: int) -> DataFrame:
    """Copies each row to the blocks that look at it; `_home` marks its own block."""
    if block < max(back, ahead):
        raise ValueError("a block must be at least as long as the furthest frame")
    own = F.floor(step / block).cast("bigint")
    within = F.pmod(step, F.lit(block))
    blocks = F.array_compact(
        F.array(
            own,
            F.when(within >= block - back, own + 1),
            F.when(within < ahead, own - 1),
        )
    )
    return (
        df.withColumn("_own", own)
        .withColumn("_block", F.explode(blocks))
        .withColumn("_home", F.col("_block") == F.col("_own"))
        .drop("_own")
    )


def row_numbered(df: DataFrame, entity: str, ts: str) -> DataFrame:
    """Adds `_step`, the row's 0-based position in its entity's series, without one task per entity.

    Positions are counted within (entity, month) and shifted by the rows of earlier months; the
    per-month counts are one row per entity and month.
    """
    bucketed = df.withColumn("_month", F.date_trunc("month", ts))
    before = Window.partitionBy(entity).orderBy("_month").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        bucketed.groupBy(entity, "_month")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col(entity).alias("_of"),
            F.col("_month").alias("_in"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        )
    )
    within = Window.partitionBy(entity, "_month").orderBy(ts)
    return (
        bucketed.withColumn("_rn", F.row_number().over(within))
        # Rows without an entity or a time are a series, or the beginning of one, as well.
        .join(offsets, F.col(entity).eqNullSafe(F.col("_of")) & F.col("_month").eqNullSafe(F.col("_in")))
        .withColumn("_step", F.col("_before") + F.col("_rn") - 1)
        .drop("_month", "_rn", "_before", "_of", "_in")
    )


def by_rows(
    df: DataFrame, entity: str, ts: str, specs: dict[str, Shift | TrailingMean], block: int = BLOCK
) -> DataFrame:
    """Adds one column per spec, counting rows of the entity's series in `ts` order."""
    back, ahead = _reach(specs)
    spread = _with_halo(row_numbered(df, entity, ts), F.col("_step"), block, back, ahead)
    window = Window.partitionBy(entity, "_block").orderBy("_step")
    columns = {}
    for name, spec in specs.items():
        if isinstance(spec, TrailingMean):
            columns[name] = F.avg(spec.column).over(window.rowsBetween(-spec.length, -1))
        else:
            columns[name] = F.lag(spec.column, -spec.offset).over(window)
    return spread.withColumns(columns).filter("_home").drop("_step", "_block", "_home")


def by_hours(
    df: DataFrame, entity: str, ts: str, specs: dict[str, Shift | TrailingMean], block: int = BLOCK
) -> DataFrame:
    """Adds one column per spec, counting hours; expects one row per entity and hour."""
    back, ahead = _reach(specs)
    spread = _with_halo(
        df.withColumn("_step", hour_index(F.col(ts))), F.col("_step"), block, back, ahead
    )
    window = Window.partitionBy(entity, "_block").orderBy("_step")
    columns = {}
    for name, spec in specs.items():
        if isinstance(spec, TrailingMean):
            columns[name] = F.avg(spec.column).over(window.rangeBetween(-spec.length, -1))
        else:
            columns[name] = F.max(spec.column).over(window.rangeBetween(spec.offset, spec.offset))
    return spread.withColumns(columns).filter("_home").drop("_step", "_block", "_home")
