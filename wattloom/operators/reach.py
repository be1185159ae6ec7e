"""How far a change of some days reaches over lags, leads and trailing means.

Days are names of partitions, `yyyy-mm-dd`; others (no date, or one of another form) reach nothing but
themselves. What is gathered is a calendar's worth of names.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.sources.snapshots import ISO


def by_hours(days: list[str], back: int, ahead: int) -> list[str]:
    """The days with an hour that lies up to `back` hours before or `ahead` hours after one of `days`."""
    before, after = -(-back // 24), -(-ahead // 24)
    out = set(days)
    for day in filter(ISO.fullmatch, days):
        at = date.fromisoformat(day)
        out.update((at + timedelta(n)).isoformat() for n in range(-before, after + 1))
    return sorted(out)


def rows_by_day(df: DataFrame, entity: str, day: str) -> DataFrame:
    """(entity, day, rows): of a partitioned table only the entity's column is read."""
    return df.groupBy(entity, day).agg(F.count(F.lit(1)).alias("rows"))


def by_rows(rows: DataFrame, entity: str, day: str, days: list[str], back: int, ahead: int) -> list[str]:
    """The days with a row that is up to `back` rows before or `ahead` rows after a row of one of `days` in
    its entity's series. A day of `days` that has no rows left is a place between two others.

    The windows run over one row an entity and day.
    """
    names = sorted(filter(ISO.fullmatch, days))
    if not names:
        return sorted(days)
    # A changed day without rows has its place in each series, too.
    places = F.explode(F.array(*[F.lit(n).cast("date") for n in names]))
    none = rows.select(entity).distinct().select(entity, places.alias(day), F.lit(0).cast("bigint").alias("rows"))
    every = rows.unionByName(none).groupBy(entity, day).agg(F.sum("rows").alias("rows"))
    series = Window.partitionBy(entity).orderBy(day)
    placed = every.withColumn("_upto", F.sum("rows").over(series)).withColumn("_from", F.col("_upto") - F.col("rows"))
    changed = F.col(day).cast("string").isin(names)
    # Of the changed days before, the last one reaches furthest; of those behind, the first.
    placed = placed.withColumns({
        "_last": F.max(F.when(changed, F.col("_upto"))).over(series.rowsBetween(Window.unboundedPreceding, 0)),
        "_next": F.min(F.when(changed, F.col("_from"))).over(series.rowsBetween(0, Window.unboundedFollowing)),
    })
    near = (F.col("_from") < F.col("_last") + ahead) | (F.col("_upto") > F.col("_next") - back)
    found = placed.filter(near & (F.col("rows") > 0)).select(F.col(day).cast("string")).distinct().collect()
    return sorted({*days, *(n for (n,) in found if n is not None)})
