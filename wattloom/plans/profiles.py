"""Profiles kept beside a table: counts, ranges and distinct sketches of each day, merged when asked for.

A day's row is computed when the table's ledger says that the day has changed; a profile of the whole table
then reads one small row a day and no old day of the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.plans.refresh import DAY, Change, changes, put_days
from wattloom.sources.tables import Tables

# 2^LOG_SIZE registers a sketch: a merged count is off by 1.04 / sqrt(2^LOG_SIZE) as a standard error, 0.8 %.
LOG_SIZE = 14


def _hashed(columns: list[str]) -> Column:
    """Of a combination of values, NULL where one of them is."""
    whole = F.lit(True)
    for c in columns:
        whole &= F.col(c).isNotNull()
    return F.when(whole, F.xxhash64(*columns))


def refresh_profile(tables: Tables, name: str, ts: str, distinct: dict[str, list[str]]) -> Change:
    """Brings `profiles.<name>` up to date: per day rows, earliest and latest `ts`, and for each entry of
    `distinct` (output name to columns) a sketch of the combinations without a NULL. Other entries than last
    time rebuild it. The table must be partitioned by its date, and days without rows go."""
    job = profile_name(name)
    change = changes(tables, job, [name])
    asked = {"ts": ts, "distinct": distinct, "size": LOG_SIZE}
    if tables.exists(job) and tables.mark(job).get("asked") != asked:
        change = Change(None, change.mark)
    change = Change(change.days, change.mark | {"asked": asked})
    made = change.read(tables, name).groupBy(DAY).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("earliest"),
        F.max(ts).alias("latest"),
        *[F.hll_sketch_agg(_hashed(columns), LOG_SIZE).alias(out) for out, columns in distinct.items()],
    )
    put_days(tables, job, change, made, [])
    return change


def profile_name(name: str) -> str:
    return f"profiles.{name.replace('.', '_')}"


def profile_sketched(tables: Tables, name: str, days: list[str] | None = None) -> DataFrame:
    """One row over the whole table, or over `days`: row_count, earliest, latest and the estimated distinct
    counts. Of a table without rows counts are 0 and times NULL."""
    job = profile_name(name)
    kept = tables.read(job, days)
    sketches = tables.mark(job)["asked"]["distinct"]
    return kept.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(s)), F.lit(0)).alias(s) for s in sketches],
    )
