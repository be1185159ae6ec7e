"""Slices relative to the newest timestamp of a table, and rows dealt out by time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a task is given by `clustered`: as envelopes they take some 150 MB of memory.
CLUSTER_ROWS = 150_000


class Day(str):
    """Name of a table's date partition column, with a day from which on the table is known to
    hold rows; see `Tables.day`."""

    since: date | None

    def __new__(cls, name: str, since: date | None = None) -> Day:
        day = super().__new__(cls, name)
        day.since = since
        return day


def newest(df: DataFrame, ts: str, day: str | None = None) -> Column:
    """The greatest `ts` as a scalar subquery; nothing comes back to the driver.

    With `day`, the table's date partition column, only the newest partition's timestamps are read.
    Which one that is takes a look at every file, unless `day` is a `Day` that knows; `df` must then
    be the whole table, as a part of it may end on an earlier day.
    """
    since = getattr(day, "since", None)
    if since is not None:
        df = df.filter(F.col(day) >= F.lit(since))
    elif day:
        df = df.filter(F.col(day) == df.agg(F.max(day)).scalar())
    return df.agg(F.max(ts)).scalar()


def latest_slice(df: DataFrame, ts: str, day: str | None = None) -> DataFrame:
    """Rows at the newest timestamp."""
    top = newest(df, ts, day)
    out = df.filter(F.col(ts) == top)
    return out.filter(F.col(day) == F.to_date(top)) if day else out


def trailing_slice(df: DataFrame, ts: str, hours: int = 24, day: str | None = None) -> DataFrame:
    """Rows within `hours` of the newest timestamp, both ends included."""
    since = F.timestamp_add("HOUR", F.lit(-hours), newest(df, ts, day))
    out = df.filter(F.col(ts) >= since)
    return out.filter(F.col(day) >= F.to_date(since)) if day else out


def clustered(df: DataFrame, *by: str, rows: int = CLUSTER_ROWS) -> DataFrame:
    """The rows in tasks of about `rows`, each a range of `by`, for what is built on them to be wide.

    Shuffle narrow rows this way before they are widened, and a date partition's rows come from a few tasks: the
    wide ones need no shuffle, and no task has more of them than it can sort in memory. `by` should end in
    something unique, so that many rows at one time can be divided too. Counts `df`, which of files reads footers only.
    """
    return df.repartitionByRange(cluster_tasks(df, rows), *by)


def cluster_tasks(df: DataFrame, rows: int = CLUSTER_ROWS) -> int:
    """Tasks of about `rows`, and no fewer than can run at once."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
