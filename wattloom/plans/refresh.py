"""The layers' refresh jobs: bronze rows to silver, silver to gold, gold to forecast.

Silver feeds are ordered upserts, so a replay or a late batch leaves them right. What is derived from
them is computed anew and replaces its days as a whole, those that came out empty included. Which days that
are a job knows from its inputs' ledgers (every version of a table says which days it changed) and its own mark,
the versions it has taken in: a changed weather row, carbon row or dimension shows after the next run,
whatever its date, and no other day is read or rewritten. Every table is partitioned by the date of its own
natural key. `since`, a date, bounds a job to the days from it on instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators import dims, reach
from wattloom.operators.keys import latest_per_key
from wattloom.operators.quality import counted, quarantine_rows, split_valid
from wattloom.plans import facts, features, integrate
from wattloom.sources.feeds import CARBON, GENERATION, WEATHER, Feed
from wattloom.sources.snapshots import NULL_FOLDER
from wattloom.sources.tables import Tables

DAY = "date_utc"


def with_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(ts))


def refresh_silver(tables: Tables, feed: Feed, bronze: DataFrame, run_id: str) -> dict[str, int]:
    """Parses and validates a batch of bronze rows, upserts the good and quarantines the bad.

    The JSON is parsed once, into a staging table both sides read; parsed / valid / invalid are
    counted as the rows pass, and returned. Quarantine is partitioned by run and a run's
    partition is replaced as a whole: replaying a run adds nothing to the audit log.
    """
    checked, observed = counted(feed.checked(bronze), f"{feed.table}-{run_id}")
    staging = f"staging.{feed.table}"
    tables.overwrite(staging, checked)
    valid, invalid = split_valid(tables.read(staging))
    tables.replace_partitions(
        f"quarantine.{feed.table}", quarantine_rows(invalid, run_id), "run_id", clustered=True
    )
    dated = with_day(valid, feed.ts)
    tables.upsert(f"silver.{feed.table}", dated, feed.key, DAY, days=dated.select(DAY))
    return observed.get


def refresh_dimensions(tables: Tables, spanned: DataFrame, ts: str) -> None:
    """Overwrites the literal dimensions, and the calendar over the hours `spanned` covers."""
    spark = tables.spark
    tables.overwrite("silver.country_dim", dims.country_bridge(spark))
    tables.overwrite("gold.dim_country", dims.dim_country(spark))
    tables.overwrite("gold.dim_fuel_type", dims.dim_fuel_type(spark))
    tables.overwrite("gold.dim_uk_region", dims.dim_uk_region(spark))
    tables.overwrite("gold.dim_time", dims.dim_time_spanning(spanned, ts))


@dataclass(frozen=True)
class Change:
    """What a job has to take in: the days its inputs have changed (None: all), and its mark for afterwards."""

    days: list[str] | None
    mark: dict

    def read(self, tables: Tables, name: str) -> DataFrame:
        return tables.read(name, self.days)


def changes(tables: Tables, job: str, inputs: list[str], dims: list[str] = (), since: Column | None = None) -> Change:
    """From the inputs' ledgers, since the job last set its mark; all days on its first run and after a
    dimension has changed. `since` bounds the job to the days from it on instead, and leaves its mark alone."""
    if since is not None:
        first = tables.spark.range(1).select(since.cast("date").cast("string")).first()[0]
        return Change(sorted({d for name in [*inputs, job] for d in tables.days_from(name, first)}), {})
    seen = tables.mark(job) if tables.exists(job) else {}
    # Taken before the inputs are read: what comes later is seen again by the next run.
    mark = {name: tables.digest(name) for name in dims}
    days: set[str] | None = set() if all(seen.get(n) == d for n, d in mark.items()) else None
    for name in inputs:
        mark[name], changed = tables.changed_days(name, seen.get(name, 0))
        days = days | set(changed) if days is not None and name in seen else None
    return Change(None if days is None else sorted(days), mark)


def put_days(
    tables: Tables, job: str, change: Change, rows: DataFrame, key: list[str], order_by: list[str] | None = None,
    days: list[str] | None = None,
) -> None:
    """Derived rows in place of all rows of their days; days that came out empty go. The newest ingestion
    of a key wins among the rows. `days` are those replaced, if not those read."""
    rows = latest_per_key(rows, key, order_by or ["ingested_at"]) if key else rows
    if change.days is None:
        tables.overwrite(job, rows, DAY, key)
    elif change.days:
        tables.replace_partitions(job, rows, DAY, key, change.days if days is None else days)
    if change.mark:
        tables.set_mark(job, change.mark)


def refresh_grid_state(tables: Tables, since: Column | None = None) -> Change:
    inputs = [f"silver.{f.table}" for f in (GENERATION, WEATHER, CARBON)]
    job = "silver.grid_state"
    change = changes(tables, job, inputs, ["silver.country_dim"], since)
    state = integrate.grid_state(*[change.read(tables, n) for n in inputs], tables.read("silver.country_dim"))
    put_days(tables, job, change, with_day(state, "hour_utc"), ["country_code", "hour_utc"])
    return change


def _quarantine_orphans(tables: Tables, name: str, orphans: DataFrame, run_id: str) -> None:
    tables.replace_partitions(
        f"quarantine.{name}", orphans.withColumn("run_id", F.lit(run_id)), "run_id"
    )


def refresh_fact_fuel(tables: Tables, run_id: str, since: Column | None = None) -> Change:
    job, key = "gold.fact_generation_fuel_hourly", ["country_code", "hour_utc", "fuel_key"]
    change = changes(tables, job, [f"silver.{GENERATION.table}"], ["gold.dim_fuel_type"], since)
    generation = change.read(tables, f"silver.{GENERATION.table}")
    fact, orphans = facts.fact_generation_fuel(generation, tables.read("gold.dim_fuel_type"))
    _quarantine_orphans(tables, "orphan_fuel", orphans, run_id)
    put_days(tables, job, change, with_day(fact, "hour_utc"), key)
    return change


def refresh_fact_carbon(tables: Tables, run_id: str, since: Column | None = None) -> Change:
    job, key = "gold.fact_carbon_intensity_30min", ["region_id", "period_start"]
    change = changes(tables, job, [f"silver.{CARBON.table}"], ["gold.dim_uk_region"], since)
    carbon = change.read(tables, f"silver.{CARBON.table}")
    fact, orphans = facts.fact_carbon_30min(carbon, tables.read("gold.dim_uk_region"))
    _quarantine_orphans(tables, "orphan_region", orphans, run_id)
    put_days(tables, job, change, with_day(fact, "period_start"), key, ["ingested_at", "source_event_id"])
    return change


def refresh_fact_grid(tables: Tables, since: Column | None = None) -> Change:
    job = "gold.fact_grid_hourly"
    change = changes(tables, job, ["silver.grid_state"], ["gold.dim_fuel_type"], since)
    fact = facts.fact_grid_hourly(change.read(tables, "silver.grid_state"), tables.read("gold.dim_fuel_type"))
    put_days(tables, job, change, with_day(fact, "hour_utc"), ["country_code", "hour_utc"])
    return change


def refresh_features(tables: Tables, mode: str = "create_or_replace", lags: str = "rows") -> Change:
    """Rebuilds the feature table, or ('incremental') brings up to date the days that a change of the
    grid fact can reach: corrections and filled gaps included, and no other day is read or written.

    A day reaches the days whose lags, means or target look at it. In hours that is the same for all days; in
    rows it goes by how many rows the days around it have.
    """
    name, grid = "gold.feature_carbon_forecast", "gold.fact_grid_hourly"
    if mode not in ("create_or_replace", "incremental"):
        raise ValueError("mode must be 'create_or_replace' or 'incremental'")
    change = changes(tables, name, [grid])
    if mode == "create_or_replace" or tables.mark(name).get("lags") != lags:
        change = Change(None, change.mark)
    change = Change(change.days, change.mark | {"lags": lags})
    back, ahead = features.REACH_BACK, features.HORIZON_HOURS
    if not change.days:
        reached = needed = change.days
    elif lags == "hours":
        reached = reach.by_hours(change.days, ahead, back)
        needed = reach.by_hours(reached, back, ahead)
    else:
        rows = reach.rows_by_day(tables.read(grid), "country_code", DAY)
        reached = reach.by_rows(rows, "country_code", DAY, change.days, ahead, back)
        needed = reach.by_rows(rows, "country_code", DAY, reached, back, ahead)
    made = with_day(features.training_features(tables.read(grid, needed), lags), "hour_utc")
    if reached is not None:
        made = made.filter(F.coalesce(F.col(DAY).cast("string"), F.lit(NULL_FOLDER)).isin(reached))
    put_days(tables, name, change, made, ["country_code", "hour_utc"], ["hour_utc"], reached)
    return Change(reached, change.mark)


def refresh_forecast(tables: Tables, rows: DataFrame, mode: str = "merge") -> None:
    """Upserts forecast rows on (country, base hour), or replaces the table ('overwrite')."""
    dated = with_day(rows, "base_hour_utc")
    name = "gold.fact_carbon_forecast"
    if mode == "overwrite":
        tables.overwrite(name, dated, DAY)
    elif mode == "merge":
        tables.upsert(name, dated, ["country_code", "base_hour_utc"], DAY, ["generated_at"])
    else:
        raise ValueError("mode must be 'merge' or 'overwrite'")


def refresh_gold(tables: Tables, run_id: str, since: Column | None = None) -> dict[str, Change]:
    """From the silver feeds to the features, in order; dimensions first. Returns what each job took in."""
    refresh_dimensions(tables, tables.read(f"silver.{CARBON.table}"), CARBON.ts)
    return {
        "grid_state": refresh_grid_state(tables, since),
        "fact_fuel": refresh_fact_fuel(tables, run_id, since),
        "fact_carbon": refresh_fact_carbon(tables, run_id, since),
        "fact_grid": refresh_fact_grid(tables, since),
        "features": refresh_features(tables, "incremental"),
    }
