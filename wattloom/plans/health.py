"""Row counts, freshness and parity across the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.measures import age_minutes, freshness

# Display order of the layers.
LAYERS = ["bronze", "silver", "gold"]

Tables = dict[tuple[str, str], DataFrame]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_row_counts(tables: Tables) -> DataFrame:
    """One row per table; each branch is a count that reads no column."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    position = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), F.col("layer"))
    return _union(counts).orderBy(position, "table_name")


def lakehouse_kpis(tables: Tables) -> DataFrame:
    return layer_row_counts(tables).agg(
        F.sum("row_count").alias("total_rows"),
        F.count(F.lit(1)).alias("tables_tracked"),
        F.count_distinct("layer").alias("layers_tracked"),
    )


def latest_timestamps(tables: Tables, ts: dict[tuple[str, str], str]) -> DataFrame:
    """Row count and newest business timestamp per table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts[key]).alias("latest_ts")).select(
                F.lit(key[0]).alias("layer"), F.lit(key[1]).alias("table_name"), "row_count", "latest_ts"
            )
            for key, df in tables.items()
        ]
    )


def freshness_report(tables: Tables, ts: dict[tuple[str, str], str], as_of: Column | None = None) -> DataFrame:
    """Age in minutes and label of every table, freshest first."""
    now = F.current_timestamp() if as_of is None else as_of
    age = age_minutes(F.col("latest_ts"), now)
    return (
        latest_timestamps(tables, ts)
        .select(
            "layer",
            "table_name",
            "latest_ts",
            F.round(age, 1).alias("age_minutes"),
            freshness(age).alias("freshness_status"),
        )
        .orderBy("age_minutes", "layer", "table_name")
    )


def layer_parity(silver: DataFrame, gold: DataFrame, ts: str) -> DataFrame:
    """One row: row count and newest timestamp of a silver table and the gold fact built on it."""
    s = silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.max(ts).alias("silver_latest"))
    g = gold.agg(F.count(F.lit(1)).alias("gold_rows"), F.max(ts).alias("gold_latest"))
    return s.select(
        "silver_rows",
        g.select("gold_rows").scalar().alias("gold_rows"),
        "silver_latest",
        g.select("gold_latest").scalar().alias("gold_latest"),
    )
