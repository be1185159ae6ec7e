"""Latest-wins deduplication, ordered upsert and dimension gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Later ingestion wins; the broker's clock and then the event id decide between equals.
LATEST_FIRST = ["ingested_at", "kafka_timestamp", "event_id"]


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by `order_by` (default LATEST_FIRST, as far as present).

    Written as row_number = 1 because Spark turns that into a per-partition limit ahead of the
    shuffle: however many copies a key has, each map task sends on at most one of them.
    """
    order = order_by or [c for c in LATEST_FIRST if c in df.columns]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def upsert_frame(
    target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """Target after the upsert: matched keys updated, new keys inserted, the rest kept.

    Rows compete across target and source, so a late-arriving older batch never overwrites a
    newer row, and replaying a batch changes nothing. Columns may be added by the source.
    """
    both = target.unionByName(source, allowMissingColumns=True)
    order = order_by or [c for c in LATEST_FIRST if c in both.columns]
    return latest_per_key(both, keys, order)


def past_newest(df: DataFrame, existing: DataFrame, ts: str, entity: str) -> DataFrame:
    """Rows past the newest `ts` that `existing` has of the same entity; all of an entity it lacks."""
    marks = existing.groupBy(F.col(entity).alias("_entity")).agg(F.max(ts).alias("_newest"))
    joined = df.join(marks, F.col(entity).eqNullSafe(F.col("_entity")), "left")
    past = F.col("_newest").isNull() | (F.col(ts) > F.col("_newest"))
    return joined.filter(past).select(*df.columns)


def match_dimension(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, on_orphan: str = "quarantine"
) -> tuple[DataFrame, DataFrame | None]:
    """Joins a dimension and says what happens to rows it does not know.

    'quarantine': (matched, orphans); 'drop': (matched, None); 'fail': the job fails when an
    orphan row is read. The dimension's key column is not kept.
    """
    on = F.col(key) == F.col(dim_key)
    if on_orphan == "fail":
        joined = df.join(dim, on, "left").withColumn(
            key,
            F.when(F.col(dim_key).isNotNull(), F.col(key)).otherwise(
                F.raise_error(
                    F.concat(F.lit(f"{key} not in dimension: "), F.col(key).cast("string"))
                ).cast(df.schema[key].dataType)
            ),
        )
        return joined.drop(dim_key), None
    matched = df.join(dim, on, "inner").drop(dim_key)
    if on_orphan == "drop":
        return matched, None
    if on_orphan == "quarantine":
        return matched, df.join(dim, on, "left_anti")
    raise ValueError("on_orphan must be 'quarantine', 'drop' or 'fail'")


def orphan_counts(fact: DataFrame, checks: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """One row; per check, how many fact rows have no partner in a dimension.

    `checks` maps output name to (dimension, fact key, dimension key). The fact is read once and
    counted per combination of its keys; what is joined to the dimensions is those counts.
    """
    columns = list(dict.fromkeys(fact_key for _, fact_key, _ in checks.values()))
    counted = fact.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    missing = []
    for name, (dim, fact_key, dim_key) in checks.items():
        own, known = f"_key_{name}", f"_known_{name}"
        dimension = dim.select(F.col(dim_key).alias(own)).distinct().withColumn(known, F.lit(True))
        counted = counted.join(dimension, F.col(fact_key) == F.col(own), "left")
        orphans = F.sum(F.when(F.col(known).isNull(), F.col("_n")))
        missing.append(F.coalesce(orphans, F.lit(0)).alias(name))
    return counted.agg(*missing)
