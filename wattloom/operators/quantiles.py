"""Exact quantiles by group, of any number of values, without a map or a sort of a group's values.

A sketch gives two values that the wanted rank lies between. One pass counts what is below them and between them,
and the same is done with what is between until few enough rows are left (or the two are equal), whose
rank is then read off. Each round leaves about 4 / ACCURACY of a group's rows, so two or three rounds do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.session import shared_folder

# The sketch's ranks are wrong by a share of 1 / ACCURACY at most.
ACCURACY = 10_000
# Rows of a group that one task may put in order.
FEW = 100_000


def _between() -> Column:
    return F.col("_v").between(F.col("_low"), F.col("_high"))


def quantile_by_group(
    df: DataFrame, by: str, value: str, p: float, name: str = "quantile", accuracy: int = ACCURACY, few: int = FEW
) -> DataFrame:
    """Per group of `by` (NULL is a group): the least value with a share of at least `p` of the group's values at or
    below it. NULL and NaN take no part; a group of nothing else has NULL. Without rows the result is empty.

    There may be any number of groups: what is known of them is joined by size. What is put in order in one task are a
    group's last distinct values with their counts: `few`, or those that no sketch can tell apart.
    """
    if not 0 <= p <= 1:
        raise ValueError("p must be from 0 to 1")
    if accuracy < 5:
        raise ValueError("accuracy must be 5 or more")
    shared_folder(df.sparkSession)
    rows = df.select(F.col(by).alias("_g"), F.col(value).alias("_v"))
    groups = rows.select("_g").distinct()
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    slack, first, settled = 2 / accuracy, True, None
    while True:
        # The wanted rank, as a share of the rows that are left, differs by group from the second round on; the
        # sketch is then asked for a grid of shares and its two neighbours are taken.
        shares = [max(0.0, p - slack), min(1.0, p + slack)] if first else [i / 100 for i in range(101)]
        cuts = rows.groupBy("_g").agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_v").alias("_least"),
            F.max("_v").alias("_most"),
            F.percentile_approx("_v", shares, accuracy).alias("_cuts"),
            *([] if first else [F.first("_rank").alias("_rank")]),
        )
        if first:
            # In decimals, as a double would make 0.1 * 30 more than 3.
            share = F.lit(repr(p)).cast("decimal(20, 18)")
            cuts = cuts.withColumn("_rank", F.greatest(F.lit(1), F.ceil(F.col("_n").cast("decimal(18, 0)") * share).cast("bigint")))
            low, high = F.col("_cuts")[0], F.col("_cuts")[1]
        else:
            at = F.col("_rank") / F.col("_n") * 100
            low = F.get("_cuts", F.floor(at - 1).cast("int"))
            high = F.get("_cuts", F.ceil(at + 1).cast("int"))
        cuts = cuts.select("_g", "_n", "_rank", "_least", "_most", F.coalesce(low, "_least").alias("_low"), F.coalesce(high, "_most").alias("_high"))
        joined = rows.drop("_rank").withColumnRenamed("_g", "_h").join(cuts, F.col("_h").eqNullSafe(F.col("_g")))
        counted = joined.groupBy("_g").agg(
            F.count_if(F.col("_v") < F.col("_low")).alias("_below"),
            F.count_if(_between()).alias("_inside"),
            *[F.first(c).alias(c) for c in ("_n", "_rank", "_least", "_most", "_low", "_high")],
        )
        # Where the sketch should have missed the rank, all rows stay.
        hit = (F.col("_below") < F.col("_rank")) & (F.col("_rank") <= F.col("_below") + F.col("_inside"))
        state = counted.select(
            "_g",
            F.when(hit, F.col("_rank") - F.col("_below")).otherwise(F.col("_rank")).alias("_rank"),
            F.when(hit, F.col("_inside")).otherwise(F.col("_n")).alias("_left"),
            (~hit | (F.col("_inside") == F.col("_n"))).alias("_stuck"),
            F.when(hit, F.col("_low")).otherwise(F.col("_least")).alias("_low"),
            F.when(hit, F.col("_high")).otherwise(F.col("_most")).alias("_high"),
        ).checkpoint()
        rows = (
            rows.drop("_rank").withColumnRenamed("_g", "_h").join(state, F.col("_h").eqNullSafe(F.col("_g")))
            .filter(_between() & (F.col("_low") < F.col("_high"))).select("_g", "_v", "_rank")
        )
        first = False
        # Groups that are done have no rows in the next round.
        done = state.filter(F.col("_low") == F.col("_high")).select("_g", F.col("_low").alias("_v"))
        settled = done if settled is None else settled.unionByName(done)
        more = (F.col("_left") > few) & (F.col("_low") < F.col("_high")) & ~F.col("_stuck")
        if state.filter(more).isEmpty():
            break
    # Equal values are counted before they meet.
    counts = rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n"), F.first("_rank").alias("_rank"))
    upto = F.sum("_n").over(Window.partitionBy("_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("_upto", upto).filter(F.col("_upto") >= F.col("_rank")).groupBy("_g").agg(F.min("_v").alias("_v"))
    known = found.unionByName(settled).withColumnRenamed("_g", "_h")
    return groups.join(known, F.col("_g").eqNullSafe(F.col("_h")), "left").select(F.col("_g").alias(by), F.col("_v").alias(name))
