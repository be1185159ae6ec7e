"""Exact quantiles against sorting, and profiles that are kept by day."""

from math import ceil

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wattloom.operators.quantiles import quantile_by_group
from wattloom.plans.profiles import profile_name, profile_sketched, refresh_profile
from wattloom.plans.refresh import DAY


@pytest.mark.parametrize(("p", "accuracy", "few"), [(0.5, 10_000, 100_000), (0.1, 20, 10), (0.0, 50, 1), (1.0, 50, 1), (0.97, 7, 5)])
def test_quantiles_equal_sorting(spark, p, accuracy, few):
    spread = [("spread", (i * 7919) % 3001 / 8) for i in range(3001)]
    ties = [("ties", float(i % 3)) for i in range(900)] + [("one", 4.0)] * 500 + [(None, 1.5), (None, -2.0)]
    held = [("nothing", None), ("nothing", float("nan")), ("odd", None), ("odd", float("nan")), ("odd", 9.0), ("odd", float("-inf"))]
    df = spark.createDataFrame(spread + ties + held, "entity string, v double").repartition(5)
    expected = {}
    for entity, v in spread + ties + held:
        expected.setdefault(entity, []).extend([] if v is None or v != v else [v])
    wanted = [(e, sorted(v)[max(ceil(round(p * len(v), 9)), 1) - 1] if v else None) for e, v in expected.items()]
    found = quantile_by_group(df, "entity", "v", p, accuracy=accuracy, few=few)
    assert rows(found) == sorted(wanted, key=repr)


def test_quantiles_of_whole_numbers_and_of_no_rows(spark):
    df = spark.range(1001).select(F.lit("a").alias("k"), F.col("id").alias("quantile"))
    assert rows(quantile_by_group(df, "k", "quantile", 0.25)) == [("a", 250)]
    assert rows(quantile_by_group(df.limit(0), "k", "quantile", 0.25)) == []
    with pytest.raises(ValueError):
        quantile_by_group(df, "k", "quantile", 1.5)


def test_profiles_follow_the_ledger(spark, tables):
    whole = spark.range(4000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias(DAY),
        F.timestamp_seconds(1704067200 + F.col("id") % 4 * 86400 + F.col("id")).alias("ts"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 700).alias("k"),
        (F.col("id") % 3).alias("j"),
    )
    distinct = {"pairs": ["k", "j"], "k": ["k"]}

    def brought(name="silver.t", of=distinct):
        return refresh_profile(tables, name, "ts", of).days

    def near(df):
        merged = profile_sketched(tables, "silver.t").first()
        seen = df.agg(F.count(F.lit(1)), F.min("ts"), F.max("ts"), F.count_distinct("k", "j"), F.count_distinct("k")).first()
        assert tuple(merged)[:3] == tuple(seen)[:3]
        assert all(abs(a - b) <= 0.03 * b for a, b in zip(tuple(merged)[3:], tuple(seen)[3:], strict=True))

    tables.overwrite("silver.t", whole, DAY)
    assert brought() is None
    near(whole)
    assert brought() == []
    # One day shrinks, another one goes: no other day is read or written.
    fewer = whole.filter((F.col(DAY) != "2024-01-03") & ((F.col(DAY) != "2024-01-02") | (F.col("j") == 1)))
    tables.replace_partitions("silver.t", fewer.filter(F.col(DAY) == "2024-01-02"), DAY, days=["2024-01-03"])
    assert brought() == ["2024-01-02", "2024-01-03"]
    near(fewer)
    assert profile_sketched(tables, "silver.t", ["2024-01-01"]).first().row_count == 1000
    # The table itself is not looked at.
    files = profile_sketched(tables, "silver.t").inputFiles()
    assert files and all("profiles" in f for f in files)
    # Other sketches: from the beginning.
    assert brought(of={"j": ["j"]}) is None
    assert profile_sketched(tables, "silver.t").first().j == 3
    tables.overwrite("silver.none", whole.limit(0), DAY)
    brought("silver.none")
    assert tuple(profile_sketched(tables, "silver.none").first()) == (0, None, None, 0, 0)
    assert rows(tables.read(profile_name("silver.none"))) == []
