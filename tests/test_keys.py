from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tests.conftest import plan, rows
from wattloom.operators import keys

SCHEMA = "k INT, ingested_at TIMESTAMP, event_id STRING, v INT"
moments = st.datetimes(datetime(2026, 1, 1), datetime(2026, 1, 2))
batches = st.lists(st.tuples(st.integers(0, 3), moments, st.text("ab", min_size=1, max_size=2), st.integers(0, 9)), max_size=8)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def expected(data):
    best = {}
    for row in data:
        if row[0] not in best or row[1:3] > best[row[0]][1:3]:
            best[row[0]] = row
    return {k: r[1:3] for k, r in best.items()}


def winners(df):
    return {r.k: (r.ingested_at, r.event_id) for r in df.collect()}


quick = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@quick
@given(batches)
def test_dedup_keeps_the_greatest_order_key(spark, data):
    got = keys.latest_per_key(frame(spark, data), ["k"])
    assert winners(got) == expected(data)
    assert got.count() == len({r[0] for r in data})


@quick
@given(batches, batches)
def test_upsert_is_idempotent_and_ignores_batch_order(spark, a, b):
    empty = frame(spark, [])
    once = keys.upsert_frame(keys.upsert_frame(empty, frame(spark, a), ["k"]), frame(spark, b), ["k"])
    other = keys.upsert_frame(keys.upsert_frame(empty, frame(spark, b), ["k"]), frame(spark, a), ["k"])
    again = keys.upsert_frame(once, frame(spark, b), ["k"])
    assert winners(once) == winners(other) == winners(again) == expected(a + b)


def test_ties_are_broken_by_event_id(spark, ts):
    at = ts("2026-01-01T00:00:00")
    df = frame(spark, [(1, at, "a", 1), (1, at, "c", 3), (1, at, "b", 2)])
    assert keys.latest_per_key(df, ["k"]).first().v == 3


def test_older_batch_does_not_overwrite(spark, ts):
    target = frame(spark, [(1, ts("2026-01-02T00:00:00"), "a", 2), (2, ts("2026-01-01T00:00:00"), "a", 5)])
    late = frame(spark, [(1, ts("2026-01-01T00:00:00"), "z", 1), (3, ts("2026-01-01T00:00:00"), "a", 7)])
    assert rows(keys.upsert_frame(target, late, ["k"]), "k", "v") == [(1, 2), (2, 5), (3, 7)]


def test_source_may_add_columns(spark, ts):
    at = ts("2026-01-01T00:00:00")
    wider = spark.createDataFrame([(2, at, "a", 2, "new")], SCHEMA + ", extra STRING")
    got = keys.upsert_frame(frame(spark, [(1, at, "a", 1)]), wider, ["k"])
    assert rows(got, "k", "extra") == [(1, None), (2, "new")]


def test_copies_of_a_hot_key_are_cut_before_the_shuffle(spark, ts):
    df = frame(spark, [(1, ts("2026-01-01T00:00:00"), str(i), i) for i in range(50)]).repartition(4)
    text = plan(keys.latest_per_key(df, ["k"]))
    partial = text.index("Partial")
    assert text.index("WindowGroupLimit") < partial
    assert "Exchange hashpartitioning(k" in text[:partial], "the per-partition limit sits below the shuffle"


def dims(spark):
    return (
        spark.createDataFrame([("x", 1), ("y", 2), ("q", 3)], "code STRING, v INT"),
        spark.createDataFrame([("x", "X"), ("y", "Y")], "dim_code STRING, name STRING"),
    )


def test_orphans_are_quarantined_dropped_or_fatal(spark):
    df, dim = dims(spark)
    matched, orphans = keys.match_dimension(df, dim, "code", "dim_code")
    assert rows(matched, "code", "name") == [("x", "X"), ("y", "Y")]
    assert rows(orphans) == [("q", 3)]
    dropped, none = keys.match_dimension(df, dim, "code", "dim_code", "drop")
    assert none is None and dropped.count() == 2
    failing, _ = keys.match_dimension(df, dim, "code", "dim_code", "fail")
    with pytest.raises(PySparkException, match="code not in dimension: q"):
        failing.collect()
    passing, _ = keys.match_dimension(df.filter("code <> 'q'"), dim, "code", "dim_code", "fail")
    assert rows(passing, "code", "name") == [("x", "X"), ("y", "Y")]
    with pytest.raises(ValueError):
        keys.match_dimension(df, dim, "code", "dim_code", "shrug")


def test_orphan_counts_count_rows_not_keys(spark):
    df, dim = dims(spark)
    counts = keys.orphan_counts(df.union(df), {"orphans": (dim, "code", "dim_code")})
    assert counts.first().orphans == 2
