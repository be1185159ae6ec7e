from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wattloom.operators.keys import upsert_frame
from wattloom.operators.slices import latest_slice
from wattloom.sources.snapshots import Conflict, Snapshots
from wattloom.sources.tables import Tables

SCHEMA = "k INT, day DATE, ingested_at TIMESTAMP, event_id STRING, v INT"


def batch(spark, *data):
    raw = spark.createDataFrame(data, "k INT, day STRING, at STRING, v INT")
    return raw.select(
        "k",
        F.to_date("day").alias("day"),
        F.to_timestamp("at").alias("ingested_at"),
        F.lit("e").alias("event_id"),
        "v",
    )


def files(tables, name):
    names = tables.read(name).select(F.input_file_name().alias("f")).distinct().collect()
    return {r.f for r in names}


def test_round_trip_and_catalog_views(tables):
    df = batch(tables.spark, (1, "2026-01-01", "2026-01-01 00:00:00", 1))
    assert not tables.exists("gold.t")
    tables.overwrite("gold.t", df, "day")
    assert tables.exists("gold.t")
    assert rows(tables.read("gold.t"), *df.columns) == rows(df)
    tables.register_views(["gold.t"])
    assert "gold_t" in [t.name for t in tables.spark.catalog.listTables()]
    described = {r.col_name: r.data_type for r in tables.spark.sql("DESCRIBE gold_t").collect()}
    assert described["day"] == "date"
    tables.spark.catalog.dropTempView("gold_t")


def test_a_table_without_rows_can_be_read_and_extended(tables):
    df = batch(tables.spark, (1, "2026-01-01", "2026-01-01 00:00:00", 1))
    tables.overwrite("gold.t", df.limit(0), "day")
    assert tables.read("gold.t").count() == 0
    tables.upsert("gold.t", df, ["k"], "day")
    assert tables.read("gold.t").count() == 1


def test_overwrite_replaces_the_schema_and_append_widens_it(tables):
    spark = tables.spark
    tables.overwrite("gold.t", spark.range(1).select(F.lit(1).alias("a")))
    tables.overwrite("gold.t", spark.range(1).select(F.lit(1).alias("b")))
    assert tables.read("gold.t").columns == ["b"]
    tables.append("gold.t", spark.range(1).select(F.lit(2).alias("b"), F.lit(3).alias("c")))
    assert rows(tables.read("gold.t"), "b", "c") == [(1, None), (2, 3)]


def test_upsert_updates_inserts_keeps_and_touches_only_its_days(tables):
    spark = tables.spark
    first = batch(
        spark,
        (1, "2026-01-01", "2026-01-01 00:00:00", 10),
        (2, "2026-01-01", "2026-01-01 00:00:00", 20),
        (3, "2026-01-02", "2026-01-02 00:00:00", 30),
    )
    tables.upsert("s.t", first, ["k"], "day")
    untouched = {f for f in files(tables, "s.t") if "2026-01-02" in f}
    second = batch(
        spark,
        (1, "2026-01-01", "2026-01-03 00:00:00", 11),
        (2, "2026-01-01", "2025-12-31 00:00:00", 19),
        (4, "2026-01-05", "2026-01-05 00:00:00", 40),
    )
    want = [(1, 11), (2, 20), (3, 30), (4, 40)]
    for _ in range(2):  # a replay changes nothing
        tables.upsert("s.t", second, ["k"], "day")
        assert rows(tables.read("s.t"), "k", "v") == want
    assert {f for f in files(tables, "s.t") if "2026-01-02" in f} == untouched


def test_upsert_needs_a_date_partition(tables):
    df = batch(tables.spark, (1, "2026-01-01", "2026-01-01 00:00:00", 1))
    with pytest.raises(ValueError, match="must be a date"):
        tables.upsert("s.t", df.withColumn("day", F.lit("x")), ["k"], "day")


def test_only_the_days_asked_for_are_listed(tables):
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    tables.upsert("s.t", batch(tables.spark, *[(i, d, f"{d} 00:00:00", i) for i, d in enumerate(days)]), ["k"], "day")
    some = tables.read("s.t", ["2026-01-02", "2027-01-01"])
    assert rows(some, "k") == [(1,)]
    assert all("day=2026-01-02" in f for f in some.inputFiles())
    assert tables.read("s.t", []).count() == 0


def test_rows_without_a_day_are_merged(tables):
    def undated(k, v):
        return batch(tables.spark, (k, "2026-01-01", "2026-01-01 00:00:00", v)).withColumn("day", F.lit(None).cast("date"))

    tables.upsert("s.t", batch(tables.spark, (0, "2026-01-01", "2026-01-01 00:00:00", 0)), ["k"], "day")
    for k in (1, 2):
        tables.upsert("s.t", undated(k, 10 * k), ["k"], "day")
    assert rows(tables.read("s.t"), "k", "day", "v") == sorted(
        [(0, date(2026, 1, 1), 0), (1, None, 10), (2, None, 20)], key=repr
    )


def test_the_newest_day_comes_from_folder_names(tables):
    assert tables.day("s.t", "day").since is None
    days = ["2025-12-31", "2026-01-02", "2026-01-01"]
    tables.overwrite("s.t", batch(tables.spark, *[(i, d, f"{d} 05:00:00", i) for i, d in enumerate(days)]), "day")
    day = tables.day("s.t", "day")
    assert (day, day.since) == ("day", date(2026, 1, 2))
    newest = latest_slice(tables.read("s.t"), "ingested_at", day)
    assert rows(newest, "k") == [(1,)]
    assert "max(day" not in plan(newest)
    assert plan(newest).count("PartitionFilters: [isnotnull(day") == plan(newest).count("PartitionFilters") > 1


def test_replacing_a_run_does_not_repeat_it(tables):
    spark = tables.spark
    for run, n in (("a", 2), ("b", 1), ("a", 2)):
        log = spark.range(n).withColumn("run_id", F.lit(run))
        tables.replace_partitions("quarantine.t", log, "run_id")
    assert rows(tables.read("quarantine.t").groupBy("run_id").count()) == [("a", 2), ("b", 1)]


def test_append_newer_goes_by_entity(tables):
    def hours(**upto):
        pairs = [(e, h) for e, n in upto.items() for h in range(n)]
        return tables.spark.createDataFrame(pairs, "e STRING, h INT")

    for part in (hours(fr=4, de=2), hours(fr=5, de=5), hours(fr=5, de=5, it=1)):
        tables.append_newer("gold.t", part, "h", "e")
    want = [("de", h) for h in range(5)] + [("fr", h) for h in range(5)] + [("it", 0)]
    assert rows(tables.read("gold.t")) == want


def test_a_column_keeps_its_type(tables):
    spark = tables.spark
    narrow = spark.range(2).select(F.col("id").cast("int").alias("n"), F.to_date(F.lit("2026-01-01")).alias("day"))
    wide = narrow.withColumn("n", F.col("n").cast("bigint"))
    tables.append("s.t", narrow, "day")
    for write in (
        lambda: tables.append("s.t", wide, "day"),
        lambda: tables.replace_partitions("s.t", wide, "day"),
        lambda: tables.upsert("s.t", wide, ["n"], "day", ["n"]),
    ):
        with pytest.raises(ValueError, match="is int, not bigint"):
            write()
    tables.append("s.t", narrow.withColumn("more", F.lit("x")), "day")
    assert rows(tables.read("s.t"), "n", "more") == sorted([(0, None), (1, None), (0, "x"), (1, "x")], key=repr)


def test_readers_see_a_version_until_the_switch(tables, monkeypatch):
    spark, day = tables.spark, "2026-01-01"
    tables.upsert("s.t", batch(spark, *[(k, day, f"{day} 00:00:00", k) for k in range(5)]), ["k"], "day")
    before = tables.read("s.t")
    old = [(k, k) for k in range(5)]
    seen = []

    def dies(self, manifest):
        # All files are written, and nothing has happened to the table.
        seen.append(rows(Tables(spark, tables.root).read("s.t"), "k", "v"))
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(Snapshots, "_put", dies)
        tables.upsert("s.t", batch(spark, (1, day, "2026-01-02 00:00:00", 11)), ["k"], "day")
    assert seen == [old] == [rows(before, "k", "v")]
    other = Tables(spark, tables.root)  # as a new run, with a batch of its own
    other.upsert("s.t", batch(spark, (7, "2026-02-01", "2026-02-01 00:00:00", 7)), ["k"], "day")
    other.upsert("s.t", batch(spark, (2, day, "2026-01-02 00:00:00", 22)), ["k"], "day")
    assert rows(other.read("s.t"), "k", "v") == [(0, 0), (1, 1), (2, 22), (3, 3), (4, 4), (7, 7)]
    assert rows(before, "k", "v") == old, "a frame stays on its version"


def test_two_writers(tables, monkeypatch):
    """Of two upserts at once the second builds on the first, unless both touch one day."""
    spark = tables.spark
    one = lambda k, d, v: batch(spark, (k, d, "2026-01-05 00:00:00", v))
    tables.upsert("s.t", one(0, "2026-01-01", 0), ["k"], "day")
    real = Tables._commit

    def late(rows_of_other):
        def commit(self, *args, **kwargs):
            monkeypatch.setattr(Tables, "_commit", real)
            Tables(spark, self.root).upsert("s.t", rows_of_other, ["k"], "day")
            return real(self, *args, **kwargs)

        monkeypatch.setattr(Tables, "_commit", commit)

    late(one(1, "2026-01-02", 1))
    tables.upsert("s.t", one(2, "2026-01-03", 2), ["k"], "day")
    assert rows(tables.read("s.t"), "k", "v") == [(0, 0), (1, 1), (2, 2)]
    late(one(3, "2026-01-03", 3))
    with pytest.raises(Conflict):
        tables.upsert("s.t", one(4, "2026-01-03", 4), ["k"], "day")
    assert rows(tables.read("s.t"), "k", "v") == [(0, 0), (1, 1), (2, 2), (3, 3)]


def test_the_ledger_and_expiry(tables):
    spark = tables.spark
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    tables.overwrite("s.t", batch(spark, *[(i, d, f"{d} 00:00:00", i) for i, d in enumerate(days)]), "day")
    first, changed = tables.changed_days("s.t")
    assert changed == days
    assert tables.changed_days("s.t", first) == (first, [])
    tables.replace_partitions("s.t", batch(spark, (9, days[0], f"{days[0]} 00:00:00", 9)), "day", days=days[:2])
    assert tables.changed_days("s.t", first) == (first + 1, days[:2])
    assert rows(tables.read("s.t"), "k") == [(2,), (9,)]
    tables.append("s.t", batch(spark, (5, days[2], f"{days[2]} 00:00:00", 5)), "day")
    assert tables.changed_days("s.t", first + 1)[1] == days[2:]
    tables.overwrite("s.t", batch(spark, (8, days[1], f"{days[1]} 00:00:00", 8)), "day")
    assert tables.snapshots("s.t").expire(keep=1) == 3
    assert rows(tables.read("s.t"), "k") == [(8,)]
    assert tables.changed_days("s.t", first)[1] == days


def test_dates_before_the_common_era_are_upserted_too(tables):
    old = F.date_from_unix_date(F.lit(-800_000))
    for k in (1, 2):
        df = batch(tables.spark, (k, "2026-01-01", "2026-01-01 00:00:00", k)).withColumn("day", old)
        tables.upsert("s.t", df, ["k"], "day")
    assert rows(tables.read("s.t"), "k") == [(1,), (2,)]
