"""Rows dealt out before they are widened, and tables written without another shuffle."""

from pyspark.sql import functions as F

from tests.conftest import SF, plan, rows
from verification import fixtures as fx
from verification.lake import Lake, Layers, bronze_rows
from wattloom.functions import instants
from wattloom.functions.envelopes import measurement_date
from wattloom.operators.slices import clustered
from wattloom.plans import refresh
from wattloom.session import shared_folder
from wattloom.sources import bronze
from wattloom.sources.feeds import CARBON, WEATHER


def shuffled_bytes(spark, before):
    """Bytes that stages after `before` wrote to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    found = [stages.apply(i) for i in range(stages.size())]
    return sum(s.shuffleWriteBytes() for s in found if s.stageId() > before)


def last_stage(spark):
    spark.range(1).count()
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return max(stages.apply(i).stageId() for i in range(stages.size()))


def test_tasks_are_bounded_ranges_and_lose_no_row(spark):
    one_moment = spark.range(40_000).select(F.lit("2026-01-01").alias("ts"), F.col("id").alias("event_id"))
    dealt = clustered(one_moment, "ts", "event_id", rows=1_000)
    sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) >= 30 and max(sizes) < 3_000
    assert clustered(one_moment.limit(0), "ts", "event_id").count() == 0


def test_bronze_is_written_without_shuffling_envelopes(spark, tmp_path):
    lake = Lake(spark, SF, f"{shared_folder(spark)}/tests/{tmp_path.name}-{id(tmp_path)}")
    before = last_stage(spark)
    got = lake.bronze(CARBON)
    narrow = shuffled_bytes(spark, before)
    wide = got.agg(F.sum(F.length("envelope_json"))).first()[0]
    # Envelopes are some 600 bytes each, of which a shuffle's compression leaves a fifth or more.
    assert narrow < wide / 10
    columns = ["offset", "event_date", "envelope_json"]
    assert rows(got, *columns) == rows(Layers(spark, SF).bronze(CARBON), *columns)


def test_quarantine_is_written_where_its_rows_are(spark, tables):
    # Each of these lacks its temperature or its message's end.
    bad = bronze_rows(fx.events(spark, SF).filter("event_id % 79 = 0"), WEATHER)
    tables.overwrite("bronze.only_bad", bad)
    before = last_stage(spark)
    refresh.refresh_silver(tables, WEATHER, tables.read("bronze.only_bad"), "run")
    shuffled = shuffled_bytes(spark, before)
    rejected = tables.read("quarantine.weather")
    assert rejected.count() == bad.count() > 100
    assert shuffled < rejected.agg(F.sum(F.length("envelope_json"))).first()[0] / 10


def test_an_upsert_computes_its_source_once(tables):
    spark = tables.spark
    day = spark.range(50).select(F.col("id").alias("k"), F.to_date(F.lit("2026-01-01")).alias("day"), F.col("id").alias("ingested_at"))
    tables.upsert("s.once", day, ["k"], "day")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    newer = day.withColumn("ingested_at", F.col("ingested_at") + 100).mapInArrow(count, day.schema)
    tables.upsert("s.once", newer, ["k"], "day")
    assert seen.value == 50
    assert rows(tables.read("s.once"), "k", "ingested_at") == sorted(((k, k + 100) for k in range(50)), key=repr)
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{tables.root}/staging/upserts")
    assert not staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(staged)


def test_a_backfill_is_summed_up_without_json(spark):
    found = bronze.backfill_rows(fx.carbon_enveloped(fx.events(spark, SF)), CARBON.topic)
    assert "to_json" not in plan(bronze.backfill_summary(found)).lower()
    dates = found.select("event_date", measurement_date(F.col("envelope_json")).alias("of_json"))
    broken = dates.filter("of_json IS NULL")
    assert broken.count() > 0 and dates.filter("of_json <> event_date").isEmpty()
    assert broken.filter("event_date <> current_date()").isEmpty()


def test_only_the_format_that_can_fit_is_tried(spark):
    texts = ["2026-05-14T01:30Z", "2026-05-14T01:30:05Z", "2026-05-14T01:30:Z", "a:b:c", "a:b", ":", "", "+12026-05-14T01:30Z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    both = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in instants.SETTLEMENT_FORMATS])
    one = instants.settlement_instant(F.col("t"))
    assert df.filter(~one.cast("string").eqNullSafe(both.cast("string"))).isEmpty()
    assert "coalesce(try_to_timestamp" not in plan(df.select(one)).lower()
