import pytest
from pyspark.sql import functions as F

from tidemark.functions import count_rows
from tidemark.sources.table import Table
from tidemark.streaming.refresh import Part, RefreshOptions, add_up, event_day, event_stream, keep_fresh, stream_into


@pytest.fixture
def feed(spark, path):
    """A folder that grows, and a stream over it."""
    folder = path("feed")
    make = lambda lo, hi: spark.range(lo, hi).select(
        "id", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts")
    ).coalesce(1)
    make(0, 60).write.mode("append").parquet(folder)
    return make, folder


def test_refresh_over_several_runs(spark, path, feed):
    make, folder = feed
    target, checkpoint = Table(spark, path()), path("state")

    def refresh():
        stream = event_stream(spark, folder, make(0, 1).schema, "ts", files_per_batch=1).withColumn("day", F.to_date("ts"))
        keep_fresh(stream, ["day"], {"n": count_rows()}, target, RefreshOptions("DOWNSTREAM"), checkpoint, once=True).awaitTermination()

    refresh()
    make(60, 100).write.mode("append").parquet(folder)
    make(10, 20).write.mode("append").parquet(folder)  # late rows still count
    refresh()
    wanted = make(0, 100).unionByName(make(10, 20)).groupBy(F.to_date("ts").alias("day")).agg(count_rows().alias("n"))
    got = target.read().select("day", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_stream_appends_each_epoch_once(spark, path, feed):
    make, folder = feed
    target, checkpoint = Table(spark, path()), path("state")
    for _ in range(2):
        stream = event_stream(spark, folder, make(0, 1).schema, "ts").select("id")
        stream_into(stream, target, checkpoint).awaitTermination()
    assert target.read().count() == 60
    assert target.last_tag(checkpoint) == 0


def test_options():
    RefreshOptions("5 minutes", "full", "on_create")
    for bad in (("", "AUTO", "ON_CREATE"), ("soon", "AUTO", "ON_CREATE"), ("1 minute", "SOME", "ON_CREATE"), ("1 minute", "AUTO", "NEVER")):
        with pytest.raises(ValueError):
            RefreshOptions(*bad)


def test_on_schedule_waits(spark, path, feed):
    make, folder = feed
    stream = event_stream(spark, folder, make(0, 1).schema, "ts")
    assert keep_fresh(stream, ["ts"], {"n": count_rows()}, Table(spark, path()), RefreshOptions("1 day", "AUTO", "ON_SCHEDULE"), path("state")) is None


def test_a_watermark_releases_state(spark, path, feed):
    make, folder = feed
    for lo in (60, 200, 400):
        make(lo, lo + 40).write.mode("append").parquet(folder)
    target, checkpoint = Table(spark, path()), path("state")
    stream = event_stream(spark, folder, make(0, 1).schema, "ts", late="1 day", files_per_batch=1)
    query = keep_fresh(stream, {"day": event_day("ts")}, {"n": count_rows()}, target, RefreshOptions("DOWNSTREAM"), checkpoint, once=True)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    days = target.read().count()
    assert held[-1] < days and held[-1] < max(held)
    assert sum(r.n for r in target.read().collect()) == 180


def test_parts_are_added_up_in_slots(spark, path, feed):
    make, folder = feed
    target, checkpoint = Table(spark, path(), "slot"), path("state")
    measures = {"n": Part(count_rows()), "low": Part(F.min("id"), F.min), "high": Part(F.max("id"), F.max)}

    def refresh():
        stream = event_stream(spark, folder, make(0, 1).schema, "ts", files_per_batch=1).withColumn("day", F.to_date("ts"))
        keep_fresh(stream, ["day"], measures, target, RefreshOptions("DOWNSTREAM"), checkpoint, once=True, slots=8).awaitTermination()

    refresh()
    make(60, 100).write.mode("append").parquet(folder)
    make(10, 20).write.mode("append").parquet(folder)  # late rows still count
    refresh()
    rows = make(0, 100).unionByName(make(10, 20))
    wanted = rows.groupBy(F.to_date("ts").alias("day")).agg(count_rows().alias("n"), F.min("id"), F.max("id"))
    assert sorted(map(tuple, target.read().select("day", "n", "low", "high").collect())) == sorted(map(tuple, wanted.collect()))
    with pytest.raises(ValueError):
        keep_fresh(make(0, 1), ["id"], measures, Table(spark, path()), RefreshOptions("DOWNSTREAM"), checkpoint)


def test_a_trigger_rewrites_its_own_slots(spark, path, rows):
    target, keys = Table(spark, path(), "slot"), {"k": F.col("k"), "g": F.col("g")}
    parts = {"n": Part(count_rows()), "total": Part(F.sum("v"))}
    first = spark.range(500).select((F.col("id") % 50).alias("k"), F.when(F.col("id") % 3 != 0, "x").alias("g"), F.col("id").alias("v"))
    add_up(target, first, keys, parts, 16, ("stream", 0))
    before, version = target.commit_info()["parts"], target.version()
    assert len(before) == 16
    one = rows("k long, g string, v long", (7, None, 5), (7, None, 6))
    add_up(target, one, keys, parts, 16, ("stream", 1))
    after = target.commit_info()["parts"]
    assert sum(before[n] != after[n] for n in after) == 1 and target.version() == version + 1
    assert add_up(target, one, keys, parts, 16, ("stream", 1)) == version + 1  # a replayed epoch
    assert add_up(target, one, keys, parts, 16, ("other stream", 0)) == version + 2
    wanted = first.unionByName(one).unionByName(one).groupBy("k", "g").agg(count_rows().alias("n"), F.sum("v").alias("total"))
    key = lambda r: (r.k, r.g or "")
    assert sorted(target.read().select("k", "g", "n", "total").collect(), key=key) == sorted(wanted.collect(), key=key)
