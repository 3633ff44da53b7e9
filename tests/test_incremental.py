import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import incremental as inc
from tidemark.sources.table import CommitConflict, Table

SCHEMA = "k int, day date, v int, stamp int"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def start(spark, rows, path):
    def build(partition_by="day"):
        table = Table(spark, path(), partition_by)
        table.overwrite(rows(SCHEMA, *[(i, day(1 + i % 5), i, 1) for i in range(50)]))
        return table

    return build


def state(table):
    return sorted(tuple(r) for r in table.read().select("k", "day", "v", "stamp").collect())


def test_merge_is_idempotent_and_never_deletes(start, rows):
    table = start()
    batch = rows(SCHEMA, (3, day(4), 300, 2), (99, day(9), 99, 2))
    inc.merge(table, batch, "k", update_columns=["v", "stamp"])
    once = state(table)
    inc.merge(table, batch, "k", update_columns=["v", "stamp"])
    assert state(table) == once
    assert len(once) == 51 and (3, day(4), 300, 2) in once


def test_merge_rewrites_only_touched_partitions(start, rows):
    table = start()
    before = table.commit_info()["parts"]
    inc.merge(table, rows(SCHEMA, (3, day(4), 300, 2)), "k")
    after = table.commit_info()["parts"]
    assert [n for n in before if before[n] != after[n]] == ["day=2024-01-04"]


def test_merge_moves_a_row_whose_partition_value_changed(start, rows):
    table = start()
    inc.merge(table, rows(SCHEMA, (3, day(20), 3, 2)), "k")
    assert [r for r in state(table) if r[0] == 3] == [(3, day(20), 3, 2)]


def test_merge_refuses_duplicate_keys(start, rows):
    with pytest.raises(inc.DuplicateKeys):
        inc.merge(start(), rows(SCHEMA, (1, day(1), 1, 2), (1, day(1), 2, 2)), "k")


def test_latest_per_key_makes_a_batch_unique(start, rows):
    batch = rows(SCHEMA, (1, day(1), 1, 2), (1, day(1), 2, 3))
    assert [tuple(r) for r in inc.latest_per_key(batch, "k", "stamp").collect()] == [(1, day(1), 2, 3)]


def test_merge_window(start, rows):
    batch = rows(SCHEMA, (0, day(1), 7, 2))
    with pytest.raises(inc.OutsideWindow):
        inc.merge(start(), batch, "k", since=day(3))
    table = start()
    inc.merge(table, batch, "k", since=day(3), outside="insert")
    assert len([r for r in state(table) if r[0] == 0]) == 2


def test_watermark_is_strict_unless_asked(start, rows):
    table = start()
    late = rows(SCHEMA, (70, day(1), 1, 1), (71, day(1), 1, 2))
    assert [r.k for r in inc.newer_rows(late, table, "stamp").collect()] == [71]
    assert inc.newer_rows(late, table, "stamp", inclusive=True).count() == 2


def test_append_only_table_refuses_a_full_refresh(start, rows):
    with pytest.raises(ValueError):
        inc.append(start(), rows(SCHEMA, (1, day(1), 1, 1)), full_refresh=True)


def test_append_new_columns_never_drops(start, rows):
    table = start()
    inc.append(table, rows("k int, day date, extra string", (90, day(1), "x")))
    assert table.read().columns == ["k", "day", "v", "stamp", "extra"]
    assert table.read().where("extra IS NULL").count() == 50
    assert table.read().where("v IS NULL").count() == 1


def test_sync_all_columns_drops(start, rows):
    table = start(None)
    inc.merge(table, rows("k int, day date, extra string", (90, day(1), "x")), "k", on_schema_change="sync_all_columns")
    assert table.read().columns == ["k", "day", "extra"]
    assert table.read().count() == 51


def test_new_columns_fail_by_default(start, rows):
    with pytest.raises(ValueError):
        inc.merge(start(), rows("k int, day date, extra string", (90, day(1), "x")), "k")


def test_delete_insert_replaces_all_rows_of_a_key(start, rows):
    for partition_by in ("day", None):
        table = start(partition_by)
        inc.delete_insert(table, rows(SCHEMA, (1000, day(2), 0, 9)), "day")
        assert [r for r in state(table) if r[1] == day(2)] == [(1000, day(2), 0, 9)]
        assert len(state(table)) == 41


def test_delete_insert_rewrites_only_touched_partitions(start, rows):
    table = start()
    before = table.commit_info()["parts"]
    inc.delete_insert(table, rows(SCHEMA, (2, day(9), 0, 9), (7, day(3), 0, 9), (None, day(9), 0, 9)), "k")
    after = table.commit_info()["parts"]
    assert sorted(n for n in after if before.get(n) != after[n]) == ["day=2024-01-03", "day=2024-01-09"]
    assert len(table.read().where("k IN (2, 7)").collect()) == 2 and table.read().count() == 51
    parts = table.commit_info()["parts"]
    inc.delete_insert(table, rows(SCHEMA, (500, day(1), 0, 9)), "k")
    assert {n: d for n, d in table.commit_info()["parts"].items() if n != "day=2024-01-01"} == {
        n: d for n, d in parts.items() if n != "day=2024-01-01"
    }
    assert table.read().where("day = DATE '2024-01-01'").count() == 11


@pytest.mark.parametrize("kind", ["int", "string", "double", "date", "timestamp_ntz", "timestamp", "binary", "decimal(9,2)"])
def test_keys_of_any_type_meet_within_their_bounds(start, rows, kind):
    def typed(df):
        k = F.date_add(F.lit("2024-01-01").cast("date"), F.col("k")) if kind in ("date", "timestamp_ntz", "timestamp") else F.col("k")
        return df.withColumn("k", (k.cast("string") if kind == "binary" else k).cast(kind))

    stored = typed(rows(SCHEMA, *[(i, day(1), i, 1) for i in range(50)]))
    batch = typed(rows(SCHEMA, (7, day(1), 0, 1), (30, day(1), 0, 1), (99, day(1), 0, 1)))
    assert inc.between_keys(stored, batch, "k").join(batch.select("k"), "k", "left_semi").count() == 2


def test_bounds_of_the_keys_reach_the_scan(start, rows):
    table, batch = start(), rows(SCHEMA, (3, day(4), 300, 2), (8, day(4), 300, 2))
    plan = inc.between_keys(table.read(), batch, "k")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,3)" in plan and "LessThanOrEqual(k,8)" in plan
    # Text keys against stored numbers: the order of the texts is not that of the numbers.
    texts = batch.withColumn("k", F.col("k").cast("string"))
    assert inc.between_keys(table.read(), texts, "k").count() == 50
    assert inc.between_keys(table.read(), batch.limit(0), "k").count() == 0


def test_insert_overwrite_modes(start, rows):
    batch = rows(SCHEMA, (1000, day(2), 0, 9))
    table = start()
    inc.insert_overwrite(table, batch, "partitions")
    assert len(state(table)) == 41
    inc.insert_overwrite(table, batch, "table")
    assert len(state(table)) == 1


def test_microbatches_add_up_to_one_load(spark, rows, path):
    events = spark.range(200).select(
        F.col("id"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts")
    ).withColumn("day", F.to_date("ts"))
    stepwise = Table(spark, path(), "day")
    begin = dt.datetime(2024, 1, 1)
    for stop in (3, 6, 12):
        inc.microbatch(stepwise, events, "ts", begin, dt.datetime(2024, 1, stop), look_back=2)
    assert sorted(r.id for r in stepwise.read().collect()) == list(range(200))
    inc.load_window(stepwise, events, "ts", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))
    assert stepwise.read().count() == 200


def test_batch_windows_are_half_open():
    windows = list(inc.batch_windows(dt.datetime(2024, 1, 31, 5), dt.datetime(2024, 3, 1), "month"))
    assert windows == [(dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)), (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))]


def test_concurrent_publish_conflicts(start, rows):
    table = start()
    base = table.version()
    staged = table.stage(rows(SCHEMA, (1, day(1), 1, 1)))
    table.append(rows(SCHEMA, (500, day(1), 1, 1)))
    with pytest.raises(CommitConflict):
        table.publish(staged, base=base)


def test_readers_keep_their_version_and_restore(start, rows):
    table = start()
    first = table.version()
    old = table.read()
    table.overwrite(rows(SCHEMA, (1, day(1), 1, 1)))
    assert old.count() == 50 and table.read().count() == 1
    table.restore(first)
    assert table.read().count() == 50
    table.vacuum(keep=1)
    assert table.read().count() == 50


def test_null_partition_value(spark, rows, path):
    table = Table(spark, path(), "day")
    table.overwrite(rows(SCHEMA, (1, None, 1, 1), (2, day(1), 1, 1)))
    inc.merge(table, rows(SCHEMA, (1, None, 5, 2)), "k")
    assert sorted((r.k, r.day, r.v) for r in table.read().collect()) == [(1, None, 5), (2, day(1), 1)]


def test_compact_merges_small_writes(start, rows):
    table = start()
    for i in range(3):
        table.append(rows(SCHEMA, (100 + i, day(1), 0, 1)))
    before = state(table)
    table.compact()
    assert state(table) == before
    assert all(len(dirs) == 1 for dirs in table.commit_info()["parts"].values())


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["x:1", "a/b", "100%", "plain", None]),
        ("boolean", ["true", "false", None]),
        ("int", ["9", "10", "-3", None]),
        ("timestamp", ["2024-01-01 10:30:00", "2024-01-02 00:00:00.5", None]),
        ("timestamp_ntz", ["2024-01-01 10:30:00", "2024-01-02 00:00:00", None]),
        ("date", ["2024-01-01", "2024-01-31", None]),
        ("decimal(5,2)", ["1.50", "10.00", None]),
    ],
)
def test_merge_finds_rows_in_partitions_of_any_type(spark, rows, path, kind, values):
    data = rows("k int, p string, v int", *[(i, p, 0) for i, p in enumerate(values * 2)])
    table = Table(spark, path(), "p")
    inc.merge(table, data.withColumn("p", F.col("p").cast(kind)), "k")
    inc.merge(table, data.withColumn("p", F.col("p").cast(kind)).withColumn("v", F.lit(1)), "k")
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(i, 1) for i in range(2 * len(values))]


def test_since_is_compared_in_the_type_of_the_column(spark, rows, path):
    table = Table(spark, path(), "p")
    inc.merge(table, rows("k int, p int", (1, 9), (2, 10)), "k")
    inc.merge(table, rows("k int, p int", (2, 11)), "k", since=9)
    assert sorted(map(tuple, table.read().select("k", "p").collect())) == [(1, 9), (2, 11)]


def test_partitions_that_cannot_be_named_are_refused(spark, rows, path):
    with pytest.raises(ValueError):
        Table(spark, path(), "p").overwrite(rows("k int, p double", (1, 0.5)))
    with pytest.raises(Exception, match="empty text"):
        Table(spark, path(), "p").overwrite(rows("k int, p string", (1, "")))


def test_merge_refuses_rows_without_a_key(start, rows):
    with pytest.raises(inc.NullKeys):
        inc.merge(start(), rows(SCHEMA, (None, day(1), 1, 2)), "k")


def test_watermark_does_not_depend_on_the_zone_of_the_driver(spark, rows, path, monkeypatch):
    import time

    stamps = rows("k int, t string", (1, "2024-01-01 00:00:00"), (2, "2024-01-01 06:00:00")).withColumn("t", F.col("t").cast("timestamp"))
    for zone in ("America/New_York", "Asia/Tokyo"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            table = Table(spark, path())
            table.overwrite(stamps.where("k = 1"))
            assert [r.k for r in inc.newer_rows(stamps, table, "t").collect()] == [2]
        finally:
            monkeypatch.undo()
            time.tzset()


def test_microbatch_sizes(spark, rows, path):
    hours = spark.range(24 * 40).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"), F.lit(0).alias("v")
    ).withColumn("day", F.to_date("ts"))
    begin, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 10)
    for size, look_back, renewed in (("hour", 3, 4), ("day", 1, 48), ("month", 0, 24 * 9), ("month", 1, 24 * 40), ("year", 0, 24 * 40)):
        table = Table(spark, path(), "day")
        inc.microbatch(table, hours, "ts", begin, end, size=size)
        inc.microbatch(table, hours.withColumn("v", F.lit(1)), "ts", begin, end, look_back=look_back, size=size)
        assert (table.read().count(), table.read().where("v = 1").count()) == (24 * 40, renewed), size
    assert inc.microbatch(Table(spark, path(), "day"), hours, "ts", end, begin) == []


@pytest.mark.parametrize("size", ["day", "hour"])
def test_windows_follow_the_schema_policy(spark, rows, path, size):
    import datetime as dt

    def source(extra, *data):
        return rows("k int, at string" + extra, *data).withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("day", F.to_date("at"))

    begin, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)
    first = source(", gone int", (1, "2024-01-01 01:00:00", 5), (2, "2024-01-02 01:00:00", 6))
    second = source(", extra string", (3, "2024-01-02 02:00:00", "x")).withColumn("k", F.col("k").cast("string"))
    want = {
        "sync_all_columns": [(1, None), (3, "x")] if size == "day" else [(1, None), (2, None), (3, "x")],
        "append_new_columns": [(1, None, 5), (3, "x", None)] if size == "day" else [(1, None, 5), (2, None, 6), (3, "x", None)],
    }
    for policy, result in want.items():
        table = Table(spark, path(), "day")
        inc.microbatch(table, first, "at", begin, end, size=size, on_schema_change=policy)
        start = dt.datetime(2024, 1, 2) if size == "day" else dt.datetime(2024, 1, 2, 2)
        inc.load_window(table, second, "at", start, end, policy)
        names = ["k", "extra"] + (["gone"] if policy == "append_new_columns" else [])
        assert sorted(tuple(r[n] for n in names) for r in table.read().collect()) == result
        assert ("gone" in table.read().columns) == (policy == "append_new_columns")
        assert dict(table.read().dtypes)["k"] == "int"
    with pytest.raises(ValueError):
        inc.load_window(table, second.withColumn("more", F.lit(1)), "at", start, end, "fail")
