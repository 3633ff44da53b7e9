import pytest
from pyspark.sql import functions as F

from tidemark import history
from tidemark.sources.table import CommitConflict

SCHEMA = "k int, a string, b int"


def run(spark, path, frames, **rule):
    kept = history.History(spark, path(), "k", **rule)
    for i, df in enumerate(frames):
        kept.take(df, f"2024-01-{i + 1:02d} 00:00:00")
    return kept


def test_check_strategy(spark, rows, path):
    frames = [
        rows(SCHEMA, (1, "x", 1), (2, None, 2), (3, "z", 3)),
        rows(SCHEMA, (1, "x", 9), (2, "y", 2), (4, "w", 4)),
        rows(SCHEMA, (1, "x", 9), (2, "y", 2), (3, "z", 3), (4, "w", 4)),
    ]
    kept = run(spark, path, frames, check_columns=["a"], hard_deletes=True)
    got = {}
    for r in kept.read().collect():
        got.setdefault(r.k, []).append((r.a, r.dbt_valid_from.day, r.dbt_valid_to.day if r.dbt_valid_to else None))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        1: [("x", 1, None)],
        2: [("y", 2, None), (None, 1, 2)],
        3: [("z", 1, 2), ("z", 3, None)],
        4: [("w", 2, None)],
    }


def test_intervals_are_disjoint_with_one_open_row(spark, path):
    frames = [spark.range(100).select(F.col("id").alias("k"), ((F.col("id") * n) % 7).alias("b")) for n in (1, 2, 3, 2)]
    kept = run(spark, path, frames, check_columns=["b"]).read()
    assert kept.where("dbt_valid_to IS NULL").groupBy("k").count().where("count <> 1").count() == 0
    other = kept.select(*[F.col(c).alias(f"o_{c}") for c in kept.columns])
    overlap = kept.join(other, (F.col("k") == F.col("o_k")) & (F.col("dbt_scd_id") != F.col("o_dbt_scd_id"))).where(
        "dbt_valid_from < coalesce(o_dbt_valid_to, TIMESTAMP_NTZ '9999-01-01') AND o_dbt_valid_from < coalesce(dbt_valid_to, TIMESTAMP_NTZ '9999-01-01')"
    )
    assert overlap.count() == 0


def test_timestamp_strategy_ignores_older_stamps(spark, rows, path):
    schema = "k int, v int, changed timestamp_ntz"
    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    frames = [
        rows("k int, v int, c string", (1, 1, day(5)), (2, 1, day(5))),
        rows("k int, v int, c string", (1, 2, day(4)), (2, 2, day(6))),
    ]
    frames = [f.select("k", "v", F.col("c").cast("timestamp_ntz").alias("changed")) for f in frames]
    assert frames[0].schema.simpleString() == "struct<k:int,v:int,changed:timestamp_ntz>", schema
    kept = run(spark, path, frames, updated_at="changed").read()
    assert sorted((r.k, r.v, r.dbt_valid_to is None) for r in kept.collect()) == [(1, 1, True), (2, 1, False), (2, 2, True)]


def test_closed_rows_are_not_rewritten(spark, rows, path):
    kept = run(spark, path, [rows(SCHEMA, (1, "x", 1)), rows(SCHEMA, (1, "y", 1))], check_columns=["a"])
    before = kept.table.commit_info()["parts"]["slot=0"]
    kept.take(rows(SCHEMA, (1, "z", 1)), "2024-02-01 00:00:00")
    assert kept.table.commit_info()["parts"]["slot=0"][: len(before)] == before


def test_unchanged_open_rows_stay_where_they_are(spark, path):
    source = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("b"))
    kept = run(spark, path, [source], check_columns=["b"])
    before = kept.table.commit_info()["parts"]
    kept.take(source.withColumn("b", F.when(F.col("k") == 5, 99).otherwise(F.col("b"))), "2024-02-01 00:00:00")
    after = kept.table.commit_info()["parts"]
    assert sum(before[n] != after[n] for n in before) == 1 and set(after) - set(before) == {"slot=0"}
    version = kept.table.version()
    assert kept.take(source.withColumn("b", F.when(F.col("k") == 5, 99).otherwise(F.col("b"))), "2024-03-01 00:00:00") == version


def test_keys_must_be_there_once(spark, rows, path):
    for bad in ([(1, "x", 1), (1, "y", 1)], [(None, "x", 1)]):
        kept = run(spark, path, [rows(SCHEMA, (1, "x", 1))], check_columns=["a"])
        with pytest.raises(ValueError):
            kept.take(rows(SCHEMA, *bad), "2024-02-01 00:00:00")
        assert kept.read().count() == 1


def test_an_overtaken_run_is_refused(spark, rows, path, monkeypatch):
    kept = run(spark, path, [rows(SCHEMA, (1, "x", 1))], check_columns=["a"])
    stage = kept.table.stage

    def overtaken(df):
        staged = stage(df)
        monkeypatch.undo()
        kept.take(rows(SCHEMA, (1, "other", 1)), "2024-02-01 00:00:00")
        return staged

    monkeypatch.setattr(kept.table, "stage", overtaken)
    with pytest.raises(CommitConflict):
        kept.take(rows(SCHEMA, (1, "late", 1)), "2024-02-02 00:00:00")
    assert [r.a for r in kept.current().collect()] == ["other"]


def test_missing_columns_are_named(rows):
    with pytest.raises(ValueError, match="nope"):
        history.snapshot(None, rows(SCHEMA, (1, "x", 1)), "k", "2024-01-01 00:00:00", check_columns=["nope"])
    with pytest.raises(ValueError):
        history.snapshot(None, rows(SCHEMA, (1, "x", 1)), "k", "2024-01-01 00:00:00")


def test_columns_come_and_go(spark, rows, path):
    kept = run(spark, path, [
        rows("k int, a string", (1, "x"), (2, "x")),
        rows("k int, extra int, a string", (1, 7, "y"), (2, 8, "x"), (3, 9, "z")),
        rows("a string, k int", ("w", 1), ("x", 2), ("z", 3)),
    ], check_columns=["a"], slots=4)
    got = sorted((r.k, r.a, r.extra, r.dbt_valid_from.day, r.dbt_valid_to.day if r.dbt_valid_to else None) for r in kept.read().collect())
    assert got == [(1, "w", None, 3, None), (1, "x", None, 1, 2), (1, "y", 7, 2, 3), (2, "x", None, 1, None), (3, "z", 9, 2, None)]
    kept.take(rows("k long, a string, more date", (1, "w", None), (2, "x", None), (3, "z", None)), "2024-01-04 00:00:00")
    assert kept.read().schema["k"].dataType.simpleString() == "int" and "more" in kept.read().columns


@pytest.mark.parametrize("slots", [8, 16])
def test_the_stored_side_is_not_moved(spark, path, slots):
    source = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("b"))
    kept = history.History(spark, path(), "k", slots=slots, check_columns=["b"])
    kept.take(source, "2024-01-01 00:00:00")
    table, version = kept.table, kept.table.version()
    with table.bucketed(kept._open_slots(version), version) as stored:
        fresh = history._fresh(source, "k", "2024-02-01 00:00:00", ["b"], None)
        stored = stored.drop("slot")
        plan = kept._changes(stored, fresh, stored.schema, F.lit("2024-02-01").cast("timestamp_ntz"), slots)
        text = plan._jdf.queryExecution().executedPlan().toString()
    join = text[text.index("SortMergeJoin"):]
    stored_side = join[: join.index("FileScan")]
    assert "Exchange" not in stored_side and "Bucketed: true" in join
    assert join.count("Exchange") == 1  # the source, once


def test_slots_follow_the_rows(spark, path, monkeypatch):
    monkeypatch.setattr(history.History, "ROWS_IN_SLOT", 100)
    source = spark.range(950).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("b"))
    kept = history.History(spark, path(), "k", check_columns=["b"])
    kept.take(source, "2024-01-01 00:00:00")
    assert kept.table.count() == 10 and len(kept._open_slots()) == 10
    kept.take(source.withColumn("b", F.lit(1)), "2024-02-01 00:00:00")
    assert kept.current().count() == 950 and kept.read().count() == 950 + source.where("b <> 1").count()
