"""Brute force comparison on skewed data that is really cut into many blocks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ranks


@pytest.fixture
def skewed(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BLOCK_ROWS", 100)
    # One group holds a third of the rows, half the values repeat, some are NULL.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id") % 20).alias("g"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7) % 400).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def same(got, wanted):
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, wanted.select("id", "r").collect()))


def test_running_total(skewed):
    over = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), "id").rowsBetween(Window.unboundedPreceding, 0)
    order = {"v": F.desc_nulls_last, "id": F.asc}
    same(ranks.running_total(skewed, ["g"], order, "v", "r"), skewed.withColumn("r", F.sum("v").over(over)))


def test_row_numbers(skewed):
    same(
        ranks.number_rows(skewed, {"v": F.asc_nulls_last, "id": F.asc}, "r"),
        skewed.withColumn("r", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_last(), "id"))),
    )
    same(
        ranks.number_rows(skewed, {"id": F.desc}, "r", keys=["g"]),
        skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("id")))),
    )


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("dense", [False, True])
def test_ranks(skewed, keys, dense):
    over = Window.partitionBy(*keys).orderBy(F.col("v").desc_nulls_first())
    wanted = skewed.withColumn("r", (F.dense_rank() if dense else F.rank()).over(over))
    same(ranks.rank_rows(skewed, {"v": F.desc_nulls_first}, "r", keys, dense), wanted)


def test_group_mean(skewed):
    got = ranks.with_group_sum(skewed, ["g"], "v", "s", "n").withColumn("r", F.col("s") / F.col("n")).drop("s", "n")
    wanted = skewed.withColumn("r", F.avg("v").over(Window.partitionBy("g")))
    assert got.join(wanted.select("id", F.col("r").alias("w")), "id").where(F.abs(F.col("r") - F.col("w")) > 1e-9).count() == 0
    assert got.count() == 3000


def test_a_hot_group_is_cut(skewed):
    cut = ranks.Blocks(skewed, ["g"], {"id": F.asc})
    blocks = skewed.withColumn(ranks.BLOCK, cut.number)
    sizes = blocks.where("g = 0").groupBy(ranks.BLOCK).count().collect()
    assert len(sizes) > 1
    assert blocks.groupBy(ranks.BLOCK).count().agg(F.max("count")).first()[0] < 1000


def test_blocks_follow_the_order(skewed):
    order = {"v": F.desc_nulls_first, "id": F.asc}
    blocks = skewed.withColumn("b", ranks.Blocks(skewed, ["g"], order).number)
    after = Window.orderBy(F.asc_nulls_first("g"), F.desc_nulls_first("v"), "id")
    assert blocks.withColumn("back", F.col("b") < F.lag("b").over(after)).where("back").count() == 0
    assert blocks.agg(F.count_distinct("b")).first()[0] > 20


@pytest.mark.parametrize("kind", ["string", "date", "decimal(20,3)", "double", "timestamp", "binary"])
def test_any_type_can_be_cut(skewed, kind):
    value = {
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v").cast("int")),
        "timestamp": F.timestamp_seconds(F.col("v") * 1000),
        "binary": F.col("v").cast("string").cast("binary"),
    }.get(kind, F.col("v").cast(kind))
    df = skewed.withColumn("t", value)
    order = {"t": F.desc_nulls_last, "id": F.asc}
    over = Window.partitionBy("g").orderBy(F.desc_nulls_last("t"), "id")
    same(ranks.number_rows(df, order, "r", ["g"]), df.withColumn("r", F.row_number().over(over)))


def test_rows_are_shuffled_once_and_not_stored(skewed):
    plan = ranks.running_total(skewed, ["g"], {"v": F.asc, "id": F.asc}, "v", "r")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "rangepartitioning" not in physical
    assert physical.count("Window [sum(v") == 1
    assert "Scan ExistingRDD" not in physical.replace("Scan ExistingRDD[_number", "")


def test_few_rows_are_one_block(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 7)
    plan = ranks.number_rows(df, {"id": F.asc}, "r")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan
    assert ranks.number_rows(df.limit(0), {"id": F.asc}, "r").count() == 0


def test_unknown_direction(skewed):
    with pytest.raises(ValueError, match="direction"):
        ranks.number_rows(skewed, {"id": lambda c: F.col(c)}, "r")
