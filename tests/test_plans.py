"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from registry.base import QUERIES
from __spark_entry__ import oracle_sql, queries

STATEFUL = ("T", "S0", "S1", "snp", "gen", "demo", "L0", "Q16", "Q26", "Q27")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "mart_daily_revenue", "fct_sales", "fct_visits", "agg_customer_lifetime_value", "agg_ride_popularity", "demo_30_visit_windows",
    "W05_dense_rank", "W06_running_sum", "W07_group_average", "W08_global_sequence", "J06_cross_join_one_row", "U03_compare_relations",
    "customer_revenue_retention_summary", "M07_multi_fact", "stg_haunted_tickets", "stg_ticket_types", "agg_visitor_recommendations",
])
def test_no_single_task_and_no_python(spark, small, name):
    text = plan(queries()[name](spark, small))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window may follow an exchange to one partition only over the block sums, one row per block.
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            windows = [above for above in lines[max(0, i - 3):i] if "Window" in above]
            assert all("[_block#" in w for w in windows), f"{name}: window over one partition\n{text}"


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(queries()["S03_event_time_window"](spark, small))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    text = plan(queries()["A01_group_by"](spark, small))
    scan = text[text.index("ReadSchema"):]
    assert "l_comment" not in scan and "l_shipdate" not in scan
    assert "partial_sum" in text


def test_calendar_is_broadcast(spark, small):
    assert "BroadcastHashJoin" in plan(queries()["J01_left_join_dimension"](spark, small))


def test_a_hot_join_key_is_split(spark):
    """A third of the facts share one key; without broadcast the join is split by AQE."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(300_000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"), F.md5(F.col("id").cast("string")).alias("text")
        )
        dims = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        joined = facts.join(dims, "k", "left").groupBy("name").agg(F.count("text"))
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_every_survey_id_is_registered():
    wanted = (
        [f"S{i:02d}" for i in range(1, 15)] + [f"P{i:02d}" for i in range(1, 21)] + [f"J{i:02d}" for i in range(1, 16)]
        + [f"A{i:02d}" for i in range(1, 17)] + [f"W{i:02d}" for i in range(1, 10)] + [f"O{i:02d}" for i in range(1, 5)]
        + [f"U{i:02d}" for i in range(1, 4)] + [f"F{i:02d}" for i in range(1, 36)] + [f"F{i:02d}" for i in range(40, 68)]
        + [f"T{i:02d}" for i in range(1, 24)] + [f"Q{i:02d}" for i in range(1, 29)] + [f"L{i:02d}" for i in range(1, 3)]
        + [f"M{i:02d}" for i in range(1, 8)] + [f"G{i:02d}" for i in range(1, 11)]
    )
    have = {name.split("_")[0] for name in QUERIES}
    assert [w for w in wanted if w not in have] == []
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["fct_sales_with_junk_key", "stg_haunted_tickets", "fct_haunted_tickets", "J08_round_robin"])
def test_facts_are_not_dealt_on_few_keys(spark, small, name):
    """Neither the junk key nor the house of a ticket shuffles the fact, whatever the broadcast limit."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()[name](spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_metrics_are_added_up_before_dimensions_are_joined(spark, small):
    text = plan(queries()["M07_multi_fact"](spark, small))
    joins = [i for i, line in enumerate(text.splitlines()) if "Join" in line and "LeftOuter" in line]
    sums = [i for i, line in enumerate(text.splitlines()) if "partial_sum" in line]
    assert joins and any(i > min(joins) for i in sums)


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith(STATEFUL)))
def test_no_plan_pairs_all_rows(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_distinct_counts_meet_dimensions_after_the_fact_is_reduced(spark, rows):
    from tidemark.metrics import Catalog, Metric, SemanticModel

    visits = spark.range(1000).select((F.col("id") % 10).alias("who"), F.col("id").alias("visit"), (F.col("id") % 3).alias("ride"), F.lit(2).alias("paid"))
    people = spark.range(10).select("id", F.when(F.col("id") % 2 == 0, "even").alias("kind"))
    catalog = Catalog(
        [SemanticModel("visits", visits, {"visit": "visit"}, {"person": "who"}), SemanticModel("people", people, {"person": "id"}, {}, ("kind",))],
        [Metric("rides", "count_distinct", "ride", "visits"), Metric("paid", "sum", "paid", "visits"),
         Metric("share", "derived", "paid / (rides - rides) + paid / rides", inputs=("paid", "rides"))],
    )
    result = catalog.query(["rides", "paid", "share"], ["kind"])
    assert sorted(map(tuple, result.collect()), key=str) == [("even", 3, 1000, None), (None, 3, 1000, None)]
    plan = catalog.query(["rides"], ["kind"])._jdf.queryExecution().optimizedPlan().toString()
    fact = plan[plan.index("Join LeftOuter"):].splitlines()[1]
    assert "Aggregate" in fact, plan


def test_equal_relations_move_digests_only(spark):
    from tidemark.operators import compare

    a = spark.range(5000).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("v"), F.lit(None).cast("long").alias("w"))
    swapped = F.col("id") == 4321  # a NULL and a value change places: only the NULLs tell them apart
    b = a.select("id", F.when(~swapped, F.col("v")).alias("v"), F.when(swapped, F.col("v")).alias("w"))
    same = compare.compare_relations(a, a.orderBy(F.desc("id")), key=["id"], buckets=64)
    assert [tuple(r)[:3] for r in same.collect()] == [(True, True, 5000)]
    text = plan(compare.differing_rows(a, a, ["id"], buckets=64))
    assert "BroadcastHashJoin [_bucket" in text and "LeftSemi" in text
    left, right, equal = compare._differing(a, b, ["id"], ["v", "w"], 64)
    assert left.count() == right.count() < 200 and equal.first()[0] == 5000 - left.count()
    got = compare.compare_relations(a, b, key=["id"], buckets=64).select("in_a", "in_b", "count")
    assert sorted(map(tuple, got.collect())) == [(False, True, 1), (True, False, 1), (True, True, 4999)]
    assert [tuple(r) for r in compare.differing_rows(a, b, ["id"], buckets=64).collect()] == [(4321, "changed")]
    twice = a.unionByName(a)  # pairs of equal rows do not cancel
    assert compare._differing(a, twice, ["id"], ["v", "w"], 64)[2].first()[0] is None
