import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark import functions as f
from tidemark.functions.dates import SEASON_MONTHS
from tidemark.operators import calendar as cal
from tidemark.sources import readers


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def d(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("start,end,days,months,years", [
    ("2024-01-31", "2024-02-01", 1, 1, 0),
    ("2023-12-31", "2024-01-01", 1, 1, 1),
    ("2024-03-10", "2024-01-15", -55, -2, 0),
])
def test_boundary_counts(spark, start, end, days, months, years):
    row = spark.range(1).select(
        f.days_between(d(start), d(end)), f.months_between_dates(d(start), d(end)), f.years_between(d(start), d(end))
    ).first()
    assert tuple(row) == (days, months, years)


def test_week_starts_on_monday(spark):
    assert one(spark, f.week_start(d("2024-09-01"))) == dt.date(2024, 8, 26)
    assert one(spark, f.day_of_week_number(d("2024-09-01"))) == 0


def test_september_is_fall(spark):
    assert one(spark, f.business_season(d("2024-09-15"))) == "Fall"
    assert sorted(m for ms in SEASON_MONTHS.values() for m in ms) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12]


@pytest.mark.parametrize("days,label", [
    (0, "Halloween Day"), (1, "Week of Halloween"), (7, "Week of Halloween"), (8, "October Pre-Halloween"),
    (30, "October Pre-Halloween"), (31, "2 Months Before"), (60, "2 Months Before"), (61, "Far Out"), (-1, "Post Halloween (2 wks)"),
    (-14, "Post Halloween (2 wks)"), (-15, "Off Season"), (None, "Far Out"),
])
def test_halloween_buckets(spark, days, label):
    assert one(spark, f.halloween_bucket(F.lit(days).cast("int"))) == label


def test_null_falls_through_to_the_last_label(spark):
    none = F.lit(None).cast("int")
    row = spark.range(1).select(
        f.visit_time_of_day(none), f.age_group(none), f.discount_category(none), f.spending_tier(none), f.rating_tier(none)
    ).first()
    assert tuple(row) == ("Night", "55+", "High Discount", "discount", "Not Yet Rated")


def test_concat_and_keys(spark):
    none = F.lit(None).cast("string")
    assert one(spark, f.concat_ws_strict("-", F.lit("a"), none)) is None
    assert one(spark, f.plain_key(F.lit("a"), none)) is None
    assert one(spark, f.surrogate_key(F.lit("a"), none)) is not None
    assert one(spark, f.surrogate_key(F.lit(True)) == F.md5(F.lit("true")))


def test_whole_string_match(spark):
    assert one(spark, f.full_match(F.lit("xaby"), "ab")) is False
    assert one(spark, f.is_valid_email(F.lit("a.b+c@d-e.org"))) is True
    assert one(spark, f.is_valid_email(F.lit("a b@c.org"))) is False


def test_half_up_and_ratio(spark):
    assert one(spark, f.half_up(F.lit(2.345))) == Decimal("2.35")
    assert one(spark, f.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, f.ratio(F.lit(1), F.lit(0), 0.0)) == 0.0


def test_money_sum_is_exact_and_raises_on_overflow(spark):
    cents = spark.range(1000).select(F.lit("0.10").cast("decimal(10,2)").alias("v"))
    assert str(cents.agg(f.money_sum("v")).first()[0]) == "100.00"
    huge = spark.range(200_000).select(F.lit("999999999999.99").cast("decimal(14,2)").alias("v"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        huge.agg(f.money_sum("v")).collect()


def test_round_robin_stays_in_range(spark):
    got = {r[0] for r in spark.range(-5, 5).select(f.round_robin(F.col("id"), F.lit(3))).collect()}
    assert got == {1, 2, 3}


def test_spine_ends(spark):
    assert cal.date_spine(spark, "2020-01-01", "2026-12-31").agg(F.max("date_day"), F.count("*")).first() == (dt.date(2026, 12, 30), 2556)
    assert cal.date_spine_inclusive(spark, "2023-01-01", "2023-12-31").count() == 365
    assert cal.numbered_days(spark, "2023-01-01", 400, "2023-12-31").count() == 365


def test_declared_schema_refuses_null(rows):
    declared = StructType([StructField("a", IntegerType(), False), StructField("b", StringType())])
    assert readers.declare(rows("a string, b string", ("1", None)), declared).first().a == 1
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.declare(rows("a string, b string", (None, "x")), declared).collect()


def test_csv_with_a_bad_value_fails(spark, path):
    target = path("csv")
    spark.createDataFrame([("x",)], "a string").write.option("header", True).csv(target)
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, target, "a int").collect()


def test_unknown_source(spark):
    with pytest.raises(KeyError):
        readers.Sources(spark, {}).table("nope")


@pytest.mark.parametrize(
    ("amounts", "wanted"),
    [(["1.00", "1.01"], "1.01"), (["-0.13", "-0.12"], "-0.13"), (["0.00", "0.01", "0.01"], "0.01"), (["99999999999999.99", "99999999999999.98"], "99999999999999.99")],
)
def test_averages_round_half_away_from_zero(spark, amounts, wanted):
    df = spark.createDataFrame([(Decimal(a),) for a in amounts], "a decimal(18,2)")
    row = df.agg(f.money_mean("a").alias("m"), f.mean("a").alias("n")).first()
    assert (row["m"], row["n"]) == (Decimal(wanted), Decimal(wanted))


def test_quotients_are_exact(spark):
    df = spark.createDataFrame([(Decimal("20000000000000.000001"), 2), (Decimal("-1.000000"), 8), (Decimal("801.000000"), 200), (Decimal("1.000000"), 0)], "t decimal(26,6), b int")
    got = [r[0] for r in df.select(f.quotient(F.col("t"), F.col("b"), 6)).collect()]
    assert got == [Decimal("10000000000000.000001"), Decimal("-0.125000"), Decimal("4.005000"), None]
    assert [r[0] for r in df.select(f.quotient(F.col("t"), F.col("b"))).collect()][1:3] == [Decimal("-0.13"), Decimal("4.01")]
    ties = spark.createDataFrame([(-0.125,), (4.005,), (2.675,), (1e13 + 0.5,)], "d double")
    assert [r[0] for r in ties.select(f.half_up(F.col("d"))).collect()] == [Decimal("-0.13"), Decimal("4.01"), Decimal("2.68"), Decimal("10000000000000.50")]


def test_sums_keep_four_decimals(spark):
    df = spark.createDataFrame([(Decimal("0.0050"),), (Decimal("0.0040"),)], "a decimal(12,4)")
    assert df.agg(f.money_sum("a")).first()[0] == Decimal("0.01")


def test_too_large_an_amount_raises(spark):
    df = spark.createDataFrame([(Decimal(10) ** 25,)], "a decimal(38,0)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(f.quotient(F.col("a"), F.lit(1))).collect()
