"""Relation comparison.

With a key, both sides are first reduced to digests of a few thousand buckets of the key, in their own tasks. Digests do
not depend on the order of the rows; only rows of buckets whose digests differ are shuffled and compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import percent
from tidemark.operators.joins import with_totals


BUCKETS = 4096
BUCKET = "_bucket"


def bucket_digests(df: DataFrame, key: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, rows, digests of their values): at most `buckets` rows, whatever the order of the input."""
    # A hash passes over NULLs, so which values are NULL is hashed as well.
    values = [v for c in [*key, *columns] for v in (F.col(c), F.col(c).isNull())]
    one, two = F.xxhash64(*values), F.xxhash64(F.lit(1), *values)
    return df.select(_bucket_of(key, buckets).alias(BUCKET), one.alias("_one"), two.alias("_two")).groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("_rows"), F.bit_xor("_one").alias("_first"), F.bit_xor("_two").alias("_second"),
        F.sum(F.col("_one").bitwiseAND(F.lit((1 << 31) - 1))).alias("_third"),
    )


def _bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets))


def _differing(a: DataFrame, b: DataFrame, key: list[str], columns: list[str], buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of a in buckets that differ, the same of b, number of rows in equal buckets)."""
    left, right = bucket_digests(a, key, columns, buckets), bucket_digests(b, key, columns, buckets)
    names = [c for c in left.columns if c != BUCKET]
    both = left.join(right.withColumnsRenamed({c: f"{c}_b" for c in names}), BUCKET, "full_outer")
    equal = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in names])
    unequal = F.broadcast(both.where(~equal).select(BUCKET))  # at most one row for each bucket

    def kept(df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, _bucket_of(key, buckets)).join(unequal, BUCKET, "left_semi").drop(BUCKET)

    return kept(a), kept(b), both.where(equal).agg(F.sum("_rows").alias("count"))


def compare_relations(
    a: DataFrame, b: DataFrame, exclude: list[str] = (), key: list[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """How many distinct rows lie in both relations or in one of them, with the share of each class.

    Both sides are tagged and grouped by the whole row, so one partial aggregate and one
    shuffle do the work of two set differences and an intersection. With a `key` that is unique on either side, rows
    of buckets with equal digests are counted where they lie.
    """
    skipped = {c.lower() for c in exclude}
    columns = [c for c in a.columns if c.lower() not in skipped]
    missing = [c for c in columns if c not in b.columns]
    if missing:
        raise ValueError(f"columns missing on the second side: {missing}")
    same = None
    if key is not None:
        a, b, same = _differing(a, b, key, [c for c in columns if c not in key], buckets)
    tagged = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    rows = tagged.groupBy(*columns).agg(
        (F.max("_a") == 1).alias("in_a"), (F.max("_b") == 1).alias("in_b")
    )
    summary = rows.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("count"))
    if same is not None:
        counted = same.where("count IS NOT NULL").select(F.lit(True).alias("in_a"), F.lit(True).alias("in_b"), "count")
        summary = summary.unionByName(counted).groupBy("in_a", "in_b").agg(F.sum("count").alias("count"))
    total = summary.agg(F.sum("count").alias("_all"))
    share = percent(F.col("count"), F.col("_all"))
    return with_totals(summary, total).select("in_a", "in_b", "count", share.alias("percent_of_total"))


def differing_rows(a: DataFrame, b: DataFrame, key: list[str], exclude: list[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per key that is missing on a side or whose other columns differ.

    With `buckets`, for sides that are expected to be nearly equal, only rows of buckets whose digests differ are joined.
    """
    skipped = {c.lower() for c in exclude} | {k.lower() for k in key}
    columns = [c for c in a.columns if c.lower() not in skipped]
    if buckets is not None:
        a, b, _ = _differing(a, b, key, columns, buckets)
    left = a.select(*key, F.struct(*columns).alias("_left"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in key], F.struct(*columns).alias("_right"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    joined = left.join(right, on, "full_outer")
    status = (
        F.when(F.col("_right").isNull(), F.lit("only_a"))
        .when(F.col("_left").isNull(), F.lit("only_b"))
        .otherwise(F.lit("changed"))
    )
    changed = ~F.col("_left").eqNullSafe(F.col("_right"))
    return joined.where(changed).select(
        *[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in key], status.alias("status")
    )
