"""Joins. A side is broadcast by hint only where its size is bounded by construction;
everywhere else Catalyst and AQE choose by measured size and split skewed keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import round_robin


SMALL = 100_000  # rows up to which a side is broadcast


def if_small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """With the hint to broadcast it if it has no more rows than that; one job counts them."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equally named keys with NULL equal to NULL; the left keys survive."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, on), how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def full_outer_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with NULL equal to NULL and one coalesced copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    joined = left.join(renamed, on, "full_outer")
    rest = [c for c in left.columns + right.columns if c not in keys]
    return joined.select(*[F.coalesce(F.col(k), F.col(f"_right_{k}")).alias(k) for k in keys], *rest)


def full_outer_zero(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on one key; the measures of the missing side become zero."""
    joined = left.join(right, key, "full_outer")
    return joined.select(key, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in joined.columns if c != key])


def fill_gaps(spine: DataFrame, facts: DataFrame, key: str, zero: list[str], keep: list[str] = ()) -> DataFrame:
    """Every spine row, with zero for the listed measures where there is no fact."""
    joined = spine.join(facts, key, "left")
    measures = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero]
    return joined.select(*spine.columns, *measures, *keep)


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row, as scalar subqueries: computed once, no join."""
    return df.select("*", *[totals.select(c).scalar().alias(c) for c in totals.columns])


def multiply_rows(df: DataFrame, times: int, number: str) -> DataFrame:
    """`times` children per row, numbered from 1; no join and no shuffle."""
    return df.withColumn(number, F.explode(F.sequence(F.lit(1), F.lit(times))))


def assign_round_robin(df: DataFrame, number: Column, targets: DataFrame, slot: str) -> DataFrame:
    """Spread rows over the numbered targets (1..n in column `slot`).

    Up to SMALL targets are broadcast, so the rows stay where they are and no slot gathers them.
    """
    count = targets.agg(F.count(F.lit(1)).alias("_slots"))
    # With no target the slot is NULL and the inner join leaves nothing, as it should.
    keyed = with_totals(df, count).withColumn(slot, round_robin(number, F.nullif(F.col("_slots"), F.lit(0))))
    return keyed.drop("_slots").join(if_small(targets), slot)


def lookup_upper(df: DataFrame, code: str, names: DataFrame, name: str) -> DataFrame:
    """Look `code` up in a (code, name) table by its upper-case form; unknown codes stay as they are."""
    table = names.toDF("_code", "_name")
    joined = df.join(table, F.upper(F.col(code)) == F.col("_code"), "left")
    return joined.withColumn(name, F.coalesce("_name", code)).drop("_code", "_name")


def with_parent_name(df: DataFrame, key: str, parent: str, name: str, out: str) -> DataFrame:
    """Self join: attach the name of the row that `parent` points to."""
    parents = df.select(F.col(key).alias("_parent_key"), F.col(name).alias(out))
    return df.join(parents, F.col(parent) == F.col("_parent_key"), "left").drop("_parent_key")


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(key).alias("_known"))
    return child.where(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("_known"), "left_anti")


def visible_rows(df: DataFrame, column: str, entitlements: DataFrame, viewer: str, admins: tuple[str, ...] = ()) -> DataFrame:
    """Rows a viewer may see; `entitlements` holds (viewer, value) pairs, admins see all."""
    if viewer in admins:
        return df
    allowed = entitlements.where(F.col("viewer") == viewer).select(F.col("value").alias(column))
    return df.join(allowed, column, "left_semi")
