"""Running totals, ranks and row numbers that split a hot group over many tasks.

A plain window sends each group to one task, and all rows to one task without a group key.
Here a sample of the rows fixes borders in (group, order), so a group is cut into consecutive
blocks. Each block is scanned on its own and then shifted by what precedes it in its group.
A block border cuts at most one group, so only groups that hold a border have shifts, and the
table of shifts has at most two rows for each border and is safe to broadcast.

The block of a row follows from the row and the borders alone. So rows are not stored: they go
through one exchange, on (block, group), and a task run again gives the same blocks. The input
is read up to four times (count, sample, shifts, rows), all but the last with only the columns
of group, order and amount; it must hold the same rows each time, so store it first where it is
costly or drawn at random.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType, TimestampType

from tidemark.functions import as_col
from tidemark.operators.joins import join_same
from tidemark.session import cut

Order = dict[str, Callable[[str], Column]]
BLOCK = "_block"
BLOCK_ROWS = 250_000  # rows of a block, as long as a shuffle partition has no more than four blocks
SAMPLED = 64  # rows in the sample for each block; a block is off its size by an eighth, as a rule

# How a direction sorts: (falling, nulls last).
DIRECTIONS = {
    F.asc: (False, False), F.asc_nulls_first: (False, False), F.asc_nulls_last: (False, True),
    F.desc: (True, True), F.desc_nulls_first: (True, False), F.desc_nulls_last: (True, True),
}


def _sorting(keys: list[str], order: Order) -> Order:
    unknown = [c for c, direction in order.items() if direction not in DIRECTIONS]
    if unknown:
        raise ValueError(f"the direction of {unknown} must be one of {', '.join(d.__name__ for d in DIRECTIONS)}")
    return {**{k: F.asc_nulls_first for k in keys}, **order}


def _literal(df: DataFrame, column: str) -> Column:
    """SQL text that stands for the value."""
    kind, value = df.schema[column].dataType, F.col(column)
    if not isinstance(kind, AtomicType):
        raise ValueError(f"no order for {column} of type {kind.simpleString()}")
    if isinstance(kind, (StringType, BinaryType)):
        text = F.concat(F.lit("X'"), F.hex(value.cast("binary")), F.lit("'"))
    elif isinstance(kind, TimestampType):
        text = F.concat(F.lit("timestamp_micros("), F.unix_micros(value).cast("string"), F.lit(")"))
    else:
        text = F.concat(F.lit("'"), value.cast("string"), F.lit("'"))
    return F.concat(F.lit("CAST("), F.coalesce(text, F.lit("NULL")), F.lit(f" AS {kind.simpleString()})"))


def _borders(df: DataFrame, sorting: Order, rows: int, n: int) -> list[str]:
    """SQL texts of the tuples at which a new block begins, in the order of `sorting`; none if one block holds all rows.

    Equal rows never lie on both sides of a border. The driver sees one tuple for each block.
    """
    blocks = min(math.ceil(n / rows), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if blocks < 2:
        return []
    sample = df.select(*sorting).sample(fraction=min(1.0, SAMPLED * blocks / n), seed=1)
    # About SAMPLED rows for each block, whatever the size of the input: one task ranks them.
    place = Window.orderBy(*[direction(c) for c, direction in sorting.items()])
    parted = sample.withColumn("_part", F.ntile(blocks).over(place)).withColumn("_place", F.row_number().over(place))
    first = Window.partitionBy("_part").orderBy("_place")
    firsts = parted.withColumn("_nth", F.row_number().over(first)).where((F.col("_nth") == 1) & (F.col("_part") > 1))
    fields = [F.concat(F.lit(f"'c{i}',"), _literal(df, c)) for i, c in enumerate(sorting)]
    text = F.concat(F.lit("named_struct("), F.concat_ws(",", *fields), F.lit(")")).alias("text")
    return list(dict.fromkeys(r["text"] for r in firsts.select("_place", text).orderBy("_place").collect()))


def _reached(border: Column, sorting: Order) -> Column:
    """The row is not before the border."""
    reached = F.lit(True)
    for i, (c, direction) in reversed(list(enumerate(sorting.items()))):
        falling, nulls_last = DIRECTIONS[direction]
        theirs, ours = border[f"c{i}"], F.col(c)
        earlier = F.coalesce(theirs > ours if falling else theirs < ours, F.lit(False))
        null_earlier = ours.isNull() & theirs.isNotNull() if nulls_last else theirs.isNull() & ours.isNotNull()
        reached = F.when(earlier | null_earlier, True).when(theirs.eqNullSafe(ours), reached).otherwise(False)
    return reached


def _array(borders: list[str]) -> Column:
    return F.expr(f"array({','.join(borders)})")


def _block(borders: list[str], sorting: Order) -> Column:
    """Number of borders up to the row: first among every w-th border, then among the w - 1 that follow."""
    w = max(2, math.isqrt(len(borders)))
    passed = F.lit(0)
    if len(borders) >= w:
        passed = F.size(F.filter(_array(borders[w - 1 :: w]), lambda b: _reached(b, sorting))) * w
    return passed + F.size(F.filter(F.slice(_array(borders), passed + 1, w - 1), lambda b: _reached(b, sorting)))


class Blocks:
    """How the rows of a frame are cut into consecutive blocks of (keys, order)."""

    def __init__(self, df: DataFrame, keys: list[str], order: Order, rows: int | None = None, n: int | None = None):
        self.df, self.keys, self.order = df, keys, order
        sorting = _sorting(keys, order)
        self.borders = _borders(df, sorting, rows or BLOCK_ROWS, df.count() if n is None else n)
        if self.borders:
            self.number = _block(self.borders, sorting)
        else:  # one block; without keys not a literal, which would be folded and leave a window without partitions
            self.number = F.lit(0) if keys else F.pmod(F.hash(*sorting), F.lit(1))

    def shifts(self, amount: Column) -> DataFrame:
        """What precedes a block in its group, for all blocks of a group but the first."""
        rows = self.df.withColumn(BLOCK, self.number)
        if self.keys:
            held = self.df.sparkSession.range(1).select(F.inline(_array(self.borders)))
            held = held.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(self.keys)]).distinct()
            rows = join_same(rows, F.broadcast(held), self.keys, "left_semi")
        before = Window.partitionBy(*self.keys).orderBy(BLOCK)
        per_block = rows.groupBy(BLOCK, *self.keys).agg(F.sum(amount).alias("_amount"))
        return (
            per_block.withColumn("_nth", F.row_number().over(before))
            .withColumn("_shift", F.sum("_amount").over(before.rowsBetween(Window.unboundedPreceding, -1)))
            .where(F.col("_nth") > 1)
            .select(BLOCK, *self.keys, "_shift")
        )

    def scan(self, rows: DataFrame, amount: Column, out: str) -> DataFrame:
        """Running sum of `amount` in (keys, order) over `rows`: those of the frame, perhaps with more columns."""
        local = (
            Window.partitionBy(BLOCK, *self.keys)
            .orderBy(*[direction(c) for c, direction in self.order.items()])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        scanned = rows.withColumn(BLOCK, self.number).withColumn(out, F.sum(amount).over(local))
        if not self.borders:
            return scanned.drop(BLOCK)
        joined = join_same(scanned, F.broadcast(self.shifts(amount)), [BLOCK, *self.keys])
        shifted = F.coalesce(F.col(out) + F.coalesce(F.col("_shift"), F.lit(0)), F.col("_shift"))
        return joined.withColumn(out, shifted).drop("_shift", BLOCK)


def running_total(df: DataFrame, keys: list[str], order: Order, value: Column | str, out: str) -> DataFrame:
    """Running sum per group, ROWS from the start to the current row.

    End `order` with a unique column: it makes the result repeatable and lets any group split.
    """
    return Blocks(df, keys, order).scan(df, as_col(value), out)


def number_rows(df: DataFrame, order: Order, out: str, keys: list[str] | None = None) -> DataFrame:
    """Row numbers 1..n, over all rows or per group; `order` must end with a unique column."""
    return Blocks(df, keys or [], order).scan(df, F.lit(1).cast("long"), out)


def rank_many(df: DataFrame, ranks: dict[str, Order], keys: list[str] | None = None, dense: bool = False) -> DataFrame:
    """Several ranks over the same columns in different orders, named by `ranks`.

    Only the distinct (group, order) tuples are scanned, with their counts; repeats collapse
    in the partial aggregate before the shuffle. The tuples are stored (narrow, one row for each),
    so the input is read once for them and once for the join back.
    """
    keys = keys or []
    columns = list(dict.fromkeys([*keys, *[c for order in ranks.values() for c in order]]))
    tuples = cut(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")))
    step = F.lit(1).cast("long") if dense else F.col("_rows")
    n = tuples.count()
    ranked = tuples
    for out, order in ranks.items():
        if set(order) | set(keys) != set(columns):
            raise ValueError("the orders must use the same columns")
        reached = Blocks(tuples, keys, order, n=n).scan(ranked, step, "_reached")
        rank = F.col("_reached") if dense else F.col("_reached") - F.col("_rows") + 1
        ranked = reached.withColumn(out, rank).drop("_reached")
    return join_same(df, ranked.drop("_rows"), columns)


def rank_rows(df: DataFrame, order: Order, out: str, keys: list[str] | None = None, dense: bool = False) -> DataFrame:
    """rank() or dense_rank(), over all rows or per group."""
    return rank_many(df, {out: order}, keys, dense)


def with_group_sum(df: DataFrame, keys: list[str], value: str, total: str, count: str) -> DataFrame:
    """Sum and number of a group's values on every row: a small aggregate joined back, not a window over the group."""
    stats = df.groupBy(*keys).agg(F.sum(value).alias(total), F.count(value).alias(count))
    return join_same(df, stats, keys)
