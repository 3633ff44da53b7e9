"""Sinks and physical layout."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType,
)

from tidemark.session import cut
from tidemark.sources.table import Table


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A named lazy query."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_table_as(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Create or replace a table from a query."""
    table = Table(df.sparkSession, path, partition_by)
    table.overwrite(df)
    return table.read()


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """A stored result for this session: computed once, kept in the shared folder."""
    return as_view(cut(df), name)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Order rows so that every file covers a narrow range of the columns and scans can skip files."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


CURVE_BITS = 6  # bits of a range rank; 63 borders for each column


def ordinal(df: DataFrame, column: str) -> Column:
    """A number that never falls as the value rises: days, microseconds, the number itself, or the first six bytes."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, (NumericType, BooleanType)):
        return value.cast("double")
    if isinstance(kind, (StringType, BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise ValueError(f"no order for {column} of type {kind.simpleString()}")


def range_ranks(df: DataFrame, columns: Iterable[str], bits: int = CURVE_BITS) -> list[Column]:
    """For each column the number of borders up to the value; the borders cut its rows into 2**bits about equal parts.

    One pass takes all borders from mergeable quantile summaries; the driver sees 2**bits - 1 numbers a column. A value
    that is more frequent than a part takes several borders at once. NULL has rank 0.
    """
    columns = list(columns)
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(ordinal(df, c), shares, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()

    def rank(value: Column, borders: list[float]) -> Column:
        passed = F.filter(F.array(*[F.lit(float(b)) for b in borders]).cast("array<double>"), lambda border: border <= value)
        return F.size(passed).cast("long")

    return [rank(ordinal(df, c), found[i] or []) for i, c in enumerate(columns)]


def curve(ranks: list[Column], bits: int = CURVE_BITS) -> Column:
    """Place on the Z-order curve: the bits of all ranks in turn, the highest first."""
    if not 0 < len(ranks) * bits <= 62:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit into 62 bits")
    place = F.lit(0).cast("long")
    for level in range(bits):
        for i, rank in enumerate(reversed(ranks)):
            bit = F.shiftright(rank, level).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, level * len(ranks) + i))
    return place


def interleaved(df: DataFrame, *columns: str, files: int | None = None, bits: int = CURVE_BITS) -> DataFrame:
    """Order rows along a space-filling curve, so that every file covers a narrow range of each of the columns.

    `clustered` serves filters on its first column; here a filter on any one of the columns skips files. Rows of one
    cell of the curve are split by their values, so a hot cell does not end in one file. The columns are given back as
    they are; reads the rows twice, the first time only these columns.
    """
    place = "_place"
    while place in df.columns:
        place = f"_{place}"
    placed = df.withColumn(place, curve(range_ranks(df, columns, bits), bits))
    ranged = placed.repartitionByRange(*([files] if files else []), place, *columns)
    return ranged.sortWithinPartitions(place, *columns).drop(place)


def partition_column(date: str, granularity: str = "day") -> Column:
    """The date a row is partitioned by: its day, month, quarter or year."""
    units = {"day": "DD", "month": "month", "quarter": "quarter", "year": "year"}
    if granularity not in units:
        raise ValueError(f"granularity must be one of {', '.join(units)}, not {granularity}")
    day = F.col(date).cast("date")
    return day if granularity == "day" else F.trunc(day, units[granularity])


class EventLog:
    """Append-only event table, one partition per day, with retention."""

    def __init__(self, spark: SparkSession, path: str, ts: str, retention_days: int | None = None):
        self.table = Table(spark, path, partition_by="event_date")
        self.ts, self.retention_days = ts, retention_days

    def append(self, events: DataFrame, tag: tuple[str, int] | None = None) -> None:
        self.table.append(events.withColumn("event_date", F.to_date(self.ts)), tag=tag)

    def expire(self, as_of: dt.date) -> None:
        """Drop whole days older than the retention."""
        if self.retention_days is None:
            return
        oldest = as_of - dt.timedelta(days=self.retention_days)
        kept = {*self.table.partitions_from(oldest), self.table.partition_name(None)}
        old = [p for p in self.table.partitions() if p not in kept]
        if old:
            self.table.drop_partitions(old)

    def read(self) -> DataFrame:
        return self.table.read()
