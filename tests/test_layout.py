import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.sources import writers

FILES = 64


def ranges(path, column):
    """(least, greatest) of the column in each file, as the footers tell."""
    out = []
    for name in glob.glob(f"{path}/*.parquet"):
        footer = pq.ParquetFile(name).metadata
        at = footer.schema.names.index(column)
        stats = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        if stats:
            out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def hit(path, column, low, high):
    found = ranges(path, column)
    return sum(a <= high and b >= low for a, b in found) / len(found)


@pytest.fixture
def table(spark):
    n = 40_000
    draw = lambda salt, size: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(size))
    return spark.range(n).select(
        "id", draw(1, 1000).alias("a"), F.date_add(F.lit(dt.date(2020, 1, 1)), draw(2, 900).cast("int")).alias("day"),
        F.concat(F.lit("k"), F.lpad(draw(3, 500).cast("string"), 3, "0")).alias("name"),
        F.lit(1).alias("_place"),
    )


def test_a_filter_on_any_column_skips_files(table, path):
    curve, plain = path("curve"), path("plain")
    writers.interleaved(table, "a", "day", "name", files=FILES).write.parquet(curve)
    table.repartitionByRange(FILES, "a", "day", "name").sortWithinPartitions("a", "day", "name").write.parquet(plain)
    first, last = dt.date(2021, 1, 1), dt.date(2021, 1, 10)
    assert hit(curve, "a", 100, 110) < 0.5 and hit(curve, "day", first, last) < 0.5
    assert hit(curve, "name", "k300", "k304") < 0.6  # 64 files are four parts of each column, and these lie on a border
    assert hit(plain, "day", first, last) > 0.9  # the usual order serves its first column only
    back = table.sparkSession.read.parquet(curve)
    assert back.columns == table.columns and back.exceptAll(table).isEmpty() and table.exceptAll(back).isEmpty()


def test_a_hot_value_is_split(spark, path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("hot"), F.col("id").alias("b"))
    target = path("hot")
    writers.interleaved(rows, "hot", "b", files=16).write.parquet(target)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{target}/*.parquet")]
    assert sum(sizes) == 20_000 and max(sizes) < 20_000 / 4


def test_ranks_follow_the_values(rows):
    df = rows("s string, t timestamp_ntz, d double, f boolean", *[
        (s, dt.datetime(2024, 1, i + 1), i - 2.5, i > 2) for i, s in enumerate(["", "a", "a\u00e9", "b", "zz"])
    ], (None, None, None, None))
    for column in df.columns:
        found = df.select(F.col(column).alias("v"), writers.range_ranks(df, [column], bits=3)[0].alias("r")).collect()
        known = sorted((r.v, r.r) for r in found if r.v is not None)
        assert [r for _, r in known] == sorted(r for _, r in known) and known[0][1] < known[-1][1]
        assert [r.r for r in found if r.v is None] == [0]


def test_curve_takes_the_bits_in_turn(rows):
    df = rows("a long, b long", (0b10, 0b01), (0b11, 0b00), (0, 0b11))
    assert [r[0] for r in df.select(writers.curve([F.col("a"), F.col("b")], bits=2)).collect()] == [0b1001, 0b1010, 0b0101]
    with pytest.raises(ValueError):
        writers.curve([F.col("a")] * 11)


def test_empty_and_unordered(rows):
    empty = rows("a long, b string")
    assert writers.interleaved(empty, "a", "b").collect() == []
    with pytest.raises(ValueError):
        writers.interleaved(rows("a array<int>", ([1],)), "a")
