"""Tables cut from their lineage in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import fresh_path

#: Bytes of a row group. A task reads and writes whole ones, so they bound what it holds, and files can be split there.
GROUP = 16 << 20


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write the rows below spark.checkpoint.dir and read them back; later jobs survive lost executors.

    With `by`, rows of one value of that column lie together, and a filter on it reads only those.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd").option("parquet.block.size", GROUP)
    writer = writer.partitionBy(by) if by else writer
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def parts(spark: SparkSession) -> int:
    """Partitions for explicit repartitioning: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets(spark: SparkSession, size: int, each: int = 16 << 20) -> int:
    """Number of partitions for `size` bytes of text: about 16 MB each, and no fewer than the session's."""
    return max(parts(spark), -(-size // each))
