"""Scans: declared CSV, logical names, event-time windows, inline rows, generated rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with declared types; a value that does not fit its type stops the job."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


class Sources:
    """Logical names over physical tables. Several names may share one scan."""

    def __init__(self, spark: SparkSession, tables: dict[str, str | DataFrame]):
        self._spark = spark
        self._tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"unknown source {name}; known: {', '.join(sorted(self._tables))}")
        found = self._tables[name]
        return self._spark.read.parquet(found) if isinstance(found, str) else found

    def alias(self, name: str, of: str) -> Sources:
        return Sources(self._spark, {**self._tables, name: self._tables[of]})


def event_window(
    df: DataFrame, column: str, start: dt.datetime | str | None = None, end: dt.datetime | str | None = None
) -> DataFrame:
    """Rows with start <= event time < end. Typed literals against the bare column reach the parquet scan."""
    kind = df.schema[column].dataType
    if start is not None:
        df = df.where(F.col(column) >= F.lit(str(start)).cast(kind))
    if end is not None:
        df = df.where(F.col(column) < F.lit(str(end)).cast(kind))
    return df


def inline_rows(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A short constant relation as a VALUES list; columns are col1, col2, ... unless named."""
    def literal(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body}")
    return df.toDF(*names) if names else df


def generated_rows(spark: SparkSession, n: int, name: str = "seq") -> DataFrame:
    """n numbered rows from 0, made on the executors."""
    return spark.range(n).withColumnRenamed("id", name)


def with_variant(df: DataFrame, text: str, out: str) -> DataFrame:
    """Parse a JSON text column into a semi-structured one."""
    return df.withColumn(out, F.parse_json(F.col(text)))


def typed_empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table of a declared schema, NOT NULL columns included."""
    return spark.createDataFrame([], schema)


def declare(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to a declared schema by name and take over its nullability.

    A NULL in a NOT NULL column stops the job, as `assert_true` is part of the expression.
    """
    def column(field):
        value = F.col(field.name).cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        broken = F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}")).cast(field.dataType)
        return F.coalesce(value, broken).alias(field.name)

    return df.select(*[column(f) for f in schema])
